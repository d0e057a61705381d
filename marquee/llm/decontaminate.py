"""Benchmark decontamination by latent semantic retrieval.

Words are hashed to FEATURES features; their document frequencies are counted
over the whole corpus.  The benchmark's TF-IDF passages are dealt into groups
of at most GROUP, and an SVD of each gives the group a basis of its own, as
wide as it must be for every passage to keep ENERGY of its squared length.
Every text is cut into windows of 32 words, half overlapping; a window's
latent vector is compared with those of all items by cosine.  What comes near
is checked on the words themselves: longest common subsequence with the item,
and, where a column gives the item's answer, most of the answer's words must be there too.

An item whose copy could stay under COSINE, because its words are light
beside the rarest ones, is also looked for by an exact join on its words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import separator_table, small_batches, text_of, word_arrays

FEATURES = 1 << 15
GROUP = 256              # passages that share a basis
ENERGY = 0.9             # share of its squared length that every passage keeps in the basis
BLOCK = 16               # words; a window is two blocks
PASSAGE = 64             # words of an item that make one row; longer items have several, half overlapping
COMMON = 0.1             # words in more than this share of the documents weigh nothing
LEAST_RARE = 3           # items with fewer other words have no useful vector: their answer does not count
COSINE = 0.22
LCS = 0.7
ANSWER = 0.6
MOST_ITEMS = 20_000      # items compared in one pass; a larger benchmark is compared in several
SLACK = 0.8              # of COSINE: share of known words below which a window is not projected

LEAKS = "array<struct<item_id:long,cosine:double,lcs:double>>"

SEPARATORS = separator_table([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])


def words_of(texts: Iterable[str | None]) -> Iterator[np.ndarray]:
    return word_arrays(((text or "").lower().encode() for text in texts), SEPARATORS)


def features_of(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(20)).astype(np.int64) % FEATURES


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    """log((n + 1) / (df + 1)) of every feature over all documents, 0 for the COMMON ones."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(FEATURES + 1, np.int64), 0
        for batch in batches:
            for words in words_of(batch["text"]):
                df[np.unique(features_of(words))] += 1
                n += 1
        df[FEATURES] = n
        at = np.flatnonzero(df)
        yield pd.DataFrame({"f": at, "n": df[at]})

    out = np.zeros(FEATURES + 1)
    for f, n in docs.select(text_of().alias("text")).mapInPandas(count, "f long, n long").groupBy("f").agg(F.sum("n")).collect():
        out[f] = n
    return np.where(out[:-1] > COMMON * out[-1] + 1, 0.0, np.log((out[-1] + 2) / (out[:-1] + 1)))


def tf_idf(words: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, n = np.unique(features_of(words), return_counts=True)
    return at, n * idf[at]


def latent_basis(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The features of some (features, unit TF-IDF) passages and, as one row of each, the right singular vectors that ENERGY asks for."""
    used = np.unique(np.concatenate([at for at, _ in rows]))
    a = np.zeros((len(rows), len(used)))
    for i, (at, x) in enumerate(rows):
        a[i, np.searchsorted(used, at)] = x
    u, d, v = np.linalg.svd(a, full_matrices=False)
    kept = np.cumsum((u * d) ** 2, axis=1)
    rank = 1 + int((kept < ENERGY * kept[:, -1:]).sum(axis=1).max())
    return used, np.ascontiguousarray(v[:rank].T)


class Latent:
    """The basis of a group of passages, and their latent vectors."""

    def __init__(self, rows: list[tuple[int, np.ndarray, np.ndarray]], idf: np.ndarray):
        self.item = [i for i, _, _ in rows]
        used, basis = latent_basis([row[1:] for row in rows])
        self.latent = np.array([x @ basis[np.searchsorted(used, at)] for _, at, x in rows], np.float32)
        self.place = np.full(FEATURES, -1, np.int32)
        self.place[used] = np.arange(len(used))
        self.basis = (basis * idf[used, None]).astype(np.float32)


def common_subsequence(masks: dict[int, int], length: int, words: list[int]) -> int:
    """Length of the longest common subsequence; ``masks`` has the places of each word of the item as bits."""
    full = (1 << length) - 1
    s = full
    for w in words:
        if m := masks.get(w):
            u = s & m
            s = ((s + u) | (s - u)) & full
    return length - s.bit_count()


class Items:
    """A block of benchmark items, ready to be compared."""

    def __init__(self, rows: list[tuple[int, str, str | None]], idf: np.ndarray):
        self.idf2 = (idf ** 2).astype(np.float32)
        self.ids, self.masks, self.lengths, self.answers = [], [], [], []
        self.passages: list[tuple[int, np.ndarray, np.ndarray]] = []
        self.light: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}   # items of the exact join, with their passages
        heaviest = float(self.idf2.max(initial=0))
        for item, text, answer in rows:
            words, told = words_of([text, answer])
            if not len(words):
                continue
            masks: dict[int, int] = {}
            for i, w in enumerate(words.tolist()):
                masks[w] = masks.get(w, 0) | 1 << i
            told, own = told.tolist(), []
            sure = np.count_nonzero(idf[np.unique(features_of(words))]) >= LEAST_RARE
            if not sure:
                told = []       # compared by its words alone
            for s in range(0, max(1, len(words) - PASSAGE // 2), PASSAGE // 2):
                at, x = tf_idf(words[s:s + PASSAGE], idf)
                at, x = at[x > 0], x[x > 0]
                if norm := np.linalg.norm(x):
                    own.append((at, x / norm))
                    sure = sure and self._least_cosine(words[s:s + PASSAGE], norm, heaviest) >= COSINE / ENERGY
            self.passages += [(len(self.ids), at, x) for at, x in own]
            if not sure:
                self.light[len(self.ids)] = [(at, (x * idf[at]).astype(np.float32)) for at, x in own]
            self.ids.append(item)
            self.masks.append(masks)
            self.lengths.append(len(words))
            self.answers.append(frozenset(told))
        self.groups = [Latent(self.passages[i:i + GROUP], idf) for i in range(0, len(self.passages), GROUP)]
        self._index()

    def _least_cosine(self, words: np.ndarray, norm: float, heaviest: float) -> float:
        """Of a window that holds LCS of any BLOCK words of a passage, beside BLOCK of the heaviest words."""
        sums = np.concatenate(([0], np.cumsum(self.idf2[features_of(words)], dtype=np.float64)))
        n = min(BLOCK, len(words))
        part = LCS * float((sums[n:] - sums[:-n]).min())
        return part / (norm * np.sqrt(part + BLOCK * heaviest)) if part else 0.0

    def _index(self) -> None:
        """Of the words of the light items: which items have them, and how often."""
        w = [(word, i, mask.bit_count()) for i in self.light for word, mask in self.masks[i].items()]
        words = np.array([x[0] for x in w], np.uint64)
        order = np.argsort(words, kind="stable")
        self.vocabulary, first = np.unique(words[order], return_index=True)
        self.first = np.concatenate((first, [len(w)])).astype(np.int64)
        self.having = np.array([x[1] for x in w], np.int64)[order]
        self.times = np.array([x[2] for x in w], np.int64)[order]
        self.least = np.array([LCS * m for m in self.lengths])

    def find(self, words: np.ndarray) -> list[tuple[int, float, float]]:
        """(item, cosine, share of the item's words in common order), each item once."""
        if not (len(words) and self.ids):
            return []
        best: dict[int, tuple[float, float]] = {}
        for found in (self._near(words), self._exact(words)):
            for i, (cosine, share) in found:
                old = best.get(i, (0.0, 0.0))
                best[i] = (max(cosine, old[0]), max(share, old[1]))
        return [(self.ids[i], *best[i]) for i in sorted(best)]

    def _exact(self, words: np.ndarray) -> Iterator[tuple[int, tuple[float, float]]]:
        """Cosine and common share of the light items: of all that have LCS of their words in the text, whatever their weight."""
        if not len(self.vocabulary):
            return
        distinct = np.unique(words)
        at = np.minimum(np.searchsorted(self.vocabulary, distinct), len(self.vocabulary) - 1)
        at = at[self.vocabulary[at] == distinct]
        n = self.first[at + 1] - self.first[at]
        if not len(at):
            return
        places = np.repeat(self.first[at] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        common = np.bincount(self.having[places], self.times[places], len(self.ids))
        present = None
        for i in np.flatnonzero((common > 0) & (common >= self.least)).tolist():
            answer, m = self.answers[i], self.lengths[i]
            present = present or set(distinct.tolist())
            if len(answer & present) < ANSWER * len(answer):
                continue
            held = np.concatenate(([0], np.cumsum(np.isin(words, np.array(list(self.masks[i]), np.uint64)))))
            starts = np.arange(0, len(words), m)
            starts = starts[held[np.minimum(starts + 2 * m, len(words))] - held[starts] >= LCS * m]
            share = 0.0
            for s in starts.tolist():
                region = words[s:s + 2 * m].tolist()
                if len(answer.intersection(region)) >= ANSWER * len(answer):
                    share = max(share, common_subsequence(self.masks[i], m, region) / m)
            if share >= LCS:
                yield i, (self._cosine(words, i), share)

    def _cosine(self, words: np.ndarray, i: int) -> float:
        """The greatest cosine of a window with a passage of a light item."""
        f = features_of(words)
        cuts = np.arange(0, len(words), BLOCK)

        def windows(x: np.ndarray) -> np.ndarray:
            sums = np.append(np.add.reduceat(x, cuts), 0)
            return (sums[:-1] + sums[1:])[:max(1, len(cuts) - 1)]

        whole, best = np.sqrt(windows(self.idf2[f])), 0.0
        for at, x in self.light[i]:
            weights = np.zeros(FEATURES, np.float32)
            weights[at] = x
            best = max(best, float((windows(weights[f])[whole > 0] / whole[whole > 0]).max(initial=0)))
        return best

    def _near(self, words: np.ndarray) -> Iterator[tuple[int, tuple[float, float]]]:
        """Cosine and common share of the items found by their vectors.

        A window is projected only if the words that the basis knows have enough
        of its weight; else its cosine cannot reach the limit.
        """
        features = features_of(words)
        cuts = np.arange(0, len(words), BLOCK)
        weight = self.idf2[features]
        every = np.append(np.add.reduceat(weight, cuts), np.float32(0))
        k = max(1, len(cuts) - 1)
        whole = (every[:-1] + every[1:])[:k]
        present, tried, enough = None, set(), {}
        for group in self.groups:
            f = group.place[features]
            known = np.flatnonzero(f >= 0)
            if not len(known):
                continue
            places = known // BLOCK
            first = np.flatnonzero(np.concatenate(([True], places[1:] != places[:-1])))
            places, f = places[first], f[known]
            part = np.zeros(len(cuts) + 1, np.float32)
            part[places] = np.add.reduceat(weight[known], first)
            part = (part[:-1] + part[1:])[:k]
            near = np.flatnonzero((whole > 0) & (part >= (SLACK * COSINE) ** 2 * whole))
            if not len(near):
                continue
            sums = np.zeros((len(cuts) + 1, group.basis.shape[1]), np.float32)
            sums[places] = np.add.reduceat(group.basis[f], first, axis=0)
            cosine = (sums[near] + sums[near + 1]) @ group.latent.T / np.sqrt(whole[near])[:, None]
            for w, passage in zip(*(x.tolist() for x in np.nonzero(cosine >= COSINE)), strict=True):
                i, at = group.item[passage], int(near[w])
                present = present or set(words.tolist())
                answer, m = self.answers[i], self.lengths[i]
                if (i, at) in tried or len(answer & present) < ANSWER * len(answer):
                    continue
                if i not in enough:     # the whole text must have as many of the item's words
                    enough[i] = sum(mask.bit_count() for word, mask in self.masks[i].items() if word in present) >= LCS * m
                if not enough[i]:
                    continue
                tried.add((i, at))
                region = words[max(0, at * BLOCK - m):(at + 2) * BLOCK + m].tolist()
                if len(answer.intersection(region)) < ANSWER * len(answer) or sum(map(self.masks[i].__contains__, region)) < LCS * m:
                    continue
                share = common_subsequence(self.masks[i], m, region) / m
                if share >= LCS:
                    yield i, (float(cosine[w, passage]), share)


def _finder(items: Items):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out = []
            for words in words_of(texts):
                each: dict[int, tuple[float, float]] = {}
                for item, cosine, lcs in items.find(words):
                    old = each.get(item, (0.0, 0.0))
                    each[item] = (max(old[0], cosine), max(old[1], lcs))
                out.append([{"item_id": i, "cosine": c, "lcs": s} for i, (c, s) in each.items()])
            yield pd.Series(out, dtype=object)

    return run


def find_leaks(docs: DataFrame, benchmark: DataFrame, answer: str | None = None) -> DataFrame:
    """All columns of ``docs`` and ``leaks``: array of (item_id, cosine, lcs), empty for a clean document.

    ``docs`` has a column text; a column leaks is replaced.  Null and empty
    texts are clean.  Items without words, or with a null id, are left out;
    an item id given more than once is matched by any of its texts, and
    reported once.  Repeated rows get the same leaks.  An empty benchmark
    leaves everything clean.

    The items of one pass are bounded (MOST_ITEMS); a larger benchmark is
    dealt into as many blocks as it needs, each compared with all texts.
    """
    small_batches(docs.sparkSession)
    told = benchmark.where("item_id is not null").select(
        F.col("item_id").cast("long").alias("item_id"), text_of().alias("text"),
        (F.col(answer) if answer else F.lit(None)).cast("string").alias("answer"))
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "leaks"]
    idf = inverse_frequencies(docs)
    blocks = max(1, -(-told.count() // MOST_ITEMS))
    found = F.array().cast(LEAKS)
    for k in range(blocks):
        rows = sorted(map(tuple, told.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).collect()), key=lambda r: (r[0], r[1]))
        items = Items(rows, idf)
        found = F.concat(found, F.pandas_udf(_finder(items), LEAKS)(text_of()))
    return docs.select(*kept, found.alias("leaks"))
