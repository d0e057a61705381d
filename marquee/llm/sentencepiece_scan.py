"""SentencePiece encoding and decoding as a max-plus parallel scan.

The encoding of a text is the best path through the lattice of its pieces: the
one whose scores add up to the most.  A giant text is cut into chunks of a
fixed length.  A piece may cross a cut, so the state at a cut is how many
characters a piece reaches beyond it, and a chunk is a matrix: entry (a, b) is
the best score from state a at its start to state b at its end.  Max-plus
products are associative; prefix products give the best score of every state
at every cut, and from the end back they tell the best path's state at each.
With its two states a chunk is backtraced independently of the others.

Inside a task the distinct words of many texts are solved together, column by
column, as arrays.

Vocabulary and scores come from a public model file, which is never trained
here: the vocabulary (bounded by the model) is sent to the tasks.  White space
follows the file's rules: a space in front, none removed.  Characters without
a piece are spelt in byte pieces, and so is a literal U+2581: decoding gives back exactly
the text that was encoded.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_key, stage

CHUNK = 1 << 15       # characters; longer texts are cut
CHUNKS = 32           # chunks that are solved at once
CACHED = 150_000      # words whose encoding a task keeps
CACHED_LENGTH = 24
TOGETHER = 1 << 20    # bytes of text that are encoded at once
NEVER = -np.inf
_BASE = np.uint64(0x9E3779B97F4A7C15)


def prefix_hashes(words: list[str], longest: int) -> list[np.ndarray]:
    """Hashes of the first 0, 1, ... characters of words that have at most ``longest``."""
    codes = _codes(words, longest)
    out = [np.zeros(len(words), np.uint64)]
    for j in range(longest):
        out.append(out[-1] * _BASE + codes[:, j] + np.uint64(1))
    return out


def _codes(words: list[str], longest: int) -> np.ndarray:
    return np.array(words, dtype=f"U{longest}").view(np.uint32).reshape(len(words), longest)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of all slices, one slice after another."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


@dataclass(frozen=True)
class Vocabulary:
    """Pieces (a space for the mark U+2581) with id and score; the ids of the 256 byte pieces."""

    pieces: dict[str, tuple[int, float]]
    bytes_: list[int]
    unknown: float        # score of a character that is spelt in bytes

    @cached_property
    def longest(self) -> int:
        return max(map(len, self.pieces), default=1)

    @cached_property
    def by_length(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of each length, the sorted hashes of the pieces, their ids and scores."""
        out = []
        for n in range(1, self.longest + 1):
            same = [p for p in self.pieces if len(p) == n]
            hashes = prefix_hashes(same, n)[n] if same else np.zeros(0, np.uint64)
            order = np.argsort(hashes)
            told = np.array([self.pieces[p] for p in same], float).reshape(-1, 2)[order]
            out.append((hashes[order], told[:, 0].astype(np.int64), told[:, 1]))
        return out

    @cached_property
    def likely(self) -> np.ndarray:
        """Marks at the first 20 bits of the pieces' hashes: most strings that are no piece are told by one look."""
        marks = np.zeros(1 << 20, bool)
        for hashes, _, _ in self.by_length:
            marks[hashes >> np.uint64(44)] = True
        return marks

    @cached_property
    def spelling(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all ids one after another, where each id's begin and how many they are."""
        texts, spelt = {i: p for p, (i, _) in self.pieces.items()}, {i: b for b, i in enumerate(self.bytes_)}
        size = max([*texts, *spelt], default=-1) + 1
        told = [texts[i].encode() if i in texts else bytes([spelt[i]]) if i in spelt else b"" for i in range(size)]
        length = np.array([len(t) for t in told], np.int64)
        return np.frombuffer(b"".join(told), np.uint8), np.cumsum(length) - length, length

    @cached_property
    def words_alone(self) -> bool:
        """No piece has a space behind another character: a word and the spaces before it are solved by themselves."""
        return not any(re.search("[^ ] ", p) for p in self.pieces)

    @cached_property
    def cut(self) -> re.Pattern:
        """A place that no piece crosses: a space behind another character."""
        return re.compile("(?<! ) ")

    @cached_property
    def unit(self) -> re.Pattern:
        return re.compile(" *[^ ]+| +") if self.words_alone else re.compile("(?s).+")


def load_vocabulary(path: str) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, spelt = {}, [0] * 256
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            spelt[int(piece[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            pieces[piece.replace("▁", " ")] = (i, model.get_score(i))
    return Vocabulary(pieces, spelt, min((s for _, s in pieces.values()), default=0.0) - 10.0)


class Encoder:
    """Best paths inside one task; the encodings of words are kept."""

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.known = vocabulary, {}
        self.places: dict[str, int] = {}          # of the words solved together
        self.ids, self.starts = np.zeros(0, np.int32), np.zeros(0, np.int64)
        self.counts, self.scores = np.zeros(0, np.int64), np.zeros(0)

    def forward(self, text: str, entry: list[float], end: int) -> tuple[list[float], list[int]]:
        """Best score of every place and where the piece that ends there starts.

        ``entry`` has the scores of places 0, 1, ...; pieces start before ``end`` and may reach beyond it.
        """
        pieces, longest, unknown = self.v.pieces, self.v.longest, self.v.unknown
        n = len(text)
        score = [NEVER] * (n + 1)
        back = [-1] * (n + 1)
        for i, s in enumerate(entry):
            if i <= n:
                score[i] = s
        for i in range(min(end, n)):
            s = score[i]
            if s == NEVER:
                continue
            for j in range(i + 1, min(n, i + longest) + 1):
                found = pieces.get(text[i:j])
                if found and s + found[1] > score[j]:
                    score[j], back[j] = s + found[1], i
            if text[i] not in pieces and s + unknown > score[i + 1]:
                score[i + 1], back[i + 1] = s + unknown, i
        return score, back

    def trace(self, text: str, back: list[int], at: int) -> tuple[list[int], int]:
        """Ids of the path that ends at a place, and the place where it entered."""
        cuts = [at]
        while back[cuts[-1]] >= 0:
            cuts.append(back[cuts[-1]])
        cuts.reverse()
        ids = []
        for i, j in zip(cuts, cuts[1:], strict=False):
            found = self.v.pieces.get(text[i:j])
            if found:
                ids.append(found[0])
            else:
                ids += [self.v.bytes_[b] for b in text[i:j].encode()]
        return ids, cuts[0]

    def whole(self, unit: str) -> tuple[list[int], float]:
        score, back = self.forward(unit, [0.0], len(unit))
        return self.trace(unit, back, len(unit))[0], score[-1]

    def encode(self, text: str) -> tuple[list[int], float]:
        """Ids and score of a text that begins with its space, unit by unit."""
        ids, total = [], 0.0
        for unit in self.v.unit.findall(text):
            got = self.known.get(unit)
            if got is None:
                got = self.whole(unit)
                if len(unit) <= CACHED_LENGTH and len(self.known) < CACHED:
                    self.known[unit] = got
            ids += got[0]
            total += got[1]
        return ids, total

    def solve(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best paths of many short units at once: all ids, their number in each unit, and scores.

        Column j holds the best way to end at place j of every unit; longer pieces win ties, as in ``forward``.
        """
        lengths = np.array([len(u) for u in units], np.int64)
        order = np.argsort(-lengths, kind="stable")
        sizes, longest, n_units = lengths[order], int(lengths.max()), len(units)
        ordered = [units[i] for i in order]
        hashes, codes = prefix_hashes(ordered, longest), _codes(ordered, longest)
        score = [np.zeros(n_units)]
        back, piece = np.zeros((longest + 1, n_units), np.int8), np.zeros((longest + 1, n_units), np.int32)
        for j in range(1, longest + 1):
            live = int(np.searchsorted(-sizes, -j, side="right"))
            best, single = np.full(live, NEVER), np.zeros(live, bool)
            for n in range(min(j, self.v.longest), 0, -1):
                keys, ids, scores = self.v.by_length[n - 1]
                if not len(keys):
                    continue
                h = hashes[j][:live] - hashes[j - n][:live] * np.uint64(pow(int(_BASE), n, 2**64))
                near = np.flatnonzero(self.v.likely[h >> np.uint64(44)])
                at = np.searchsorted(keys, h[near])
                at[at == len(keys)] = 0
                found = keys[at] == h[near]
                hit, at = near[found], at[found]
                if n == 1:
                    single[hit] = True
                total = score[j - n][hit] + scores[at]
                better = total > best[hit]
                hit = hit[better]
                best[hit], back[j, hit], piece[j, hit] = total[better], n, ids[at[better]]
            alone = np.flatnonzero(~single)
            total = score[j - 1][alone] + self.v.unknown
            better = total > best[alone]
            alone = alone[better]
            best[alone], back[j, alone], piece[j, alone] = total[better], 1, -1 - codes[alone, j - 1].astype(np.int32)
            score.append(best)
        who, at = np.arange(n_units), sizes.copy()
        steps, counts = [], np.zeros(n_units, np.int64)
        while len(who):
            steps.append((who, piece[at, who]))
            counts[who] += 1
            at = at - back[at, who]
            who, at = who[at > 0], at[at > 0]
        ends = np.cumsum(counts)
        flat = np.zeros(int(ends[-1]), np.int32)
        for step, (who, what) in enumerate(steps):
            flat[ends[who] - 1 - step] = what
        totals = np.array([score[n][i] for i, n in enumerate(sizes.tolist())])
        flat, counts = self._spelt(flat, counts)
        starts, rank = np.cumsum(counts) - counts, np.argsort(order, kind="stable")
        return flat[ragged(starts[rank], counts[rank])], counts[rank], totals[rank]

    def _spelt(self, flat: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters without a piece (-1 - code point) replaced by their bytes' ids."""
        strange = np.flatnonzero(flat < 0)
        if not len(strange):
            return flat, counts
        chars, which = np.unique(-1 - flat[strange], return_inverse=True)
        spelt = [[self.v.bytes_[b] for b in chr(c).encode()] for c in chars.tolist()]
        sizes = np.array([len(x) for x in spelt])
        table, begins = np.concatenate(spelt), np.cumsum(sizes) - sizes
        width = np.ones(len(flat), np.int64)
        width[strange] = sizes[which]
        new, ends = np.repeat(flat, width), np.cumsum(width)
        new[ragged(ends[strange] - width[strange], width[strange])] = table[ragged(begins[which], sizes[which])]
        owner = np.repeat(np.arange(len(counts)), counts)
        return new.astype(np.int32), np.bincount(owner, width, len(counts)).astype(np.int64)

    def _learn(self, words: list[str]) -> None:
        """Solve the words that are not kept yet."""
        fresh = [w for w in words if w not in self.places]
        short = [w for w in fresh if len(w) < CACHED_LENGTH]
        long = [w for w in fresh if len(w) >= CACHED_LENGTH]
        parts = [(self.ids, self.counts, self.scores)]
        if short:
            parts.append(self.solve([" " + w for w in short]))
        for w in long:
            ids, total = self.whole(" " + w)
            parts.append((np.array(ids, np.int32), np.array([len(ids)]), np.array([total])))
        self.ids, self.counts, self.scores = (np.concatenate(x) for x in zip(*parts, strict=True))
        self.starts = np.cumsum(self.counts) - self.counts
        first = len(self.places)
        self.places.update((w, first + i) for i, w in enumerate([*short, *long]))

    def encode_many(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of texts (their first space not yet written), the number of ids of each text, and scores."""
        split = pc.split_pattern(texts, " ")
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        if len(self.places) > CACHED:
            self.__init__(self.v)
        self._learn(words)
        at = np.fromiter((self.places[w] for w in words), np.int64, len(words))[coded.indices.to_numpy()]
        offsets = split.offsets.to_numpy()
        offsets = offsets - offsets[0]
        counts = self.counts[at]
        ids = self.ids[ragged(self.starts[at], counts)]
        each = np.diff(np.concatenate(([0], np.cumsum(counts)))[offsets])
        return ids, each, np.diff(np.concatenate(([0.0], np.cumsum(self.scores[at])))[offsets])

    def encode_array(self, texts: pa.Array) -> pa.StructArray:
        """(ids, score) of every text; texts that begin with a space or have several in a row are read unit by unit."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        runs = pc.or_(pc.match_substring(texts, "  "), pc.starts_with(texts, " ")).to_numpy(zero_copy_only=False)
        plain = (sizes > 0) & ~runs & self.v.words_alone
        counts, scores = np.zeros(len(texts), np.int64), np.zeros(len(texts))
        ids: list[np.ndarray] = [np.zeros(0, np.int32)] * len(texts)
        for i in np.flatnonzero(~plain & (sizes > 0)).tolist():
            told, scores[i] = self.encode(" " + texts[i].as_py())
            ids[i], counts[i] = np.array(told, np.int32), len(told)
        where = np.flatnonzero(plain)
        group = np.cumsum(sizes[where]) // TOGETHER
        for g in np.unique(group):
            rows = where[group == g]
            flat, counts[rows], scores[rows] = self.encode_many(texts.take(pa.array(rows)))
            ends = np.cumsum(counts[rows]).tolist()
            for i, a, b in zip(rows.tolist(), [0, *ends], ends, strict=False):
                ids[i] = flat[a:b]
        offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
        flat = np.concatenate([*ids, np.zeros(0, np.int32)])
        return pa.StructArray.from_arrays([pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(scores)], ["ids", "score"])

    def middles(self, chunks: list[str]) -> list[tuple[int, int, np.ndarray, float]]:
        """Of each chunk the first cut that no piece crosses and that lies behind every entry state, the last such
        cut, and ids and score of what is between them, all chunks together; cuts of -1: there is none."""
        cuts = [self._cuts(c) for c in chunks]
        got = self.encode_array(pa.array([c[a + 1:b] if a >= 0 else "" for c, (a, b) in zip(chunks, cuts, strict=True)], pa.string()))
        ids, ends, scores = got.field("ids").values.to_numpy(), got.field("ids").offsets.to_numpy().tolist(), got.field("score").to_pylist()
        return [(*c, ids[s:e], t) for c, s, e, t in zip(cuts, ends[:-1], ends[1:], scores, strict=True)]

    def _cuts(self, chunk: str) -> tuple[int, int]:
        first = self.v.cut.search(chunk, self.v.longest) if self.v.words_alone else None
        if first is None:
            return -1, -1
        last = chunk.rfind(" ")
        while chunk[last - 1] == " ":
            last -= 1
        return first.start(), max(last, first.start())

    def matrix(self, chunk: str, ahead: str, first: int, last: int, middle: float) -> np.ndarray:
        """Scores from every entry state to every exit state; the middle is the same for all of them."""
        size, n, text = self.v.longest, len(chunk), chunk + ahead
        out = np.full((size, size), NEVER)
        if first < 0:
            for a in range(min(size, n + 1)):
                tail = self.forward(text, [NEVER] * a + [0.0], n)[0][n:n + size]
                out[a, :len(tail)] = tail
            return out
        tail = np.array(self.forward(text[last:], [0.0], n - last)[0][n - last:n - last + size])
        for a in range(size):
            score, _ = self.forward(chunk[:first], [NEVER] * a + [0.0], first)
            out[a, :len(tail)] = score[first] + middle + tail
        return out

    def backtrace(self, chunk: str, ahead: str, entry: int, leave: int, first: int, last: int, middle: np.ndarray) -> np.ndarray:
        """Ids of the pieces that start in a chunk, given the states at its two ends."""
        n, text = len(chunk), chunk + ahead
        begin = [NEVER] * entry + [0.0]
        if first < 0:
            return np.array(self.trace(text, self.forward(text, begin, n)[1], n + leave)[0], np.int32)
        lead = self.trace(chunk, self.forward(chunk[:first], begin, first)[1], first)[0]
        tail = self.trace(text[last:], self.forward(text[last:], [0.0], n - last)[1], n - last + leave)[0]
        return np.concatenate((np.array(lead, np.int32), middle, np.array(tail, np.int32)))


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus matrix product."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def _spelling(ids: np.ndarray, vocabulary: Vocabulary) -> bytes:
    data, starts, lengths = vocabulary.spelling
    return data[ragged(starts[ids], lengths[ids])].tobytes()[1:]


def decode(ids: list[int], vocabulary: Vocabulary) -> str:
    return _spelling(np.asarray(ids, np.int64), vocabulary).decode()


def encode_texts(docs: DataFrame, vocabulary: Vocabulary, chunk: int = CHUNK) -> DataFrame:
    """doc_id, text, ids and score for every row of ``docs``; other columns are ignored.

    A null or empty text has no ids and score 0.  Repeated rows are encoded
    alike.  Where several paths are equally good, one of them is taken.
    """
    size = vocabulary.longest
    if chunk < size:
        raise ValueError("a chunk must be at least as long as the longest piece")
    keyed = doc_key(docs)

    def short(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = Encoder(vocabulary)
        for texts in batches:
            yield encoder.encode_array(texts)

    long = F.length("text") >= chunk
    plain = keyed.where(~long).select("doc_id", "text", F.arrow_udf(short, "ids array<int>, score double")("text").alias("e")) \
        .select("doc_id", "text", "e.ids", "e.score")

    marked = keyed.where(long).dropDuplicates(["_key"]).withColumn("marked", F.concat(F.lit(" "), "text"))
    count = F.ceil(F.length("marked") / chunk).cast("int")
    chunks = marked.select("_key", "marked", F.explode(F.sequence(F.lit(0), count - 1)).alias("i")).select(
        "_key", "i", F.substr("marked", F.col("i") * chunk + 1, F.lit(chunk)).alias("part"),
        F.substr("marked", (F.col("i") + 1) * chunk + 1, F.lit(size - 1)).alias("ahead"))
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = stage(chunks.repartition(tasks, "_key", "i"), "chunks")

    def groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return (b.iloc[s:s + CHUNKS] for b in batches for s in range(0, len(b), CHUNKS))

    def matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(vocabulary)
        for b in groups(batches):
            middles = encoder.middles(b["part"].tolist())
            yield pd.DataFrame({"_key": b["_key"], "i": b["i"], "m": [
                encoder.matrix(p, a, x, y, t).tobytes() for p, a, (x, y, _, t) in zip(b["part"], b["ahead"], middles, strict=True)]})

    def scan(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """The best path's states at the cuts of one text: prefix products as vectors, then back from the end."""
        rows = rows.sort_values("i")
        all_ = [np.frombuffer(m).reshape(size, size) for m in rows["m"]]
        vector = np.full((1, size), NEVER)
        vector[0, 0] = 0.0
        before = []
        for m in all_:
            before.append(vector[0])
            vector = product(vector, m)
        states = [0]
        for v, m in zip(before[::-1], all_[::-1], strict=True):
            states.append(int(np.argmax(v + m[:, states[-1]])))
        states.reverse()
        return pd.DataFrame({"_key": key[0], "i": rows["i"].to_numpy(), "entry": states[:-1], "leave": states[1:], "total": vector[0, 0]})

    def traced(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(vocabulary)
        for b in groups(batches):
            middles = encoder.middles(b["part"].tolist())
            yield pd.DataFrame({"_key": b["_key"], "i": b["i"], "total": b["total"], "ids": [
                encoder.backtrace(*x, *m[:3]) for *x, m in zip(b["part"], b["ahead"], b["entry"], b["leave"], middles, strict=True)]})

    states = chunks.select("_key", "i", "part", "ahead").mapInPandas(matrices, "_key long, i int, m binary") \
        .groupBy("_key").applyInPandas(scan, "_key long, i int, entry int, leave int, total double")
    pieces = chunks.join(states, ["_key", "i"]).mapInPandas(traced, "_key long, i int, total double, ids array<int>")
    whole = pieces.groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("i", "ids"))).alias("parts"), F.first("total").alias("score")) \
        .select("_key", F.flatten("parts.ids").alias("ids"), "score")
    giants = keyed.where(long).join(whole, "_key").select("doc_id", "text", "ids", "score")
    return plain.unionByName(giants)


def decode_ids(encoded: DataFrame, vocabulary: Vocabulary, column: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``: the text of the ids."""
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            ends = lists.offsets.to_numpy().tolist()
            ids = lists.values.to_numpy()
            told = [_spelling(ids[a:b], vocabulary) for a, b in zip(ends, ends[1:], strict=False)]
            yield pa.array(told, pa.binary()).cast(pa.string())

    return encoded.withColumn("decoded", F.arrow_udf(run, "string")(column))
