"""Packing documents into training sequences by patterns of lengths.

Every document becomes token ids and an end mark; one longer than a sequence is
cut into full pieces behind a first one that may be shorter.  Only how many
pieces of each length there are matters for the packing, and that histogram
has one number a length, whatever the corpus.

Patterns.  All multisets of at most DEPTH lengths that fill a sequence exactly are
enumerated.  How often each is repeated is fitted to the histogram by least
squares under x >= 0 (accelerated projected gradients; a pattern is three
places in the histogram, so a step is one gather and one scatter).  The fit aims
at SHARE of every length: what rounding leaves over then has pieces of all
lengths to be filled up with.  Rounding carries its error on to the next
pattern and takes no more than there is.  The rest is packed on the histogram
too: longest first, each length into the fullest open sequences it fits, a
group of alike sequences at a time.

Places.  A pattern repeated c times takes c pieces of each of its lengths, so
a piece's sequence and offset follow from its rank among the pieces of its
length.  Ranks are the place within a task plus the earlier tasks' counts:
only counts are summed, no length is one group, and pieces stay where they are.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import plain, small_batches, stage, text_of

ROOM = 1024
END = 2
DEPTH = 3
SHARE = 0.85
STEPS = 400
BATCH = 500

SPECIAL = "<|endoftext|>"   # the vocabulary's only special token: texts that hold it are left to its own library


@lru_cache(maxsize=2)
def encoder(vocabulary: str, ranks: str):
    """text -> token ids of the vocabulary file.

    ``ranks`` holds the same vocabulary for a quicker library; texts that name the
    special token, or that the quicker library gives up on, go to the vocabulary's own one.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(vocabulary)
    with open(ranks, "rb") as lines:
        quick = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                  mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)})

    def encode(text: str) -> list[int]:
        if SPECIAL not in text:
            try:
                return quick.encode_ordinary(text)
            except BaseException as e:      # very long white space: its stack of open matches is bounded
                if type(e).__name__ != "PanicException":
                    raise
        return slow.encode(text, add_special_tokens=False).ids

    return encode


def vocabulary_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def pieces(docs: DataFrame, room: int = ROOM, keep_ids: bool = False, files: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids), with the task and the place among its pieces of that length."""
    small_batches(docs.sparkSession, BATCH)
    vocabulary = files or vocabulary_files()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, seen, task = encoder(*vocabulary), [0] * (room + 1), TaskContext.get().partitionId()
        for batch in batches:
            out = []
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.array([*encode(text), END], "<u4")
                first = (len(ids) - 1) % room + 1
                for piece, end in enumerate(range(first, len(ids) + 1, room)):
                    start = max(end - room, 0)
                    held = ids[start:end]
                    n = end - start
                    out.append((doc, piece, start, n, zlib.crc32(held), task, seen[n], *([held.astype(np.int32)] if keep_ids else [])))
                    seen[n] += 1
            yield plain(pd.DataFrame(out, columns=names))

    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth", *(["ids"] if keep_ids else [])]
    kind = "doc_id string, piece int, start long, length long, ids_crc32 long, task int, nth long" + ", ids array<int>" * keep_ids
    # ids of documents travel as text: pandas turns integers with nulls among them into rounded floats
    found = docs.select(F.col("doc_id").cast("string").alias("doc_id"), text_of().alias("text")).mapInPandas(run, kind)
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def exact_patterns(lengths: np.ndarray, room: int, depth: int = DEPTH) -> np.ndarray:
    """Multisets of 2 to ``depth`` of the lengths that sum to ``room``: rows of falling lengths, filled up with 0."""
    there = np.zeros(room + 1, bool)
    there[lengths] = True
    done, open_rows = [], np.zeros((1, 0), np.int64)
    for d in range(1, depth + 1):
        last = open_rows[:, -1] if d > 1 else np.array([room])
        rest = room - open_rows.sum(1)
        if d > 1:       # close with one length more, no longer than the last
            close = (rest > 0) & (rest <= last) & there[np.clip(rest, 0, room)]
            rows = np.column_stack((open_rows[close], rest[close]))
            done.append(np.pad(rows, ((0, 0), (0, depth - d))))
        if d < depth:
            at, to = np.nonzero((lengths[None, :] <= last[:, None]) & (lengths[None, :] < rest[:, None]))
            open_rows = np.column_stack((open_rows[at], lengths[to]))
    return np.concatenate(done) if done else np.zeros((0, depth), np.int64)


def fit_repeats(patterns: np.ndarray, histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """x >= 0 with the least squared distance between the lengths that x patterns use and the histogram."""
    size = len(histogram)

    def used(x: np.ndarray) -> np.ndarray:
        out = np.zeros(size)
        for column in patterns.T:
            out += np.bincount(column, x, size)
        out[0] = 0      # filling
        return out

    def back(r: np.ndarray) -> np.ndarray:
        return r[patterns].sum(1)

    v = np.ones(len(patterns))
    for _ in range(20):     # the largest eigenvalue bounds the step
        w = back(used(v))
        norm = np.linalg.norm(w)
        v = w / norm
    step = 1 / (1.05 * norm)
    x = y = np.zeros(len(patterns))
    t = 1.0
    goal = np.array(histogram, float)
    goal[0] = 0
    for _ in range(steps):
        new = np.maximum(0, y - step * back(used(y) - goal))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        if np.dot(y - new, new - x) < 0:     # overshoot: start the momentum afresh
            y, t_new = new, 1.0
        x, t = new, t_new
    return x


def whole(x: np.ndarray) -> np.ndarray:
    """Whole numbers whose running sums are the rounded ones of x."""
    return np.diff(np.floor(np.cumsum(x) + 0.5), prepend=0).astype(np.int64)


def round_repeats(patterns: np.ndarray, x: np.ndarray, histogram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole repeats that the histogram can pay for, and what it has left.

    No two lengths over half a sequence share one.  If more of those are left than the rest could fill
    up, sequences without one are given back, evenly.
    """
    wanted = whole(x)
    left, out = histogram.astype(np.int64).tolist(), np.zeros(len(patterns), np.int64)
    for i in np.flatnonzero(wanted):
        lengths = [n for n in patterns[i].tolist() if n]
        c = min(int(wanted[i]), *(left[n] // lengths.count(n) for n in lengths))
        if c > 0:
            out[i] = c
            for n in lengths:
                left[n] -= c
    left, room, size = np.array(left), len(histogram) - 1, np.arange(len(histogram))
    short = 1.05 * left[room // 2 + 1:].sum() - (left * size).sum() / room
    small = np.where(patterns.max(1) <= room // 2, out, 0)
    if short > 0 and small.any():
        back = np.minimum(whole(small * min(1, short / small.sum())), out)
        left += sum(np.bincount(column, back, len(histogram)).astype(np.int64) for column in patterns.T)
        left[0] = 0
        out -= back
    return out, left


def pack_rest(histogram: np.ndarray, room: int) -> list[tuple[list[int], int]]:
    """(lengths of a sequence, how many such) by best fit of falling lengths, alike sequences at a time."""
    open_by_space: dict[int, list[tuple[list[int], int]]] = {}

    def put(lengths: list[int], n: int, count: int, space: int) -> None:
        if count:
            open_by_space.setdefault(space, []).append((lengths + [n] if n else lengths, count))

    for length in range(room, 0, -1):
        c = int(histogram[length])
        while c:
            space = min((s for s in open_by_space if s >= length), default=room)
            groups = open_by_space.get(space)
            lengths, count = groups.pop() if groups else ([], c)
            if groups == []:
                del open_by_space[space]
            fits = space // length
            full = min(count, c // fits)
            part = c - full * fits if full < count else 0
            put(lengths + [length] * (fits - 1), length, full, space - fits * length)
            if part:
                put(lengths + [length] * (part - 1), length, 1, space - part * length)
            unused = count - full - (part > 0)
            if lengths:
                put(lengths, 0, unused, space)
            c -= full * fits + part
    return [g for groups in open_by_space.values() for g in groups]


def plan(histogram: np.ndarray, room: int = ROOM, depth: int = DEPTH) -> list[tuple[list[int], int]]:
    """(lengths of a sequence in order, how many such sequences) that use up the histogram."""
    patterns = exact_patterns(np.flatnonzero(histogram[:room]), room, depth)
    out, left = [([room], int(histogram[room]))] if histogram[room] else [], histogram.copy()
    left[room] = 0
    if len(patterns):
        repeats, left = round_repeats(patterns, fit_repeats(patterns, SHARE * left), left)
        out += [([n for n in patterns[i].tolist() if n], int(repeats[i])) for i in np.flatnonzero(repeats)]
    return out + pack_rest(left, room)


def runs(planned: list[tuple[list[int], int]]) -> tuple[np.ndarray, ...]:
    """For each run of ranks of a length: its key (length << 40 | first rank), first sequence and offset; sorted by key."""
    taken: dict[int, int] = {}
    key, first, offset, sequence = [], [], [], 0
    for lengths, count in planned:
        at = 0
        for n in lengths:
            key.append((n << 40) | taken.get(n, 0))
            first.append(sequence)
            offset.append(at)
            taken[n] = taken.get(n, 0) + count
            at += n
        sequence += count
    order = np.argsort(np.array(key, np.int64))
    return tuple(np.array(a, np.int64)[order] for a in (key, first, offset))


def pack(docs: DataFrame, room: int = ROOM, keep_ids: bool = False, files: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids) of every piece of every row of ``docs``.

    Sequences hold at most ``room`` ids; offsets of a sequence's pieces follow
    each other without a gap.  A null text is empty: one piece, the end mark
    alone.  Repeated rows and shared or null ids are documents of their own; an
    empty table has no pieces; other columns are ignored.  Pieces of the same
    length are dealt in the order of the tasks that made them.

    The histogram (``room`` numbers) and the plan (a row for each pattern used) pass
    through the driver; both are bounded by ``room`` and ``DEPTH`` alone.
    """
    told = stage(pieces(docs, room, keep_ids, files), "pieces")
    counts = told.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = np.zeros(room + 1, np.int64)
    for length, n in counts.groupBy("length").agg(F.sum("n")).collect():
        histogram[length] = n
    key, first, offset = runs(plan(histogram, room))

    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    ranked = told.join(starts, ["task", "length"]).withColumn("rank", F.col("earlier") + F.col("nth"))

    @F.pandas_udf("struct<sequence_id:long,offset:long>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        asked = (length.to_numpy(np.int64) << 40) | rank.to_numpy(np.int64)
        at = np.searchsorted(key, asked, side="right") - 1
        return pd.DataFrame({"sequence_id": first[at] + asked - key[at], "offset": offset[at]})

    return ranked.withColumn("_at", place("length", "rank")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "_at.sequence_id", "_at.offset", *(["ids"] if keep_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids and the pieces' lengths (for masks that keep documents apart) from ``pack(..., keep_ids=True)``.

    A sequence holds at most ``room`` ids, so every group is bounded.
    """
    held = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "length", "doc_id", "ids"))).alias("_p"))
    return held.select("sequence_id", F.flatten("_p.ids").alias("ids"), F.col("_p.length").alias("lengths"), F.col("_p.doc_id").alias("doc_ids"))
