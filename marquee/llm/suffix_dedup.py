"""Exact substring deduplication by column-wise sorting of suffixes.

Every byte is removed that lies in a string of LENGTH bytes which starts anywhere
else too.  Sorting all suffixes of a corpus in one place does not scale, so
the collection is first cut into small ones that cannot share such a string:

1. Each window of LENGTH bytes is given an *anchor*: the LENGTH / 2 bytes in it
   with the least hash, the leftmost of equals.  Equal windows have equal anchors at equal
   offsets, and windows of one anchor occurrence make one *segment*.  Anchors
   that occur once cannot hold a repeat and are dropped (counted with partial
   sums).  Equal segments are merged by digest; those that occur twice are
   repeated as a whole.
2. What is left are different segments of one anchor.  They are laid under
   each other by their anchors and sorted column by column, from the last to the first:
   a round inserts one symbol of every segment, a stable sort by that symbol
   turns the order of the suffixes behind it into the new order, and the common
   prefixes follow as one more than the least over the range between two
   old neighbours.  A run of common prefixes of LENGTH or more is a repeated string.
   The rounds are bounded by a segment's length, a collection by COLLECTION segments; its
   rows arrive from, and results leave to, tables in the shared folder.
3. An anchor with more segments than CHUNK is dealt over several collections.
   Each reports its different strings once, and their digests are summed over
   the collections, so no anchor, however hot, meets in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_key, mix, plain, prefix_hash, slice_hash, spans_of, stage

LENGTH = 200
CHUNK = 512           # segments of one anchor that are sorted together
COLLECTION = 4096     # segments that are sorted together
BUCKETS = 1 << 18     # bound of the broadcast pre-filter of documents whose text is needed


def _slide(x: np.ndarray, width: int, op: np.ufunc) -> np.ndarray:
    """op over every ``width`` neighbours, by doubling."""
    size = 1
    while size * 2 <= width:
        x = op(x[:-size], x[size:])
        size *= 2
    return op(x[:len(x) - (width - size)], x[width - size:]) if width > size else x


def segments(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, anchor place, first and last window start of every segment of a text."""
    half = length // 2
    n = len(data)
    if n < length:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    sums = prefix_hash(np.frombuffer(data, np.uint8))
    starts = np.arange(n - half + 1)
    h = mix(slice_hash(sums, starts, starts + half))
    width = length - half + 1
    least = _slide(h, width, np.minimum)
    pad = np.zeros(width - 1, np.uint64)
    top = _slide(np.concatenate((pad, least, pad)), width, np.maximum)
    anchors = np.flatnonzero(top == h)
    at = np.searchsorted(anchors, np.arange(len(least)))
    wrong = np.flatnonzero(h[anchors[at]] != least)
    while len(wrong):
        at[wrong] += 1
        wrong = wrong[h[anchors[at[wrong]]] != least[wrong]]
    edges = np.flatnonzero(at[1:] != at[:-1]) + 1
    first = np.concatenate(([0], edges))
    last = np.concatenate((edges - 1, [len(at) - 1]))
    places = anchors[at[first]]
    return h[places].view(np.int64), places, first, last


def _anchor_counts(docs: DataFrame, length: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [segments(t.encode(), length)[0] for t in batch["text"]]
            anchors, n = np.unique(np.concatenate([*found, np.zeros(0, np.int64)]), return_counts=True)
            yield pd.DataFrame({"anchor": anchors, "n": n})

    return docs.select("text").mapInPandas(run, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))


def _segments(docs: DataFrame, length: int) -> DataFrame:
    """(anchor, digest, _key, place): place packs first window, run and the anchor's offset."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for key, text in zip(batch["_key"], batch["text"], strict=True):
                data = text.encode()
                anchor, at, first, last = segments(data, length)
                digests = [int.from_bytes(hashlib.blake2b(data[a:b], digest_size=8).digest(), "little", signed=True)
                           for a, b in zip(first.tolist(), (last + length).tolist(), strict=True)]
                parts.append((anchor, np.array(digests, np.int64), np.full(len(anchor), key, np.int64),
                              first << 20 | (last - first) << 10 | (at - first)))
            yield pd.DataFrame(dict(zip(("anchor", "digest", "_key", "place"), map(np.concatenate, zip(*parts, strict=True)), strict=True))) \
                if parts else pd.DataFrame({c: np.zeros(0, np.int64) for c in ("anchor", "digest", "_key", "place")})

    return docs.select("_key", "text").mapInPandas(run, "anchor long, digest long, _key long, place long")


def repeated_windows(rows: list[bytes], offsets: list[int], length: int = LENGTH) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Column by column, from the last: (window column, segments in order, group of each).

    ``rows`` are segments whose anchors begin at ``offsets``; only segments
    with a whole window at the column are told.  Equal groups are equal strings.
    """
    half, m = length // 2, len(rows)
    width = length - half + length
    table = np.full((m, width), -1, np.int16)
    begins = half - np.array(offsets)
    lengths = np.array([len(r) for r in rows])
    for i, (row, begin) in enumerate(zip(rows, begins.tolist(), strict=True)):
        table[i, begin:begin + len(row)] = np.frombuffer(row, np.uint8)
    columns = np.ascontiguousarray(table.T)
    order, common = np.arange(m), np.zeros(m + 1, np.int32)
    for j in range(width - 1, -1, -1):
        symbols = columns[j][order]
        turn = np.argsort(symbols, kind="stable")
        order, symbols = order[turn], symbols[turn]
        new = np.zeros(m + 1, np.int32)
        same = np.flatnonzero((symbols[1:] == symbols[:-1]) & (symbols[1:] >= 0))
        if len(same):
            pairs = np.stack((turn[same] + 1, turn[same + 1] + 1), axis=1).ravel()
            new[same + 1] = np.minimum.reduceat(common, pairs)[::2] + 1
        common = new
        if j <= half:
            whole = (begins <= j) & (j + length <= begins + lengths)
            group = np.cumsum(common[:-1] < length)
            here = whole[order]
            if here.any():
                yield j, order[here], group[here]


def _sort_collections(found: DataFrame, length: int) -> DataFrame:
    """Marked windows (kind 1: _key, s, e) and strings to be summed over collections (kind 0)."""
    half = length // 2

    def solve(batch: pd.DataFrame) -> pd.DataFrame:
        rows, place = batch["data"].tolist(), batch["place"].to_numpy()
        first, offset = place >> 20, place & 1023
        weight, many, key = batch["weight"].to_numpy(), batch["many"].to_numpy(), batch["_key"].to_numpy()
        marks = np.zeros((len(rows), half + 1), bool)
        told = []
        for j, order, group in repeated_windows(rows, offset.tolist(), length):
            _, start, which = np.unique(group, return_index=True, return_inverse=True)
            total = np.bincount(which, weight[order])
            marks[order[total[which] > 1], j] = True
            for g in np.flatnonzero(many[order[start]]).tolist():
                i = int(order[start[g]])
                at = j - half + int(offset[i])
                window = rows[i][at:at + length]
                told.append((0, int(key[i]), int(first[i]) + at, int(min(total[g], 2)),
                             int.from_bytes(hashlib.blake2b(window, digest_size=8).digest(), "little", signed=True), int(batch["anchor"].iat[i])))
        for i in np.flatnonzero(marks.any(axis=1)).tolist():
            for s, e in zip(*spans_of(marks[i]), strict=True):
                at = int(first[i]) - half + int(offset[i])
                told.append((1, int(key[i]), at + int(s), at + int(e) - 1 + length, 0, 0))
        return pd.DataFrame(told, columns=["kind", "_key", "s", "e", "digest", "anchor"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            while len(held) >= 2 * COLLECTION:
                # a collection ends where a chunk ends; a chunk is far smaller
                ids = held["chunk"].to_numpy()
                cut = COLLECTION + int(np.argmax(ids[COLLECTION:] != ids[COLLECTION - 1])) if (ids[COLLECTION:] != ids[COLLECTION - 1]).any() else len(held)
                yield solve(held.iloc[:cut].reset_index(drop=True))
                held = held.iloc[cut:].reset_index(drop=True)
        if held is not None and len(held):
            yield solve(held)

    return found.mapInPandas(run, "kind int, _key long, s long, e long, digest long, anchor long")


def _near(docs: DataFrame, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents in and out of the key buckets of ``wanted`` (a broadcast of at most BUCKETS rows)."""
    bucket = F.pmod("_key", F.lit(BUCKETS)).alias("_bucket")
    buckets = F.broadcast(wanted.select(bucket).distinct())
    told = docs.withColumn("_bucket", bucket)
    return told.join(buckets, "_bucket", "left_semi").drop("_bucket"), told.join(buckets, "_bucket", "left_anti").drop("_bucket")


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of ``docs``.

    Null texts count as empty, and texts shorter than ``length`` bytes stay
    whole.  Repeated rows are documents of their own: their texts are found in
    each other.  Strings never cross documents and are judged on the input.
    """
    if not 2 <= length <= 1000:
        raise ValueError("length must be 2 to 1000 bytes")
    half = length // 2
    keyed = doc_key(docs)
    twice = stage(_anchor_counts(keyed, length).where("n > 1").select("anchor"), "anchors")
    rows = stage(_segments(keyed, length).join(twice, "anchor"), "segments")
    merged = stage(rows.groupBy("anchor", "digest").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("_key", "place")).alias("at")), "merged")
    whole = rows.join(merged.where("c > 1").select("anchor", "digest"), ["anchor", "digest"]).select(
        "_key", F.shiftright("place", 20).alias("s"),
        (F.shiftright("place", 20) + F.shiftright("place", 10).bitwiseAND(1023) + length).alias("e"))

    many = merged.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    asked = merged.join(many, "anchor").select(
        F.col("at._key").alias("_key"), F.col("at.place").alias("place"), "anchor",
        F.least("c", F.lit(2)).cast("int").alias("weight"), (F.col("n") > CHUNK).alias("many"),
        F.xxhash64("anchor", F.pmod("digest", F.ceil(F.col("n") / CHUNK))).alias("chunk"))
    asked = stage(asked, "asked")
    near, _ = _near(keyed.select("_key", "text"), asked)
    wanted = asked.groupBy("_key").agg(F.collect_list(F.struct("place", "anchor", "weight", "many", "chunk")).alias("asked"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, text, places in zip(batch["_key"], batch["text"], batch["asked"], strict=True):
                data = text.encode()
                for r in places:
                    s = r["place"] >> 20
                    out.append((key, r["place"], r["anchor"], r["weight"], r["many"], r["chunk"], data[s:s + (r["place"] >> 10 & 1023) + length]))
            yield pd.DataFrame(out, columns=["_key", "place", "anchor", "weight", "many", "chunk", "data"])

    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    data = near.dropDuplicates(["_key"]).join(wanted, "_key").mapInPandas(
        cut, "_key long, place long, anchor long, weight int, many boolean, chunk long, data binary")
    data = data.repartition(tasks, "chunk").sortWithinPartitions("chunk", "_key", "place")
    told = stage(_sort_collections(data, length), "sorted")
    strings = told.where("kind = 0")
    again = strings.groupBy("anchor", "digest").agg(F.sum("e").alias("n")).where("n > 1").select("anchor", "digest")
    late = strings.where("e = 1").join(again, ["anchor", "digest"]).select("_key", "s", (F.col("s") + length).alias("e"))

    spans = whole.unionByName(told.where("kind = 1").select("_key", "s", "e")).unionByName(late)
    spans = stage(spans.groupBy("_key").agg(F.collect_set(F.struct("s", "e")).alias("spans")), "spans")

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text, spans in zip(batch["doc_id"], batch["text"], batch["spans"], strict=True):
                data, kept, last, runs = text.encode(), [], 0, []
                for s, e in sorted((r["s"], r["e"]) for r in spans) if spans is not None else []:
                    if runs and s <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], e)
                    else:
                        runs.append([s, e])
                for s, e in runs:
                    kept.append(data[last:s])
                    last = e
                kept.append(data[last:])
                rest = b"".join(kept)
                out.append((doc, len(data), len(data) - len(rest), len(runs), hashlib.sha256(rest).hexdigest()))
            yield plain(pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]))

    near, far = _near(keyed, spans)
    # ids travel as text: pandas turns integers with nulls among them into rounded floats
    changed = near.join(spans, "_key", "left").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "spans").mapInPandas(
        apply, "doc_id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string").withColumn("doc_id", F.col("doc_id").cast("long"))
    zero = F.lit(0).cast("long")
    return changed.unionByName(far.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), zero.alias("n_removed"),
                                          zero.alias("n_spans"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")))
