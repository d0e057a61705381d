"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import stage

__all__ = ["content_key", "doc_key", "join_hot", "plain", "read", "separator_table", "shingle_sets", "small_batches", "spans_of", "stage", "text_of", "word_arrays"]

GROUP_BYTES = 1 << 18


def separator_table(keep: Iterable[int]) -> bytes:
    """For ``bytes.translate``: 0 for the bytes that words are made of, else 1."""
    kept = set(keep)
    return bytes(b not in kept for b in range(256))


WHITE = separator_table(set(range(256)) - {0x20, *range(0x09, 0x0E)})

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(frame: pd.DataFrame) -> pd.DataFrame:
    """The frame, with columns of objects if it has no rows: an empty list makes floats, which do not become strings."""
    return frame if len(frame) else frame.astype(object)


def text_of(column: str = "text") -> Column:
    """The text; a null text is the empty one."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """At most ``rows`` rows in a batch sent to Python.

    The setting counts rows, and texts can be long: the default of 10,000 of them fills
    a worker's memory several times over, on both sides of the pipe.
    """
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def doc_key(docs: DataFrame) -> DataFrame:
    """doc_id, text and a content key.

    Documents are told apart by doc_id *and* text, so tables in which an id is
    repeated or null still join back row by row; exact repeats of a row share
    their key and get the same result.
    """
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), content_key().alias("_key"))


def content_key() -> Column:
    """A hash of doc_id and text, both as ``doc_key`` reads them."""
    doc = F.col("doc_id").cast("long")
    return F.xxhash64(F.coalesce(doc, F.lit(-1)), doc.isNull(), text_of())


HOT_SHARE = 1_000     # keys with more than 1 / HOT_SHARE of the rows are joined by broadcast
HOT_ROWS = 1_000      # unless they have fewer rows than this


def join_hot(rows: DataFrame, facts: DataFrame, key: str, weight: str, n_rows: int, how: str = "inner") -> DataFrame:
    """``rows`` with the facts of their key; ``how`` is inner or left.

    ``facts`` has one row a key and, in ``weight``, that key's rows of ``n_rows`` in all.  At most HOT_SHARE
    keys can hold more than a HOT_SHARE-th of the rows: they are broadcast, the others
    meet in a shuffle without a hot key.
    """
    hot = F.col(weight) > max(HOT_ROWS, n_rows // HOT_SHARE)
    often, rest = facts.where(hot).drop(weight), facts.where(~hot).drop(weight)
    return rows.join(F.broadcast(often), key).unionByName(
        rows.join(F.broadcast(often.select(key)), key, "left_anti").join(rest, key, how))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums of bytes times powers; with ``slice_hash`` they give the hash of any slice."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(0x9E37)) * _power(len(data))[0], out=out[1:])
    return out


def slice_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each slice that depends on its bytes alone, not on its place."""
    return (sums[ends] - sums[starts]) * _power(len(sums))[1][starts]


def spans_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return edge[::2], edge[1::2]


def word_arrays(texts: Iterable[bytes], separators: bytes = WHITE) -> Iterator[np.ndarray]:
    """64-bit hashes of each text's words, in order; texts are hashed together, some hundred kilobytes at a time."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text) + 1
        if size >= GROUP_BYTES:
            yield from _hash_group(group, separators)
            group, size = [], 0
    if group:
        yield from _hash_group(group, separators)


def _hash_group(group: list[bytes], separators: bytes) -> Iterator[np.ndarray]:
    joined = b" ".join(group) + b" "
    gap = np.frombuffer(joined.translate(separators), bool)
    edges = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    if not gap[0]:
        edges = np.concatenate(([0], edges))
    starts, ends = edges[::2], edges[1::2]
    hashes = mix(slice_hash(prefix_hash(np.frombuffer(joined, np.uint8)), starts, ends))
    last = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in group])).tolist()
    first = 0
    for end in last:
        yield hashes[first:end]
        first = end


def shingle_sets(texts: Iterable[str], words: int = 5) -> Iterator[np.ndarray]:
    """Of each text the sorted distinct hashes of its word shingles; fewer words make one shingle.

    Words are runs of anything but ASCII white space, A-Z lower-cased.
    """
    for w in word_arrays((text.encode().lower() for text in texts)):
        n = min(words, len(w))
        if not n:
            yield np.zeros(0, np.int64)
            continue
        h = np.full(len(w) - n + 1, n, np.uint64)
        for i in range(n):
            h = h * np.uint64(_BASE) + w[i:len(w) - n + 1 + i]
        h = mix(h).view(np.int64)
        h.sort()
        yield h[np.concatenate(([True], h[1:] != h[:-1]))]
