"""Substring deduplication by content-defined chunks.

A gear hash (one random word per byte value, shifted left at every step) rolls
over the last 32 bytes of a text; a chunk ends where its top bits are zero.
Cuts depend on the bytes around them only, so an insertion changes the chunks
around it and no others.  Chunks are compared by digest over the whole
corpus.  The first of equal chunks (least document, then place) is kept; later
ones are removed where they make up runs of MIN_RUN bytes or more, so short
phrases stay.  Shorter documents are compared whole too, and copies of them removed.

Only digests are shuffled, counted before they are, and a hot digest is joined
to its rows, which splits.  The rows carry key, place and digest only: ends are cut anew
beside the text, and the files of the count are freed before the join writes its own.  Texts are
shuffled once, for the documents that hold a repeated chunk or not.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.session import free_shuffles

from .common import doc_key, plain, stage

MIN_CHUNK, MAX_CHUNK = 16, 512
BITS = 4              # a cut every 2**BITS bytes on average, from MIN_CHUNK on
MIN_RUN = 128         # bytes

_GEAR = np.random.default_rng(0x6EA2).integers(0, 2**32, 256, dtype=np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The rolling hash behind every byte: doubled up from windows of 1 to windows of 32 bytes."""
    h = _GEAR[data]
    for k in (1, 2, 4, 8, 16):
        h[k:] = h[k:] + (h[:-k] << np.uint32(k))
    return h


def cut_points(data: bytes, least: int = MIN_CHUNK, most: int = MAX_CHUNK, bits: int = BITS) -> list[int]:
    """Ends of the chunks of a text's bytes."""
    n = len(data)
    places = np.flatnonzero(gear_hashes(np.frombuffer(data, np.uint8)) >> np.uint32(32 - bits) == 0) + 1 if n else np.zeros(0, np.int64)
    ends, last = [], 0
    for p in [*places.tolist(), n]:
        while p - last > most:
            last += most
            ends.append(last)
        if p - last >= least or (p == n and p > last):
            ends.append(p)
            last = p
    return ends


def chunks_of(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """(_key, doc_id, s, e, digest) of every chunk; places are bytes, the end exclusive.

    A text of fewer than ``min_run`` bytes has a row for the whole of it too, with s = -1.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keys, ids, starts, ends, digests = [], [], [], [], []
            for key, doc, text in zip(batch["_key"], batch["doc_id"], batch["text"], strict=True):
                data = text.encode()
                cuts = cut_points(data)
                keys += [key] * len(cuts)
                ids += [doc] * len(cuts)
                starts += [0, *cuts[:-1]] if cuts else []
                ends += cuts
                digests += [hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip([0, *cuts], cuts, strict=False)]
                if 0 < len(data) < min_run:
                    keys.append(key)
                    ids.append(doc)
                    starts.append(-1)
                    ends.append(len(data))
                    digests.append(hashlib.blake2b(data, digest_size=16, person=b"whole").digest())
            yield plain(pd.DataFrame({"_key": keys, "doc_id": ids, "s": starts, "e": ends, "digest": digests}))

    # ids travel as text: pandas turns integers with nulls among them into rounded floats
    told = docs.select("_key", F.col("doc_id").cast("string").alias("doc_id"), "text").mapInPandas(
        run, "_key long, doc_id string, s int, e int, digest binary")
    return told.withColumn("doc_id", F.col("doc_id").cast("long"))


def deduplicate(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """doc_id, n_bytes, n_chunks, n_repeated, n_removed, linked and the remaining text of every row.

    n_repeated counts the chunks whose digest occurs elsewhere too; n_removed
    is in bytes; linked lists the documents that keep what was removed, with a null at the end if one of them has no id.
    Chunks end between bytes, so runs are narrowed to whole characters.  A null text counts as empty.  Of equal chunks the one of
    the least doc_id is kept (null last, then the least place).  Exact repeats of a row (same
    doc_id and text) count as one document and come back with the same result.
    """
    keyed = doc_key(docs)
    chunks = chunks_of(keyed.select("_key", "doc_id", "text"), min_run)
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("_key").alias("k"), F.col("s").alias("s"))
    first = stage(chunks.groupBy("digest").agg(F.min(order).alias("first"), F.max(order).alias("last"))
                  .where("first <> last").select("digest", "first"), "repeated")
    free_shuffles(docs.sparkSession)
    # key and place tell a row from the first one: the key stands for doc_id and text
    later = (F.col("_key") != F.col("first.k")) | (F.col("s") != F.col("first.s"))
    found = chunks.select("_key", "s", "digest").join(first, "digest").groupBy("_key").agg(F.collect_set(F.struct(
        "s", later.alias("later"), F.col("first.d").alias("keeper"))).alias("found"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc, text, found in zip(batch["doc_id"], batch["text"], batch["found"], strict=True):
                data = text.encode()
                cuts = cut_points(data)
                end_of = dict(zip([0, *cuts], cuts, strict=False))
                runs: list[list] = []
                rows = sorted(found, key=lambda r: r["s"]) if found is not None else []
                whole = [rows.pop(0)] if rows and rows[0]["s"] < 0 else []
                for r in rows:
                    if not r["later"]:
                        continue
                    if runs and runs[-1][1] == r["s"]:
                        runs[-1][1] = end_of[r["s"]]
                        runs[-1][2].add(r["keeper"])
                    else:
                        runs.append([r["s"], end_of[r["s"]], {r["keeper"]}])
                copy = bool(whole) and whole[0]["later"]
                if copy:
                    runs = [[0, len(data), {whole[0]["keeper"]}]]
                kept, last, linked = [], 0, set()
                for s, e, keepers in runs:
                    if e - s < min_run and not copy:
                        continue
                    while s < e and data[s] & 0xC0 == 0x80:
                        s += 1
                    while e > s and e < len(data) and data[e] & 0xC0 == 0x80:
                        e -= 1
                    kept.append(data[last:s])
                    last = e
                    linked |= keepers
                kept.append(data[last:])
                rest = b"".join(kept)
                named = {k for k in linked if k is not None and k == k}
                out.append((doc, len(data), len(cuts), len(rows), len(data) - len(rest),
                            sorted(int(k) for k in named) + [None] * (len(named) < len(linked)), rest.decode()))
            yield plain(pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_chunks", "n_repeated", "n_removed", "linked", "text"]))

    return keyed.join(found, "_key", "left").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "found").mapInPandas(
        run, "doc_id string, n_bytes long, n_chunks long, n_repeated long, n_removed long, linked array<long>, text string") \
        .withColumn("doc_id", F.col("doc_id").cast("long"))
