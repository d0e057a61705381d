"""Whitening of integer vectors with a covariance weighted by multiplicity.

Equal vectors are grouped first (by a 128-bit digest of their entries), so the
fit and the whitening touch every distinct vector once.  A vector's fit weight
is its count, or one where the caller wants copies to count once.

Fit.  Sums per dimension are exact integers, so the mean is the same whatever the
partitions.  Then one weighted centred product X' W X per batch of distinct
vectors; Spark adds the d x d results.  Eigenvectors of the covariance are
found on the driver: d x d numbers, whatever the number of rows.

Whitening.  Every distinct vector is projected once and joined back to the
rows that hold it; the few vectors that hold a large part of the rows are
joined by broadcast, so no digest is a hot key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_hot, stage

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8


def valid(vector: Column) -> Column:
    """The vector is not null and holds no null, NaN or infinite entry."""
    x = vector.cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(~bad, F.lit(False))


def quantised(vector: Column, scale: float = SCALE, shift: int = SHIFT) -> Column:
    """floor(scale * c) + shift of every entry."""
    return F.transform(vector.cast("array<double>"), lambda v: F.floor(v * scale) + F.lit(shift))


def _matrix(vectors: pd.Series, width: int, filling: int = 0) -> np.ndarray:
    out = np.full((len(vectors), width), filling, np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _keyed(rows: DataFrame, width: int, filling: int) -> DataFrame:
    """vec_id, key (digest of the filled vector), x (its entries as bytes)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            data = [r.tobytes() for r in _matrix(b["x"], width, filling)]
            yield pd.DataFrame({"vec_id": b["vec_id"].astype(object), "key": [hashlib.blake2b(r, digest_size=16).digest() for r in data], "x": data})

    # ids travel as text: pandas turns integers with nulls among them into rounded floats
    return rows.select(F.col("vec_id").cast("string").alias("vec_id"), "x").mapInPandas(run, "vec_id string, key binary, x binary")


def _entries(x: pd.Series, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(x), np.int64).reshape(len(x), width)


def exact_sums(distinct: DataFrame, width: int) -> np.ndarray:
    """Weighted sums per dimension as Python integers: added in halves of 24 bits, so nothing overflows."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x, w = _entries(b["x"], width), b["w"].to_numpy(np.int64)
            parts = [(w @ ((x >> at) & 0xFFFFFF if at < 48 else x >> at)).tolist() for at in (0, 24, 48)]
            yield pd.DataFrame({"part": [0, 24, 48] * width, "i": np.repeat(np.arange(width), 3), "s": np.array(parts).T.ravel()})

    total = np.array([0] * width, object)
    per = distinct.select("x", "w").mapInPandas(run, "part int, i int, s long").groupBy("part", "i").agg(F.sum(F.col("s").cast("decimal(38,0)")))
    for part, i, s in per.collect():
        total[i] += int(s) << part
    return total


def covariance(distinct: DataFrame, column: str, width: int, n: int, centred: Callable[[pd.Series], np.ndarray]) -> np.ndarray:
    """Weighted covariance (divisor n) of a column of centred vectors; one d x d product a task, added by Spark."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((width, width))
        for b in batches:
            y = centred(b[column])
            total += (y * b["w"].to_numpy(float)[:, None]).T @ y
        yield pd.DataFrame({"i": np.arange(width), "row": total.tolist()})

    rows = distinct.select(column, "w").mapInPandas(run, "i int, row array<double>")
    sums = rows.select("i", F.posexplode("row").alias("j", "s")).groupBy("i", "j").agg(F.sum("s"))
    out = np.zeros((width, width))
    for i, j, s in sums.collect():
        out[i, j] = s
    return (out + out.T) / (2 * n)


def whiten(rows: DataFrame, components: int = COMPONENTS, filling: int = SHIFT, once: bool = False) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error for every row and component.

    ``rows`` has vec_id and x, arrays of integers without nulls; other columns are
    ignored.  n and the sums S run over the fit list: every row, or with
    ``once`` every distinct vector once.  deviation is the sum over dimensions of
    (n*x-S)^2, exact (null where it does not fit a long); whitened is x-S/n
    projected on a unit eigenvector of the covariance, over the root of its
    eigenvalue; explained is eigenvalue / trace; identity_error is the largest
    entry of |covariance of whitened - identity| over the components returned.

    Components are those whose variance is above rounding (1e-12 of the trace), at most
    ``components``: equal vectors only, or no rows at all, give no rows.
    Shorter vectors count as filled up with ``filling``.  Repeated rows,
    shared and null ids come back as often as they were given.  Equal eigenvalues leave
    the choice of their vectors free; all rows use the same.
    """
    spark = rows.sparkSession
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    if width <= 0:
        return spark.createDataFrame([], schema)
    keyed = stage(_keyed(rows, width, filling), "vectors")
    grouped = keyed.groupBy("key").agg(F.first("x").alias("x"), F.count(F.lit(1)).alias("copies"))
    distinct = stage(grouped.withColumn("w", F.lit(1).cast("long") if once else F.col("copies")), "distinct")
    n_rows, n = distinct.agg(F.sum("copies"), F.sum("w")).first()
    total = exact_sums(distinct, width)
    whole, part = ([int(f(s, n)) for s in total] for f in (lambda s, n: s // n, lambda s, n: s % n))
    base, fraction = np.array(whole, np.int64), np.array([p / n for p in part])

    def centred(x: pd.Series) -> np.ndarray:
        return (_entries(x, width) - base) - fraction      # the first difference is exact

    cov = covariance(distinct, "x", width, n, centred)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)[:components]
    order = order[values[order] > 1e-12 * max(np.trace(cov), 0.0)]
    if not len(order):
        return spark.createDataFrame([], schema)
    basis, share = vectors[:, order] / np.sqrt(values[order]), values[order] / np.trace(cov)

    def deviations(x: np.ndarray) -> list[int]:
        far = x - base
        if n * (int(np.abs(far).max(initial=0)) + 1) < (2 ** 63 / width) ** 0.5:
            return ((far * n - np.array(part, np.int64)) ** 2).sum(1).tolist()
        return ((far.astype(object) * n - np.array(part, object)) ** 2).sum(1).tolist()

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"key": b["key"], "copies": b["copies"], "w": b["w"], "whitened": (centred(b["x"]) @ basis).tolist(),
                                "deviation": [str(d) for d in deviations(_entries(b["x"], width))]})

    done = stage(distinct.mapInPandas(project, "key binary, copies long, w long, whitened array<double>, deviation string")
                 .withColumn("deviation", F.expr("try_cast(deviation as bigint)")), "whitened")
    check = covariance(done, "whitened", len(order), n, lambda v: np.array(v.tolist()).reshape(len(v), len(order)))
    error = float(np.abs(check - np.eye(len(order))).max())

    out = join_hot(keyed.select("vec_id", "key"), done.select("key", "copies", "whitened", "deviation"), "key", "copies", n_rows) \
        .select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.array(*(F.lit(float(s)) for s in share))
    return out.select(F.col("vec_id").cast("long").alias("vec_id"), (F.col("at") + 1).cast("int").alias("component"),
                      F.lit(int(n)).cast("long").alias("n"), "deviation", "whitened",
                      explained[F.col("at")].alias("explained"), F.lit(error).alias("identity_error"))
