"""Exact top-k by inner product as a Voronoi kNN join.

Queries are grouped by their nearest pivot and dealt into blocks of at most
BLOCK queries.  A block has a centre c and the largest distance r of its
queries from it, so for each of them the score of a row v lies within r * |v|
of c . v.  One pass gives for each block the k + 1 best lower bounds
c . v - r |v| of all rows: the least of them bounds the k-th best score of every
query of the block (one row may be the query itself).  A row is replicated
only to the blocks for which c . v + r |v| reaches that bound.  Each block's
rows are dealt into slices, solved locally, and the slices' best k are merged.

Vectors are integers in double precision: sums are exact below 2**53.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

BLOCK = 512
PIVOTS = 256          # at most
SLICE_ROWS = 50_000   # rows of a block that one task solves


def valid(vector: Column) -> Column:
    """No null, NaN or infinite component, at least one component."""
    x = vector.cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce((F.size(x) > 0) & ~bad, F.lit(False))


def quantised(vector: Column, scale: float = 64.0) -> Column:
    """floor(scale * x) of every component, as doubles."""
    return F.transform(vector.cast("array<double>"), lambda v: F.floor(v * scale).cast("double"))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def top_k(rows: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for every query.

    ``rows`` has vec_id (long) and v (array<double> of integers).  Queries are
    rows whose vec_id is divisible by ``every``; candidates are all rows but
    those of the query's own vec_id.  Ties go to the smaller vec_id, fewer than
    k candidates are all returned, shorter vectors count as filled with zeros.
    Repeated rows (same vec_id and vector) are one row; rows with a null vec_id
    take no part.
    """
    spark = rows.sparkSession
    rows = stage(rows.select(F.col("vec_id").cast("long").alias("vec_id"), "v").where("vec_id is not null").dropDuplicates(), "vectors")
    queries = rows.where(F.col("vec_id") % every == 0)
    schema = "query_id long, rank int, vec_id long, score long"
    told = queries.agg(F.count(F.lit(1))).first()[0], rows.agg(F.max(F.size("v")), F.count(F.lit(1))).first()
    n_queries, (width, n_rows) = told
    if not n_queries:
        return spark.createDataFrame([], schema)

    wanted = int(min(PIVOTS, max(1, n_queries // BLOCK)))
    pivots = _matrix(pd.Series([r[0] for r in queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(wanted).select("v").collect()]), width)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = _matrix(b["v"], width)
            d = (pivots ** 2).sum(1)[None, :] - 2 * x @ pivots.T
            yield pd.DataFrame({"vec_id": b["vec_id"], "v": b["v"], "cell": d.argmin(1)})

    cells = stage(queries.mapInPandas(assign, "vec_id long, v array<double>, cell int"), "cells")
    # blocks of a cell are ranges of a hash; a cell's number of blocks comes from its count
    count = {r[0]: r[1] for r in cells.groupBy("cell").count().collect()}
    parts = F.create_map(*(F.lit(x) for c, n in sorted(count.items()) for x in (c, -(-n // BLOCK))))
    blocks = stage(cells.withColumn("block", F.concat_ws(":", "cell", F.pmod(F.xxhash64("vec_id"), parts[F.col("cell")]))), "blocks")

    def summary(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = _matrix(b["v"], width)
            for block, at in b.groupby("block").indices.items():
                yield pd.DataFrame({"block": [block], "n": [len(at)], "total": [x[at].sum(0).tolist()]})

    sums = blocks.mapInPandas(summary, "block string, n long, total array<double>").collect()
    n, total = {}, {}
    for r in sums:
        n[r[0]] = n.get(r[0], 0) + r[1]
        total[r[0]] = total.get(r[0], 0) + np.array(r[2])
    names = sorted(n)
    place = {b: i for i, b in enumerate(names)}
    centres = np.array([total[b] / n[b] for b in names])

    def reach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x, at = _matrix(b["v"], width), b["block"].map(place).to_numpy()
            yield pd.DataFrame({"at": at, "r": np.sqrt(((x - centres[at]) ** 2).sum(1))})

    radius = np.zeros(len(names))
    for at, r in blocks.mapInPandas(reach, "at int, r double").groupBy("at").agg(F.max("r")).collect():
        radius[at] = r * (1 + 1e-9) + 1e-6

    def bounds(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        middle, slack = x @ centres.T, np.sqrt((x ** 2).sum(1))[:, None] * radius[None, :]
        return middle - slack - 1e-6, middle + slack + 1e-6

    def best_bounds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = np.full((0, len(names)), 0.0)
        for b in batches:
            best = np.concatenate((best, bounds(_matrix(b["v"], width))[0]))
            best = -np.sort(-best, axis=0)[:k + 1]
        yield pd.DataFrame({"at": np.tile(np.arange(len(names)), len(best)), "low": best.ravel()})

    ranked = rows.mapInPandas(best_bounds, "at int, low double").withColumn(
        "rank", F.row_number().over(Window.partitionBy("at").orderBy(F.desc("low"))))
    least = np.full(len(names), -np.inf)
    for at, low in ranked.where(F.col("rank") == k + 1).select("at", "low").collect():
        least[at] = low

    slices = int(-(-n_rows // SLICE_ROWS))

    def replicate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = _matrix(b["v"], width)
            who, where = np.nonzero(bounds(x)[1] >= least[None, :])
            data = [r.tobytes() for r in x]
            yield pd.DataFrame({"at": where, "slice": b["vec_id"].to_numpy()[who] % slices, "row": 1,
                                "vec_id": b["vec_id"].to_numpy()[who], "v": [data[i] for i in who]})

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x, at = _matrix(b["v"], width), b["block"].map(place).to_numpy()
            for s in range(slices):
                yield pd.DataFrame({"at": at, "slice": s, "row": 0, "vec_id": b["vec_id"], "v": [r.tobytes() for r in x]})

    kind = "at int, slice int, row int, vec_id long, v binary"
    dealt = rows.mapInPandas(replicate, kind).unionByName(blocks.mapInPandas(ask, kind))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.repartition(tasks, "at", "slice").sortWithinPartitions("at", "slice", "row", "vec_id")

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, ids, asked, best = None, [], [], []

        def finish() -> pd.DataFrame:
            told = [(q, int(i), int(s)) for q, (scores, found) in zip(ids, best, strict=True) for s, i in zip(scores, found, strict=True)]
            return pd.DataFrame(told, columns=["query_id", "vec_id", "score"])

        for b in batches:
            for key, part in b.groupby(["at", "slice"], sort=False):
                if key != group:
                    if group is not None:
                        yield finish()
                    group, ids, asked, best = key, [], [], []
                questions, part = part[part["row"] == 0], part[part["row"] == 1]
                for i, v in zip(questions["vec_id"], questions["v"], strict=True):
                    ids.append(i)
                    asked.append(np.frombuffer(v))
                    best.append((np.zeros(0), np.zeros(0, np.int64)))
                if not len(part):
                    continue
                found = part["vec_id"].to_numpy()
                scores = np.array(asked) @ np.array([np.frombuffer(v) for v in part["v"]]).T
                for j, (q, (old, who)) in enumerate(zip(ids, best, strict=True)):
                    new = np.flatnonzero(found != q)
                    if len(old) == k:
                        new = new[scores[j, new] >= old[-1]]
                    s, i = np.concatenate((old, scores[j, new])), np.concatenate((who, found[new]))
                    top = np.lexsort((i, -s))[:k]
                    best[j] = s[top], i[top]
        if group is not None:
            yield finish()

    ranking = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return dealt.mapInPandas(solve, "query_id long, vec_id long, score long").withColumn("rank", ranking) \
        .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
