"""Aggregations that stay small per task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import share
from ..session import stage
from .ranking import HOT_ROWS


def distinct_counts(df: DataFrame, keys: list[str], entity: str, flags: dict[str, Column],
                    total: str | None = None) -> DataFrame:
    """Many COUNT(DISTINCT CASE WHEN flag THEN entity END) in one group-by.

    Level 1 groups by (keys, entity) and keeps one bit per flag, level 2 sums
    the bits.  Both levels combine map-side and a hot key is spread over its
    entities, where the naive form would expand every row once per flag.
    """
    one = df.groupBy(*keys, entity).agg(
        *[F.max(F.when(cond & F.col(entity).isNotNull(), 1).otherwise(0)).alias(name) for name, cond in flags.items()],
    )
    sums = [F.sum(name).cast("bigint").alias(name) for name in flags]
    if total:
        sums.append(F.count(entity).alias(total))
    return one.groupBy(*keys).agg(*sums)


BUCKETS = 1024       # of one narrowing round
MOST_NAMES = 10_000  # values that may become a list on the driver


def percentile_cont(df: DataFrame, keys: list[str], value: str, q: float, out: str,
                    hot_rows: int | None = None) -> DataFrame:
    """Exact continuous percentile per group, however many values a group has.

    Groups of up to ``hot_rows`` rows are merged from (group, value, count).  Larger
    ones, of which there are few, are never sorted: ``select_ranks`` narrows down to the two values
    around the target position, which are interpolated.
    """
    if not keys:
        return percentile_cont(df.withColumn("_all", F.lit(0)), ["_all"], value, q, out, hot_rows).groupBy().agg(F.max(out).alias(out))
    rows = stage(df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_value")), "values")
    limit = HOT_ROWS if hot_rows is None else hot_rows

    def merged(some: DataFrame) -> DataFrame:
        counted = some.groupBy(*keys, "_value").agg(F.count(F.lit(1)).alias("_n"))
        return counted.groupBy(*keys).agg(F.percentile("_value", q, F.col("_n")).alias(out))

    if rows.count() <= limit:
        return merged(rows)
    sizes = stage(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_size"), F.min("_value").alias("_lo"), F.max("_value").alias("_hi")), "sizes")
    hot = sizes.where(F.col("_size") > limit)
    if hot.isEmpty():
        return merged(rows)
    at = (F.col("_size") - 1) * F.lit(float(q))
    wanted = hot.select(*keys, "_lo", "_hi", F.explode(F.array_distinct(F.array(F.floor(at), F.ceil(at)))).alias("_rank"), at.alias("_at"))
    found = select_ranks(rows, keys, wanted)
    two = found.groupBy(*keys).agg(F.min_by("_v", "_rank").alias("_lo"), F.max_by("_v", "_rank").alias("_hi"), F.first("_at").alias("_at"))
    # the arithmetic of ``percentile``, so that both routes agree to the last bit
    mixed = (F.ceil("_at") - F.col("_at")) * F.col("_lo") + (F.col("_at") - F.floor("_at")) * F.col("_hi")
    large = two.select(*keys, F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(mixed).alias(out))
    if limit == 0:
        return large
    return large.unionByName(merged(_joined(rows, hot.select(*keys), keys, "left_anti")))


def _joined(rows: DataFrame, facts: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join with broadcast facts on keys, NULL equal to NULL; the facts' keys are dropped."""
    other = facts.withColumnsRenamed({k: f"_g{i}" for i, k in enumerate(keys)})
    same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(other[f"_g{i}"]) for i, k in enumerate(keys)])
    return rows.join(F.broadcast(other), same, how).drop(*[f"_g{i}" for i in range(len(keys))])


def select_ranks(rows: DataFrame, keys: list[str], wanted: DataFrame) -> DataFrame:
    """The ``_rank``-th smallest ``_value`` (from 0) of each group, as ``_v``, by narrowing histograms.

    ``wanted`` has one row for each group and rank, with the range _lo to _hi in which the value lies.  Every round counts
    the rows of that range in BUCKETS equal parts, picks the part that holds the rank and goes
    on with the least and the largest value in it, until these are equal: a few scans
    with small partial counts, and no sort.  ``wanted`` holds large groups only, so it is short.
    """
    state = stage(wanted.select(*keys, "_rank", F.col("_rank").alias("_left"), "_lo", "_hi", "_at"), "ranks")
    while not state.where(~F.col("_lo").cast("double").eqNullSafe(F.col("_hi").cast("double"))).isEmpty():
        lo, hi = F.col("_lo").cast("double"), F.col("_hi").cast("double")
        share = (F.col("_value").cast("double") - lo) / (hi - lo)
        part = F.when(lo == hi, 0).otherwise(F.least(F.lit(BUCKETS - 1), F.floor(share * BUCKETS)).cast("int"))
        inside = _joined(rows, state.drop("_at"), keys, "inner").where(F.col("_value").between(F.col("_lo"), F.col("_hi")))
        counted = inside.groupBy(*keys, "_rank", "_left", part.alias("_part")).agg(
            F.count(F.lit(1)).alias("_n"), F.min("_value").alias("_l"), F.max("_value").alias("_h"))
        # at most BUCKETS parts a group and rank
        before = Window.partitionBy(*keys, "_rank").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        narrowed = counted.withColumn("_below", F.coalesce(F.sum("_n").over(before), F.lit(0))) \
            .where((F.col("_below") <= F.col("_left")) & (F.col("_left") < F.col("_below") + F.col("_n")))
        kept = state.select(*[F.col(k).alias(f"_s{i}") for i, k in enumerate(keys)], F.col("_rank").alias("_r"), "_at")
        same = reduce(lambda a, b: a & b, [narrowed[k].eqNullSafe(kept[f"_s{i}"]) for i, k in enumerate(keys)], narrowed["_rank"] == kept["_r"])
        state = stage(narrowed.join(F.broadcast(kept), same).select(
            *keys, "_rank", (F.col("_left") - F.col("_below")).alias("_left"), F.col("_l").alias("_lo"), F.col("_h").alias("_hi"), "_at"), "ranks")
    return state.select(*keys, "_rank", F.col("_lo").cast("double").alias("_v"), "_at")


def with_shares(df: DataFrame, shares: dict[str, str], scale: int = 4) -> DataFrame:
    """{out: amount}: each amount's share of its grand total.

    The grouped rows are stored once: the totals are scalar subqueries, and over
    a lazy frame each of them would compute everything below it again.
    """
    groups = stage(df, "group-totals")
    totals = groups.agg(*[F.sum(amount).alias(out) for out, amount in shares.items()])
    return groups.withColumns({
        out: share(amount, totals.select(out).scalar(), scale) for out, amount in shares.items()})


def value_frequencies(df: DataFrame, column: str, where: str | None = None, limit: int | None = None,
                      order_by: list[Column] | None = None) -> DataFrame:
    """(value, num_rows), by default most frequent first, ties by value."""
    rows = df.where(where) if where else df
    out = rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("num_rows"))
    out = out.orderBy(*(order_by or []), F.desc("num_rows"), F.asc_nulls_last("value"))
    return out.limit(limit) if limit is not None else out


def column_values(df: DataFrame | None, column: str, where: str | None = None, limit: int | None = None,
                  default: list | None = None, at_most: int = MOST_NAMES, order_by: list[Column] | None = None) -> list:
    """Distinct values as a list, for naming columns.

    ``df=None`` stands for a table that does not exist.  More values than
    ``at_most`` are an error; for a list of unknown length use
    ``value_frequencies``, which stays distributed.
    """
    if df is None:
        if default is None:
            raise ValueError("no such table and no default value")
        return default
    values = value_frequencies(df, column, where, limit, order_by).select("value")
    found = [r[0] for r in values.take(at_most + 1)]
    if len(found) > at_most:
        raise ValueError(f"{column} has more than {at_most} distinct values")
    return found or (default if default is not None else [])


def group_first(df: DataFrame, n: int, *aggs: Column) -> DataFrame:
    """Group by the first n columns."""
    return df.groupBy(*df.columns[:n]).agg(*aggs)


def proportion(df: DataFrame, cond: Column, out: str, keys: list[str] = ()) -> DataFrame:
    """Share of rows that satisfy a condition, per group."""
    return df.groupBy(*keys).agg(F.avg(F.when(cond, 1.0).otherwise(0.0)).alias(out))
