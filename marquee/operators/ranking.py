"""Ranks and neighbours over groups of any size.

A window hands each group to one task.  That is the right plan while every
group is small, and the wrong one when a title type, a genre or "no group at
all" holds a third of the rows.  So each operator first measures the largest
group; beyond ``HOT_ROWS`` it sorts globally into range partitions ("slices")
and stores them bucketed by slice: the only exchange of the rows.  Reading
knows that a slice lies together, so ranks inside each slice need no further
shuffle; a table of per-slice facts (one row per slice, or slice and group)
stitches the slices.

Rows that an order leaves tied are ordered by all their columns on either route: the
size of a group decides the plan, never the result.
"""

from __future__ import annotations

import itertools
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage, stage_bucketed, staged_bytes
from .joins import join_counted

HOT_ROWS = 500_000       # rows of one group a window task may be given
WHOLE_ROWS = 100_000     # rows of a whole table a window task may be given
SLICE_ROWS = 20_000      # rows worth a slice of their own
SLICE_BYTES = 128 << 20  # what a slice is meant to hold
MOST_SLICES = 20_000     # beyond that slices grow instead: facts about slices stay small
SMALL_BYTES = 16 << 20   # stored facts that may be broadcast, by the size of their files

_SLICE, _POS = "_slice", "_pos"
_fresh = itertools.count()


def asc(c: str) -> Column:
    return F.col(c).asc_nulls_last()


def desc(c: str) -> Column:
    return F.col(c).desc_nulls_first()


def _bytes(df: DataFrame) -> Column:
    """Rough size of the rows: lengths of texts, and some bytes for every other column."""
    long = [f.name for f in df.schema.fields if f.dataType.simpleString() in ("string", "binary")]
    texts = [F.coalesce(F.sum(F.octet_length(F.col(f"`{c}`"))), F.lit(0)) for c in long]
    return reduce(lambda a, b: a + b, texts, F.count(F.lit(1)) * (16 * len(df.columns)))


def slices_needed(df: DataFrame, key_sets: list[list[str]], limit: int | None = None) -> int:
    """0 when every group of every key set fits one task, else the number of slices to cut.

    Counting rows first settles small tables; otherwise one pre-aggregated
    count per key set does, and only the largest count reaches the driver.
    """
    limit = HOT_ROWS if limit is None else limit
    total = df.count()
    if total <= (limit if all(key_sets) else min(limit, WHOLE_ROWS)):
        return 0
    if all(key_sets):
        sizes = [df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n"))
                 for keys in key_sets]
        if reduce(DataFrame.unionAll, sizes).agg(F.max("n")).first()[0] <= limit:
            return 0
    # enough slices for all tasks where there are rows for them, else as many as their bytes ask for
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(MOST_SLICES, max(df.agg(_bytes(df)).first()[0] // SLICE_BYTES, min(tasks, total // SLICE_ROWS)) + 1)


_labels: dict[int, list[int]] = {}


def slice_labels(df: DataFrame, slices: int) -> list[int]:
    """Rising numbers, one for each slice, that hash to buckets of their own."""
    if slices not in _labels:
        bucket = F.pmod(F.hash("id"), F.lit(slices))
        first = df.sparkSession.range(64 * slices, numPartitions=1).groupBy(bucket).agg(F.min("id")).collect()
        _labels[slices] = sorted(r[1] for r in first)
    return _labels[slices]


def _others(df: DataFrame) -> list[Column]:
    """All columns that can be ordered: they break the ties of an order, alike on both routes."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [F.col(f"`{c}`") for c, kind in kinds.items() if "map<" not in kind and kind != "variant"]


def into_slices(df: DataFrame, order: list[Column], slices: int) -> DataFrame:
    """Globally sorted rows stored with the slice and position they landed in, each slice in a bucket of its own.

    The number of slices is explicit, so that AQE does not merge them.

    Ties of ``order`` are broken by all other columns and then by the row's
    place in the input, so that even a huge group of copies splits into slices.
    Places must be the same in every attempt of a task, so rows that come out
    of a shuffle are stored first (which also computes them only once).
    """
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        df = stage(df, "unsliced")
    here = F.monotonically_increasing_id()
    labels = slice_labels(df, slices)
    slices = len(labels)
    keys = [*order, *_others(df), F.col("_tie")]
    placed = (
        df.withColumn("_tie", here)
        .repartitionByRange(slices, *keys).sortWithinPartitions(*keys).drop("_tie")
        .withColumn(_POS, here)
        .withColumn(_SLICE, F.array(*map(F.lit, labels))[F.shiftright(F.col(_POS), 33).cast("int")])
        .withColumn(_POS, F.col(_POS).bitwiseAND(F.lit((1 << 33) - 1)))
    )
    return stage_bucketed(placed, "slices", _SLICE, slices)


def _null_safe(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[a].eqNullSafe(right[b]) for a, b in pairs])


def _attach(df: DataFrame, facts: DataFrame, keys: list[str], take: str, one_per_slice: bool = True) -> DataFrame:
    """Left join of per-(slice, key) facts.

    In a sort that starts with the keys only one key per slice goes on from an
    earlier (or into a later) slice, so the facts are at most as many as the
    slices and can be broadcast.  Otherwise they are stored and their size decides.
    """
    tag = next(_fresh)
    names = {k: f"_k{tag}_{i}" for i, k in enumerate([_SLICE, *keys])}
    facts = facts.select(*[F.col(k).alias(n) for k, n in names.items()], take)
    if not one_per_slice:
        facts = stage(facts, "offsets")
    if one_per_slice or staged_bytes(facts) <= SMALL_BYTES:
        facts = F.broadcast(facts)
    return df.join(facts, _null_safe(df, facts, list(names.items())), "left").drop(*names.values())


def _earlier(sliced: DataFrame, keys: list[str], amount: Column, out: str) -> DataFrame:
    """Per (slice, key): total ``amount`` of the key's rows in earlier slices."""
    per_slice = sliced.groupBy(_SLICE, *keys).agg(amount.alias("_n"))
    before = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return per_slice.withColumn(out, F.sum("_n").over(before)).where(F.col(out).isNotNull()).drop("_n")


def row_numbers(df: DataFrame, ranks: dict[str, list[str]], order: list[Column],
                hot_rows: int | None = None) -> DataFrame:
    """Several ROW_NUMBERs that share one order, each within its own keys.

    One global sort serves all of them: the rank inside a key is the local rank
    in the slice plus the key's rows in earlier slices.
    """
    slices = slices_needed(df, list(ranks.values()), hot_rows)
    if not slices:
        return df.withColumns({
            out: F.row_number().over(Window.partitionBy(*keys).orderBy(*order, *_others(df))).cast("bigint")
            for out, keys in ranks.items()
        })
    # lying together by slice satisfies every (slice, key) window below
    sliced = placed = into_slices(df, order, slices)
    for i, (out, keys) in enumerate(ranks.items()):
        offset = f"_before{i}"
        local = F.row_number().over(Window.partitionBy(_SLICE, *keys).orderBy(_POS))
        placed = placed.withColumn(out, local.cast("bigint"))
        placed = _attach(placed, _earlier(sliced, keys, F.count(F.lit(1)), offset), keys, offset, one_per_slice=False)
        placed = placed.withColumn(out, F.col(out) + F.coalesce(F.col(offset), F.lit(0))).drop(offset)
    return placed.drop(_SLICE, _POS)


def row_number(df: DataFrame, keys: list[str], order: list[Column], out: str = "row_number",
               hot_rows: int | None = None) -> DataFrame:
    """ROW_NUMBER within ``keys`` (or over everything) for groups of any size."""
    slices = slices_needed(df, [keys], hot_rows)
    if not slices:
        w = Window.partitionBy(*keys).orderBy(*order, *_others(df))
        return df.withColumn(out, F.row_number().over(w).cast("bigint"))
    # sorting by key first leaves at most one continued key per slice
    sliced = into_slices(df, [asc(k) for k in keys] + order, slices)
    local = F.row_number().over(Window.partitionBy(_SLICE, *keys).orderBy(_POS))
    placed = _attach(sliced.withColumn(out, local.cast("bigint")),
                     _earlier(sliced, keys, F.count(F.lit(1)), "_before"), keys, "_before")
    return (placed.withColumn(out, F.col(out) + F.coalesce(F.col("_before"), F.lit(0)))
            .drop("_before", _SLICE, _POS))


def exclusive_sum(df: DataFrame, keys: list[str], order: list[Column], amount: str, out: str,
                  hot_rows: int | None = None) -> DataFrame:
    """Running total of ``amount`` over the rows before the current one (0 for the first)."""
    slices = slices_needed(df, [keys], hot_rows)
    if not slices:
        w = Window.partitionBy(*keys).orderBy(*order, *_others(df)).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(out, F.coalesce(F.sum(amount).over(w), F.lit(0)))
    sliced = into_slices(df, [asc(k) for k in keys] + order, slices)
    w = Window.partitionBy(_SLICE, *keys).orderBy(_POS).rowsBetween(Window.unboundedPreceding, -1)
    placed = _attach(sliced.withColumn(out, F.coalesce(F.sum(amount).over(w), F.lit(0))),
                     _earlier(sliced, keys, F.sum(amount), "_before"), keys, "_before")
    return (placed.withColumn(out, F.col(out) + F.coalesce(F.col("_before"), F.lit(0)))
            .drop("_before", _SLICE, _POS))


def _neighbour(df: DataFrame, value: str, out: str, keys: list[str], order: list[Column],
               ahead: bool, hot_rows: int | None) -> DataFrame:
    step = F.lead if ahead else F.lag
    slices = slices_needed(df, [keys], hot_rows)
    if not slices:
        return df.withColumn(out, step(value).over(Window.partitionBy(*keys).orderBy(*order, *_others(df))))
    sliced = into_slices(df, [asc(k) for k in keys] + order, slices)
    inside = Window.partitionBy(_SLICE, *keys).orderBy(_POS)
    placed = sliced.withColumn(out, step(value).over(inside)).withColumn("_edge", step(_POS).over(inside).isNull())
    # the row next to a border sits in the nearest slice that holds the same key
    pick = F.min_by if ahead else F.max_by
    borders = sliced.groupBy(_SLICE, *keys).agg(pick(F.struct(value), F.col(_POS)).alias("_v"))
    across = Window.partitionBy(*keys).orderBy(_SLICE)
    borders = borders.withColumn("_nbr", step("_v").over(across)).where(F.col("_nbr").isNotNull())
    placed = _attach(placed, borders, keys, "_nbr")
    return (placed.withColumn(out, F.when(F.col("_edge"), F.col("_nbr")[value]).otherwise(F.col(out)))
            .drop("_nbr", "_edge", _SLICE, _POS))


def lag(df: DataFrame, value: str, out: str, order: list[Column], keys: list[str] = (),
        hot_rows: int | None = None) -> DataFrame:
    """Value of the previous row, within ``keys`` or over everything."""
    return _neighbour(df, value, out, list(keys), order, False, hot_rows)


def lead(df: DataFrame, value: str, out: str, order: list[Column], keys: list[str] = (),
         hot_rows: int | None = None) -> DataFrame:
    """Value of the next row, within ``keys`` or over everything."""
    return _neighbour(df, value, out, list(keys), order, True, hot_rows)


def percent_rank(df: DataFrame, value: str, out: str, hot_rows: int | None = None,
                 counts_from: DataFrame | None = None) -> DataFrame:
    """PERCENT_RANK over the whole table, ascending with NULLs last.

    Ties share a rank, so ranks are a running count over distinct values: count
    per value (map-side combined), running sum, join back on the value.  The counts
    are broadcast while their files are small; else only values that hold a large part of the
    rows are, and the others meet in a shuffle.
    ``counts_from`` names a stored table with the same rows to count from.
    """
    counts = stage((df if counts_from is None else counts_from).groupBy(value).agg(F.count(F.lit(1)).alias("_n")), "value-counts")
    ranked = exclusive_sum(counts, [], [asc(value)], "_n", "_below", hot_rows)
    total = counts.agg(F.sum("_n")).first()[0] or 0
    ranked = ranked.select(F.col(value).alias("_v"), "_n", (F.col("_below") / F.lit(max(total - 1, 1))).cast("double").alias(out))
    if staged_bytes(counts) <= SMALL_BYTES:
        return df.join(F.broadcast(ranked.drop("_n")), df[value].eqNullSafe(ranked["_v"]), "left").drop("_v")
    return join_counted(df, stage(ranked.withColumnRenamed("_v", value), "value-ranks"), value, "_n", total)


def deduplicate(df: DataFrame, partition_by: list[str], order_by: list[tuple[str, str]]) -> DataFrame:
    """First row of each group, by [(column, 'asc' | 'desc'), ...].

    Spark turns row_number() = 1 into a group limit on both sides of the
    shuffle: every task sends at most one row per key, however hot the key.
    (max_by over a row struct would do the same sorts, as its buffer cannot be hashed.)
    """
    if not {way for _, way in order_by} <= {"asc", "desc"}:
        raise ValueError("directions must be 'asc' or 'desc'")
    order = [asc(c) if way == "asc" else desc(c) for c, way in order_by]
    return top_n(df, partition_by, order, 1, "_rn").drop("_rn")


def top_n(df: DataFrame, keys: list[str], order: list[Column], n: int, out: str = "row_number") -> DataFrame:
    """The first n rows of each group; the limit prunes each task's rows before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= n)
