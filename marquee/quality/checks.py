"""Check functions, table -> failing rows.

NULL handling is part of each check's meaning and noted where it matters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import as_timestamp, date_add
from ..functions.text import true_only
from ..operators.joins import compare_counts, orphans
from ..operators.ranking import asc, lag, lead
from ..operators.sets import symmetric_difference

# ---- row-level conditions: TRUE marks a failing row; the runner fuses these into one pass


def null_row(column: str) -> Column:
    return F.col(column).isNull()


def outside_values(column: str, values: list) -> Column:
    """NULL passes."""
    return true_only(~F.col(column).isin(list(values)))


def inside_values(column: str, values: list) -> Column:
    return true_only(F.col(column).isin(list(values)))


def outside_range(column: str, min_value=None, max_value=None, inclusive: bool = True) -> Column:
    """NULL passes."""
    c, bad = F.col(column), F.lit(False)
    if min_value is not None:
        bad = bad | ((c < min_value) if inclusive else (c <= min_value))
    if max_value is not None:
        bad = bad | ((c > max_value) if inclusive else (c >= max_value))
    return true_only(bad)


def expression_false(expression: str, column: str | None = None) -> Column:
    """``expression`` over the row, or the text that follows ``column``; NULL passes."""
    return true_only(~F.expr(f"({column} {expression})" if column else f"({expression})"))


def blank_text(column: str, trim: bool = True) -> Column:
    c = F.col(column)
    return true_only((F.trim(c) if trim else c) == "")


def unequal(actual: str, expected: str) -> Column:
    """NULL on either side passes."""
    return true_only(F.col(actual) != F.col(expected))


# ---- checks


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(null_row(column))


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """(value_field, n_records) of values outside the list."""
    return df.where(outside_values(column, values)).groupBy(F.col(column).alias("value_field")) \
        .agg(F.count(F.lit(1)).alias("n_records"))


def not_accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """(value_field) found although forbidden."""
    return df.where(inside_values(column, values)).select(F.col(column).alias("value_field")).distinct()


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True) -> DataFrame:
    return df.where(outside_range(column, min_value, max_value, inclusive))


def expression_is_true(df: DataFrame, expression: str, column: str | None = None) -> DataFrame:
    return df.where(expression_false(expression, column))


def not_empty_string(df: DataFrame, column: str, trim: bool = True) -> DataFrame:
    c = F.trim(column) if trim else F.col(column)
    return df.where(blank_text(column, trim)).select(c.alias(column))


def assert_equal(df: DataFrame, actual: str, expected: str) -> DataFrame:
    return df.where(unequal(actual, expected))


def unique(df: DataFrame, column: str) -> DataFrame:
    """(unique_field, n_records) of non-NULL values that occur more than once."""
    return df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("unique_field")) \
        .agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    """Combinations that occur more than once; NULLs group together."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str,
                  child_where: str | None = None, parent_where: str | None = None) -> DataFrame:
    """(from_field) of child rows without a parent; NULL passes."""
    return orphans(child, column, parent, field, child_where, parent_where).select(F.col(column).alias("from_field"))


def at_least_one(df: DataFrame, column: str, group_by: list[str] = ()) -> DataFrame:
    """Groups (or the table) with no non-NULL value.

    Ungrouped, one value is enough to stop reading.
    """
    rows = df if group_by else df.where(F.col(column).isNotNull()).limit(1)
    return rows.groupBy(*group_by).agg(F.count(column).alias("non_null_values")).where("non_null_values = 0")


def not_constant(df: DataFrame, column: str, group_by: list[str] = ()) -> DataFrame:
    """Groups with exactly one distinct non-NULL value; two running extremes instead of a distinct count."""
    ends = df.groupBy(*group_by).agg(F.min(column).alias("_min"), F.max(column).alias("_max"))
    return ends.where(F.col("_min") == F.col("_max")).select(*group_by, F.lit(1).cast("bigint").alias("distinct_values"))


def not_null_proportion(df: DataFrame, column: str, at_least: float, at_most: float = 1.0,
                        group_by: list[str] = ()) -> DataFrame:
    share = F.avg(F.when(F.col(column).isNull(), 0.0).otherwise(1.0)).alias("not_null_proportion")
    return df.groupBy(*group_by).agg(share).where(
        (F.col("not_null_proportion") < at_least) | (F.col("not_null_proportion") > at_most))


def recency(df: DataFrame, field: str, datepart: str, interval: int, now=None, ignore_time: bool = False,
            group_by: list[str] = ()) -> DataFrame:
    """Groups whose newest value is older than the interval; a group without values passes."""
    clock = F.current_timestamp() if now is None else F.lit(str(now)).cast("timestamp")
    limit, newest = date_add(datepart, -interval, clock), F.max(as_timestamp(field))
    if ignore_time:
        limit, newest = limit.cast("date"), newest.cast("date")
    out = df.groupBy(*group_by).agg(newest.alias("most_recent")).withColumn("threshold", limit)
    return out.where(F.col("most_recent") < F.col("threshold"))


def cardinality_equality(a: DataFrame, column: str, b: DataFrame, field: str) -> DataFrame:
    """(value, num_rows) pairs only one table has."""
    def counted(df: DataFrame, c: str) -> DataFrame:
        return df.groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("num_rows"))
    return symmetric_difference(counted(a, column), counted(b, field)).drop("which_diff")


def _counts(a: DataFrame, b: DataFrame, group_by: list[str], strict: bool) -> tuple[DataFrame, Column, Column]:
    both = compare_counts(a, b, group_by)
    left, right = F.col("count_a"), F.col("count_b")
    return (both, F.coalesce(left, F.lit(0)), F.coalesce(right, F.lit(0))) if strict else (both, left, right)


def equal_rowcount(a: DataFrame, b: DataFrame, group_by: list[str] = (), strict: bool = False) -> DataFrame:
    """Counts side by side with |difference|; a group one side lacks counts 0 unless ``strict``."""
    both, left, right = _counts(a, b, group_by, strict)
    return both.withColumn("diff_count", F.abs(left - right))


def fewer_rows_than(a: DataFrame, b: DataFrame, group_by: list[str] = (), strict: bool = False) -> DataFrame:
    """Counts side by side with the excess of a over b; equality counts 1."""
    both, left, right = _counts(a, b, group_by, strict)
    return both.withColumn("row_count_delta", F.when(left > right, left - right).when(left == right, 1).otherwise(0))


def _comparable(df: DataFrame, columns: list[str], precision: int | None) -> DataFrame:
    if precision is None:
        return df.select(*columns)
    kinds = {f.name.lower(): f.dataType for f in df.schema.fields}
    out = []
    for c in columns:
        kind = kinds[c.lower()]
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            out.append(F.round(F.col(c).cast("double"), precision).alias(c))
        elif isinstance(kind, T.DecimalType):
            out.append(F.round(c, precision).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def equality(a: DataFrame, b: DataFrame, columns: list[str] | None = None, exclude: list[str] | None = None,
             precision: int | None = None, strict: bool = False) -> DataFrame:
    """Rows of one table only, tagged by side (set semantics unless ``strict``)."""
    if columns and exclude:
        raise ValueError("give columns or exclude, not both")
    if not columns:
        out = {c.lower() for c in exclude or []}
        columns = [c for c in a.columns if c.lower() not in out]
        theirs = {c.lower() for c in b.columns} - out
        if {c.lower() for c in columns} != theirs:
            raise ValueError("the tables have different columns; name the columns to compare or exclude some")
    return symmetric_difference(_comparable(a, columns, precision), _comparable(b, columns, precision), strict)


GAPS = {"not_allowed": "=", "allowed": "<=", "required": "<"}


def mutually_exclusive_ranges(df: DataFrame, lower: str, upper: str, partition_by: str | None = None,
                              gaps: str = "allowed", zero_length: bool = False,
                              hot_rows: int | None = None) -> DataFrame:
    """Ranges that are empty, overlap, or break the gap rule; a NULL bound fails.

    ``lower`` and ``upper`` are SQL expressions.
    """
    if gaps not in GAPS:
        raise ValueError(f"gaps must be one of {list(GAPS)}, got {gaps!r}")
    keys = ["partition_by_col"] if partition_by else []
    head = [F.expr(partition_by).alias("partition_by_col")] if partition_by else []
    rows = df.select(*head, F.expr(lower).alias("lower_bound"), F.expr(upper).alias("upper_bound"))
    # a wrapped bound tells "next row has a NULL bound" from "no next row"
    rows = rows.withColumn("_here", F.struct(F.col("lower_bound").alias("v")))
    rows = lead(rows, "_here", "_next", [asc("lower_bound"), asc("upper_bound")], keys, hot_rows)
    rows = rows.withColumn("next_lower_bound", F.col("_next.v")).withColumn("is_last_record", F.col("_next").isNull())
    lo, up, nxt = F.col("lower_bound"), F.col("upper_bound"), F.col("next_lower_bound")
    wide_enough = F.coalesce(lo <= up if zero_length else lo < up, F.lit(False))
    follows = {"=": up == nxt, "<=": up <= nxt, "<": up < nxt}[GAPS[gaps]]
    in_order = F.coalesce(follows, F.col("is_last_record"), F.lit(False))
    return rows.drop("_here", "_next").where(~(wide_enough & in_order))


def sequential_values(df: DataFrame, column: str, interval: int = 1, datepart: str | None = None,
                      group_by: list[str] = (), hot_rows: int | None = None) -> DataFrame:
    """Values that are not their predecessor plus the interval; the first passes."""
    rows = df.select(*group_by, column)
    rows = lag(rows, column, "previous_value", [asc(column)], list(group_by), hot_rows)
    if datepart:
        ok = as_timestamp(column) == date_add(datepart, interval, "previous_value")
    else:
        ok = F.col(column) == F.col("previous_value") + F.lit(interval)
    return rows.where(true_only(~ok))


def columns_match(df: DataFrame, columns: list[str], transform: str = "upper", with_rows: bool = False) -> DataFrame:
    """(relation_column, input_column): names one side has and the other lacks.

    ``with_rows`` adds in ``num_rows`` how many rows of the relation hold a value in a column that the
    input lacks, 0 for a column that the relation lacks: what would be lost.
    """
    change = {"upper": str.upper, "lower": str.lower, "none": str}[transform]
    spark = df.sparkSession
    have = spark.createDataFrame([(change(c),) for c in df.columns], "relation_column string")
    want = spark.createDataFrame([(change(c),) for c in columns], "input_column string")
    both = have.join(want, F.col("relation_column") == F.col("input_column"), "full")
    off = both.where("relation_column is null or input_column is null")
    if not with_rows:
        return off
    wanted = {change(c) for c in columns}
    extra = [c for c in df.columns if change(c) not in wanted]
    if not extra:
        return off.withColumn("num_rows", F.lit(0).cast("bigint"))
    # one pass over the extra columns
    held = df.agg(*(F.count(F.col(f"`{c}`")).alias(f"_{i}") for i, c in enumerate(extra)))
    held = held.select(F.explode(F.array(*(F.struct(F.lit(change(c)).alias("name"), F.col(f"_{i}").alias("n")) for i, c in enumerate(extra)))).alias("h"))
    held = held.select(F.col("h.name").alias("_name"), F.col("h.n").alias("_n"))
    return off.join(F.broadcast(held), F.col("relation_column") == F.col("_name"), "left").select(
        "relation_column", "input_column", F.coalesce("_n", F.lit(0).cast("bigint")).alias("num_rows"))
