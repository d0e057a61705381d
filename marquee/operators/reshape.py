"""Pivot, unpivot and list splitting."""

from __future__ import annotations

import operator
import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import part

_COMPARE = {"=": operator.eq, "<>": operator.ne, "!=": operator.ne, "<": operator.lt,
            "<=": operator.le, ">": operator.gt, ">=": operator.ge}
_AGGREGATE = {"sum": F.sum, "count": F.count, "avg": F.avg, "min": F.min, "max": F.max}
_PER_PASS = 500


def column_slug(text: str) -> str:
    """``functions.text.slug`` for a column name."""
    kept = re.sub("[^a-z0-9_]", "", re.sub("[ -]+", "_", text.lower()))
    return f"_{kept}" if kept[:1].isdigit() else kept


def pivot_columns(column: str, values: list, agg: str = "sum", cmp: str = "=", prefix: str = "",
                  suffix: str = "", then_value=1, else_value=0, distinct: bool = False,
                  slugify: bool = False, alias: bool = True) -> list[Column]:
    """One conditional aggregate per value; absent values give the else value, not NULL."""
    out = []
    for v in values:
        case = F.when(_COMPARE[cmp](F.col(column), F.lit(v)), _term(then_value)).otherwise(_term(else_value))
        if distinct:
            case = F.count_distinct(case) if agg == "count" else F.sum_distinct(case)
        else:
            case = _AGGREGATE[agg](case)
        name = f"{prefix}{v}{suffix}"
        out.append(case.alias(column_slug(name) if slugify else name) if alias else case)
    return out


def _term(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def pivot(df: DataFrame, group_by: list[str], column: str, values: list, **options) -> DataFrame:
    """Values of ``column`` as columns, one row per group.

    One aggregate pass makes _PER_PASS columns; the passes of more values are joined on the groups.
    """
    one = _distinct_pass if options.get("distinct") else _pass
    passes = [one(df, group_by, column, values[at:at + _PER_PASS], options) for at in range(0, max(len(values), 1), _PER_PASS)]

    def beside(a: DataFrame, b: DataFrame) -> DataFrame:
        b = b.withColumnsRenamed({k: f"_k{i}" for i, k in enumerate(group_by)})
        same = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(group_by)], F.lit(True))
        return a.join(b, same).drop(*[f"_k{i}" for i in range(len(group_by))])

    return reduce(beside, passes)


def _pass(df: DataFrame, group_by: list[str], column: str, values: list, options: dict) -> DataFrame:
    return df.groupBy(*group_by).agg(*pivot_columns(column, values, **options))


def _distinct_pass(df: DataFrame, group_by: list[str], column: str, values: list, options: dict) -> DataFrame:
    """Distinct counts or sums in two levels, where one aggregate would expand every row once for each value.

    Level 1 keeps one row for each group and entity (the then value) with a mark for each
    value that it matches; level 2 adds marks.  The else value is one entity more
    wherever a row does not match and no matching row has it already.
    """
    agg, cmp = options.get("agg", "sum"), options.get("cmp", "=")
    then, other = _term(options.get("then_value", 1)), _term(options.get("else_value", 0))
    names = pivot_columns(column, values, **{**options, "distinct": False, "agg": "count"})
    hits = [F.coalesce(_COMPARE[cmp](F.col(column), F.lit(v)), F.lit(False)) for v in values]
    marks = [F.max(h).alias(f"_m{i}") for i, h in enumerate(hits)] + [F.max(~h).alias(f"_o{i}") for i, h in enumerate(hits)]
    # both values in the type that one CASE of them has
    entity, other = (F.when(F.lit(first), then).otherwise(other) for first in (True, False))
    once = df.select(*group_by, F.col(column), entity.alias("_entity"), other.alias("_other"))
    once = once.groupBy(*group_by, "_entity", "_other").agg(*marks)

    def total(i: int) -> Column:
        mine, others = F.col(f"_m{i}"), F.col(f"_o{i}")
        extra = F.max(F.when(others, F.col("_other")))
        known = F.bool_or(mine & F.col("_entity").eqNullSafe(F.col("_other")))
        more = extra.isNotNull() & ~F.coalesce(known, F.lit(False))
        if agg == "count":
            return F.count(F.when(mine, F.col("_entity"))) + more.cast("bigint")
        if agg != "sum":
            raise ValueError("distinct values are counted or summed")
        matched = F.sum(F.when(mine, F.col("_entity")))
        return F.when(more, F.coalesce(matched, F.lit(0)) + extra).otherwise(matched)

    labels = df.groupBy(*group_by).agg(*names).columns[len(group_by):]
    return once.groupBy(*group_by).agg(*[total(i).alias(n) for i, n in enumerate(labels)])


def unpivot(df: DataFrame, cast_to: str = "string", keep: list[str] = (), remove: list[str] = (),
            field_name: str = "field_name", value_name: str = "value") -> DataFrame:
    """Columns as rows; ``keep`` columns repeat, ``remove`` columns vanish, NULLs stay."""
    skip = {c.lower() for c in [*keep, *remove]}
    fields = [f for f in df.schema.fields if f.name.lower() not in skip]
    cast = []
    for f in fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.BooleanType):
            c = c.cast("string")
        cast.append(c.cast(cast_to).alias(f.name))
    names = [f.name for f in fields]
    return df.select(*keep, *cast).unpivot(list(keep), names, field_name, value_name)


def columns_to_ranked_rows(df: DataFrame, keys: list[str], columns: list[str], value_name: str,
                           rank_name: str) -> DataFrame:
    """Columns as rows with their 1-based position, blanks skipped, in one scan."""
    exploded = df.select(*keys, F.posexplode(F.array(*columns)).alias("_at", value_name))
    return exploded.where(F.col(value_name) != "").select(*keys, value_name, (F.col("_at") + 1).alias(rank_name))


def split_rows(df: DataFrame, column: str, out: str, delimiter: str = ",", drop: list[str] = ("",),
               keep: list[str] | None = None, position: str | None = None) -> DataFrame:
    """A delimited list as one trimmed row per item; items in ``drop`` vanish."""
    kept = [c for c in df.columns if c != column] if keep is None else list(keep)
    items = F.split(F.col(column), _literal(delimiter), -1)
    rows = df.select(*kept, F.posexplode(items).alias("_at", out)).withColumn(out, F.trim(F.col(out)))
    if drop:
        rows = rows.where(reduce(lambda a, b: a & b, [F.col(out) != d for d in drop]))
    return rows.withColumnRenamed("_at", position) if position else rows.drop("_at")


def _literal(delimiter: str) -> str:
    return "".join(f"\\{ch}" if ch in r"\.[]{}()*+-?^$|" else ch for ch in delimiter)


def split_columns(df: DataFrame, column: str, names: list[str], delimiter: str = ",",
                  blank_to_null: bool = False) -> DataFrame:
    """The first pieces of a delimited list as columns."""
    pieces = {}
    for i, name in enumerate(names, start=1):
        p = part(column, i, delimiter)
        pieces[name] = F.nullif(p, F.lit("")) if blank_to_null else p
    return df.withColumns(pieces)
