"""Unions and differences of tables."""

from __future__ import annotations

import fnmatch
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_WHOLE = ("tinyint", "smallint", "int", "bigint")
_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def common_type(kinds: list[T.DataType]) -> T.DataType:
    """The narrowest type that holds the values of all: numbers widen, dates become timestamps, anything else becomes text."""
    if all(k == kinds[0] for k in kinds):
        return kinds[0]
    kinds = [k for k in kinds if not isinstance(k, T.NullType)]
    whole = [k for k in kinds if type(k) in _BITS]
    decimals = [k for k in kinds if isinstance(k, T.DecimalType)]
    floating = [k for k in kinds if isinstance(k, (T.FloatType, T.DoubleType))]
    if kinds and len(whole) + len(decimals) + len(floating) == len(kinds):
        if floating:
            # a float holds 24 bits: only next to short whole numbers does it stay one
            narrow = all(isinstance(k, T.FloatType) for k in floating) and not decimals and all(_BITS[type(k)] <= 16 for k in whole)
            return T.FloatType() if narrow else T.DoubleType()
        if not decimals:
            return max(whole, key=lambda k: _BITS[type(k)])
        scale = max(k.scale for k in decimals)
        digits = max([k.precision - k.scale for k in decimals] + [_DIGITS[type(k)] for k in whole])
        return T.DecimalType(digits + scale, scale) if digits + scale <= 38 else T.DoubleType()
    if kinds and all(isinstance(k, (T.DateType, T.TimestampType)) for k in kinds):
        return T.TimestampType()
    return kinds[0] if kinds and all(k == kinds[0] for k in kinds) else T.StringType()


def union_relations(relations: dict[str, DataFrame], column_override: dict[str, str] | None = None,
                    include: list[str] = (), exclude: list[str] = (),
                    source_column: str | None = "source_relation", where: str | None = None,
                    types_from: str = "all") -> DataFrame:
    """Union of tables with different columns: superset of columns, NULL where absent.

    A column gets the narrowest type that holds the values of all tables (text, if they have nothing
    else in common), unless overridden.  With ``types_from='first'`` the first table to have it fixes its type,
    and fractions that meet a whole-number type are rounded: doubles to even, decimals away from zero.
    """
    if types_from not in ("all", "first"):
        raise ValueError("types_from must be 'all' or 'first'")
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    override = column_override or {}
    only, never = {c.lower() for c in include}, {c.lower() for c in exclude}
    found: dict[str, list[T.DataType]] = {}
    for df in relations.values():
        for f in df.schema.fields:
            low = f.name.lower()
            if low in never or (only and low not in only):
                continue
            found.setdefault(f.name, []).append(f.dataType)
    if not found:
        raise ValueError(f"no columns to union in {', '.join(relations)}")
    types = {c: override.get(c, (common_type(kinds) if types_from == "all" else kinds[0]).simpleString()) for c, kinds in found.items()}

    def cast(c: str, kind: T.DataType, to: str) -> Column:
        col = F.col(f"`{c}`")
        if to in _WHOLE and isinstance(kind, (T.DoubleType, T.FloatType)):
            col = F.bround(col, 0)
        elif to in _WHOLE and isinstance(kind, T.DecimalType):
            col = F.round(col, 0)
        return col.cast(to).alias(c)

    parts = []
    for name, df in relations.items():
        rows = df.where(where) if where else df
        kinds = {f.name: f.dataType for f in df.schema.fields}
        cols = [cast(c, kinds[c], t) if c in kinds else F.lit(None).cast(t).alias(c) for c, t in types.items()]
        if source_column is not None:
            cols.insert(0, F.lit(name).alias(source_column))
        parts.append(rows.select(*cols))
    return reduce(DataFrame.unionByName, parts)


def _like(name: str, pattern: str) -> bool:
    """Case-insensitive LIKE on a table name."""
    shell = "".join({"%": "*", "_": "?"}.get(ch, f"[{ch}]" if ch in "*?[" else ch) for ch in pattern.lower())
    return fnmatch.fnmatchcase(name.lower(), shell)


def tables_matching(spark: SparkSession, pattern: str, exclude: str = "", database: str | None = None) -> dict[str, DataFrame]:
    """Catalog tables and views by LIKE pattern, in name order."""
    names = sorted({t.name for t in spark.catalog.listTables(database)})
    hits = [n for n in names if _like(n, pattern) and not (exclude and _like(n, exclude))]
    return {n: spark.table(f"{database}.{n}" if database else n) for n in hits}


def tables_with_prefix(spark: SparkSession, prefix: str, exclude: str = "", database: str | None = None) -> dict[str, DataFrame]:
    return tables_matching(spark, f"{prefix}%", exclude, database)


def table_kinds(spark: SparkSession, pattern: str = "%", database: str | None = None) -> DataFrame:
    """(table_name, table_type) with types 'view', 'table' or 'external'."""
    kinds = {"VIEW": "view", "TEMPORARY": "view", "EXTERNAL": "external"}
    rows = [(t.name, kinds.get(t.tableType, "table")) for t in spark.catalog.listTables(database) if _like(t.name, pattern)]
    return spark.createDataFrame(rows, "table_name string, table_type string")


def union_files(spark: SparkSession, paths: dict[str, str], **options) -> DataFrame:
    """``union_relations`` over parquet paths."""
    return union_relations({name: spark.read.parquet(p) for name, p in paths.items()}, **options)


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of a that b lacks (EXCEPT); NULLs compare equal."""
    return a.subtract(b)


def symmetric_difference(a: DataFrame, b: DataFrame, strict: bool = False, tag: str = "which_diff") -> DataFrame:
    """Rows of one side only, tagged, in a single shuffle.

    Set semantics by default; ``strict`` also reports rows whose number of
    copies differs (once per row, on the side with more copies).
    """
    cols = a.columns
    both = a.withColumns({"_a": F.lit(1), "_b": F.lit(0)}).unionByName(
        b.select(*cols).withColumns({"_a": F.lit(0), "_b": F.lit(1)}))
    n = both.groupBy(*cols).agg(F.sum("_a").alias("_a"), F.sum("_b").alias("_b"))
    if strict:
        off = n.where("_a <> _b").withColumn(tag, F.when(F.expr("_a > _b"), "a_minus_b").otherwise("b_minus_a"))
    else:
        off = n.where("_a = 0 or _b = 0").withColumn(tag, F.when(F.expr("_b = 0"), "a_minus_b").otherwise("b_minus_a"))
    return off.select(tag, *cols)
