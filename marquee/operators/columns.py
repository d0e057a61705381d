"""Operators over the columns of a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import empty_to_null


def remaining_columns(df: DataFrame, excluded: list[str] = ()) -> list[str]:
    """Column names not in the (case-insensitive) list."""
    out = {c.lower() for c in excluded}
    return [c for c in df.columns if c.lower() not in out]


def star(df: DataFrame, excluded: list[str] = (), prefix: str = "", suffix: str = "",
         alias: str | None = None) -> list[Column]:
    """All columns but some, optionally qualified by an alias and renamed."""
    lead = f"{alias}." if alias else ""
    return [F.col(f"{lead}`{c}`").alias(f"{prefix}{c}{suffix}") for c in remaining_columns(df, excluded)]


def aggregate_all(df: DataFrame, fn: Callable[[str], Column], excluded: list[str] = ()) -> DataFrame:
    """One aggregate applied to every remaining column, in one pass."""
    return df.agg(*[fn(c).alias(c) for c in remaining_columns(df, excluded)])


def blanks_to_null(df: DataFrame) -> DataFrame:
    """'' becomes NULL in every text column."""
    return df.select(*[
        empty_to_null(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def single_value(query: DataFrame, default) -> Column:
    """First column of a one-row query as an expression; ``default`` when it has no row.

    An aggregate over at most one row keeps the subquery scalar when empty.
    """
    c = query.columns[0]
    found = query.limit(1).agg(F.max(F.struct(F.lit(True).alias("hit"), F.col(c).alias("v"))).alias("r"))
    return F.when(found.select(F.col("r.hit")).scalar(), found.select(F.col("r.v")).scalar()).otherwise(F.lit(default))


def with_audit(df: DataFrame, batch_date: str | None = None, run_id: str | None = None) -> DataFrame:
    """Load time and, when given, the batch date and run id."""
    out = df.withColumn("loaded_at", F.current_timestamp())
    if batch_date is not None:
        out = out.withColumn("batch_date", F.lit(batch_date))
    return out if run_id is None else out.withColumn("run_id", F.lit(run_id))
