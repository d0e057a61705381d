"""Registration, table access and shared SQL views."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import tune
from ..sources.catalogue import CATALOGUE_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VIEWS: dict[str, str] = dict(CATALOGUE_SQL)   # named SQL the oracles may refer to

AS_OF = "2025-01-01"


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its equivalent over the same tables."""
    def keep(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)
        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLES[name] = with_views(sql)
        return fn
    return keep


def with_views(sql: str) -> str:
    """Prefix the named views a statement refers to, in dependency order."""
    order: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\b[a-z_]+\b", text)):
            if word in VIEWS and word not in order:
                visit(VIEWS[word])
                order.append(word)

    visit(sql)
    if not order:
        return sql.strip()
    ctes = ",\n".join(f"{v} AS ({VIEWS[v].strip()})" for v in order)
    return f"WITH {ctes}\n{sql.strip()}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, scale: int = 6) -> DataFrame:
    """Comparable output: decimals as doubles, doubles rounded, load times dropped."""
    out = []
    for f in df.schema.fields:
        if f.name == "loaded_at":
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DecimalType, T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), scale)
        out.append(c.alias(f.name))
    return df.select(*out)
