"""Number series, date spines and gap filling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import date_add, date_diff


def number_series(spark: SparkSession, upper: int) -> DataFrame:
    """generated_number = 1 .. upper."""
    if upper <= 0:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper + 1).select(F.col("id").alias("generated_number"))


def intervals_between(spark: SparkSession, start: str, end: str, datepart: str) -> int:
    """Number of periods the spine between two instants has."""
    one = spark.range(1).select(date_diff(datepart, F.lit(start), F.lit(end)).alias("n"))
    return one.first()[0]


def date_spine(spark: SparkSession, datepart: str, start: str, end: str) -> DataFrame:
    """Periods from ``start`` (included) to ``end`` (excluded); distributed like any range."""
    n = intervals_between(spark, start, end, datepart)
    if n <= 0:
        raise ValueError("the spine needs an end after its start")
    at = date_add(datepart, F.col("id").cast("int"), F.lit(start))
    out = f"date_{datepart.lower()}"
    return spark.range(n).select(at.alias(out)).where(F.col(out) <= F.lit(end).cast("timestamp"))


def fill_spine(spine: DataFrame, on: str, facts: DataFrame, zero: list[str]) -> DataFrame:
    """Facts per period, with zeros for the periods that have none."""
    return spine.join(facts, on, "left").withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zero})
