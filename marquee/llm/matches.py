"""Regular-expression matches of whole texts with their places, in SQL functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

PLACES = "array<struct<s:int,e:int,hit:string>>"


def located(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as (s, e, hit); s and e count code points, e is exclusive.

    The text between matches comes from a split by the same pattern, so the
    places are running sums of lengths.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    steps = F.zip_with(F.split(text, pattern, -1), hits, lambda gap, hit: F.struct(F.length(gap).alias("g"), hit.alias("hit")))

    def add(acc: Column, x: Column) -> Column:
        s = acc["at"] + x["g"]
        e = s + F.length(x["hit"])
        return F.when(x["hit"].isNull(), acc).otherwise(F.struct(
            e.alias("at"), F.concat(acc["out"], F.array(F.struct(s.alias("s"), e.alias("e"), x["hit"].alias("hit")))).alias("out")))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(PLACES).alias("out"))
    return F.when(text.rlike(pattern), F.aggregate(steps, start, add, lambda acc: acc["out"])).otherwise(F.array().cast(PLACES))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once: lambdas evaluate what they capture at every call."""
    return F.transform(F.array(value), use)[0]


def rewritten(text: Column, pattern: str, change: Callable[[Column], Column], gate: str) -> Column:
    """The text with every match replaced by ``change(match)``.

    ``gate`` is a cheap pattern that is found in every text with a match.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.zip_with(F.split(text, pattern, -1), F.transform(hits, change),
                       lambda gap, new: F.concat(gap, F.coalesce(new, F.lit(""))))
    return F.when(text.rlike(gate) & text.rlike(pattern), F.array_join(parts, "")).otherwise(text)


def characters(s: Column) -> Column:
    """The characters of a string as an array."""
    return F.regexp_extract_all(s, F.lit(r"(?s)."), F.lit(0))
