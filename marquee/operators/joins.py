"""Join shapes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import is_scan, stage

HOT_SHARE = 1000   # a key is hot above 1/HOT_SHARE of the rows: fewer than HOT_SHARE such keys
HOT_LEAST = 1_000  # and with at least this many of them, where it is only a matter of joining


def hot_keys(df: DataFrame, key: str, at_least: int = 1_000_000, share: int = HOT_SHARE) -> list:
    """Keys, None among them, that hold more than 1/share of the rows (and ``at_least`` rows): under ``share`` values.

    A mergeable sketch of the frequent keys finds the candidates in one pass without a
    shuffle of keys; only those are counted exactly.
    """
    total, without = df.agg(F.count(F.lit(1)), F.count_if(F.col(key).isNull())).first()
    floor = max(total // share, at_least)
    if total <= floor:
        return []
    # the sketch tracks 8 * share keys: no key above 1/share of the rows can slip out of it
    found = df.where(F.col(key).isNotNull()).agg(F.expr(f"approx_top_k(`{key}`, {share}, {8 * share})").alias("top"))
    likely = [r[0] for r in found.select(F.explode("top.item")).collect()]
    counted = df.where(F.col(key).isin(likely)).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > floor)
    return [r[0] for r in counted.select(key).collect()] + ([None] if without > floor else [])


def with_place(df: DataFrame, out: str) -> DataFrame:
    """Rows with their place in the file they are read from: the same in every attempt of a task, different for equal rows.

    Rows that do not come straight from files are stored first.
    """
    rows = df if is_scan(df) else stage(df, "placed")
    return rows.select("*", F.col("_metadata.row_index").alias(out))


def skew_join(facts: DataFrame, dim: DataFrame, key: str, how: str = "inner", salts: int = 64,
              hot: list | None = None) -> DataFrame:
    """Join whose hot fact keys are dealt over ``salts`` tasks.

    Only dimension rows of hot keys are copied; the salt is the row's place in its file,
    so a retried task deals it the same way and equal rows are spread too.  Rows without a key match nothing and
    are dealt without copies.  Without hot keys it is the plain join, and AQE still splits whatever partition turns out large.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    hot = hot_keys(facts, key) if hot is None else hot
    if not hot:
        return facts.join(dim, key, how)
    hot = [k for k in hot if k is not None]
    spread = F.pmod("_place", F.lit(salts)).cast("int")
    dealt = with_place(facts, "_place").withColumn(
        "_salt", F.when(F.col(key).isNull() | F.col(key).isin(hot), spread).otherwise(F.lit(0))).drop("_place")
    copies = F.when(F.col(key).isin(hot), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    copied = dim.withColumn("_salt", F.explode(copies))
    return dealt.join(copied, [key, "_salt"], how).drop("_salt")


def join_counted(rows: DataFrame, facts: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """``rows`` with the one fact row of their key (NULL is a key), when facts also tell each key's number of rows.

    Keys with more than 1/HOT_SHARE of the ``total`` rows are fewer than HOT_SHARE: their
    facts are broadcast, and the rest meets in a shuffle in which no key is hot.
    """
    limit = F.lit(max(HOT_LEAST, total // HOT_SHARE))
    often, rest = (facts.where(c).withColumnRenamed(key, "_key").drop(weight)
                   for c in (F.col(weight) > limit, F.col(weight) <= limit))
    in_hot = rows.join(F.broadcast(often), rows[key].eqNullSafe(often["_key"])).drop("_key")
    known = often.select(F.col("_key").alias("_hot"))
    others = rows.join(F.broadcast(known), rows[key].eqNullSafe(known["_hot"]), "left_anti")
    return in_hot.unionByName(others.join(rest, others[key].eqNullSafe(rest["_key"])).drop("_key"))


def orphans(child: DataFrame, column: str, parent: DataFrame, field: str,
            child_where: str | None = None, parent_where: str | None = None) -> DataFrame:
    """Child rows whose non-NULL value has no parent."""
    left = child.where(F.col(column).isNotNull())
    left = left.where(child_where) if child_where else left
    right = parent.where(parent_where) if parent_where else parent
    right = right.where(F.col(field).isNotNull()).select(F.col(field).alias("_parent"))
    return left.join(right, F.col(column) == F.col("_parent"), "left_anti")


def natural_join(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    """Equi-join on all common columns; NULL keys never match."""
    common = [c for c in a.columns if c in b.columns]
    if not common:
        raise ValueError("no common columns")
    return a.join(b, common, how)


def join_group_totals(df: DataFrame, keys: list[str], *aggs: Column) -> DataFrame:
    """Each row with its own group's aggregates.

    The totals are stored, so the join knows their size: small ones are
    broadcast and the rows stay where they are, otherwise both sides are
    shuffled and AQE can split a hot group.
    """
    totals = stage(df.groupBy(*keys).agg(*aggs), "group-totals")
    return df.join(totals, keys, "left")


def compare_counts(a: DataFrame, b: DataFrame, group_by: list[str] = ()) -> DataFrame:
    """Row counts of two tables side by side, per group (full outer join of two aggregates).

    Group keys match by plain equality, so a NULL group stays one-sided; a side
    without rows has a NULL count.
    """
    keys, n = list(group_by), F.count(F.lit(1)).alias("n")
    if not keys:
        one, other = a.agg(n), b.agg(n)
        return one.select(F.nullif("n", F.lit(0)).alias("count_a"), F.nullif(other.scalar(), F.lit(0)).alias("count_b"))

    def counted(df: DataFrame, side: str) -> DataFrame:
        return df.groupBy(*keys).agg(n).select(*[F.col(k).alias(f"{k}_{side}") for k in keys], F.col("n").alias(f"count_{side}"))

    on = [F.col(f"{k}_a") == F.col(f"{k}_b") for k in keys]
    both = counted(a, "a").join(counted(b, "b"), reduce(lambda x, y: x & y, on), "full")
    return both.select(*[f"{k}_{side}" for k in keys for side in "ab"], "count_a", "count_b")


def parent_child(titles: DataFrame, links: DataFrame, kind: str, parent_kind: str, child_kind: str,
                 parent: list[Column], child: list[Column], parent_key: str, child_key: str) -> DataFrame:
    """One table in two roles, joined through a link table; each role filters its rows first.

    ``parent`` must expose ``parent_key`` and ``child`` must expose ``child_key``.
    """
    parents = titles.where(F.col(kind) == parent_kind).select(*parent)
    children = titles.where(F.col(kind) == child_kind).select(*child)
    return links.join(parents, parent_key).join(children, child_key)
