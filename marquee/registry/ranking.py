"""Ranks, neighbours and deduplication over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ranking as K
from .core import query, rounded, table

_NUMBERED = """SELECT o_orderkey, o_orderstatus,
  row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS price_rank FROM orders"""
_PERCENT = "SELECT o_orderkey, round(percent_rank() OVER (ORDER BY o_totalprice), 6) AS price_percentile FROM orders"
_LAG = "SELECT event_id, lag(ts) OVER (ORDER BY ts, event_id) AS previous_ts FROM events"
_LEAD = "SELECT event_id, user_id, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_ts FROM events"


def _rank_in_status(spark, sf, hot_rows=None):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    ranked = K.row_number(rows, ["o_orderstatus"], [K.desc("o_totalprice"), K.asc("o_orderkey")], "price_rank", hot_rows)
    return ranked.drop("o_totalprice")


def _percent(spark, sf, hot_rows=None):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return rounded(K.percent_rank(rows, "o_totalprice", "price_percentile", hot_rows).drop("o_totalprice"))


def _lag(spark, sf, hot_rows=None):
    rows = table(spark, sf, "events").select("event_id", "ts")
    return K.lag(rows, "ts", "previous_ts", [K.asc("ts"), K.asc("event_id")], hot_rows=hot_rows).drop("ts")


def _lead(spark, sf, hot_rows=None):
    rows = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return K.lead(rows, "ts", "next_ts", [K.asc("ts"), K.asc("event_id")], ["user_id"], hot_rows).drop("ts")


# each runs once on its default route and once on the route for huge groups
for _name, _fn, _sql in (("rank_in_status", _rank_in_status, _NUMBERED), ("percent_rank_price", _percent, _PERCENT),
                         ("lag_event_gap", _lag, _LAG), ("lead_event_gap", _lead, _LEAD)):
    query(_name, _sql)(_fn)
    query(f"{_name}_sliced", _sql)(lambda spark, sf, fn=_fn: fn(spark, sf, hot_rows=0))


@query("rank_many_one_sort", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
  row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_shipdate, l_linestatus) AS flag_rank,
  row_number() OVER (PARTITION BY l_linestatus ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_tax, l_shipdate, l_linestatus) AS status_rank
FROM lineitem""")
def rank_many_one_sort(spark, sf):
    """Two rankings of the whole table from one global sort."""
    tie = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax", "l_shipdate", "l_linestatus"]
    rows = table(spark, sf, "lineitem").select("l_extendedprice", "l_returnflag", *tie)
    ranked = K.row_numbers(rows, {"flag_rank": ["l_returnflag"], "status_rank": ["l_linestatus"]},
                           [K.desc("l_extendedprice"), *[K.asc(c) for c in tie]], hot_rows=0)
    return ranked.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "flag_rank", "status_rank")


@query("order_line_position", """
SELECT l_orderkey, l_partkey, l_suppkey, l_extendedprice,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice, l_partkey, l_suppkey, l_quantity, l_discount, l_shipdate) AS position
FROM lineitem""")
def order_line_position(spark, sf):
    tie = ["l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_shipdate"]
    rows = table(spark, sf, "lineitem").select("l_orderkey", *tie)
    return K.row_number(rows, ["l_orderkey"], [K.asc(c) for c in tie], "position") \
        .select("l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "position")


@query("dedup_latest_event", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) x WHERE rn = 1""")
def dedup_latest_event(spark, sf):
    return K.deduplicate(table(spark, sf, "events"), ["user_id"], [("ts", "desc"), ("event_id", "desc")])


@query("dedup_mixed_order", """
SELECT o_orderkey, o_custkey, o_orderpriority, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey) AS rn FROM orders) x
WHERE rn = 1""")
def dedup_mixed_order(spark, sf):
    return K.deduplicate(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice"),
                         ["o_custkey"], [("o_orderpriority", "asc"), ("o_totalprice", "desc"), ("o_orderkey", "asc")])


@query("top_n_per_group", """
SELECT p_brand, p_partkey, p_retailprice, rn FROM (
  SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rn FROM part) x WHERE rn <= 3""")
def top_n_per_group(spark, sf):
    rows = table(spark, sf, "part").select("p_brand", "p_partkey", "p_retailprice")
    return K.top_n(rows, ["p_brand"], [K.desc("p_retailprice"), K.asc("p_partkey")], 3, "rn").withColumn("rn", F.col("rn").cast("bigint"))
