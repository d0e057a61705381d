"""Aggregations, joins and set operations over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import guarded_ratio
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import sets as U
from ..operators.columns import aggregate_all, single_value, star
from ..sources.catalogue import register_tables
from .core import query, rounded, table

# --- aggregations -------------------------------------------------------------------------


@query("multi_distinct", """
SELECT l_suppkey, count(DISTINCT l_orderkey) AS orders,
  count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_orderkey END) AS returned,
  count(DISTINCT CASE WHEN l_discount > 0.05 THEN l_orderkey END) AS discounted,
  count(DISTINCT CASE WHEN l_quantity >= 30 THEN l_orderkey END) AS bulky
FROM lineitem GROUP BY l_suppkey""")
def multi_distinct(spark, sf):
    flags = {"returned": F.col("l_returnflag") == "R", "discounted": F.col("l_discount") > 0.05, "bulky": F.col("l_quantity") >= 30}
    return A.distinct_counts(table(spark, sf, "lineitem"), ["l_suppkey"], "l_orderkey", flags, total="orders")


@query("count_distinct", "SELECT o_custkey, count(DISTINCT o_orderpriority) AS priorities FROM orders GROUP BY o_custkey")
def count_distinct(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(F.count_distinct("o_orderpriority").alias("priorities"))


@query("group_stats", """
SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(cast(l_extendedprice AS decimal(18,2))), 2)::double AS revenue,
  round(avg(l_quantity), 6) AS avg_quantity, min(l_shipdate) AS first_ship, max(l_extendedprice) AS top_price
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def group_stats(spark, sf):
    return rounded(table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("revenue"),
        F.avg("l_quantity").alias("avg_quantity"), F.min("l_shipdate").alias("first_ship"),
        F.max("l_extendedprice").alias("top_price")))


_MEDIAN = """
SELECT c_mktsegment, round(quantile_cont(o_totalprice, 0.5), 6) AS median_price
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment"""


def _median(spark, sf, hot_rows=None):
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_totalprice")
    joined = orders.join(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "c_custkey")
    return rounded(A.percentile_cont(joined, ["c_mktsegment"], "o_totalprice", 0.5, "median_price", hot_rows))


query("median_by_segment", _MEDIAN)(_median)
query("median_by_segment_sliced", _MEDIAN)(lambda spark, sf: _median(spark, sf, hot_rows=0))


@query("stddev_by_type", """
SELECT p_type, round(stddev_samp(p_retailprice), 6) AS spread, count(*) AS n FROM part GROUP BY p_type""")
def stddev_by_type(spark, sf):
    return rounded(table(spark, sf, "part").groupBy("p_type").agg(
        F.stddev_samp("p_retailprice").alias("spread"), F.count(F.lit(1)).alias("n")))


@query("cond_counts", """
SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS finished, count(*) FILTER (o_totalprice > 150000) AS large,
  count(CASE WHEN o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1997-01-01' THEN 1 END) AS mid_nineties
FROM orders GROUP BY o_orderpriority""")
def cond_counts(spark, sf):
    date = F.col("o_orderdate")
    return table(spark, sf, "orders").groupBy("o_orderpriority").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("finished"), F.count_if(F.col("o_totalprice") > 150000).alias("large"),
        F.count_if((date >= "1995-01-01") & (date < "1997-01-01")).alias("mid_nineties"))


@query("cond_avg", """
SELECT event_type, round(avg(CASE WHEN value >= 20 THEN value END), 6) AS avg_high,
  round(avg(CASE WHEN value < 20 THEN value END), 6) AS avg_low FROM events GROUP BY event_type""")
def cond_avg(spark, sf):
    v = F.col("value")
    return rounded(table(spark, sf, "events").groupBy("event_type").agg(
        F.avg(F.when(v >= 20, v)).alias("avg_high"), F.avg(F.when(v < 20, v)).alias("avg_low")))


@query("ratio_zero_guard", """
SELECT s_suppkey, round(count(l_orderkey) / greatest(count(DISTINCT l_partkey), 1), 2) AS lines_per_part
FROM supplier LEFT JOIN lineitem ON s_suppkey = l_suppkey GROUP BY s_suppkey""")
def ratio_zero_guard(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        F.count("l_orderkey").alias("n"), F.count_distinct("l_partkey").alias("parts"))
    joined = table(spark, sf, "supplier").select("s_suppkey").join(lines, "s_suppkey", "left")
    n, parts = F.coalesce("n", F.lit(0)), F.coalesce("parts", F.lit(0))
    return rounded(joined.select("s_suppkey", guarded_ratio(n, parts, 2).alias("lines_per_part")))


@query("having_big", """
SELECT o_custkey, count(DISTINCT o_orderpriority) AS priorities, count(*) AS n FROM orders GROUP BY o_custkey
HAVING count(DISTINCT o_orderpriority) >= 4""")
def having_big(spark, sf):
    return table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count_distinct("o_orderpriority").alias("priorities"), F.count(F.lit(1)).alias("n")).where("priorities >= 4")


@query("share_of_total", """
SELECT p_brand, cast(sum(l_quantity) AS bigint) AS quantity,
  round(sum(l_quantity) / (SELECT sum(l_quantity) FROM lineitem JOIN part ON l_partkey = p_partkey), 4) AS quantity_share
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""")
def share_of_total(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_quantity")
    brands = lines.join(table(spark, sf, "part").select("p_partkey", "p_brand"), "p_partkey").groupBy("p_brand").agg(
        F.sum("l_quantity").cast("bigint").alias("quantity"))
    return rounded(A.with_shares(brands, {"quantity_share": "quantity"}))


@query("total_of_groups", """
SELECT cast(sum(n) AS bigint) AS lines, cast(max(n) AS bigint) AS largest_order, count(*) AS orders
FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) x""")
def total_of_groups(spark, sf):
    per_order = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    return per_order.agg(F.sum("n").alias("lines"), F.max("n").alias("largest_order"), F.count(F.lit(1)).alias("orders"))


@query("group_first_n", """
SELECT l_returnflag, l_linestatus, cast(sum(l_quantity) AS bigint) AS quantity FROM lineitem GROUP BY 1, 2""")
def group_first_n(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity")
    return A.group_first(rows, 2, F.sum("l_quantity").cast("bigint").alias("quantity"))


@query("row_proportion", """
SELECT event_type, round(avg(CASE WHEN value > 10 THEN 1.0 ELSE 0.0 END), 6) AS share_above FROM events GROUP BY event_type""")
def row_proportion(spark, sf):
    return rounded(A.proportion(table(spark, sf, "events"), F.col("value") > 10, "share_above", ["event_type"]))


@query("value_frequencies_topk", """
SELECT user_id AS value, count(*) AS num_rows FROM events WHERE event_type <> 'error' GROUP BY user_id
ORDER BY num_rows DESC, value LIMIT 10""")
def value_frequencies_topk(spark, sf):
    return A.value_frequencies(table(spark, sf, "events"), "user_id", where="event_type <> 'error'", limit=10)


@query("value_frequencies", "SELECT p_type AS value, count(*) AS num_rows FROM part GROUP BY p_type")
def value_frequencies(spark, sf):
    return A.value_frequencies(table(spark, sf, "part"), "p_type")


@query("max_of_every_column", """
SELECT max(o_custkey) AS o_custkey, max(o_orderstatus) AS o_orderstatus, max(o_totalprice) AS o_totalprice,
  max(o_orderdate) AS o_orderdate, max(o_orderpriority) AS o_orderpriority FROM orders""")
def max_of_every_column(spark, sf):
    return aggregate_all(table(spark, sf, "orders"), F.max, excluded=["O_ORDERKEY"])


@query("distinct_values", "SELECT DISTINCT event_type, user_id FROM events")
def distinct_values(spark, sf):
    return table(spark, sf, "events").select("event_type", "user_id").distinct()


@query("scalar_default", """
SELECT c_custkey, coalesce((SELECT max(o_orderkey) FROM orders WHERE o_totalprice < 0), -1) AS missing,
  coalesce((SELECT max(o_orderkey) FROM orders), -1) AS newest FROM customer""")
def scalar_default(spark, sf):
    orders = table(spark, sf, "orders")
    none = orders.where("o_totalprice < 0").select("o_orderkey")
    newest = orders.agg(F.max("o_orderkey").alias("newest"))
    return table(spark, sf, "customer").select("c_custkey", single_value(none, -1).alias("missing"), single_value(newest, -1).alias("newest"))


# --- joins ------------------------------------------------------------------------------------


@query("join_inner", """
SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey""")
def join_inner(spark, sf):
    orders = table(spark, sf, "orders")
    customer = table(spark, sf, "customer").select("c_custkey", "c_name")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "o_totalprice")


@query("join_left", """
SELECT c_custkey, n FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey) o ON c_custkey = o_custkey""")
def join_left(spark, sf):
    n = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    return table(spark, sf, "customer").select("c_custkey").join(n, "c_custkey", "left")


@query("join_chain", """
SELECT n_name, r_name, count(*) AS lines, round(sum(cast(l_extendedprice AS decimal(18,2))), 2)::double AS revenue
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY n_name, r_name""")
def join_chain(spark, sf):
    # shrink the fact table to one row per supplier before it meets the dimensions
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("r"))
    nation = table(spark, sf, "nation").withColumnsRenamed({"n_nationkey": "s_nationkey", "n_regionkey": "r_regionkey"})
    joined = lines.join(table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), "s_suppkey") \
        .join(nation, "s_nationkey").join(table(spark, sf, "region"), "r_regionkey", "left")
    return rounded(joined.groupBy("n_name", "r_name").agg(F.sum("n").alias("lines"), F.sum("r").alias("revenue")))


@query("join_back_totals", """
SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, lines, round(total_quantity, 6) AS total_quantity FROM lineitem
  JOIN (SELECT l_orderkey, count(*) AS lines, sum(l_quantity) AS total_quantity FROM lineitem GROUP BY l_orderkey) t USING (l_orderkey)""")
def join_back_totals(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    return rounded(J.join_group_totals(rows, ["l_orderkey"], F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("total_quantity")))


@query("join_parent_child", """
SELECT p.o_orderkey AS parent_key, c.o_orderkey AS child_key, p.o_totalprice AS parent_price, c.o_totalprice AS child_price
FROM (SELECT o_custkey, min(o_orderkey) AS pk FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey) l
  JOIN orders c ON c.o_custkey = l.o_custkey AND c.o_orderstatus = 'P' JOIN orders p ON p.o_orderkey = pk""")
def join_parent_child(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    first = orders.where("o_orderstatus = 'O'").groupBy("o_custkey").agg(F.min("o_orderkey").alias("parent_key"))
    links = orders.where("o_orderstatus = 'P'").select("o_custkey", F.col("o_orderkey").alias("child_key")) \
        .join(first, "o_custkey").select("parent_key", "child_key")
    return J.parent_child(
        orders, links, "o_orderstatus", "O", "P",
        parent=[F.col("o_orderkey").alias("parent_key"), F.col("o_totalprice").alias("parent_price")],
        child=[F.col("o_orderkey").alias("child_key"), F.col("o_totalprice").alias("child_price")],
        parent_key="parent_key", child_key="child_key")


@query("join_full_counts", """
SELECT a.c_nationkey AS nation_a, b.s_nationkey AS nation_b, a.n AS count_a, b.n AS count_b
FROM (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) a
  FULL JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1) b ON c_nationkey = s_nationkey""")
def join_full_counts(spark, sf):
    a = table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation"))
    return J.compare_counts(a, table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation")), ["nation"])


@query("join_anti", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000)""")
def join_anti(spark, sf):
    return J.orphans(table(spark, sf, "customer").select("c_custkey", "c_name"), "c_custkey",
                     table(spark, sf, "orders"), "o_custkey", parent_where="o_totalprice > 200000")


@query("join_natural", """
SELECT key, region, nation FROM (SELECT n_regionkey AS key, n_name AS nation FROM nation) a
  JOIN (SELECT r_regionkey AS key, r_name AS region FROM region) b USING (key)""")
def join_natural(spark, sf):
    return J.natural_join(table(spark, sf, "nation").select(F.col("n_regionkey").alias("key"), F.col("n_name").alias("nation")),
                          table(spark, sf, "region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("region")))


@query("join_skewed", """
SELECT e.event_type, e.user_id, e.event_id, t.n FROM events e
  JOIN (SELECT event_type, count(*) AS n FROM events GROUP BY event_type) t USING (event_type)""")
def join_skewed(spark, sf):
    """Five keys hold all rows: each is dealt over salted tasks."""
    events = table(spark, sf, "events").select("event_id", "event_type", "user_id")
    totals = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    hot = J.hot_keys(events, "event_type", at_least=1)
    return J.skew_join(events, totals, "event_type", salts=16, hot=hot)


# --- set operations -----------------------------------------------------------------------------


@query("except_sets", """
SELECT o_custkey FROM orders EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'""")
def except_sets(spark, sf):
    orders = table(spark, sf, "orders")
    return U.difference(orders.select("o_custkey"), orders.where("o_orderstatus = 'F'").select("o_custkey"))


@query("sym_diff", """
WITH a AS (SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F'),
  b AS (SELECT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'O')
SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b) x
UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a) y""")
def sym_diff(spark, sf):
    orders = table(spark, sf, "orders").select("o_custkey", "o_orderpriority", "o_orderstatus")
    return U.symmetric_difference(orders.where("o_orderstatus = 'F'").drop("o_orderstatus"),
                                  orders.where("o_orderstatus = 'O'").drop("o_orderstatus"))


def _parties(spark, sf):
    return {"customer": table(spark, sf, "customer").withColumnsRenamed({"c_nationkey": "nationkey", "c_acctbal": "acctbal"}),
            "supplier": table(spark, sf, "supplier").withColumnsRenamed({"s_nationkey": "nationkey", "s_acctbal": "acctbal"})}


@query("union_superset", """
SELECT 'customer' AS source_relation, c_custkey, c_name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment,
  NULL::bigint AS s_suppkey, NULL::varchar AS s_name FROM customer
UNION ALL SELECT 'supplier', NULL, NULL, s_nationkey, s_acctbal, NULL, s_suppkey, s_name FROM supplier""")
def union_superset(spark, sf):
    return U.union_relations(_parties(spark, sf))


@query("union_include", """
SELECT cast(c_nationkey AS bigint) AS nationkey, c_acctbal AS acctbal FROM customer
UNION ALL SELECT s_nationkey, s_acctbal FROM supplier""")
def union_include(spark, sf):
    return U.union_relations(_parties(spark, sf), include=["NATIONKEY", "acctbal"], source_column=None, column_override={"nationkey": "bigint"})


@query("union_where", """
SELECT 'customer' AS origin, c_custkey, c_mktsegment, c_acctbal AS acctbal, NULL::bigint AS s_suppkey FROM customer WHERE c_acctbal < 0
UNION ALL SELECT 'supplier', NULL, NULL, s_acctbal, s_suppkey FROM supplier WHERE s_acctbal < 0""")
def union_where(spark, sf):
    return U.union_relations(_parties(spark, sf), exclude=["c_name", "s_name", "nationkey"], source_column="origin", where="acctbal < 0")


@query("union_all", """
SELECT c_nationkey AS nationkey, 'customer' AS kind FROM customer UNION ALL SELECT s_nationkey, 'supplier' FROM supplier""")
def union_all(spark, sf):
    p = _parties(spark, sf)
    return p["customer"].select("nationkey", F.lit("customer").alias("kind")).unionByName(
        p["supplier"].select("nationkey", F.lit("supplier").alias("kind")))


@query("union_by_pattern", """
SELECT 'customer' AS source_relation, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, NULL::bigint AS s_suppkey,
  NULL::varchar AS s_name, NULL::int AS s_nationkey, NULL::double AS s_acctbal FROM customer
UNION ALL SELECT 'supplier', NULL, NULL, NULL, NULL, NULL, s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""")
def union_by_pattern(spark, sf):
    register_tables(spark, sf, ["customer", "supplier", "orders"])
    return U.union_relations(U.tables_matching(spark, "%ER", exclude="order%"))


@query("union_by_prefix", """
SELECT 'customer' AS source_relation, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, NULL::bigint AS conv_id, NULL::bigint AS turn,
  NULL::varchar AS role, NULL::varchar AS text FROM customer
UNION ALL SELECT 'conversations', NULL, NULL, NULL, NULL, NULL, conv_id, turn, role, text FROM conversations""")
def union_by_prefix(spark, sf):
    register_tables(spark, sf, ["customer", "conversations", "orders"])
    return U.union_relations(dict(reversed(U.tables_with_prefix(spark, "c").items())))


@query("union_files", """
SELECT 'nation' AS source_relation, n_name, n_regionkey, NULL::varchar AS r_name FROM nation
UNION ALL SELECT 'region', NULL, NULL, r_name FROM region
UNION ALL SELECT 'part', NULL, NULL, NULL FROM part""")
def union_files(spark, sf):
    paths = {name: f"{sf}/{name}.parquet" for name in ("nation", "region", "part")}
    return U.union_files(spark, paths, include=["n_regionkey", "n_name", "r_name"])


@query("union_mixed_types", """
SELECT 'lines' AS source_relation, l_linenumber::double AS amount, l_orderkey::varchar AS code FROM lineitem
UNION ALL SELECT 'prices', p_retailprice, p_brand FROM part
UNION ALL SELECT 'balances', c_acctbal, NULL FROM customer""")
def union_mixed_types(spark, sf):
    """Whole numbers first, then fractions; keys first, then names: the common type holds all of them."""
    return U.union_relations({
        "lines": table(spark, sf, "lineitem").select(F.col("l_linenumber").cast("int").alias("amount"), F.col("l_orderkey").alias("code")),
        "prices": table(spark, sf, "part").select(F.col("p_retailprice").alias("amount"), F.col("p_brand").alias("code")),
        "balances": table(spark, sf, "customer").select(F.col("c_acctbal").alias("amount"))})


@query("union_first_types", """
SELECT 'lines' AS source_relation, l_linenumber AS amount FROM lineitem
UNION ALL SELECT 'prices', round_even(p_retailprice, 0)::int FROM part""")
def union_first_types(spark, sf):
    """The first table's type asked for: fractions are rounded to it."""
    return U.union_relations({
        "lines": table(spark, sf, "lineitem").select(F.col("l_linenumber").cast("int").alias("amount")),
        "prices": table(spark, sf, "part").select(F.col("p_retailprice").alias("amount"))}, types_from="first")


@query("star_except", "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def star_except(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.select(*star(orders, excluded=["O_CUSTKEY", "o_orderdate"]))


@query("star_renamed", """
SELECT o_orderkey AS x_o_orderkey_y, o_totalprice AS x_o_totalprice_y, o_orderpriority AS x_o_orderpriority_y FROM orders""")
def star_renamed(spark, sf):
    orders = table(spark, sf, "orders").alias("t")
    return orders.select(*star(orders, ["o_custkey", "o_orderdate", "o_orderstatus"], prefix="x_", suffix="_y", alias="t"))
