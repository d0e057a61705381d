"""Data checks over the given tables and the derived catalogue; each returns its failing rows."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from ..operators.columns import star
from ..plans import build as B
from ..quality import checks as C
from ..quality import runner as Q
from ..quality.suite import ALL
from ..session import at_once, scratch_path
from ..sources.catalogue import raw
from .core import AS_OF, query, rounded, table
from .layers import stg


@query("chk_not_null", "SELECT tconst, season_number, episode_number FROM stg_episodes WHERE season_number IS NULL")
def chk_not_null(spark, sf):
    return C.not_null(stg(spark, sf, "stg_episodes").select("tconst", "season_number", "episode_number"), "season_number")


@query("chk_unique", """
SELECT o_custkey AS unique_field, count(*) AS n_records FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING count(*) > 1""")
def chk_unique(spark, sf):
    return C.unique(table(spark, sf, "orders"), "o_custkey")


@query("chk_accepted_values", """
SELECT title_type AS value_field, count(*) AS n_records FROM stg_titles WHERE title_type NOT IN ('movie', 'tvSeries') GROUP BY 1""")
def chk_accepted_values(spark, sf):
    return C.accepted_values(stg(spark, sf, "stg_titles"), "title_type", ["movie", "tvSeries"])


@query("chk_relationships", """
SELECT l_orderkey AS from_field FROM lineitem LEFT JOIN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') o ON l_orderkey = o_orderkey
WHERE o_orderkey IS NULL""")
def chk_relationships(spark, sf):
    return C.relationships(table(spark, sf, "lineitem"), "l_orderkey", table(spark, sf, "orders").where("o_orderstatus <> 'P'"), "o_orderkey")


@query("chk_accepted_range", """
SELECT s_suppkey, s_acctbal FROM supplier WHERE s_acctbal < 0 OR s_acctbal > 5000""")
def chk_accepted_range(spark, sf):
    return C.accepted_range(table(spark, sf, "supplier").select("s_suppkey", "s_acctbal"), "s_acctbal", 0, 5000)


@query("chk_accepted_range_open", """
SELECT l_orderkey, l_partkey, l_suppkey, l_quantity FROM lineitem WHERE l_quantity >= 50 OR l_quantity <= 1""")
def chk_accepted_range_open(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    return C.accepted_range(rows, "l_quantity", 1, 50, inclusive=False)


@query("chk_at_least_one", """
SELECT title_type, count(end_year) AS non_null_values FROM stg_titles GROUP BY title_type HAVING count(end_year) = 0""")
def chk_at_least_one(spark, sf):
    return C.at_least_one(stg(spark, sf, "stg_titles"), "end_year", ["title_type"])


@query("chk_cardinality_equality", """
WITH a AS (SELECT o_custkey AS value, count(*) AS num_rows FROM orders GROUP BY 1),
  b AS (SELECT c_custkey AS value, count(*) AS num_rows FROM customer GROUP BY 1)
SELECT * FROM (SELECT * FROM a EXCEPT SELECT * FROM b) x UNION ALL SELECT * FROM (SELECT * FROM b EXCEPT SELECT * FROM a) y""")
def chk_cardinality_equality(spark, sf):
    return C.cardinality_equality(table(spark, sf, "orders"), "o_custkey", table(spark, sf, "customer"), "c_custkey")


@query("chk_equal_rowcount", """
SELECT a.k AS k_a, b.k AS k_b, a.n AS count_a, b.n AS count_b, abs(a.n - b.n) AS diff_count
FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1) a
  FULL JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1) b ON a.k = b.k""")
def chk_equal_rowcount(spark, sf):
    return C.equal_rowcount(table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")),
                            table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k")), ["k"])


@query("chk_fewer_rows_than", """
SELECT a.k AS k_a, b.k AS k_b, a.n AS count_a, b.n AS count_b,
  cast(CASE WHEN a.n > b.n THEN a.n - b.n WHEN a.n = b.n THEN 1 ELSE 0 END AS bigint) AS row_count_delta
FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1) a
  FULL JOIN (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1) b ON a.k = b.k""")
def chk_fewer_rows_than(spark, sf):
    out = C.fewer_rows_than(table(spark, sf, "customer").select(F.col("c_nationkey").alias("k")),
                            table(spark, sf, "supplier").select(F.col("s_nationkey").alias("k")), ["k"])
    return out.withColumn("row_count_delta", F.col("row_count_delta").cast("bigint"))


@query("chk_equality", """
WITH a AS (SELECT o_orderkey, round(o_totalprice::decimal(18,6), 1)::double AS o_totalprice FROM orders),
  b AS (SELECT o_orderkey, round((o_totalprice + CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END)::decimal(18,6), 1)::double AS o_totalprice FROM orders)
SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b) x
UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a) y""")
def chk_equality(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    changed = orders.withColumn("o_totalprice", F.col("o_totalprice") + F.when(F.col("o_orderstatus") == "P", 1).otherwise(0))
    return rounded(C.equality(orders, changed, exclude=["o_orderstatus"], precision=1))


@query("chk_expression_is_true", """
SELECT l_orderkey, l_partkey, l_suppkey, l_discount FROM lineitem WHERE NOT (l_discount + l_tax < 0.15)""")
def chk_expression_is_true(spark, sf):
    rows = C.expression_is_true(table(spark, sf, "lineitem"), "l_discount + l_tax < cast(0.15 as double)")
    return rows.select("l_orderkey", "l_partkey", "l_suppkey", "l_discount")


_RANGES = """
SELECT partition_by_col, lower_bound, upper_bound, next_lower_bound, is_last_record FROM (
  SELECT user_id AS partition_by_col, ts AS lower_bound, ts + INTERVAL 2 HOUR AS upper_bound,
    lead(ts) OVER (PARTITION BY user_id ORDER BY ts, ts + INTERVAL 2 HOUR) AS next_lower_bound,
    row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, ts + INTERVAL 2 HOUR DESC) = 1 AS is_last_record FROM events) x
WHERE NOT (coalesce(lower_bound < upper_bound, false) AND coalesce(upper_bound <= next_lower_bound, is_last_record, false))"""


def _ranges(spark, sf, hot_rows=None):
    return C.mutually_exclusive_ranges(table(spark, sf, "events"), "ts", "ts + interval 2 hours", "user_id", hot_rows=hot_rows)


query("chk_mutually_exclusive_ranges", _RANGES)(_ranges)
query("chk_mutually_exclusive_ranges_sliced", _RANGES)(lambda spark, sf: _ranges(spark, sf, hot_rows=0))


@query("chk_not_accepted_values", """
SELECT DISTINCT o_orderpriority AS value_field FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '9-NONE')""")
def chk_not_accepted_values(spark, sf):
    return C.not_accepted_values(table(spark, sf, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH", "9-NONE"])


@query("chk_not_constant", """
SELECT o_custkey, count(DISTINCT o_orderstatus) AS distinct_values FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderstatus) = 1""")
def chk_not_constant(spark, sf):
    return C.not_constant(table(spark, sf, "orders"), "o_orderstatus", ["o_custkey"])


@query("chk_not_empty_string", "SELECT trim(primaryTitle) AS primaryTitle FROM raw_title_basics WHERE trim(primaryTitle) = ''")
def chk_not_empty_string(spark, sf):
    return C.not_empty_string(raw(spark, sf, "raw_title_basics"), "primaryTitle")


@query("chk_not_null_proportion", """
SELECT title_type, round(avg(CASE WHEN end_year IS NULL THEN 0.0 ELSE 1.0 END), 6) AS not_null_proportion FROM stg_titles
GROUP BY title_type HAVING avg(CASE WHEN end_year IS NULL THEN 0.0 ELSE 1.0 END) < 0.9""")
def chk_not_null_proportion(spark, sf):
    return rounded(C.not_null_proportion(stg(spark, sf, "stg_titles"), "end_year", 0.9, group_by=["title_type"]))


@query("chk_recency", """
SELECT user_id, max(ts) AS most_recent, TIMESTAMP '2024-01-31 00:00:00' AS threshold FROM events GROUP BY user_id
HAVING max(ts) < TIMESTAMP '2024-01-31 00:00:00'""")
def chk_recency(spark, sf):
    out = C.recency(table(spark, sf, "events"), "ts", "day", 1, now="2024-02-01", group_by=["user_id"])
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("most_recent", "threshold")})


@query("chk_relationships_where", """
SELECT c_custkey AS from_field FROM customer WHERE c_acctbal > 0 AND c_custkey NOT IN
  (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def chk_relationships_where(spark, sf):
    return C.relationships(table(spark, sf, "customer"), "c_custkey", table(spark, sf, "orders"), "o_custkey",
                           "c_acctbal > 0", "o_orderstatus = 'P'")


_SEQUENCE = """
SELECT o_custkey, o_orderkey, previous_value FROM (
  SELECT o_custkey, o_orderkey, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS previous_value
  FROM orders) x WHERE NOT (o_orderkey = previous_value + 1)"""


def _sequence(spark, sf, hot_rows=None):
    return C.sequential_values(table(spark, sf, "orders"), "o_orderkey", group_by=["o_custkey"], hot_rows=hot_rows)


query("chk_sequential_values", _SEQUENCE)(_sequence)
query("chk_sequential_values_sliced", _SEQUENCE)(lambda spark, sf: _sequence(spark, sf, hot_rows=0))


@query("chk_sequential_dates", """
SELECT o_custkey, day, previous_value FROM (SELECT o_custkey, o_orderdate::date AS day,
  lag(o_orderdate::date) OVER (PARTITION BY o_custkey ORDER BY o_orderdate::date) AS previous_value FROM orders) x
WHERE NOT (day = previous_value + INTERVAL 1 DAY)""")
def chk_sequential_dates(spark, sf):
    days = table(spark, sf, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"))
    return C.sequential_values(days, "day", 1, "day", ["o_custkey"])


@query("chk_unique_combination", """
SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def chk_unique_combination(spark, sf):
    return C.unique_combination(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("chk_assert_equal", """
SELECT tconst, originalTitle, genres FROM raw_title_basics WHERE originalTitle <> genres""")
def chk_assert_equal(spark, sf):
    return C.assert_equal(raw(spark, sf, "raw_title_basics").select("tconst", "originalTitle", "genres"), "originalTitle", "genres")


@query("chk_columns_match", """
SELECT 'EVENT_TYPE' AS relation_column, NULL::varchar AS input_column, count(event_type) AS num_rows FROM events
UNION ALL SELECT 'PROPS', NULL, count(props) FROM events UNION ALL SELECT NULL, 'COMMENT', 0""")
def chk_columns_match(spark, sf):
    """Columns that a target lacks, with the number of values that would be lost, and columns that the table lacks."""
    events = table(spark, sf, "events")
    expected = [c for c in events.select(*star(events, ["event_type", "props"])).columns] + ["comment"]
    return C.columns_match(events, expected, with_rows=True)


REPORT = [
    Q.Check("orders", "not_null", {"column": "o_orderkey"}),
    Q.Check("orders", "accepted_range", {"column": "o_totalprice", "min_value": 0, "max_value": 300000}, "warn"),
    Q.Check("orders", "accepted_values", {"column": "o_orderstatus", "values": ["F", "O"]}),
    Q.Check("orders", "not_accepted_values", {"column": "o_orderpriority", "values": ["1-URGENT", "2-HIGH"]}, "warn"),
    Q.Check("orders", "expression_is_true", {"expression": "o_totalprice > 1000"}, where="o_orderstatus = 'F'"),
    Q.Check("orders", "unique", {"column": "o_orderkey"}),
    Q.Check("orders", "relationships", {"column": "o_custkey", "parent": "customer", "field": "c_custkey"}),
    Q.Check("lineitem", "unique_combination", {"columns": ["l_orderkey", "l_linenumber"]}, error_if="> 1000000000", warn_if="> 10"),
    Q.Check("lineitem", "fewer_rows_than", {"b": "orders"}),
    Q.Check("customer", "equality", {"b": "rich", "columns": ["c_custkey"]}),
    Q.Check("customer", "at_least_one", {"column": "c_name"}),
]


@query("chk_report", """
WITH dup AS (SELECT count(*) AS n FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) x),
 poor AS (SELECT count(*) AS n FROM customer WHERE c_acctbal < 5000),
 r AS (
 SELECT 'not_null_orders_o_orderkey' AS check_name, 'orders' AS table_name, 'not_null' AS kind, 'error' AS severity,
   (SELECT count(*) FROM orders WHERE o_orderkey IS NULL) AS failures, 'error' AS bad
 UNION ALL SELECT 'accepted_range_orders_o_totalprice', 'orders', 'accepted_range', 'warn',
   (SELECT count(*) FROM orders WHERE o_totalprice < 0 OR o_totalprice > 300000), 'warn'
 UNION ALL SELECT 'accepted_values_orders_o_orderstatus', 'orders', 'accepted_values', 'error',
   (SELECT count(DISTINCT o_orderstatus) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')), 'error'
 UNION ALL SELECT 'not_accepted_values_orders_o_orderpriority', 'orders', 'not_accepted_values', 'warn',
   (SELECT count(DISTINCT o_orderpriority) FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')), 'warn'
 UNION ALL SELECT 'expression_is_true_orders_o_totalprice > 1000', 'orders', 'expression_is_true', 'error',
   (SELECT count(*) FROM orders WHERE o_orderstatus = 'F' AND NOT o_totalprice > 1000), 'error'
 UNION ALL SELECT 'unique_orders_o_orderkey', 'orders', 'unique', 'error',
   (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1) x), 'error'
 UNION ALL SELECT 'relationships_orders_o_custkey', 'orders', 'relationships', 'error',
   (SELECT count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)), 'error'
 UNION ALL SELECT 'unique_combination_lineitem_l_orderkey_l_linenumber', 'lineitem', 'unique_combination', 'error', (SELECT n FROM dup),
   CASE WHEN (SELECT n FROM dup) > 10 THEN 'warn' ELSE 'pass' END
 UNION ALL SELECT 'fewer_rows_than_lineitem', 'lineitem', 'fewer_rows_than', 'error',
   (SELECT greatest((SELECT count(*) FROM lineitem) - (SELECT count(*) FROM orders), 0)), 'error'
 UNION ALL SELECT 'equality_customer_c_custkey', 'customer', 'equality', 'error', 2 * (SELECT n FROM poor), 'error'
 UNION ALL SELECT 'at_least_one_customer_c_name', 'customer', 'at_least_one', 'error', 0, 'error')
SELECT check_name, table_name, kind, severity, failures::bigint AS failures, CASE WHEN failures = 0 THEN 'pass' ELSE bad END AS status FROM r""")
def chk_report(spark, sf):
    tables = {n: table(spark, sf, n) for n in ("orders", "lineitem", "customer")}
    tables["rich"] = tables["customer"].where("c_acctbal >= 5000")
    return Q.run(tables, REPORT)


@query("chk_row_failures", """
SELECT 'expression_is_true_orders_o_totalprice > 50000' AS check_name, o_orderkey, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND NOT o_totalprice > 50000""")
def chk_row_failures(spark, sf):
    """Failing rows of a check, stored and read back."""
    check = Q.Check("orders", "expression_is_true", {"expression": "o_totalprice > 50000"}, where="o_orderstatus = 'F'")
    rows = Q.store_failures(check, {"orders": table(spark, sf, "orders")}, scratch_path(spark, "failures"))
    return rows.select(F.lit(check.name).alias("check_name"), "o_orderkey", "o_totalprice")


def _values_sql(values: list) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _failures_sql(c: Q.Check) -> str:
    """Metric of a declared check as a scalar subquery."""
    p, t = c.params, c.table
    col = p.get("column")
    if c.kind in ("unique", "unique_combination"):
        cols = ", ".join(p.get("columns") or [col])
        rows = f"{t} WHERE {col} IS NOT NULL" if col else t
        return f"(SELECT count(*) FROM (SELECT {cols} FROM {rows} GROUP BY {cols} HAVING count(*) > 1) d)"
    bad, counted = {
        "not_null": lambda: (f"{col} IS NULL", "*"),
        "accepted_values": lambda: (f"{col} NOT IN ({_values_sql(p['values'])})", f"DISTINCT {col}"),
        "accepted_range": lambda: (f"({col} < {p['min_value']} OR {col} > {p['max_value']})", "*"),
        "relationships": lambda: (f"{col} NOT IN (SELECT {p['field']} FROM {p['parent']})", "*"),
    }[c.kind]()
    return f"(SELECT count({counted}) FROM {t} WHERE {bad}{f' AND {c.where}' if c.where else ''})"


_SUITE = " UNION ALL ".join(
    f"SELECT '{c.name}' AS check_name, '{c.table}' AS table_name, '{c.kind}' AS kind, '{c.severity}' AS severity, "
    f"{_failures_sql(c)} AS failures" for c in ALL)


@query("chk_suite", f"SELECT *, CASE WHEN failures = 0 THEN 'pass' ELSE severity END AS status FROM ({_SUITE}) r")
def chk_suite(spark, sf):
    """All layers built, then every declared check run on them."""
    names = ("title_basics", "name_basics", "title_crew", "title_episode", "title_ratings", "title_principals")
    raws = dict(zip(names, at_once(spark, *(partial(raw, spark, sf, f"raw_{n}") for n in names)), strict=True))
    return Q.run(B.build(spark, raws, scratch_path(spark, "layers"), as_of=AS_OF), ALL)
