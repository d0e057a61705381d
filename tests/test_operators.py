"""Operators: goldens, and the routes for huge groups against the plain ones."""

import random

import pytest
from helpers import plan, rows, single_task_sort
from pyspark.sql import Window
from pyspark.sql import functions as F

from marquee.operators import aggregates as A
from marquee.operators import columns as C
from marquee.operators import generators as G
from marquee.operators import joins as J
from marquee.operators import ranking as K
from marquee.operators import reshape as P
from marquee.operators import sets as U

# ---- ranking --------------------------------------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, many share one value, some keys and values are NULL."""
    rng = random.Random(7)
    data = [(i, "hot" if i % 3 == 0 else rng.choice(["a", "b", None]), None if rng.random() < .05 else rng.choice([1, 1, 1, 2, 5, rng.randint(0, 99)]))
            for i in range(3000)]
    return spark.createDataFrame(data, "id int, k string, v int").repartition(5).cache()


def order():
    return [K.desc("v"), K.asc("id")]


def same(a, b):
    cols = sorted(a.columns)
    return a.select(*cols).exceptAll(b.select(*cols)).isEmpty() and b.select(*cols).exceptAll(a.select(*cols)).isEmpty()


@pytest.mark.parametrize("keys", [[], ["k"], ["k", "v"]])
def test_row_number_of_huge_groups(skewed, keys):
    plain = skewed.withColumn("rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order())).cast("bigint"))
    assert same(K.row_number(skewed, keys, order(), "rn", hot_rows=0), plain)
    assert same(K.row_number(skewed, keys, order(), "rn"), plain)


def test_row_numbers_share_one_sort(skewed):
    ranks = {"by_k": ["k"], "by_v": ["v"], "overall": []}
    assert same(K.row_numbers(skewed, ranks, order(), hot_rows=0), K.row_numbers(skewed, ranks, order()))


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_neighbours_across_slices(skewed, keys):
    w = Window.partitionBy(*keys).orderBy(*order())
    assert same(K.lag(skewed, "v", "p", order(), keys, hot_rows=0), skewed.withColumn("p", F.lag("v").over(w)))
    assert same(K.lead(skewed, "v", "n", order(), keys, hot_rows=0), skewed.withColumn("n", F.lead("v").over(w)))


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_ties_fall_alike_on_both_routes(spark, keys):
    tied = spark.createDataFrame([("x", 1, v) for v in ("d", "a", "c", "b", "c", None)] + [("y", 1, "z")], "k string, o int, v string").repartition(3)
    tied = tied.withColumn("n", F.coalesce(F.ascii("v"), F.lit(0)))
    for rank in (lambda hot: K.row_number(tied, keys, [K.asc("o")], "r", hot_rows=hot),
                 lambda hot: K.row_numbers(tied, {"r": keys, "s": ["o"]}, [K.asc("o")], hot_rows=hot),
                 lambda hot: K.lag(tied, "v", "r", [K.asc("o")], keys, hot_rows=hot),
                 lambda hot: K.lead(tied, "v", "r", [K.asc("o")], keys, hot_rows=hot),
                 lambda hot: K.exclusive_sum(tied, keys, [K.asc("o")], "n", "r", hot_rows=hot)):
        assert same(rank(None), rank(0))


@pytest.mark.parametrize("hot_rows", [None, 0])
def test_percent_rank(skewed, spark, hot_rows):
    plain = skewed.withColumn("pr", F.percent_rank().over(Window.orderBy(K.asc("v"))))
    assert same(K.percent_rank(skewed, "v", "pr", hot_rows), plain)
    one = spark.createDataFrame([(1,)], "v int")
    assert K.percent_rank(one, "v", "pr", hot_rows).first()["pr"] == 0.0
    none = spark.createDataFrame([], "v int")
    assert K.percent_rank(none, "v", "pr", hot_rows).count() == 0


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_running_total_before_the_row(skewed, keys):
    w = Window.partitionBy(*keys).orderBy(K.asc("id")).rowsBetween(Window.unboundedPreceding, -1)
    plain = skewed.withColumn("s", F.coalesce(F.sum("v").over(w), F.lit(0)))
    assert same(K.exclusive_sum(skewed, keys, [K.asc("id")], "v", "s", hot_rows=0), plain)


def test_a_huge_group_of_copies_splits_into_slices(spark):
    copies = spark.range(4000).select(F.lit(1).alias("v"), F.lit("x").alias("k"))
    sizes = [r[0] for r in K.into_slices(copies, [K.asc("v")], 4).groupBy("_slice").count().select("count").collect()]
    assert sum(sizes) == 4000 and len(sizes) == 4 and max(sizes) < 2000
    assert rows(K.row_number(copies, ["k"], [K.asc("v")], "rn", hot_rows=0), F.max("rn"), F.count_distinct("rn")) == [(4000, 4000)]
    assert K.lag(copies, "v", "p", [K.asc("v")], hot_rows=0).where("p is null").count() == 1


def test_empty_input(spark):
    none = spark.createDataFrame([], "id int, k string, v int")
    assert K.row_number(none, ["k"], order(), hot_rows=0).count() == 0
    assert K.lag(none, "v", "p", order(), hot_rows=0).count() == 0


def test_huge_group_route_has_no_single_task_window(skewed):
    df = K.row_number(skewed, [], order(), hot_rows=0)
    assert not single_task_sort(df)
    assert "_slice" in plan(df)
    assert single_task_sort(skewed.withColumn("rn", F.row_number().over(Window.orderBy(*order()))))


def test_deduplicate(spark):
    df = spark.createDataFrame([(1, "play", 1), (1, "play", 2), (2, "pause", 1)], "user_id int, event string, version int")
    assert rows(K.deduplicate(df.where("user_id = 1"), ["user_id"], [("version", "desc")])) == [(1, "play", 2)]
    assert rows(K.deduplicate(df, ["user_id"], [("event", "asc"), ("version", "desc")])) == [(1, "play", 2), (2, "pause", 1)]
    # NULL sorts last ascending, first descending
    nulls = spark.createDataFrame([(1, None), (1, 5)], "k int, v int")
    assert rows(K.deduplicate(nulls, ["k"], [("v", "asc")])) == [(1, 5)]
    assert rows(K.deduplicate(nulls, ["k"], [("v", "desc")])) == [(1, None)]
    # each task sends at most one row per key
    assert plan(K.deduplicate(nulls, ["k"], [("v", "asc")])).count("WindowGroupLimit") == 2


# ---- aggregates ------------------------------------------------------------------


def test_distinct_counts_equal_the_naive_form_without_expand(skewed):
    flags = {"low": F.col("v") < 3, "hot": F.col("k") == "hot"}
    fast = A.distinct_counts(skewed, ["k"], "v", flags, total="n")
    naive = skewed.groupBy("k").agg(
        *[F.count_distinct(F.when(c, F.col("v"))).alias(n) for n, c in flags.items()], F.count_distinct("v").alias("n"))
    assert same(fast, naive)
    assert "Expand" not in plan(fast) and "Expand" in plan(naive)


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_percentile_of_huge_groups(skewed, q, keys):
    sql = skewed.groupBy(*keys).agg(F.percentile("v", q).alias("p"))
    for hot_rows in (None, 0):
        got = A.percentile_cont(skewed, keys, "v", q, "p", hot_rows)
        assert rows(got, *keys, "p") == rows(sql, *keys, "p")


def test_column_values(spark):
    data = [("a", "left"), ("b", "right"), ("c", "left"), ("d", "right"), ("e", "left"), ("f", "right")] + [("g", "left")] * 5
    df = spark.createDataFrame(data, "field string, condition string")
    assert A.column_values(df, "field") == ["g", "a", "b", "c", "d", "e", "f"]
    assert A.column_values(df, "field", where="condition = 'left'") == ["g", "a", "c", "e"]
    assert A.column_values(df, "field", limit=1) == ["g"]
    assert A.column_values(df, "field", limit=2, order_by=[F.desc("value")]) == ["g", "f"]
    assert A.column_values(None, "field", default=["x"]) == ["x"]
    with pytest.raises(ValueError):
        A.column_values(None, "field")
    with pytest.raises(ValueError):
        A.column_values(df, "field", at_most=3)


def test_shares(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int")
    assert [float(r[2]) for r in A.with_shares(df, {"s": "n"}).orderBy("k").collect()] == [0.3333, 0.6667]


def test_group_first(spark):
    df = spark.createDataFrame([("a", "b", 1), ("a", "b", 2), ("c", "d", 3), ("c", "e", 4)], "group_field_1 string, group_field_2 string, value int")
    assert rows(A.group_first(df, 2, F.sum("value"))) == [("a", "b", 3), ("c", "d", 3), ("c", "e", 4)]


# ---- columns -----------------------------------------------------------------------


def test_star_and_aggregates_over_columns(spark):
    df = spark.createDataFrame([("a", "b", "c"), ("d", "e", "f"), ("g", "h", "i")], "field_1 string, field_2 string, field_3 string")
    assert df.select(*C.star(df, ["FIELD_3"])).columns == ["field_1", "field_2"]
    assert df.select(*C.star(df, prefix="prefix_", suffix="_suffix")).columns[0] == "prefix_field_1_suffix"
    assert C.star(df, df.columns) == []
    assert rows(C.aggregate_all(df, F.max, ["FIELD_1"])) == [("h", "i")]
    assert df.alias("x").select(*C.star(df, ["field_1"], alias="x")).columns == ["field_2", "field_3"]


def test_blanks_to_null(spark):
    df = spark.createDataFrame([("a", "", 1), ("", "b", 2), ("", "", 3)], "field_1 string, field_2 string, field_3 int")
    assert rows(C.blanks_to_null(df)) == sorted([("a", None, 1), (None, "b", 2), (None, None, 3)], key=str)


def test_single_value(spark):
    one = spark.createDataFrame([("string_a", 3.3)], "s string, f double")
    got = spark.range(2).select(C.single_value(one.select("s"), "none").alias("s"), C.single_value(one.where("f > 9").select("f"), 1.5).alias("f"))
    assert rows(got) == [("string_a", 1.5)] * 2


# ---- reshape ------------------------------------------------------------------------


def test_pivot(spark):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")], "size string, color string")
    assert rows(P.pivot(df, ["size"], "color", ["red", "blue"])) == [("M", 1, 0), ("S", 1, 1)]
    out = P.pivot(df, ["size"], "color", ["red", "blue", "blue's"], slugify=True)
    assert out.columns == ["size", "red", "blue", "blues"] and rows(out) == [("M", 1, 0, 0), ("S", 1, 1, 1)]
    assert "red" not in df.groupBy("size").agg(*P.pivot_columns("color", ["red"], alias=False)).columns
    assert [P.column_slug(t) for t in ("a - b__c!", "1x")] == ["a_b__c", "_1x"]


CUSTOMERS = [(123, "2017-01-01", "active", "tier 1", "name 1"), (234, "2017-02-01", "active", "tier 3", "name 3"), (567, "2017-03-01", "churned", "tier 2", "name 2")]


def test_pivot_of_two_thousand_values(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1999), (None, 700)], "k string, v int")
    for keys in (["k"], []):
        out = P.pivot(df, keys, "v", list(range(2000)), prefix="v")
        assert len(out.columns) == 2000 + len(keys)
        told = {r["k"] if keys else "all": [c for c in out.columns if c != "k" and r[c]] for r in out.collect()}
        assert told == ({"a": ["v3", "v1999"], None: ["v700"]} if keys else {"all": ["v3", "v700", "v1999"]})


def test_unpivot(spark):
    df = spark.createDataFrame(CUSTOMERS, "customer_id int, created_at string, status string, segment string, name string")
    out = P.unpivot(df, keep=["customer_id", "created_at"], remove=["NAME"], field_name="prop", value_name="val")
    assert out.columns == ["customer_id", "created_at", "prop", "val"]
    assert (123, "2017-01-01", "segment", "tier 1") in rows(out) and out.count() == 6
    assert P.unpivot(df, keep=["customer_id", "created_at"]).count() == 9
    flags = df.select("customer_id", F.when(F.col("customer_id") == 123, True).when(F.col("customer_id") == 234, False).alias("is_updated"))
    assert rows(P.unpivot(flags, keep=["customer_id"]), "value") == sorted([None, "false", "true"], key=str)
    mixed = df.withColumnRenamed("status", "sTaTuS").select("customer_id", "sTaTuS")
    assert rows(P.unpivot(mixed, keep=["customer_id"]).select("field_name").distinct()) == ["sTaTuS"]


def test_splits(spark):
    df = spark.createDataFrame([(1, "a, b,,c"), (2, None), (3, "")], "id int, l string")
    assert rows(P.split_rows(df, "l", "x", position="at")) == [(1, 0, "a"), (1, 1, "b"), (1, 3, "c")]
    assert rows(P.split_rows(spark.createDataFrame([(1, "a|b")], "id int, l string"), "l", "x", "|")) == [(1, "a"), (1, "b")]
    cols = P.split_columns(df, "l", ["p", "q"], blank_to_null=True).orderBy("id").select("p", "q").collect()
    assert [tuple(r) for r in cols] == [("a", " b"), (None, None), (None, None)]
    ranked = P.columns_to_ranked_rows(spark.createDataFrame([(1, "a", "", None), (2, None, "b", "c")], "id int, x string, y string, z string"),
                                      ["id"], ["x", "y", "z"], "v", "rank")
    assert rows(ranked) == [(1, "a", 1), (2, "b", 2), (2, "c", 3)]
    assert plan(ranked).count("Scan") == 1


# ---- sets ------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def unions(spark):
    t1 = spark.createDataFrame([(1, "drew", "pi"), (2, "bob", "e"), (3, "alice", "4")], "id int, name string, favorite_number string")
    t2 = spark.createDataFrame([(1, "green", "7"), (2, "pink", "13")], "id int, favorite_color string, favorite_number string")
    return {"t1": t1, "t2": t2}


def test_union_relations(unions):
    out = U.union_relations(unions)
    assert out.columns == ["source_relation", "id", "name", "favorite_number", "favorite_color"] and out.count() == 5
    assert ("t2", 1, None, "7", "green") in rows(out)
    assert U.union_relations(unions, exclude=["NAME"], source_column=None).columns == ["id", "favorite_number", "favorite_color"]
    assert U.union_relations(unions, include=["ID"], where="id = 1").count() == 2
    assert dict(U.union_relations(unions, column_override={"id": "string"}).dtypes)["id"] == "string"
    with pytest.raises(ValueError):
        U.union_relations(unions, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        U.union_relations(unions, include=["nothing"])


def test_union_of_matching_tables(spark):
    for day, users in (("20180101", (1, 2)), ("20180102", (3, 4)), ("20180103", (5, 6))):
        spark.createDataFrame([(users[0], "play"), (users[1], "pause")], "user_id int, event string").createOrReplaceTempView(f"data_events_{day}")
    assert U.union_relations(U.tables_matching(spark, "DATA_events_%")).count() == 6
    assert list(U.tables_with_prefix(spark, "data_events_", exclude="%0102")) == ["data_events_20180101", "data_events_20180103"]
    assert rows(U.table_kinds(spark, "data_events_%"), "table_type") == ["view"] * 3


def test_differences(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "i int, s string")
    b = spark.createDataFrame([(1, None), (3, "y")], "i int, s string")
    assert rows(U.difference(a, b)) == [(2, "x")]
    assert rows(U.symmetric_difference(a, b)) == [("a_minus_b", 2, "x"), ("b_minus_a", 3, "y")]
    assert ("a_minus_b", 1, None) in rows(U.symmetric_difference(a, b, strict=True))
    assert plan(U.symmetric_difference(a, b)).count("Exchange") == 1


# ---- generators and joins ------------------------------------------------------------------


def test_generators(spark):
    assert rows(G.number_series(spark, 10)) == sorted(range(1, 11), key=str)
    with pytest.raises(ValueError):
        G.number_series(spark, 0)
    days = rows(G.date_spine(spark, "day", "2018-01-01", "2018-01-10").select(F.col("date_day").cast("date").cast("string")))
    assert days == [f"2018-01-0{d}" for d in range(1, 10)]
    months = rows(G.date_spine(spark, "month", "2020-01-31", "2020-05-01").select(F.col("date_month").cast("date").cast("string")))
    assert months == ["2020-01-31", "2020-02-29", "2020-03-31", "2020-04-30"]
    assert G.date_spine(spark, "hour", "2020-01-01", "2020-01-02").count() == 24
    facts = spark.createDataFrame([("2018-01-02", 5)], "d string, n int").select(F.col("d").cast("timestamp").alias("date_day"), "n")
    filled = G.fill_spine(G.date_spine(spark, "day", "2018-01-01", "2018-01-04"), "date_day", facts, ["n"])
    assert [r.n for r in filled.orderBy("date_day").collect()] == [0, 5, 0]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_the_plain_join(spark, how):
    facts = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(300)], "id int, k string")
    dim = spark.createDataFrame([("hot", 1), ("k0", 2), ("k3", 3)], "k string, v int")
    assert J.hot_keys(facts, "k", at_least=50) == ["hot"]
    assert J.hot_keys(facts, "k") == []
    blank = facts.withColumn("k", F.when(F.col("k") != "hot", F.col("k")))
    assert J.hot_keys(blank, "k", at_least=50) == [None]
    assert same(J.skew_join(blank, dim, "k", how, salts=8, hot=[None]), blank.join(dim, "k", how))
    assert same(J.skew_join(facts, dim, "k", how, salts=8, hot=["hot"]), facts.join(dim, "k", how))


def test_join_shapes(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, v string")
    b = spark.createDataFrame([(1, 10), (None, 20)], "k int, w int")
    assert rows(J.natural_join(a, b)) == [(1, "x", 10)]
    assert rows(J.orphans(a, "k", b, "k")) == [(2, "y")]
    both = J.compare_counts(a, b, ["k"])
    assert both.columns == ["k_a", "k_b", "count_a", "count_b"] and both.count() == 4
    assert rows(J.join_group_totals(a, ["v"], F.count(F.lit(1)).alias("n")), "v", "n") == [("x", 1), ("y", 1), ("z", 1)]
    with pytest.raises(ValueError):
        J.natural_join(a.select("v"), b.select("w"))
