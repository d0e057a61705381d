"""Every check with rows that pass and rows that fail."""

from collections import Counter

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from marquee.quality import checks as C
from marquee.quality import runner as Q
from marquee.quality.suite import ALL


def frame(spark, data, ddl):
    return spark.createDataFrame(data, ddl)


def passes(df):
    assert df.isEmpty()


def fails(df, n=None):
    assert df.count() == n if n is not None else not df.isEmpty()


def test_simple_checks(spark):
    df = frame(spark, [(1, "a"), (1, "b"), (None, None), (None, "c")], "i int, s string")
    fails(C.not_null(df, "i"), 2)
    passes(C.not_null(df.where("i = 1"), "i"))
    assert rows(C.unique(df, "i")) == [(1, 2)]
    passes(C.unique(df, "s"))
    assert rows(C.accepted_values(df, "s", ["a", "b"])) == [("c", 1)]
    passes(C.accepted_values(df, "s", ["a", "b", "c"]))
    cities = frame(spark, [("Barcelona",), ("London",), ("Paris",), ("New York",)], "city string")
    passes(C.not_accepted_values(cities, "city", ["Madrid", "Berlin"]))
    assert rows(C.not_accepted_values(cities, "city", ["Paris"])) == ["Paris"]
    fails(C.assert_equal(frame(spark, [(1, 1), (1, 2), (None, 2)], "a int, e int"), "a", "e"), 1)


def test_accepted_range(spark):
    df = frame(spark, [(-1,), (11,), (None,)], "id int")
    passes(C.accepted_range(df, "id", -1, 11))
    passes(C.accepted_range(df, "id", -2, 11.1, inclusive=False))
    passes(C.accepted_range(df.where("id <> -1"), "id", 0))
    fails(C.accepted_range(df, "id", -1, 11, inclusive=False), 2)
    fails(C.accepted_range(df, "id", 0), 1)


def test_relationships(spark):
    child, parent = frame(spark, [(1,), (2,), (4,), (None,)], "id int"), frame(spark, [(1,), (2,), (3,)], "id int")
    passes(C.relationships(child, "id", parent, "id", "id <> 4"))
    assert rows(C.relationships(child, "id", parent, "id")) == [4]
    assert rows(C.relationships(child, "id", parent, "id", parent_where="id <> 1")) == [1, 4]


def test_at_least_one(spark):
    df = frame(spark, [("a", 1), ("b", None)], "field string, value int")
    passes(C.at_least_one(df, "field"))
    fails(C.at_least_one(df.where("field = 'b'"), "value"), 1)
    assert rows(C.at_least_one(df, "value", ["field"])) == [("b", 0)]


def test_not_constant(spark):
    df = frame(spark, [(1, 1), (1, 1), (1, 2)], "col_a int, field int")
    passes(C.not_constant(df, "field"))
    passes(C.not_constant(df, "field", ["col_a"]))
    fails(C.not_constant(df, "col_a"), 1)
    passes(C.not_constant(df.where("false"), "field"))


def test_not_empty_string(spark):
    df = frame(spark, [("text",), ("trailing  ",), ("   ",), ("",), (None,)], "s string")
    fails(C.not_empty_string(df, "s"), 2)
    fails(C.not_empty_string(df, "s", trim=False), 1)
    passes(C.not_empty_string(df.where("s <> ''"), "s", trim=False))


def test_not_null_proportion(spark):
    half = frame(spark, [(1, 1), (None, 2), (None, 3), (4, 4), (5, 5), (6, 6), (None, 7), (None, 8), (None, None), (10, 10)], "point_5 int, point_9 int")
    passes(C.not_null_proportion(half, "point_5", 0.5, 0.5))
    passes(C.not_null_proportion(half, "point_9", 0.9))
    passes(C.not_null_proportion(half, "point_5", 0, group_by=["point_9"]))
    fails(C.not_null_proportion(half, "point_5", 0.6), 1)
    fails(C.not_null_proportion(half, "point_9", 0, 0.5), 1)


def test_cardinality_equality(spark):
    a = frame(spark, [(1,), (2,), (3,)], "same_name int")
    b = frame(spark, [(1, 2), (2, 3), (3, 1)], "same_name int, different_name int")
    passes(C.cardinality_equality(a, "same_name", b, "same_name"))
    passes(C.cardinality_equality(a, "same_name", b, "different_name"))
    fails(C.cardinality_equality(a.union(a), "same_name", b, "same_name"), 6)


def test_row_counts(spark):
    df = frame(spark, [(1,), (1,), (2,)], "field int")
    total = "coalesce(sum(coalesce(diff_count, 0)), 0) n"
    assert C.equal_rowcount(df, df, ["field"]).selectExpr(total).first().n == 0
    assert C.equal_rowcount(df, df.where("field = 1")).selectExpr(total).first().n == 1
    # a group that one side lacks counts 0 unless strict
    assert C.equal_rowcount(df, df.where("field = 1"), ["field"]).selectExpr(total).first().n == 0
    assert C.equal_rowcount(df, df.where("field = 1"), ["field"], strict=True).selectExpr(total).first().n == 1
    none = df.where("false")
    assert C.equal_rowcount(df, none).selectExpr(total).first().n == 0
    assert C.equal_rowcount(df, none, strict=True).selectExpr(total).first().n == 3
    one = frame(spark, [(1, 1), (1, 2), (1, 3)], "col_a int, f int")
    four = one.union(frame(spark, [(1, 4)], "col_a int, f int"))
    delta = "sum(row_count_delta) n"
    assert C.fewer_rows_than(one, four).selectExpr(delta).first().n == 0
    assert C.fewer_rows_than(one, four, ["col_a"]).selectExpr(delta).first().n == 0
    assert C.fewer_rows_than(one, one).selectExpr(delta).first().n == 1
    assert C.fewer_rows_than(four, one).selectExpr(delta).first().n == 1


def test_equality(spark):
    a = frame(spark, [(1, 1, 3), (1, 2, 1), (2, 3, 3)], "col_a int, col_b int, col_c int")
    b = frame(spark, [(1, 1, 2), (1, 2, 2), (2, 3, 2)], "col_a int, col_b int, col_c int")
    passes(C.equality(a, a))
    passes(C.equality(a, a.union(a)))
    fails(C.equality(a, a.union(a), strict=True), 3)
    fails(C.equality(a, b), 6)
    passes(C.equality(a, b, columns=["col_a", "col_b"]))
    passes(C.equality(a, b, exclude=["COL_C"]))
    with pytest.raises(ValueError):
        C.equality(a, b, columns=["col_a"], exclude=["col_b"])
    with pytest.raises(ValueError):
        C.equality(a, b.drop("col_c"))
    x = frame(spark, [(1, 62.3888186, "a")], "id int, float_number double, to_ignore string")
    y = frame(spark, [(1, 62.3888187, "b")], "id int, float_number double, to_ignore string")
    passes(C.equality(x, y, exclude=["to_ignore"], precision=4))
    passes(C.equality(x, y, columns=["id", "float_number"], precision=4))
    fails(C.equality(x, y, exclude=["to_ignore"], precision=8), 2)
    fails(C.equality(x, y, precision=4), 2)


def test_expression_is_true(spark):
    df = frame(spark, [(0.0, 1.0), (1.0, 0.0), (0.5, 0.5), (None, 1.0)], "col_a double, col_b double")
    passes(C.expression_is_true(df, "col_a + col_b = 1"))
    passes(C.expression_is_true(df, "+ col_b = 1", "col_a"))
    passes(C.expression_is_true(df.where("col_b = 0.5"), "= 0.5", "col_a"))
    fails(C.expression_is_true(df, "col_a = 0.5"), 2)


RANGES = "sub int, valid_from string, valid_to string"


@pytest.mark.parametrize("hot_rows", [None, 0])
def test_mutually_exclusive_ranges(spark, hot_rows):
    def check(df, lower, upper, **kw):
        return C.mutually_exclusive_ranges(df, lower, upper, hot_rows=hot_rows, **kw)

    steps = frame(spark, [(0, 1), (1, 2), (2, 4)], "lo int, up int")
    passes(check(steps, "lo", "up", gaps="not_allowed"))
    fails(check(steps, "lo", "up", gaps="required"), 2)
    gaps = frame(spark, [(1, "2019-01-01", "2019-02-01"), (1, "2019-03-03", "2019-04-01"), (2, "2019-05-06", "2019-07-02"),
                         (2, "2019-07-03", None)], RANGES)
    until = "coalesce(valid_to, '2099-01-01')"
    passes(check(gaps, "valid_from", until, partition_by="sub"))
    passes(check(gaps, "valid_from", until, partition_by="sub", gaps="required"))
    fails(check(gaps, "valid_from", until, partition_by="sub", gaps="not_allowed"), 2)
    fails(check(gaps, "valid_from", "valid_to", partition_by="sub"), 1)   # a NULL bound fails
    zero = frame(spark, [(3, "2020-05-06", "2020-05-07"), (3, "2020-05-08", "2020-05-10"), (3, "2020-05-08", "2020-05-08"),
                         (3, "2020-05-12", "2020-05-15"), (4, "2020-06-06", "2020-06-07"), (4, "2020-06-08", "2020-06-08"),
                         (4, "2020-06-09", "2020-06-10")], RANGES)
    passes(check(zero, "valid_from", "valid_to", partition_by="sub", zero_length=True))
    fails(check(zero, "valid_from", "valid_to", partition_by="sub"), 2)
    overlap = frame(spark, [(0, 3), (2, 4), (None, 1)], "lo int, up int")
    fails(check(overlap, "lo", "up"), 3)
    with pytest.raises(ValueError):
        check(steps, "lo", "up", gaps="some")


@pytest.mark.parametrize("hot_rows", [None, 0])
def test_sequential_values(spark, hot_rows):
    df = frame(spark, [(1, 2), (1, 4), (1, 6), (2, 8), (2, 10)], "col_a int, my_even_sequence int")
    passes(C.sequential_values(df, "my_even_sequence", 2, hot_rows=hot_rows))
    passes(C.sequential_values(df, "my_even_sequence", 2, group_by=["col_a"], hot_rows=hot_rows))
    fails(C.sequential_values(df, "my_even_sequence", hot_rows=hot_rows), 4)
    hours = frame(spark, [(f"2021-01-01 0{h}:00:00",) for h in range(4)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    passes(C.sequential_values(hours, "t", 1, "hour", hot_rows=hot_rows))
    fails(C.sequential_values(hours, "t", 1, "day", hot_rows=hot_rows), 3)


def test_unique_combination(spark):
    df = frame(spark, [("2019-01", "a"), ("2019-01", "b"), ("2019-02", "a"), (None, "a"), (None, "a")], "month string, product string")
    assert rows(C.unique_combination(df, ["month", "product"])) == [(None, "a", 2)]
    passes(C.unique_combination(df.where("month is not null"), ["month", "product"]))


def test_recency(spark):
    df = frame(spark, [("a", "2024-01-31 01:00:00"), ("b", "2024-01-01 00:00:00"), ("c", None)], "k string, t string")
    now = "2024-02-01 00:00:00"
    passes(C.recency(df, "t", "day", 1, now))
    assert rows(C.recency(df, "t", "day", 1, now, group_by=["k"]), "k") == ["b"]
    yesterday = frame(spark, [("2024-01-31 00:00:00",)], "t string")
    passes(C.recency(yesterday, "t", "day", 1, "2024-02-01 13:00:00", ignore_time=True))
    fails(C.recency(yesterday, "t", "day", 1, "2024-02-01 13:00:00"), 1)


def test_columns_match(spark):
    df = frame(spark, [(1, 2)], "a int, b int")
    passes(C.columns_match(df, ["A", "b"]))
    assert rows(C.columns_match(df, ["a", "c"])) == sorted([("B", None), (None, "C")], key=str)
    fails(C.columns_match(df, ["A", "b"], transform="none"), 2)
    held = df.where("b is not null").count()
    assert rows(C.columns_match(df, ["a", "c"], with_rows=True)) == sorted([("B", None, held), (None, "C", 0)], key=str)
    assert rows(C.columns_match(df, ["a", "b", "c"], with_rows=True)) == [(None, "C", 0)]


# ---- runner ------------------------------------------------------------------------


@pytest.fixture(scope="module")
def people(spark):
    return frame(spark, [(1, "a", 5), (2, "", 50), (3, "zz", None), (3, "zz", 7)], "id int, s string, n int")


def result(tables, *checks):
    return {r.check_name: (r.failures, r.status) for r in Q.run(tables, list(checks)).collect()}


def test_runner_statuses(people):
    got = result(
        {"t": people, "u": people.where("id < 3")},
        Q.Check("t", "not_null", {"column": "n"}), Q.Check("t", "not_null", {"column": "id"}),
        Q.Check("t", "accepted_range", {"column": "n", "max_value": 10}, "warn"),
        Q.Check("t", "accepted_values", {"column": "s", "values": ["a"]}),
        Q.Check("t", "not_empty_string", {"column": "s"}, error_if="> 5", warn_if="> 0"),
        Q.Check("t", "unique", {"column": "id"}, where="n is not null"),
        Q.Check("t", "unique_combination", {"columns": ["id", "s"]}, fail_calc="sum(n_records)"),
        Q.Check("t", "equality", {"b": "u", "columns": ["id"]}),
        Q.Check("t", "equal_rowcount", {"b": "u"}), Q.Check("u", "fewer_rows_than", {"b": "t"}),
        Q.Check("t", "relationships", {"column": "id", "parent": "u", "field": "id"}))
    assert got == {
        "not_null_t_n": (1, "error"), "not_null_t_id": (0, "pass"), "accepted_range_t_n": (1, "warn"),
        "accepted_values_t_s": (2, "error"), "not_empty_string_t_s": (1, "warn"), "unique_t_id": (0, "pass"),
        "unique_combination_t_id_s": (2, "error"), "equality_t_id": (2, "error"), "equal_rowcount_t": (2, "error"),
        "fewer_rows_than_u": (0, "pass"), "relationships_t_id": (2, "error"),
    }


def test_error_if_can_demand_failures(people):
    check = Q.Check("t", "not_null", {"column": "id"}, error_if="<1", warn_if="<0")
    assert result({"t": people}, check) == {"not_null_t_id": (0, "error")}


def test_row_checks_share_one_scan(spark, small):
    orders = spark.read.parquet(f"{small}/orders.parquet")
    checks = [Q.Check("orders", "not_null", {"column": c}) for c in orders.columns]
    checks += [Q.Check("orders", "accepted_range", {"column": "o_totalprice", "min_value": 0})]
    df = Q.run({"orders": orders}, checks)
    assert plan(df).count("Scan parquet") == 1 and df.count() == len(checks)


def test_failures_can_be_stored(people, tmp_path):
    check = Q.Check("t", "expression_is_true", {"expression": "n < 10"})
    stored = Q.store_failures(check, {"t": people}, str(tmp_path))
    assert rows(stored) == [(2, "", 50)]


def test_assert_passed(spark, people):
    Q.assert_passed(spark, Q.run({"t": people}, [Q.Check("t", "not_null", {"column": "id"})]))
    with pytest.raises(AssertionError, match="not_null_t_n: 1"):
        Q.assert_passed(spark, Q.run({"t": people}, [Q.Check("t", "not_null", {"column": "n"})]))


def test_suite_declares_68_checks():
    kinds = Counter(c.kind for c in ALL)
    assert kinds == {"not_null": 30, "accepted_values": 14, "unique": 10, "accepted_range": 7, "unique_combination": 4, "relationships": 3}


def test_a_computed_table_of_many_checks_is_computed_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(part):
        for r in part:
            seen.add(1)
            yield r
    data = [(1, "a", 5), (1, "b", None), (None, "c", 7), (3, None, 9)]
    df = spark.createDataFrame(spark.sparkContext.parallelize(data, 2).mapPartitions(count), "i int, s string, n int")
    parent = frame(spark, [(1,)], "k int")
    checks = [Q.Check("t", "not_null", {"column": "i"}), Q.Check("t", "unique", {"column": "i"}),
              Q.Check("t", "accepted_values", {"column": "s", "values": ["a", "b"]}),
              Q.Check("t", "relationships", {"column": "i", "parent": "p", "field": "k"}),
              Q.Check("t", "unique_combination", {"columns": ["i", "s"]})]
    out = Q.run({"t": df, "p": parent}, checks)
    got = {r.kind: r.failures for r in out.collect()}
    assert got == {"not_null": 1, "unique": 1, "accepted_values": 1, "relationships": 1, "unique_combination": 0}
    assert seen.value == len(data)
    whole = Q.run({"t": df, "p": parent}, [*checks, Q.Check("t", "expression_is_true", {"expression": "n > 5"}, where="i = 1")])
    assert {r.kind: r.failures for r in whole.collect()} == {**got, "expression_is_true": 1}
