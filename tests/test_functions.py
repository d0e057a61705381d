"""Golden values of the column functions."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from marquee.functions import dates as D
from marquee.functions import numeric as N
from marquee.functions import text as X
from marquee.functions.ladder import Ladder, rules, steps
from marquee.plans import rulebook as R


def test_safe_add_and_subtract(spark):
    df = spark.createDataFrame([(1, 2, 3), (1, None, 3), (None, None, 2), (None, None, None)], "a int, b int, c int")
    assert [r[0] for r in df.select(N.safe_add("a", "b", "c")).collect()] == [6, 4, 2, 0]
    df = spark.createDataFrame([(3, 2, 1), (4, None, 3), (None, None, 2), (None, None, None)], "a int, b int, c int")
    assert [r[0] for r in df.select(N.safe_subtract("a", "b", "c")).collect()] == [0, 1, -2, 0]


def test_safe_divide(spark):
    data = [(6, 0), (10, 5), (None, None), (0, None), (17, None), (0, None), (None, 9), (0, 5)]
    df = spark.createDataFrame(data, "n int, d int")
    assert [r[0] for r in df.select(N.safe_divide("n", "d")).collect()] == [None, 2, None, None, None, None, None, 0]
    df = spark.createDataFrame([(0, 5, 9), (2, 3, 0), (0, 0, 0), (3, 4, None), (None, 6, 14), (2, 5, 2)], "a int, b int, d int")
    assert [r[0] for r in df.select(N.safe_divide(F.col("a") * F.col("b"), "d")).collect()] == [0, None, None, None, None, 5]
    df = spark.createDataFrame([(None, 0, 4), (6, 3, 2), (0, 2, 6), (0, None, 8), (5, None, 2), (4, 0, 4)], "n int, a int, b int")
    assert [r[0] for r in df.select(N.safe_divide("n", F.col("a") * F.col("b"))).collect()] == [None, 1, 0, None, None, None]


def test_width_bucket(spark):
    amounts = [190000.0, 290000.0, 320000.0, 399999.99, 400000.0, 470000.0, 510000.0, 610000.0]
    df = spark.createDataFrame([(a,) for a in amounts], "amount double")
    assert [r[0] for r in df.select(N.width_bucket("amount", 200000, 600000, 4)).collect()] == [0, 1, 2, 2, 3, 3, 4, 5]


def test_surrogate_key(spark):
    df = spark.createDataFrame([("a", "b", "c"), ("a", None, "c"), (None, None, "c"), (None, None, None)], "c1 string, c2 string, c3 string")
    one = [r[0] for r in df.select(X.surrogate_key("c1")).collect()]
    assert one == ["0cc175b9c0f1b6a831c399e269772661"] * 2 + ["f14cc5cdce0420f4a5a6b6d9d7b85f39"] * 2
    three = [r[0] for r in df.select(X.surrogate_key("c1", "c2", "c3")).collect()]
    assert three == ["7b193b3d33184464106f41ddf733783b", "4f32a73dc87b7bbb7a654d8898d58c7e",
                     "d9c538b129f1a3ad6ecfe55345c32a05", "2fa5491950d66d153d23cfbcfea4e164"]
    blank = df.select(X.surrogate_key("c2", nulls_as_empty=True)).collect()
    assert blank[1][0] == "d41d8cd98f00b204e9800998ecf8427e"


def test_haversine(spark):
    df = spark.createDataFrame([(48.864716, 2.349014, 52.379189, 4.899431)], "a double, b double, c double, d double")
    assert round(df.select(N.haversine("a", "b", "c", "d")).first()[0]) == 267
    assert round(df.select(N.haversine("a", "b", "c", "d", unit="km")).first()[0]) == 430
    with pytest.raises(ValueError):
        N.haversine("a", "b", "c", "d", unit="m")


URLS = [
    ("www.google.co.uk?utm_source=google&utm_medium=cpc", "www.google.co.uk", ""),
    ("http://witanddelight.com/2018/01/tips-tricks-how-run-half-marathon-first-time/", "witanddelight.com",
     "2018/01/tips-tricks-how-run-half-marathon-first-time/"),
    ("https://www.nytimes.com/2018/01/01/blog", "www.nytimes.com", "2018/01/01/blog"),
    ("docs.nytimes.com/2021/01/01/index.js?utm_source=google", "docs.nytimes.com", "2021/01/01/index.js"),
    ("https://m.facebook.com/", "m.facebook.com", ""),
]


def test_urls(spark):
    df = spark.createDataFrame([(u,) for u, _, _ in URLS], "u string")
    assert [r[0] for r in df.select(X.url_host("u")).collect()] == [h for _, h, _ in URLS]
    assert [r[0] for r in df.select(X.url_path("u")).collect()] == [p for _, _, p in URLS]
    app = spark.createDataFrame([("android-app://m.facebook.com/",)], "u string")
    assert app.select(X.url_host("u")).first()[0] == "m.facebook.com"
    df = spark.createDataFrame([("http://drewbanin.com/milky?utm_medium=organic",),
                                ("http://drewbanin.com/milky?utm_medium=organic&utm_source=github",)], "u string")
    found = df.select(X.url_parameter("u", "utm_medium"), X.url_parameter("u", "utm_source")).collect()
    assert [tuple(r) for r in found] == [("organic", None), ("organic", "github")]


def test_slug(spark):
    df = spark.createDataFrame([("",), (None,), ("!Hell0 world-hi",), ("0Hell0 world-hi",)], "s string")
    assert [r[0] for r in df.select(X.slug("s")).collect()] == ["", "", "hell0_world_hi", "_0hell0_world_hi"]


def test_episode_title_rewrites_the_first_match_only(spark):
    df = spark.createDataFrame([("Episode #1.2",), ("Episode #1.2 and Episode #3.4",), ("The Episode #1.2",), ("Episode #1",), (None,)], "t string")
    assert [r[0] for r in df.select(X.episode_title("t")).collect()] == [
        "S1.E2", "S1.E2 and Episode #3.4", "The Episode #1.2", "Episode #1", None]


def test_markers_keys_and_flags(spark):
    df = spark.createDataFrame([(r"\N", "1", "Actress"), ("", "0", "archive_footage"), (None, "x", None), ("a,b", None, "self")],
                               "t string, f string, c string")
    got = df.select(X.marker_to_null("t"), X.empty_to_null("t"), X.default_text("t", "?"), X.is_blank("t"), X.flag_01("f"),
                    X.mapped("c", R.ROLE_GROUPS, "other"), X.part("t", 2), X.composite_key("t", "f")).collect()
    assert tuple(got[0]) == (None, r"\N", r"\N", False, True, "actor", "", r"\N_1")
    assert tuple(got[1]) == ("", None, "?", True, False, "other", "", "_0")
    assert tuple(got[2]) == (None, None, "?", True, None, "other", None, None)
    assert tuple(got[3]) == ("a,b", "a,b", "a,b", False, None, "self", "b", None)


def test_bounded_int(spark):
    df = spark.createDataFrame([("1799",), ("1800",), ("2030",), ("2031",), (r"\N",), (None,)], "y string")
    assert [r[0] for r in df.select(N.bounded_int("y", 1800, 2030)).collect()] == [None, 1800, 2030, None, None, None]


@pytest.mark.parametrize("part, start, end, expected", [
    ("month", "2020-01-31", "2020-02-01", 1), ("year", "2019-12-31", "2020-01-01", 1), ("day", "2020-02-28", "2020-03-01", 2),
    ("quarter", "2020-03-31", "2020-04-01", 1), ("hour", "2020-01-01 00:59:00", "2020-01-01 01:00:00", 1),
    ("week", "2024-01-06", "2024-01-07", 1), ("week", "2024-01-07", "2024-01-13", 0), ("month", "2020-05-01", "2020-03-31", -2),
    ("minute", "2020-01-01 00:00:59", "2020-01-01 00:02:00", 2), ("second", "2020-01-01", "2020-01-01 00:01:00", 60),
])
def test_date_diff_counts_boundaries(spark, part, start, end, expected):
    assert spark.range(1).select(D.date_diff(part, F.lit(start), F.lit(end))).first()[0] == expected


@pytest.mark.parametrize("part, n, expected", [
    ("month", 1, "2020-02-29 00:00:00"), ("year", -1, "2019-01-31 00:00:00"), ("week", 1, "2020-02-07 00:00:00"),
    ("quarter", 1, "2020-04-30 00:00:00"), ("hour", 25, "2020-02-01 01:00:00"), ("second", -1, "2020-01-30 23:59:59"),
])
def test_date_add(spark, part, n, expected):
    assert spark.range(1).select(D.date_add(part, n, F.lit("2020-01-31")).cast("string")).first()[0] == expected
    with pytest.raises(ValueError):
        D.date_add("fortnight", 1, F.lit("2020-01-31"))


def test_span_years_open_end(spark):
    df = spark.createDataFrame([(2000, 2004), (2000, None), (None, 2004)], "a int, b int")
    assert [r[0] for r in df.select(D.span_years("a", "b", D.as_of_column("2025-06-01"))).collect()] == [5, 26, None]


def test_ladder_first_rule_wins_and_null_falls_through(spark):
    ladder = steps("x", ">=", [(10, "big"), (5, "mid")], "small")
    df = spark.createDataFrame([(10,), (9,), (5,), (4,), (None,)], "x int")
    assert [r[0] for r in df.select(ladder.column()).collect()] == ["big", "mid", "mid", "small", "small"]
    assert ladder.sql() == "CASE WHEN x >= 10 THEN 'big' WHEN x >= 5 THEN 'mid' ELSE 'small' END"
    assert ladder.labels == ["big", "mid", "small"]
    assert rows(df.select(Ladder((), "z").column()).distinct()) == ["z"]
    assert rules(("x = 1", "one"), default="no").labels == ["one", "no"]


def test_exact_average_and_ratio(spark):
    df = spark.createDataFrame([(1.1,), (2.2,), (3.4,)], "r double").select(F.col("r").cast("decimal(3,1)").alias("r"))
    assert str(df.select(N.exact_avg("r")).first()[0]) == "2.2333333333333333"
    one = spark.range(1).select(N.guarded_ratio(F.lit(5), F.lit(0), 1), N.guarded_ratio(F.lit(5), F.lit(2), 0),
                                N.share(F.lit(1), F.lit(0)))
    got = one.first()
    assert float(got[0]) == 5.0 and float(got[1]) == 3.0 and got[2] is None


def test_ratios_of_large_totals(spark):
    n = F.lit(9 * 10**18)
    one = spark.range(1).select(N.guarded_ratio(n, F.lit(2 * 10**18), 1), N.share(n, F.lit(9 * 10**18)), N.share(F.lit(1), F.lit(3)))
    assert [float(x) for x in one.first()] == [4.5, 1.0, 0.3333]
