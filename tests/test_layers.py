"""The layers: cleaning rules, label boundaries and the surprising cases they keep."""

from decimal import Decimal

import pytest
from helpers import plan, rows, single_task_sort
from pyspark.sql import functions as F

from marquee.plans import build as B
from marquee.plans import consumers, intermediate as I, marts as M, rulebook as R, staging as S
from marquee.sources.datasets import DATASETS


def extract(spark, name, data):
    return spark.createDataFrame(data, DATASETS[name].schema)


@pytest.fixture(scope="module")
def raw(spark):
    """A hand-made catalogue: two series with episodes, two movies, three persons."""
    basics = [("m1", "movie", "Old film", "", "0", 1799, None, 0, "Action,Drama"),
              ("m2", "movie", "", "Orig", "1", 1995, 2031, 2001, None),
              ("m3", "movie", "New film", None, "x", 2021, None, 95, "Sci-Fi,Action,Drama,Comedy"),
              ("s1", "tvSeries", "Show", None, "0", 2010, 2014, 30, "Drama"),
              ("s2", "tvSeries", "Open show", None, "0", 2020, None, 30, "Comedy"),
              ("", "movie", "no key", None, "0", 2000, None, 10, "Drama")]
    basics += [(f"e{i}", "tvEpisode", f"Episode #1.{i}", None, "0", 2010 + i % 3, None, 30, "Drama") for i in range(1, 9)]
    ratings = [("m1", 9.0, 10), ("m3", 8.0, 20000), ("s1", 7.0, 100), *[(f"e{i}", 7.0 + i / 10, 100 * i) for i in range(1, 8)]]
    episodes = [(f"e{i}", "s1", (i + 1) // 2, i) for i in range(1, 8)] + [("e8", "s2", None, None), (None, "s1", 1, 1)]
    names = [("n1", "Ann", 1950, 2000, "actor,,writer", "m1,m2"), ("n2", "", 1790, None, None, None), ("n3", "Cy", 1980, None, "", "m1,m2,m3,s1,e1")]
    crew = [("m1", "n3, n1,,n2", None), ("m2", "", "n1"), ("m3", None, "n2,")]
    principals = [("m2", 1, "n1", " Actress ", None, None), ("m2", 2, "n1", "director", "j", "c"), ("m3", 1, "n1", "writer", None, None),
                  ("s1", 1, "n1", "archive_footage", None, None), ("m3", 2, "n2", "Actor", None, None), ("m3", None, "n2", "self", None, None)]
    dec = [(t, Decimal(str(round(r, 1))), v) for t, r, v in ratings]
    return {"title_basics": extract(spark, "title_basics", basics), "title_ratings": extract(spark, "title_ratings", dec),
            "title_episode": extract(spark, "title_episode", episodes), "name_basics": extract(spark, "name_basics", names),
            "title_crew": extract(spark, "title_crew", crew), "title_principals": extract(spark, "title_principals", principals)}


@pytest.fixture(scope="module")
def stg(raw):
    return B.staging_tables(raw, "2025-06-01", batch_date="2025-06-01", run_id="r1")


@pytest.fixture(scope="module")
def tables(raw):
    return B.all_tables(raw, "2025-06-01")


def one(df, where):
    return df.where(where).first().asDict()


def test_titles(stg):
    t = stg["stg_titles"]
    assert t.count() == 13
    m1, m2, m3 = (one(t, f"tconst = 'm{i}'") for i in (1, 2, 3))
    assert (m1["start_year"], m1["runtime_minutes"], m1["original_title"], m1["is_adult"]) == (None, None, None, False)
    assert (m1["primary_genre"], m1["secondary_genre"], m1["third_genre"]) == ("Action", "Drama", "")
    assert (m2["primary_title"], m2["end_year"], m2["runtime_minutes"], m2["is_adult"]) == ("Unknown Title", None, None, True)
    assert (m2["primary_genre"], m2["is_missing_title"], m2["is_missing_genres"]) == (None, True, True)
    assert (m3["is_adult"], m3["third_genre"], m3["start_year"]) == (None, "Drama", 2021)
    assert one(t, "tconst = 'e1'")["primary_title"] == "S1.E1"


def test_people(stg):
    n1, n2, n3 = (one(stg["stg_people"], f"nconst = 'n{i}'") for i in (1, 2, 3))
    assert (n1["death_age"], n1["actual_age"], n1["is_deceased"]) == (50, None, True)
    assert (n1["first_profession"], n1["second_profession"], n1["third_profession"]) == ("actor", None, "writer")
    # out-of-range birth year is dropped, but the age still uses the raw value
    assert (n2["primary_name"], n2["birth_year"], n2["actual_age"], n2["is_missing_name"]) == ("Unknown Person", None, 235.0, True)
    # the first piece of an empty list stays '', later ones are NULL
    assert (n3["first_profession"], n3["second_profession"], n3["is_missing_professions"]) == ("", None, False)
    assert n3["fourth_title_known_for"] == "s1"


def test_crew_order_is_alphabetical(raw, stg):
    want = [("m1", "n1", 1), ("m1", "n2", 2), ("m1", "n3", 3)]
    assert rows(stg["stg_directors"], "tconst", "director_nconst", "director_order") == want
    across = S.directors(raw["title_crew"], one_row_per_title=False)
    assert rows(across, "tconst", "director_nconst", "director_order") == want
    assert rows(stg["stg_writers"], "tconst", "writer_nconst", "writer_order") == [("m2", "n1", 1), ("m3", "n2", 1)]
    assert "Exchange" not in plan(stg["stg_directors"]) and "Window" not in plan(stg["stg_directors"])


def test_missing_flags(spark, raw):
    # a loaded table holds NULL, not the marker, so the default flags are always FALSE
    assert rows(S.episodes(raw["title_episode"]).where("is_missing_season")) == []
    assert rows(S.episodes(raw["title_episode"], missing="null").where("is_missing_season"), "tconst") == ["e8"]
    unrated = extract(spark, "title_ratings", [("x", None, 1000)])
    assert tuple(S.ratings(unrated, "null").first())[3:6] == (True, False, True)
    with pytest.raises(ValueError):
        S.episodes(raw["title_episode"], missing="maybe")


def test_credits(stg):
    got = rows(stg["stg_credits"], "composite_key", "category", "role_category", "airflow_run_id")
    assert ("m2_n1_2", "director", "director", "r1") in got and len(got) == 5
    # the category is trimmed for display, but not before it is grouped
    assert ("m2_n1_1", "actress", "other", "r1") in got
    assert ("m3_n2_2", "actor", "actor", "r1") in got and ("s1_n1_1", "archive_footage", "other", "r1") in got


def test_title_genres_skip_blanks(tables):
    assert rows(tables["int_title_genres"].where("tconst in ('m1', 'm2')")) == [("m1", "Action", 1), ("m1", "Drama", 2)]


def ladder(spark, df, rule):
    return [r[0] for r in df.select(rule.column()).collect()]


def test_title_ladders(spark):
    df = spark.createDataFrame([(2020, 8.5, 25), (2019, 8.5, 26), (1960, 7.0, None), (1959, 6.0, 478), (None, 5.9, 479), (1990, None, 27)],
                               "start_year int, average_rating double, num_votes int")
    assert ladder(spark, df, R.DECADE) == ["2020s", "2010s", "1960s", "Old Classic", "Old Classic", "1990s"]
    assert ladder(spark, df, R.QUALITY_TIER) == ["Hidden Gem", "Acclaimed", "Solid", "Watchable", "Weak", "Low rated"]
    assert ladder(spark, df, R.POPULARITY_TIER) == ["Bottom 50%", "Bottom 50%", "Unknown", "Top 20–10%", "Top 10%", "Top 50–40%"]
    assert ladder(spark, df, R.WORK_DECADE) == ["2020s", "2010s", "Legacy", "Legacy", "Legacy", "1990s"]
    assert ladder(spark, df, R.WORK_QUALITY) == ["High Quality", "High Quality", "Good Quality", "Average Quality", "Below Average", "Unrated"]
    minutes = spark.createDataFrame([(None,), (29,), (30,), (89,), (90,), (179,), (180,)], "runtime_minutes int")
    assert ladder(spark, minutes, R.RUNTIME_CATEGORY) == ["Unknown", "Short", "Standard", "Standard", "Long", "Long", "Epic"]
    votes = spark.createDataFrame([(v,) for v in (7, 8, 11, 14, 19, 41, 72, 150)], "num_votes int")
    assert ladder(spark, votes, R.POPULARITY_TIER) == ["Bottom 10%", "Bottom 20%", "Bottom 30%", "Bottom 40%", "Bottom 50%",
                                                       "Top 40–30%", "Top 30–20%", "Top 20–10%"]


def test_career_ladders(spark):
    cols = "actor_credits int, director_credits int, writer_credits int, producer_credits int"
    df = spark.createDataFrame([(0, 0, 0, 0), (1, 1, 1, 1), (0, 2, 2, 1), (0, 0, 1, 1), (0, 0, 0, 3)], cols)
    # no credits at all still reads 'Actor'
    assert ladder(spark, df, R.DOMINANT_ROLE) == ["Actor", "Actor", "Director", "Writer", "Producer"]
    df = spark.createDataFrame([(0, 0, 0, 0), (0, 0, 0, 4), (0, 2, 1, 1), (0, 0, 3, 1), (1, 2, 0, 0), (0, 0, 1, 2)],
                               "works_2020s int, works_2010s int, works_2000s int, works_1990s int")
    # nothing, or only 1990s, still reads as current
    assert ladder(spark, df, R.ACTIVITY) == ["Current Era Active", "Current Era Active", "Peak 2010s", "Peak 2000s", "Peak 2010s", "Legacy Era"]
    df = spark.createDataFrame([(40, 100), (39, 99), (19, 49), (9, 19), (4, 9)], "career_span_years int, total_credits int")
    assert ladder(spark, df, R.CAREER_STAGE) == ["Veteran (40+ years)", "Established (20-39 years)", "Experienced (10-19 years)",
                                                 "Mid-Career (5-9 years)", "Emerging (0-4 years)"]
    assert ladder(spark, df, R.PRODUCTIVITY) == ["Highly Prolific (100+)", "Very Active (50-99)", "Active (20-49)", "Moderate (10-19)",
                                                 "Limited Activity (3-9)"]
    df = spark.createDataFrame([(7.5, 5, 3), (7.5, 4, 20), (7.5, 4, 3), (6.4, 9, 99), (None, 0, 3)],
                               "avg_project_rating double, high_quality_works int, total_credits int")
    assert ladder(spark, df, R.REPUTATION) == ["Quality Specialist", "Consistent Quality", "Good Track Record", "Mixed Results", "Unrated Work"]


def test_series_ladders(spark):
    df = spark.createDataFrame([(15.0, 1), (14.0, 2), (5.0, 3), (3.0, 4), (None, None)], "series_years double, season_number int")
    assert ladder(spark, df, R.LONGEVITY_CLASS) == ["Long-Running (15+ years)", "Established (10-14 years)", "Mid-Length (5-9 years)",
                                                    "Short-Run (3-4 years)", "Limited Series (1-2 years)"]
    seasons = df.withColumn("latest_season", F.lit(4)).unionByName(
        spark.createDataFrame([(1.0, 5, 9), (1.0, 7, 9)], "series_years double, season_number int, latest_season int"))
    assert ladder(spark, seasons, R.SEASON_POSITION) == ["Premiere Season", "Early Seasons", "Early Seasons", "Latest Season",
                                                         "Middle Seasons", "Middle Seasons", "Recent Seasons"]
    gaps = spark.createDataFrame([(1, 0.5), (1, 0.2), (1, -0.2), (1, -0.5), (1, -0.6), (None, 0.5)], "episode_rating int, rating_gap double")
    assert ladder(spark, gaps, R.EPISODE_QUALITY) == ["Standout Episode", "Above Average", "Typical", "Below Average", "Poor Episode", "Unrated"]
    spread = spark.createDataFrame([(0.3,), (0.5,), (0.8,), (1.2,), (1.5,), (1.6,), (None,)], "rating_spread double")
    assert ladder(spark, spread, R.CONSISTENCY_CLASS)[-4:] == ["Variable", "Highly Variable", "Highly Variable", "Highly Variable"]
    assert ladder(spark, spread, R.MART_CONSISTENCY) == ["Very Consistent", "Very Consistent", "Consistent", "Moderately Variable",
                                                         "Variable", "Highly Variable", "Highly Variable"]
    votes = spark.createDataFrame([(5000.0,), (1000.0,), (100.0,), (1.0,), (None,)], "avg_episode_votes double")
    assert ladder(spark, votes, R.ENGAGEMENT) == ["High Engagement", "Moderate Engagement", "Low Engagement", "Minimal Engagement", "No Engagement Data"]
    assert ladder(spark, votes, R.MART_ENGAGEMENT) == ["Strong Engagement", "Moderate Engagement", "Limited Engagement",
                                                       "Minimal Engagement", "Minimal Engagement"]
    shares = spark.createDataFrame([(0.5, 0.5), (0.3, 0.5), (0.1, 0.1), (0.1, 0.3), (0.1, 0.2)], "excellent_share double, poor_share double")
    assert ladder(spark, shares, R.QUALITY_PATTERN) == ["Excellence Driven", "Quality Focused", "Consistent Quality", "Quality Issues", "Mixed Quality"]


def test_title_mart_ladders(spark):
    df = spark.createDataFrame(
        [(.95, .9), (.9, .7), (.85, .5), (.6, .85), (.7, .1), (.1, .7), (.5, .0), (.0, .5), (.4, .4)],
        "quality_percentile double, popularity_percentile double")
    assert ladder(spark, df, R.PERFORMANCE_TIER) == ["Masterpiece", "Blockbuster Hit", "Critical Success", "Popular Hit", "Quality Content",
                                                     "Mainstream Appeal", "Above Average", "Above Average", "Standard Content"]
    df = spark.createDataFrame([(.8, .3), (.7, .5), (.3, .7), (.6, .6), (.5, .5)], "quality_percentile double, popularity_percentile double")
    assert ladder(spark, df, R.DISCOVERY) == ["Hidden Gem", "Underrated", "Overrated", "Well-Deserved Success", "Standard Discovery"]
    df = spark.createDataFrame([(8.5, 50000), (8.0, 10000), (7.5, 1), (1.0, 100000), (7.0, 1), (1.0, 10000), (1.0, 1)], "weighted_score double, num_votes int")
    assert ladder(spark, df, R.INVESTMENT) == ["Premium Investment", "Strong Investment", "Solid Investment", "Solid Investment",
                                               "Moderate Investment", "Moderate Investment", "High Risk Investment"]
    df = spark.createDataFrame([(2000, .6, 0.), (2010, 0., .8), (2020, .7, 0.), (2015, 0., .8), (None, 1., 1.)],
                               "start_year int, popularity_percentile double, quality_percentile double")
    assert ladder(spark, df, R.LONGEVITY) == ["Timeless Classic", "Enduring Quality", "Recent Hit", "Modern Classic", "Standard Longevity"]


def test_genre_ladders(spark):
    df = spark.createDataFrame([(5, 4), (6, 10), (7, 10), (10, 10)], "titles_2020s int, titles_2010s int")
    assert ladder(spark, df, R.PRODUCTION_TREND) == ["Growing", "Declining", "Stable", "Stable"]
    df = spark.createDataFrame([(0.21,), (0.2,), (-0.21,), (None,)], "rating_drift double")
    assert ladder(spark, df, R.QUALITY_TREND) == ["Quality Improving", "Quality Stable", "Quality Declining", "Quality Stable"]
    df = spark.createDataFrame([(7.0, 0.05, 5, 5), (7.0, 0.05, 4, 5), (6.0, 0.5, 5, 5), (5.9, 0.5, 5, 5)],
                               "avg_rating double, market_share double, titles_2020s int, titles_2010s int")
    assert ladder(spark, df, R.PRIORITY) == ["High Priority", "Medium Priority", "Low Priority", "Not Recommended"]
    df = spark.createDataFrame([(0.1,), (0.05,), (0.02,), (0.01,)], "market_share double")
    assert ladder(spark, df, R.MARKET_POSITION) == ["Dominant Genre", "Major Genre", "Established Genre", "Niche Genre"]


def test_hierarchy(tables):
    h = tables["int_hierarchy"]
    assert h.count() == 8
    e1, e7, e8 = (one(h, f"episode_tconst = 'e{i}'") for i in (1, 7, 8))
    assert (e1["total_episodes"], e1["total_seasons"], float(e1["avg_episodes_per_season"]), e1["avg_series_rating"]) == (7, 4, 1.8, 7.4)
    assert (e1["season_position"], e7["season_position"], e1["series_duration_years"]) == ("Premiere Season", "Latest Season", 5.0)
    assert (e1["episode_quality_class"], e7["episode_quality_class"]) == ("Below Average", "Above Average")
    # no rated episode: totals are NULL, classes fall to their last rung
    assert (e8["total_episodes"], e8["series_longevity_class"], e8["series_performance_tier"]) == (None, "Limited Series (1-2 years)", "Unrated")
    assert (e8["season_position"], e8["audience_engagement_level"], e8["series_duration_years"]) == ("Middle Seasons", "No Engagement Data", 6.0)


def test_people_mart_counts_titles_once_but_weighs_credit_rows(spark, tables):
    p = tables["mart_people"]
    assert rows(p, "nconst") == ["n1"]
    n1 = one(p, "nconst = 'n1'")
    assert (n1["total_credits"], n1["active_years"], n1["career_span_years"]) == (3, 3, 26)
    assert (n1["actor_credits"], n1["director_credits"], n1["writer_credits"]) == (0, 1, 1)
    assert (n1["avg_project_rating"], n1["total_audience_reach"], n1["versatility_level"]) == (7.5, 20100, "Dual-Role")
    twice = spark.createDataFrame([("s1", "n1", "actor"), ("s1", "n1", "writer"), ("m3", "n1", "actor"), ("m2", "n1", "actor")],
                                  "tconst string, nconst string, role_category string")
    raw_people = spark.createDataFrame([("n1", "Ann")], "nconst string, primary_name string")
    got = M.people_mart(raw_people, twice, tables["int_title_complete"]).first()
    assert got["total_credits"] == 3 and got["total_audience_reach"] == 20000 + 2 * 100
    assert got["avg_project_rating"] == pytest.approx((8.0 + 7.0 + 7.0) / 3)


def test_people_mart_plan_has_no_expansion(tables):
    text = plan(tables["mart_people"])
    assert "Expand" not in text and "Window" not in text


def test_title_mart(tables):
    t = tables["mart_titles"]
    # 10 votes are too few, the unrated are out
    assert "m1" not in rows(t, "tconst") and t.count() == 9
    m3 = one(t, "tconst = 'm3'")
    assert (float(m3["weighted_score"]), m3["type_rank"], m3["popularity_percentile"], m3["is_top_100_in_type"]) == (7.6, 1, 1.0, True)
    assert not single_task_sort(M.title_mart(tables["int_title_complete"], hot_rows=0))


def test_genre_mart(tables):
    g = {r["genre"]: r for r in tables["mart_genres"].collect()}
    assert g["Action"]["total_titles"] == 1 and g["Comedy"]["total_titles"] == 1
    assert float(sum(r["market_share"] for r in g.values())) == pytest.approx(1.0, abs=.001)
    assert g["Drama"]["tv_series_count"] == 1 and g["Drama"]["movie_count"] == 1 and g["Drama"]["platform_fit"] == "Art House / Festival"


def test_series_mart(tables):
    s = tables["mart_series"]
    assert rows(s, "series_tconst", "total_episodes", "final_season", "excellent_episodes", "poor_episodes") == [("s1", 7, 4, 0, 0)]
    r = s.first()
    assert (r["quality_pattern"], r["production_scale"], r["is_consistent_quality"]) == ("Consistent Quality", "Limited Scale (6-19)", True)


def test_consumers_and_order(tables):
    assert rows(consumers.top_movies(tables["mart_titles"]), "primary_title") == ["New film"]
    assert consumers.versatile_people(tables["mart_people"]).count() == 0
    assert "TakeOrderedAndProject" in plan(consumers.top_movies(tables["mart_titles"]))
    scores = [r["weighted_score"] for r in M.ordered("mart_titles", tables["mart_titles"]).collect()]
    assert scores == sorted(scores, reverse=True)
    assert consumers.genre_investments(tables["mart_genres"]).columns[0] == "genre"
    assert consumers.premium_series(tables["mart_series"]).count() == 0


def test_consumers_keep_the_published_classes(spark):
    genres = spark.createDataFrame([(p, 0.1, 7.0, "Stable", "Quality Stable", p, "Niche Targeting") for p in (*R.PRIORITY.labels, "Emerging Opportunity")],
                                   "genre string, market_share double, avg_rating double, production_trend string, quality_trend string, "
                                   "investment_priority string, content_strategy string")
    assert rows(consumers.genre_investments(genres), "genre") == ["Emerging Opportunity", "High Priority", "Medium Priority"]
    series = spark.createDataFrame([(f"{t}/{c}", 60, 3, 8.5, c, t, "High Engagement") for t in R.MART_SERIES_TIER.labels for c in R.MART_CONSISTENCY.labels],
                                   "series_title string, total_episodes long, total_seasons long, avg_series_rating double, consistency_rating string, "
                                   "series_performance_tier string, engagement_level string")
    assert rows(consumers.premium_series(series), "series_title") == sorted(
        f"{t}/{c}" for t in ("Premium Franchise", "Quality Series") for c in ("Very Consistent", "Consistent"))


def test_build_writes_tables_and_views(spark, raw, tmp_path):
    out = B.build(spark, raw, str(tmp_path / "layers"), "2025-06-01", "2025-06-01", "r1")
    assert len(out) == 15
    assert out["mart_people"].count() == 1 and spark.table("int_title_genres").count() > 0
    assert sorted(p.name for p in (tmp_path / "layers").iterdir()) == sorted(B.LAYOUT)


def test_hot_title_is_split(spark, tables):
    """One title holds most credits: AQE deals its partition over several tasks."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB"}
    credits = spark.range(20000).select(
        F.when(F.col("id") % 10 < 8, "m3").otherwise(F.concat(F.lit("e"), (F.col("id") % 7 + 1).cast("string"))).alias("tconst"),
        F.concat(F.lit("p"), (F.col("id") % 900).cast("string")).alias("nconst"), F.lit("actor").alias("role_category")).repartition(6)
    people = credits.select("nconst", F.col("nconst").alias("primary_name")).distinct()
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        for df in (I.filmography(people, credits, tables["int_title_complete"]),
                   M.people_mart(people, credits, tables["int_title_complete"])):
            df.collect()
            assert "skew=true" in plan(df)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
