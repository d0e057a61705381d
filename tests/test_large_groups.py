"""Plans and files for large tables: one exchange per ranking, dealt copies, narrowed percentiles, buckets that stay."""

import pytest
from helpers import plan, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from marquee import session
from marquee.operators import aggregates as A
from marquee.operators import joins as J
from marquee.operators import ranking as K
from marquee.operators import reshape as P
from marquee.operators import sets as U
from marquee.operators.upsert import BucketedTable, upsert
from marquee.plans import build as B
from marquee.registry import layers
from marquee.registry.core import table
from marquee.sources import catalogue, layout


@pytest.fixture(scope="module")
def hot(spark):
    """60 % of the rows in one key, many ties, some nulls."""
    ids = spark.range(20_000)
    key = F.when(F.col("id") % 5 < 3, "a").when(F.col("id") % 97 == 0, None).otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string")))
    return session.stage(ids.select("id", key.alias("k"), F.pmod(F.xxhash64("id"), F.lit(500)).alias("v"), (F.col("id") % 13).alias("g")), "hot")


RANKINGS = {
    "row_number": lambda df: K.row_number(df, ["k"], [K.asc("v")], "r", hot_rows=0),
    "row_numbers": lambda df: K.row_numbers(df, {"r": ["k"], "s": ["g"]}, [K.asc("v")], hot_rows=0),
    "lag": lambda df: K.lag(df, "v", "r", [K.asc("v")], ["k"], hot_rows=0),
    "lead": lambda df: K.lead(df, "v", "r", [K.asc("v")], ["k"], hot_rows=0),
    "exclusive_sum": lambda df: K.exclusive_sum(df, ["k"], [K.asc("v")], "g", "r", hot_rows=0),
}


@pytest.mark.parametrize("name", RANKINGS)
def test_ranked_rows_are_not_shuffled_again(hot, name):
    """The sort stored the rows; what is shuffled afterwards are facts, one row per slice or slice and group."""
    ranked = RANKINGS[name](hot)
    lines = plan(ranked).splitlines()
    assert [line for line in lines if "Window " in line] and [line for line in lines if "Bucketed: true" in line]
    assert "rangepartitioning" not in plan(ranked)
    # below an exchange there is always an aggregate of facts, never the stored rows themselves
    exchanges = [i for i, line in enumerate(lines) if " Exchange " in line]
    assert all(any("Aggregate" in below for below in lines[i + 1:i + 4]) for i in exchanges)


def test_rankings_equal_windows(hot):
    w = Window.partitionBy("k").orderBy(K.asc("v"), "id", "g")
    one = hot.select("id", F.row_number().over(w).alias("r"), F.lag("v").over(w).alias("l"))
    assert rows(K.row_number(hot, ["k"], [K.asc("v")], "r", hot_rows=0), "id", "r") == rows(one, "id", "r")
    assert rows(K.lag(hot, "v", "l", [K.asc("v")], ["k"], hot_rows=0), "id", "l") == rows(one, "id", "l")


def test_slices_are_bounded_and_sized_by_bytes(spark, monkeypatch):
    wide = spark.range(50_000).select(F.lit("k").alias("k"), F.lpad(F.col("id").cast("string"), 200, "x").alias("t"))
    monkeypatch.setattr(K, "SLICE_BYTES", 1 << 20)
    n = K.slices_needed(wide, [["k"]], 0)
    assert 10 <= n <= 20
    monkeypatch.setattr(K, "MOST_SLICES", 6)
    assert K.slices_needed(wide, [["k"]], 0) == 6
    labels = K.slice_labels(wide, 50)
    assert len(labels) == 50 and labels == sorted(labels)
    spread = spark.createDataFrame([(x,) for x in labels], "id long").select(F.pmod(F.hash("id"), F.lit(50))).distinct().count()
    assert spread == 50


@pytest.mark.parametrize("q", [0, 0.25, 0.5, 0.9, 1])
def test_percentiles_are_selected_without_a_sort(hot, q):
    expected = hot.groupBy("k").agg(F.percentile("v", q).alias("p"))
    got = A.percentile_cont(hot, ["k"], "v", q, "p", hot_rows=3000)      # one hot group, the others merged
    assert rows(got, "k", "p") == rows(expected, "k", "p")
    assert "rangepartitioning" not in plan(got)
    assert rows(A.percentile_cont(hot, [], "v", q, "p", hot_rows=0)) == rows(hot.agg(F.percentile("v", q)))


def test_percentiles_of_any_number(spark):
    values = [1e-300, 1e300, -1e300, 0.1, 0.1, 0.1, 5.0, None, 2.0 ** 53, 2.0 ** 53 + 2]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for q in (0, 0.3, 0.5, 1):
        assert rows(A.percentile_cont(df, [], "v", q, "p", hot_rows=0)) == rows(df.agg(F.percentile("v", q)))
    cents = df.where("abs(v) < 100").select((F.col("v")).cast("decimal(20,6)").alias("v"), F.lit(1).alias("k"))
    assert rows(A.percentile_cont(cents, ["k"], "v", 0.5, "p", hot_rows=0), "p") == [0.1]
    assert rows(A.percentile_cont(df.where("false"), [], "v", 0.5, "p", hot_rows=0)) == [None]


def test_percent_rank_of_many_long_values_is_not_broadcast(spark, monkeypatch):
    """Values that are all different, and one that holds a third of the rows."""
    text = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.sha2(F.col("id").cast("string"), 256))
    df = session.stage(spark.range(9_000).select("id", text.alias("t")), "long")
    expected = rows(df.select("id", F.percent_rank().over(Window.orderBy(K.asc("t"))).alias("p")))
    assert rows(K.percent_rank(df, "t", "p"), "id", "p") == expected
    monkeypatch.setattr(K, "SMALL_BYTES", 0)
    ranked = K.percent_rank(df, "t", "p")
    assert rows(ranked, "id", "p") == expected
    assert "Filter" in plan(ranked) and "_n#" in plan(ranked)       # only values above the limit are broadcast
    with_null = df.withColumn("t", F.when(F.col("id") % 5 > 0, F.col("t")))
    assert rows(K.percent_rank(with_null, "t", "p"), "id", "p") == rows(
        with_null.select("id", F.percent_rank().over(Window.orderBy(K.asc("t"))).alias("p")))


def test_copies_of_one_row_are_dealt_over_all_salts(spark):
    facts = session.stage(spark.range(6_400).select(F.lit(7).alias("k"), F.lit("same").alias("x")), "copies")
    dim = spark.createDataFrame([(7, "seven"), (8, "eight")], "k int, n string")
    salted = J.with_place(facts, "_p").groupBy(F.pmod("_p", F.lit(16)).alias("s")).count().collect()
    assert len(salted) == 16 and max(r["count"] for r in salted) <= 410
    assert rows(J.skew_join(facts, dim, "k", salts=16, hot=[7]).groupBy("n").count()) == [("seven", 6_400)]


def test_hot_keys_come_from_a_sketch(spark):
    key = F.when(F.col("id") < 6_000, 1).when(F.col("id") < 9_000, None).otherwise(F.col("id"))
    df = spark.range(12_000).select(key.alias("k"))
    assert set(J.hot_keys(df, "k", at_least=100)) == {1, None}
    assert J.hot_keys(df.where("k > 1"), "k", at_least=100) == []


def test_distinct_pivot_does_not_expand(spark):
    df = spark.createDataFrame([("g", "x", 1), ("g", "x", 1), ("g", "y", 1), ("g", "y", 2), ("h", "x", None), ("h", None, 5), ("i", "y", 0)],
                               "g string, c string, v int")
    for agg, one in (("count", "count"), ("sum", "sum")):
        for cmp in ("=", "<>", ">="):
            for other in (0, None, 1):
                got = P.pivot(df, ["g"], "c", ["x", "y"], agg=agg, cmp=cmp, then_value=F.col("v"), else_value=other, distinct=True)
                cases = ", ".join(f"{one}(DISTINCT CASE WHEN c {cmp} '{v}' THEN v ELSE {'NULL' if other is None else other} END) AS {v}" for v in "xy")
                df.createOrReplaceTempView("pivoted")
                assert rows(got) == rows(spark.sql(f"SELECT g, {cases} FROM pivoted GROUP BY g")), (agg, cmp, other)
                assert "Expand" not in plan(got)


def test_unions_hold_every_value(spark):
    ints, halves = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2.7,), (2.5,), (None,)], "x double")
    cents = spark.createDataFrame([(1,)], "n int").select(F.lit("2.50").cast("decimal(5,2)").alias("x"))
    words = spark.createDataFrame([("w",)], "x string")
    assert rows(U.union_relations({"a": ints, "b": halves}), "x") == [1.0, 2.5, 2.7, None]
    assert rows(U.union_relations({"a": ints, "b": words}), "x") == ["1", "w"]
    first = {"a": ints, "b": halves, "c": cents}
    assert rows(U.union_relations(first, types_from="first"), "x") == [1, 2, 3, 3, None]
    assert U.union_relations({"a": ints, "c": cents}).schema["x"].dataType.simpleString() == "decimal(12,2)"
    with pytest.raises(ValueError):
        U.union_relations({"a": ints}, types_from="last")


def folders(table):
    return table.manifest()["buckets"]


def test_upserts_keep_the_files_of_untouched_buckets(spark):
    home = BucketedTable(spark, session.scratch_path(spark, "kv"), ["k"], 16)
    assert home.read() is None and home.matching(spark.range(1).select(F.col("id").alias("k")), ["k"]) is None
    home.replace(spark.range(2_000).select(F.col("id").alias("k"), F.lit("old").alias("v")))
    before = folders(home)
    assert len(before) == 16
    batch = spark.createDataFrame([(3, "new"), (3, "new too"), (5_000, "more")], "k long, v string")
    home.upsert(batch, ["k"])
    touched = {str(b) for b in home.touched(batch)}
    assert {b for b in before if folders(home)[b] != before[b]} == touched and len(touched) <= 2
    assert home.read().count() == 2_002 and rows(home.read().where("v <> 'old'"), "v") == ["more", "new", "new too"]
    assert rows(home.matching(batch, ["k"]), "v") == ["more", "new", "new too"]
    assert home.read(0).count() == 2_000
    scanned = home._rows(home.manifest(), home.touched(batch)).inputFiles()
    assert len(scanned) <= len(touched)
    assert home.expire(1) == len(touched) and home.versions() == [1] and home.read().count() == 2_002
    with pytest.raises(ValueError):
        home.upsert(batch, ["v"])

    def refuse(_):
        raise RuntimeError("no")
    with pytest.raises(RuntimeError):
        home.upsert(batch, ["k"], refuse)
    assert home.versions() == [1]


def test_a_large_bucket_is_written_by_several_tasks(spark):
    home = BucketedTable(spark, session.scratch_path(spark, "large"), ["k"], 2)
    spread = session.stage(spark.range(0, 40_000, 1, 8).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")), "spread")
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    kept = spark.conf.get(name)
    spark.conf.set(name, "256k")
    try:
        home.replace(spread)
        home.upsert(spread.where("k % 2 = 0").withColumn("v", F.lit("new")), ["k"])
    finally:
        spark.conf.set(name, kept)
    for version in (0, 1):
        files = home.read(version).inputFiles()
        assert len(home.manifest(version)["buckets"]) == 2 and len(files) >= 4
    assert home.read().count() == 40_000 and home.read().where("v = 'new'").count() == 20_000
    assert home.read(0).exceptAll(spread).isEmpty()


def test_an_upsert_builds_no_table_of_its_keys(spark):
    target, batch = (spark.range(n).select(F.col("id").alias("k"), F.lit(n).alias("v")) for n in (50, 20))
    assert "Aggregate" not in plan(upsert(target, batch.union(batch), ["k"]))


def scratch_files(spark):
    return {p for p, _, _ in session.files_below(spark, f"{session.scratch_root(spark)}/*")}


def test_scopes_delete_what_they_own(spark):
    before = scratch_files(spark)
    with session.scratch_scope():
        held = session.stage(spark.range(10), "inner")
        assert held.count() == 10 and scratch_files(spark) - before
        K.row_number(held, [], [K.asc("id")], hot_rows=0).count()
    assert scratch_files(spark) == before
    one = session.stage(spark.range(5), "one")
    session.release(one)
    assert scratch_files(spark) == before


def test_build_leaves_no_scratch_and_views_stay_lazy(spark, small, tmp_path):
    raw = {n.removeprefix("raw_"): layers.raw(spark, small, n) for n in
           ("raw_title_basics", "raw_title_ratings", "raw_name_basics", "raw_title_crew", "raw_title_episode", "raw_title_principals")}
    before = scratch_files(spark)
    built = B.build(spark, raw, str(tmp_path / "out"), "2025-01-01")
    assert scratch_files(spark) == before
    for view in ("int_title_genres", "int_title_complete", "int_filmography", "int_hierarchy"):
        read = session.paths_read(spark.table(view))
        assert read and all(str(tmp_path) in p for p in read)
    assert built["mart_titles"].count() and spark.table("int_hierarchy").count()


def test_sorted_layout_computes_its_rows_once(spark, tmp_path):
    """Range partitioning reads its input twice: what has to be computed is stored first."""
    seen = spark.sparkContext.accumulator(0)

    def count(part):
        for r in part:
            seen.add(1)
            yield r
    df = spark.createDataFrame(spark.sparkContext.parallelize([(i % 100, i) for i in range(2_000)], 4).mapPartitions(count), "a int, b int")
    layout.write_sorted(df, str(tmp_path / "t"), ["a", "b"], files=4)
    assert seen.value == 2_000
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2_000


def test_year_bits_need_no_object_buffers(spark, small):
    assert "ObjectHashAggregate" not in plan(layers.people_mart(spark, small))
    df = spark.createDataFrame([(1, 1800), (1, 1800), (1, 1863), (1, 1864), (1, 2030), (2, None)], "k int, y int")
    from marquee.plans import marts as M
    got = df.groupBy("k").agg(*M.year_words("y")).select("k", M.years_in_words().alias("n"))
    assert rows(got) == [(1, 4), (2, 0)]


def test_published_positions_follow_the_order(spark, small):
    from marquee.plans import marts as M
    mart = layers.genre_mart(spark, small)
    listed = [r.genre for r in M.ordered("mart_genres", mart).collect()]
    shares = {r.genre: (r.market_share, r.avg_rating) for r in mart.collect()}
    placed = [r.genre for r in M.positions("mart_genres", mart, 0).orderBy("position").collect()]
    assert [shares[g] for g in placed] == [shares[g] for g in listed] and table(spark, small, "orders").count()


def test_scopes_forget_what_is_released(spark):
    owned = []
    with session.recording(owned):
        gone, kept = session.stage(spark.range(3), "gone"), session.stage(spark.range(3), "kept")
        session.release(gone)
    assert [path for _, path in owned] == [getattr(kept, session._PATH)]
    session.free_unread(owned)
    assert owned == []


def test_steps_at_once_store_for_the_scope_around_them(spark):
    before, setting = scratch_files(spark), spark.conf.get(session.SHUFFLES_END, "false")
    with session.scratch_scope():
        frames = session.at_once(spark, *(lambda n=n: session.stage(spark.range(n).groupBy().count(), f"n{n}") for n in range(6)))
        assert [df.first()[0] for df in frames] == list(range(6))
    assert scratch_files(spark) == before and spark.conf.get(session.SHUFFLES_END, "false") == setting
    with pytest.raises(ZeroDivisionError), session.scratch_scope():
        session.at_once(spark, lambda: session.stage(spark.range(3), "kept"), lambda: 1 // 0)
    assert scratch_files(spark) == before


def test_extracts_deal_out_sources_before_their_texts(spark, small, tmp_path):
    """A source of one row group is dealt out as it is read; one that keeps the cores busy is not, nor is what an aggregate has spread."""
    one, many = (str(tmp_path / n) for n in ("one", "many"))
    tasks = spark.sparkContext.defaultParallelism
    for path, files in ((one, 1), (many, tasks)):
        for t in catalogue.SOURCES:
            spark.read.parquet(f"{small}/{t}.parquet").repartition(files).write.parquet(f"{path}/{t}.parquet")
    told = {(path, name): plan(catalogue.derived(spark, path, name)) for path in (one, many) for name in ("raw_title_basics", "raw_title_crew")}
    dealt = [line for line in told[one, "raw_title_basics"].splitlines() if "Exchange" in line]
    assert len(dealt) == 1 and "RoundRobin" in dealt[0]
    assert told[one, "raw_title_basics"].index("Exchange") > told[one, "raw_title_basics"].index("Project")
    assert "RoundRobin" not in told[many, "raw_title_basics"] and told[many, "raw_title_crew"].count("Exchange") == 1
    for name in catalogue.CATALOGUE_SQL:
        assert rows(catalogue.derived(spark, one, name)) == rows(catalogue.derived(spark, many, name))
