"""Extract format, loads, layout, upserts and streams."""

import gzip
import os
import time

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from marquee.operators.upsert import VersionedTable, incremental_batch, upsert
from marquee.session import fingerprint, scratch_path, scratch_root, stage_once
from marquee.sources import layout, load, tsv
from marquee.sources.datasets import DATASETS, Dataset
from marquee.streaming import ingest

PAIRS = Dataset("pairs", "pairs.tsv.gz", "k string, v string, n int")


def write_gz(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt", encoding="utf-8", newline="") as f:
        f.write("".join(line + "\n" for line in lines))
    return str(path)


def test_seven_datasets(spark):
    assert {n: len(d.columns) for n, d in DATASETS.items()} == {
        "title_basics": 9, "title_akas": 8, "title_ratings": 3, "name_basics": 6, "title_crew": 3, "title_episode": 4, "title_principals": 6}


def test_scan_rules(spark, tmp_path):
    path = write_gz(tmp_path / "a.tsv.gz", "k\tv\tn", "a\t\\N\t1", "b\t\t\\N", 'c\t"quoted\t2', "d\tx\\ty\\\\z\\nw\\q\t3", "e\té–\t4\r")
    got = rows(tsv.scan(spark, path, PAIRS))
    assert got == sorted([("a", None, 1), ("b", "", None), ("c", '"quoted', 2), ("d", "x\ty\\z\nwq", 3), ("e", "é–", 4)], key=str)


def test_scan_fails_on_bad_rows(spark, tmp_path):
    short = write_gz(tmp_path / "short.tsv.gz", "k\tv\tn", "a\tb")
    with pytest.raises(Exception, match="expected 3 fields"):
        tsv.scan(spark, short, PAIRS).collect()
    text = write_gz(tmp_path / "text.tsv.gz", "k\tv\tn", "a\tb\tc")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        tsv.scan(spark, text, PAIRS).collect()


def test_rejects(spark, tmp_path):
    path = write_gz(tmp_path / "a.tsv.gz", "k\tv\tn", "a\tb\t1", "a\tb", "a\tb\tx", "a\tb\t\\N", "a\tb\t1\t2")
    good, bad = tsv.scan_with_rejects(spark, path, PAIRS)
    assert rows(good) == [("a", "b", 1), ("a", "b", None)]
    assert rows(bad) == sorted(["a\tb", "a\tb\tx", "a\tb\t1\t2"])


def test_corrupt_gzip_fails(spark, tmp_path):
    path = tmp_path / "bad.tsv.gz"
    path.write_bytes(b"\x1f\x8b\x08\x00 not a gzip body")
    with pytest.raises(Exception):
        tsv.scan(spark, str(path), PAIRS).collect()


def test_header_check(spark, tmp_path):
    write_gz(tmp_path / "d" / "good.tsv.gz", "k\tv\tn", "a\tb\t1")
    write_gz(tmp_path / "d" / "order.tsv.gz", "v\tk\tn", "a\tb\t1")
    write_gz(tmp_path / "d" / "count.tsv.gz", "k\tv", "a\tb")
    found = {r.file.rsplit("/", 1)[1]: r.problem for r in tsv.check_headers(spark, str(tmp_path / "d"), PAIRS).collect()}
    assert found == {"good.tsv.gz": None, "order.tsv.gz": "column names or order differ", "count.tsv.gz": "expected 3 columns, got 2"}


def test_write_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a\tb", 'q"u\\N', 1), ("", None, None), (" x ", "\n\r", 3)], PAIRS.schema)
    tsv.write(df, str(tmp_path / "o"), PAIRS)
    assert rows(tsv.scan(spark, str(tmp_path / "o"), PAIRS)) == rows(df)
    assert all(p.suffix == ".gz" for p in (tmp_path / "o").glob("part-*"))
    flags = spark.createDataFrame([("t1", 1, "x", None, None, None, "", True), ("t2", 2, "y", None, None, None, "", None)], DATASETS["title_akas"].schema)
    tsv.write(flags, str(tmp_path / "akas"), DATASETS["title_akas"])
    assert rows(tsv.scan(spark, str(tmp_path / "akas"), DATASETS["title_akas"])) == rows(flags)


def test_seed(spark, tmp_path):
    (tmp_path / "s.csv").write_text("id,amount\n1,2.5\n2,\n")
    assert rows(tsv.read_seed(spark, str(tmp_path / "s.csv"), "id int, amount double")) == [(1, 2.5), (2, None)]
    with pytest.raises(Exception):
        tsv.read_seed(spark, str(tmp_path / "s.csv"), "amount double, id int").collect()


def test_load_skips_unchanged_and_sees_new_files(spark, tmp_path):
    src, home = tmp_path / "in", str(tmp_path / "table")
    manifest = VersionedTable(spark, str(tmp_path / "manifest"))
    write_gz(src / "one.tsv.gz", "k\tv\tn", "a\tb\t1")

    def run():
        return load.load_dataset(spark, str(src), PAIRS, home, manifest, partitions=2)

    assert run() == {"dataset": "pairs", "loaded": True, "reason": "no previous load recorded", "rows": 1}
    assert run()["loaded"] is False
    time.sleep(1.1)
    write_gz(src / "two.tsv.gz", "k\tv\tn", "c\td\t2", "e\tf\t3")
    listing = load.list_files(spark, str(src), "pairs")
    assert [r.path.rsplit("/", 1)[1] for r in load.changed_files(listing, manifest.read()).collect()] == ["two.tsv.gz"]
    assert run() == {"dataset": "pairs", "loaded": True, "reason": "source newer than last load", "rows": 3}
    assert VersionedTable(spark, home).versions() == [0, 1]


def test_failed_load_publishes_nothing(spark, tmp_path):
    src, home = tmp_path / "in", str(tmp_path / "table")
    manifest = VersionedTable(spark, str(tmp_path / "manifest"))
    write_gz(src / "one.tsv.gz", "wrong\tv\tn", "a\tb\t1")
    with pytest.raises(ValueError, match="names or order"):
        load.load_dataset(spark, str(src), PAIRS, home, manifest)
    text = Dataset("texts", "t", "k string, v string")
    write_gz(tmp_path / "in2" / "one.tsv.gz", "k\tw", "a\tb")
    with pytest.raises(ValueError, match="names or order"):
        load.load_dataset(spark, str(tmp_path / "in2"), text, home, manifest)
    assert VersionedTable(spark, home).read() is None and manifest.read() is None


def test_load_reads_what_it_lists(spark, tmp_path):
    src, home = tmp_path / "in", str(tmp_path / "table")
    manifest = VersionedTable(spark, str(tmp_path / "manifest"))

    def run():
        got = load.load_dataset(spark, str(src), PAIRS, home, manifest)
        return got["loaded"], got["reason"], got["rows"]

    write_gz(src / "one.tsv.gz", "k\tv\tn", "a\tb\t1")
    write_gz(src / "sub folder" / "two.tsv.gz", "k\tv\tn", "c\td\t2")
    assert run() == (True, "no previous load recorded", 2)
    assert run() == (False, "current version already loaded", 0)
    old = write_gz(src / "three.tsv.gz", "k\tv\tn", "e\tf\t3")
    os.utime(old, (10**9, 10**9))
    assert run() == (True, "source newer than last load", 3)
    os.remove(old)
    assert run() == (True, "files removed since last load", 2)
    assert run()[0] is False


@pytest.mark.parametrize("lines", [(), ("k\tv\tn", "a\tb\t1", "k\tv\tn")], ids=["empty", "repeated"])
def test_load_wants_one_header_in_each_file(spark, tmp_path, lines):
    write_gz(tmp_path / "in" / "one.tsv.gz", "k\tv\tn", "a\tb\t1")
    path = write_gz(tmp_path / "in" / "odd.tsv.gz", *lines)
    if not lines:
        open(path, "wb").close()
    with pytest.raises(ValueError, match="header lines instead of one"):
        load.load_dataset(spark, str(tmp_path / "in"), PAIRS, str(tmp_path / "table"))
    assert VersionedTable(spark, str(tmp_path / "table")).read() is None


def test_load_notices_files_that_balance(spark, tmp_path):
    write_gz(tmp_path / "in" / "twice.tsv.gz", "k\tv\tn", "a\tb\t1", "k\tv\tn")
    open(write_gz(tmp_path / "in" / "none.tsv.gz"), "wb").close()
    with pytest.raises(ValueError, match="header lines instead of one"):
        load.load_dataset(spark, str(tmp_path / "in"), PAIRS, str(tmp_path / "table"))
    table = tsv.scan(spark, str(tmp_path / "in"), PAIRS)
    assert rows(load.reconcile(spark, str(tmp_path / "in"), PAIRS, table), "ok") == [False]


def test_text_format_keeps_every_character(spark, tmp_path):
    signs = [chr(i) for i in range(0x21)] + ["\x7f", "\x80", "é", "😀", "\\"]
    texts = [f"a{x}b" for x in signs] + signs + ["\\" * n + x for n in range(1, 6) for x in ("", "n", "x41", "101", "\x01", "\t")]
    df = spark.createDataFrame([(t, "v", i) for i, t in enumerate(texts)], PAIRS.schema)
    tsv.write(df.repartition(3), str(tmp_path / "o"), PAIRS)
    assert rows(tsv.scan(spark, str(tmp_path / "o"), PAIRS)) == rows(df)


def test_octal_and_hex_escapes(spark, tmp_path):
    path = write_gz(tmp_path / "a.tsv.gz", "k\tv\tn", "\\x41\\101\\x4\\18\\xg\\\\x41\t\\303\\251\\xc3\\xa9\\134n\t1", "end\\\t\\777\t2")
    good, bad = tsv.scan_with_rejects(spark, path, PAIRS)
    assert rows(good) == [("AA\x04\x018xg\\x41", "éé\\n", 1)]
    assert rows(bad) == ["end\\\t\\777\t2"]
    with pytest.raises(Exception, match="INVALID_UTF8"):
        tsv.scan(spark, path, PAIRS).collect()


def test_reconcile(spark, tmp_path):
    path = write_gz(tmp_path / "a.tsv.gz", "k\tv\tn", "a\tb\t1", "c\td\t2")
    table = tsv.scan(spark, path, PAIRS)
    assert rows(load.reconcile(spark, path, PAIRS, table)) == [("pairs", 2, 2, True)]
    assert rows(load.reconcile(spark, path, PAIRS, table.where("n = 1")), "ok") == [False]


def test_layout(spark, small, tmp_path):
    orders = spark.read.parquet(f"{small}/orders.parquet")
    layout.write_sorted(orders, str(tmp_path / "sorted"), ["o_orderstatus", "o_orderkey"], bloom=["o_orderkey"], files=3)
    back = spark.read.parquet(str(tmp_path / "sorted"))
    assert back.count() == orders.count() and len(back.inputFiles()) == 3
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,P)]" in plan(back.where("o_orderstatus = 'P'"))
    for name, key, out in (("orders", "o_custkey", "buckets_a"), ("customer", "c_custkey", "buckets_b")):
        layout.write_bucketed(spark.read.parquet(f"{small}/{name}.parquet"), out, [key], 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    joined = spark.table("buckets_a").join(spark.table("buckets_b"), F.col("o_custkey") == F.col("c_custkey"))
    text = plan(joined)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in text
    layout.write_table(orders.limit(3), "three_orders")
    assert layout.as_view(spark.table("three_orders"), "three").count() == 3 and spark.table("three").count() == 3


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    batch = spark.createDataFrame([(2, "B"), (2, "B2"), (3, "C")], "k int, v string")
    assert rows(upsert(target, batch, ["k"])) == sorted([(1, "a"), (2, "B"), (2, "B2"), (3, "C"), (None, "n")], key=str)
    assert rows(upsert(target, batch, ["k"], delete_missing=True)) == [(2, "B"), (2, "B2"), (3, "C")]


def test_incremental_batch(spark):
    a, b = spark.range(3), spark.range(2)
    assert incremental_batch(a, None).count() == 3
    assert incremental_batch(a, a).count() == 0 and incremental_batch(a, b).count() == 3
    assert rows(incremental_batch(a, b, "manifest", b, ["id"])) == [2]
    with pytest.raises(ValueError):
        incremental_batch(a, b, "never")


def test_versions(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert table.read() is None
    table.replace(spark.range(2))
    table.replace(table.read().selectExpr("id + 10 id"))

    def refuse(_):
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        table.replace(spark.range(100), refuse)
    assert table.versions() == [0, 1] and rows(table.read()) == [10, 11] and rows(table.read(0)) == [0, 1]
    table.upsert(spark.createDataFrame([(11,), (12,)], "id bigint"), ["id"])
    assert rows(table.read()) == [10, 11, 12]


def test_stream_reads_only_new_files(spark, tmp_path):
    src, out, checkpoint = tmp_path / "land", str(tmp_path / "out"), str(tmp_path / "cp")
    ddl = spark.createDataFrame([], "id bigint").schema
    spark.range(3).coalesce(1).write.parquet(str(src / "a"))
    for _ in range(2):
        ingest.append_available(ingest.new_files(spark, str(src / "*"), ddl), out, checkpoint)
    assert spark.read.parquet(out).count() == 3
    spark.range(3, 5).coalesce(1).write.parquet(str(src / "b"))
    ingest.append_available(ingest.new_files(spark, str(src / "*"), ddl, max_files=1), out, checkpoint)
    assert rows(spark.read.parquet(out)) == [0, 1, 2, 3, 4]


def test_stream_upsert(spark, tmp_path):
    src, table = tmp_path / "land", VersionedTable(spark, str(tmp_path / "t"))
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "k int, at int, v string")
    df.coalesce(1).write.parquet(str(src / "a"))

    def run():
        ingest.upsert_available(ingest.new_files(spark, str(src / "*"), df.schema), table, ["k"], str(tmp_path / "cp"), ["at"])

    run()
    assert rows(table.read()) == [(1, 2, "b"), (2, 1, "c")]
    spark.createDataFrame([(2, 5, "d"), (3, 1, "e")], df.schema).coalesce(1).write.parquet(str(src / "b"))
    run()
    assert rows(table.read()) == [(1, 2, "b"), (2, 5, "d"), (3, 1, "e")]
    spark.createDataFrame([(2, 4, "late"), (3, 2, "f")], df.schema).coalesce(1).write.parquet(str(src / "c"))
    run()
    assert rows(table.read()) == [(1, 2, "b"), (2, 5, "d"), (3, 2, "f")]


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch_path(spark, "x").startswith(scratch_root(spark))
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_fingerprint_follows_the_files(spark, tmp_path):
    write_gz(tmp_path / "d" / "sub" / "a.gz", "x")
    first = fingerprint(spark, str(tmp_path / "d"))
    assert first == fingerprint(spark, str(tmp_path / "d"))
    write_gz(tmp_path / "d" / "sub" / "a.gz", "something longer")
    assert first != fingerprint(spark, str(tmp_path / "d"))


def test_stored_once(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    first = stage_once(spark, ("here", "three"), build)
    assert rows(stage_once(spark, ("here", "three"), build)) == [0, 1, 2] and len(calls) == 1
    gone = spark._jvm.org.apache.hadoop.fs.Path(first.inputFiles()[0]).getParent()
    gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    assert rows(stage_once(spark, ("here", "three"), build)) == [0, 1, 2] and len(calls) == 2
