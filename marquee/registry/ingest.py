"""Extracts, loads, layout, incremental maintenance and streams over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.upsert import BucketedTable, VersionedTable, incremental_batch, upsert
from ..session import scratch_path
from ..sources import layout, load, tsv
from ..sources.catalogue import raw
from ..sources.datasets import DATASETS
from ..streaming import ingest
from .core import query, rounded, table


def _exported(spark, sf, name: str) -> tuple[str, object]:
    """A derived extract written in the published file format."""
    dataset = DATASETS[name]
    path = scratch_path(spark, f"extract-{name}")
    tsv.write(raw(spark, sf, f"raw_{name}"), path, dataset)
    return path, dataset


def _round_trip(name: str, columns: str):
    @query(f"tsv_roundtrip_{name}", f"SELECT {columns} FROM raw_{name}")
    def run(spark, sf):
        """Written as gzip text, read back typed."""
        return rounded(tsv.scan(spark, *_exported(spark, sf, name)))
    return run


for _name, _columns in (("title_basics", "*"), ("title_crew", "*"), ("title_principals", "*"), ("name_basics", "*"), ("title_episode", "*"),
                        ("title_ratings", "tconst, round(cast(averageRating AS double), 6) AS averageRating, numVotes")):
    _round_trip(_name, _columns)


@query("tsv_text_roundtrip", """
SELECT 'd' || doc_id AS titleId, doc_id::int AS ordering, text AS title, lang AS region, NULL::varchar AS language, source AS types,
  '' AS attributes, doc_id % 2 = 0 AS isOriginalTitle FROM documents""")
def tsv_text_roundtrip(spark, sf):
    """Whole texts with tabs, line breaks, quotes and backslashes survive the format."""
    rows = table(spark, sf, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("titleId"), F.col("doc_id").cast("int").alias("ordering"),
        F.col("text").alias("title"), F.col("lang").alias("region"), F.lit(None).cast("string").alias("language"),
        F.col("source").alias("types"), F.lit("").alias("attributes"), (F.col("doc_id") % 2 == 0).alias("isOriginalTitle"))
    path, dataset = scratch_path(spark, "extract-akas"), DATASETS["title_akas"]
    tsv.write(rows, path, dataset)
    return tsv.scan(spark, path, dataset)


@query("tsv_rejects", """
SELECT tconst || chr(9) || 'x' || chr(9) || coalesce(cast(numVotes AS varchar), '\\N') AS value FROM raw_title_ratings
WHERE averageRating >= 9.5""")
def tsv_rejects(spark, sf):
    """Lines whose rating is no number are set aside."""
    path, dataset = scratch_path(spark, "extract-bad"), DATASETS["title_ratings"]
    rating = F.when(F.col("averageRating") >= 9.5, "x").otherwise(F.col("averageRating").cast("string"))
    votes = F.coalesce(F.col("numVotes").cast("string"), F.lit("\\N"))
    raw(spark, sf, "raw_title_ratings").select(F.concat_ws("\t", "tconst", rating, votes).alias("value")).write.text(path)
    return tsv.scan_with_rejects(spark, path, dataset)[1]


@query("csv_seed", "SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 6) AS c_acctbal, c_mktsegment FROM customer")
def csv_seed(spark, sf):
    """A CSV with a header, read with declared types."""
    path, rows = scratch_path(spark, "seed"), table(spark, sf, "customer")
    rows.write.option("header", True).csv(path)
    return rounded(tsv.read_seed(spark, path, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"))


@query("header_check", """
SELECT 'title_crew' AS dataset, true AS ok, 3 AS column_count UNION ALL SELECT 'title_ratings', false, 3""")
def header_check(spark, sf):
    """An extract against its own header and against another dataset's."""
    path, dataset = _exported(spark, sf, "title_crew")
    out = None
    for expected in (dataset, DATASETS["title_ratings"]):
        one = tsv.check_headers(spark, path, expected).groupBy("column_count").agg(F.bool_and(F.col("problem").isNull()).alias("ok"))
        one = one.select(F.lit(expected.name).alias("dataset"), "ok", "column_count")
        out = one if out is None else out.unionByName(one)
    return out


@query("rowcount_reconcile", """
SELECT 'title_principals' AS dataset, count(*) AS rows_read, count(*) AS rows_written, true AS ok FROM raw_title_principals""")
def rowcount_reconcile(spark, sf):
    path, dataset = _exported(spark, sf, "title_principals")
    home = scratch_path(spark, "table-principals")
    load.load_dataset(spark, path, dataset, home)
    return load.reconcile(spark, path, dataset, VersionedTable(spark, home).read())


@query("change_manifest", """
SELECT 1 AS run, 'title_ratings' AS dataset, true AS loaded, 'no previous load recorded' AS reason,
  (SELECT count(*) FROM raw_title_ratings) AS rows
UNION ALL SELECT 2, 'title_ratings', false, 'current version already loaded', 0
UNION ALL SELECT 3, 'title_ratings', true, 'source newer than last load', 2 * count(*) FROM raw_title_ratings""")
def change_manifest(spark, sf):
    """The second load of unchanged files is skipped; the third finds new ones in a sub-folder."""
    path, dataset = _exported(spark, sf, "title_ratings")
    home, manifest = scratch_path(spark, "table-ratings"), VersionedTable(spark, scratch_path(spark, "manifest"))
    runs = [load.load_dataset(spark, path, dataset, home, manifest) for _ in range(2)]
    tsv.write(raw(spark, sf, "raw_title_ratings"), f"{path}/more", dataset)
    runs.append(load.load_dataset(spark, path, dataset, home, manifest))
    return spark.createDataFrame([(i, r["dataset"], r["loaded"], r["reason"], r["rows"]) for i, r in enumerate(runs, 1)],
                                 "run int, dataset string, loaded boolean, reason string, rows bigint")


@query("layout_sorted_write", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders WHERE o_orderstatus = 'P'")
def layout_sorted_write(spark, sf):
    """Range-partitioned, sorted files with a bloom filter; lookups prune by statistics."""
    path = scratch_path(spark, "sorted-orders")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    layout.write_sorted(rows, path, ["o_orderstatus", "o_orderdate", "o_orderkey"], bloom=["o_orderkey"])
    return spark.read.parquet(path).where("o_orderstatus = 'P'")


@query("layout_full_refresh", "SELECT c_custkey, c_name FROM customer")
def layout_full_refresh(spark, sf):
    """A table replaced as a whole; readers see complete versions only."""
    home = VersionedTable(spark, scratch_path(spark, "customer"))
    rows = table(spark, sf, "customer").select("c_custkey", "c_name")
    home.replace(rows.where("c_acctbal > 0"))
    home.replace(rows)
    return home.read()


@query("view_materialization", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000")
def view_materialization(spark, sf):
    layout.as_view(table(spark, sf, "orders").where("o_totalprice > 100000").select("o_orderkey", "o_totalprice"), "large_orders")
    return spark.table("large_orders")


_BATCH = "SELECT o_orderkey, o_custkey, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_orderstatus = 'O'"
_UPSERTED = f"""
SELECT o_orderkey, o_custkey, round(o_totalprice, 6) AS o_totalprice FROM (
  SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')
  UNION ALL {_BATCH}) x"""


def _halves(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    batch = orders.where("o_orderstatus = 'O'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return orders.drop("o_orderstatus"), batch.drop("o_orderstatus")


@query("upsert_orders", _UPSERTED)
def upsert_orders(spark, sf):
    return rounded(upsert(*_halves(spark, sf), ["o_orderkey"]))


@query("upsert_versioned", _UPSERTED)
def upsert_versioned(spark, sf):
    """The same upsert on a stored table: the new version is complete before it shows, and untouched buckets keep their files."""
    target, batch = _halves(spark, sf)
    home = BucketedTable(spark, scratch_path(spark, "orders"), ["o_orderkey"], 8)
    home.replace(target)
    home.upsert(batch, ["o_orderkey"])
    return rounded(home.read())


@query("incremental_skip", """
SELECT 'same count' AS target, 0::bigint AS rows_to_process UNION ALL SELECT 'fewer rows', count(*) FROM orders
UNION ALL SELECT 'unseen keys', count(*) FROM orders WHERE o_orderstatus <> 'F'""")
def incremental_skip(spark, sf):
    orders = table(spark, sf, "orders")
    finished = orders.where("o_orderstatus = 'F'")
    cases = {"same count": incremental_batch(orders, orders), "fewer rows": incremental_batch(orders, finished),
             "unseen keys": incremental_batch(orders, finished, "manifest", finished, ["o_orderkey"])}
    out = None
    for name, rows in cases.items():
        one = rows.agg(F.count(F.lit(1)).alias("rows_to_process")).select(F.lit(name).alias("target"), "rows_to_process")
        out = one if out is None else out.unionByName(one)
    return out


@query("credits_incremental", """
SELECT composite_key, tconst, ordering, nconst, category, job_title, characters, role_category, is_missing_category, batch_date, airflow_run_id
FROM stg_credits""")
def credits_incremental(spark, sf):
    """Credits loaded in two runs: a partial first extract, then the full one."""
    from ..plans.staging import credits
    extract = raw(spark, sf, "raw_title_principals")
    home = BucketedTable(spark, scratch_path(spark, "credits"), ["composite_key"], 8)
    home.replace(credits(extract.where("category <> 'self'"), "2024-12-31", "run-0"))
    fresh = incremental_batch(extract, home.read())
    home.upsert(credits(fresh, "2025-01-01", "run-1"), ["composite_key"])
    return home.read().drop("loaded_at")


@query("stream_new_files", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_new_files(spark, sf):
    """File stream, run twice with one checkpoint: the second run finds nothing new."""
    out, checkpoint = scratch_path(spark, "events"), scratch_path(spark, "stream")
    schema = table(spark, sf, "events").schema
    for _ in range(2):
        ingest.append_available(ingest.new_files(spark, sf, schema, glob="events.parquet"), out, checkpoint)
    return spark.read.schema(schema).parquet(out)


@query("stream_upsert", """
SELECT event_id, ts, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) x WHERE rn = 1""")
def stream_upsert(spark, sf):
    """Newest event per user, kept by upserting micro-batches of one file whose events are in no order of time."""
    home = BucketedTable(spark, scratch_path(spark, "newest"), ["user_id"], 4)
    events, landing = table(spark, sf, "events"), scratch_path(spark, "landing")
    for part in range(3):
        events.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == part).coalesce(1).write.parquet(f"{landing}/{part}")
    rows = ingest.new_files(spark, f"{landing}/*", events.schema, max_files=1)
    rows = rows.select("event_id", "ts", "user_id", "event_type", "value")
    ingest.upsert_available(rows, home, ["user_id"], scratch_path(spark, "stream"), ["ts", "event_id"])
    return home.read()


@query("stream_dedup", "SELECT event_id, user_id FROM events")
def stream_dedup(spark, sf):
    out = scratch_path(spark, "dedup")
    rows = ingest.new_files(spark, sf, table(spark, sf, "events").schema, glob="events.parquet")
    ingest.append_available(ingest.dedup_within(rows, ["event_id"], "ts", "40 days").select("event_id", "user_id"),
                            out, scratch_path(spark, "stream"))
    return spark.read.schema("event_id bigint, user_id bigint").parquet(out)
