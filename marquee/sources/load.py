"""Loading extracts into tables: change detection, one-pass counting, publishing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import VersionedTable
from ..session import files_below, stage
from .datasets import Dataset
from .tsv import check_headers, is_header, lines, parse

MANIFEST_DDL = "dataset string, path string, size bigint, modified_at timestamp, loaded_at timestamp"


class CountMismatch(RuntimeError):
    """Rows written differ from rows read."""


def list_files(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """(dataset, path, size, modified_at) of the files below a path; contents are not read.

    Spark's readers pass over files of no bytes; they are listed all the same.
    """
    empty = [(dataset, p, size, at / 1000) for p, size, at in files_below(spark, path)
             if not size and not p.rsplit("/", 1)[1].startswith(("_", "."))]
    blank = spark.createDataFrame(empty, "dataset string, path string, size bigint, at double") \
        .select("dataset", "path", "size", F.col("at").cast("timestamp").alias("modified_at"))
    return blank.unionByName(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(
        F.lit(dataset).alias("dataset"), F.col("_metadata.file_path").alias("path"), F.col("length").alias("size"),
        F.col("modificationTime").alias("modified_at")))


def changed_files(listing: DataFrame, manifest: DataFrame | None) -> DataFrame:
    """Files of the listing that the manifest has not recorded with that size and time."""
    if manifest is None:
        return listing
    return listing.join(manifest.select("path", "size", "modified_at").distinct(), ["path", "size", "modified_at"], "left_anti")


def load_decisions(listing: DataFrame, manifest: DataFrame | None) -> DataFrame:
    """(dataset, needed, reason) per dataset of the listing.

    A dataset is loaded unless its files, by path, size and time, are those of
    its last load.  The age of a file does not matter: an old-dated file that
    was not there before is new.
    """
    key = ["dataset", "path", "size", "modified_at"]
    found = listing.select(*key, F.lit(True).alias("found"))
    if manifest is None:
        both = found.withColumn("loaded", F.lit(None).cast("boolean"))
    else:
        last = manifest.groupBy("dataset").agg(F.max("loaded_at").alias("loaded_at"))
        loaded = manifest.join(last, ["dataset", "loaded_at"]).select(*key, F.lit(True).alias("loaded"))
        both = found.join(loaded, key, "full")
    facts = both.groupBy("dataset").agg(
        F.count("found").alias("files"), F.count("loaded").alias("known"), F.count_if(F.col("loaded").isNull()).alias("fresh"),
        F.count_if(F.col("found").isNull()).alias("gone"), F.count_if(F.col("found") & F.col("modified_at").isNull()).alias("undated"))
    rule = (F.when(F.col("undated") > 0, "no modification time available")
            .when(F.col("known") == 0, "no previous load recorded")
            .when(F.col("fresh") > 0, "source newer than last load")
            .when(F.col("gone") > 0, "files removed since last load")
            .otherwise("current version already loaded"))
    decided = facts.where("files > 0").withColumn("reason", rule)
    return decided.select("dataset", (F.col("reason") != "current version already loaded").alias("needed"), "reason")


def manifest_rows(listing: DataFrame) -> DataFrame:
    return listing.select("dataset", "path", "size", "modified_at", F.current_timestamp().alias("loaded_at"))


def load_dataset(spark: SparkSession, source: str, dataset: Dataset, table_path: str,
                 manifest: VersionedTable | None = None, partitions: int | None = None) -> dict:
    """Full refresh of one dataset, skipped when the manifest already has its files.

    The extract is read once: header lines and data lines are counted while the
    rows are written.  The new version is published only when the files read are
    those listed, each with one header line, and as many rows arrived as lines were
    read; the manifest is written last, so a failed load leaves table and manifest as they
    were.  It records the files as listed: one replaced meanwhile is new to the next run.
    Fewer files than cores are spread out before the write.
    """
    known = manifest.read() if manifest else None
    listing = stage(list_files(spark, source, dataset.name), "listing")
    decision = load_decisions(listing, known).first()
    if decision is None:
        raise FileNotFoundError(source)
    if not decision["needed"]:
        return {"dataset": dataset.name, "loaded": False, "reason": decision["reason"], "rows": 0}
    files, mark = listing.agg(F.count(F.lit(1)), F.sum(_mark("path", "size", "modified_at"))).first()
    seen = Observation()
    told = F.when(is_header(dataset), _mark("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time"))
    raw = lines(spark, source).select("value", told.alias("_mark")).observe(
        seen, F.count("_mark").alias("headers"), F.sum("_mark").alias("mark"), F.count_if(~is_header(dataset)).alias("rows"))
    rows = parse(raw, dataset)
    if partitions is None and files < spark.sparkContext.defaultParallelism:
        partitions = spark.sparkContext.defaultParallelism
    if partitions:
        rows = rows.repartition(partitions)   # gzip gives one partition per file
    table = VersionedTable(spark, table_path)

    def check(written: DataFrame) -> None:
        if (seen.get["headers"], seen.get["mark"]) != (files, mark):
            _raise_bad_header(spark, source, dataset)   # a retried stage may have counted twice: count again before failing
            _raise_other_files(file_facts(spark, source, dataset, listing))
        if seen.get["rows"] != written.count():
            # a retried stage may have counted lines twice: count again before failing
            off = reconcile(spark, source, dataset, written).first()
            if not off["ok"]:
                raise CountMismatch(f"{dataset.name}: read {off['rows_read']}, wrote {off['rows_written']}")

    try:
        version = table.replace(rows, check)
    except (CountMismatch, ValueError):
        raise
    except Exception:
        _raise_bad_header(spark, source, dataset)   # a wrong header usually shows as a failed cast
        raise
    if manifest:
        fresh = manifest_rows(listing)
        manifest.replace(fresh if known is None else known.unionByName(fresh))
    return {"dataset": dataset.name, "loaded": True, "reason": decision["reason"], "rows": table.read(version).count()}


def _mark(*facts: str) -> Column:
    """A number for a file; sums of them tell sets of files apart."""
    return F.pmod(F.xxhash64(*[F.col(c) for c in facts]), F.lit(1 << 32))


def file_facts(spark: SparkSession, source: str, dataset: Dataset, listing: DataFrame | None = None) -> DataFrame:
    """(path, headers, rows, listed) of every file that is listed or read: its header and data lines."""
    listing = list_files(spark, source, dataset.name) if listing is None else listing
    read = lines(spark, source).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
                                       F.col("_metadata.file_modification_time").alias("modified_at"))
    read = read.groupBy("path", "size", "modified_at").agg(F.count_if(is_header(dataset)).alias("headers"), F.count_if(~is_header(dataset)).alias("rows"))
    both = listing.select("path", "size", "modified_at", F.lit(True).alias("listed")).join(read, ["path", "size", "modified_at"], "full")
    return both.select("path", F.coalesce("headers", F.lit(0)).alias("headers"), F.coalesce("rows", F.lit(0)).alias("rows"),
                       F.coalesce("listed", F.lit(False)).alias("listed"))


def _raise_other_files(facts: DataFrame) -> None:
    bad = facts.where("headers <> 1 or not listed").first()
    if bad:
        raise ValueError(f"{bad['path']}: " + (f"{bad['headers']} header lines instead of one" if bad["listed"] else "changed during the load"))


def _raise_bad_header(spark: SparkSession, source: str, dataset: Dataset) -> None:
    bad = check_headers(spark, source, dataset).where("problem is not null").first()
    if bad:
        raise ValueError(f"{bad['file']}: {bad['problem']}")


def reconcile(spark: SparkSession, source: str, dataset: Dataset, table: DataFrame) -> DataFrame:
    """(dataset, rows_read, rows_written, ok): data lines of every file listed against the table.

    Not ok as well when a file has no header line, or several.
    """
    facts = file_facts(spark, source, dataset).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_read"), F.coalesce(F.bool_and((F.col("headers") == 1) & F.col("listed")), F.lit(True)).alias("whole"))
    written = table.agg(F.count(F.lit(1)))
    return facts.select(F.lit(dataset.name).alias("dataset"), "rows_read", written.scalar().alias("rows_written"), "whole") \
        .withColumn("ok", F.col("whole") & (F.col("rows_read") == F.col("rows_written"))).drop("whole")
