"""Incremental maintenance of a stored table."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_path, scratch_scope, stage


def upsert(target: DataFrame, batch: DataFrame, key: list[str], delete_missing: bool = False) -> DataFrame:
    """Delete target rows whose key is in the batch, then add the batch.

    Copies within the batch are all kept.  ``delete_missing`` also drops target
    rows whose key the batch (then a full extract) no longer has.
    """
    if delete_missing:
        return batch.select(*target.columns)
    # an anti join asks only whether a key is there: distinct keys would first fill a hash table of all of a task's
    return target.join(batch.select(*key), key, "left_anti").select(*target.columns).unionByName(batch)


def incremental_batch(source: DataFrame, target: DataFrame | None, when: str = "rowcount",
                      seen: DataFrame | None = None, on: list[str] = ()) -> DataFrame:
    """Rows of the source that need processing.

    'rowcount': all rows, or none when source and target have as many rows.
    'manifest': the rows whose ``on`` columns (such as file, size, time) were
    not ``seen`` before.
    """
    if target is None:
        return source
    if when == "rowcount":
        return source.limit(0) if source.count() == target.count() else source
    if when == "manifest":
        return source.join(seen.select(*on).distinct(), list(on), "left_anti")
    raise ValueError("when must be 'rowcount' or 'manifest'")


class VersionedTable:
    """A parquet table published by version, for one writer and any readers.

    ``v=N+1`` is written completely, then checked, and only then marked;
    readers see marked versions only.  A failed or lost write is never read and
    the older version stays readable meanwhile.
    """

    MARK = "_published"

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def _file(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def versions(self) -> list[int]:
        """Published versions, ascending."""
        fs, pattern = self._file(f"v=*/{self.MARK}")
        return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in fs.globStatus(pattern) or [])

    def _load(self, version: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/v={version}")

    def read(self, version: int | None = None) -> DataFrame | None:
        """The newest (or given) version; None while there is none."""
        known = self.versions()
        if not known:
            return None
        return self._load(known[-1] if version is None else version)

    def replace(self, df: DataFrame, check: Callable[[DataFrame], None] | None = None) -> int:
        """Publish ``df`` as the next version; it may read older versions of this table.

        ``check`` sees the written rows before they are published and raises to
        keep them from readers.
        """
        known = self.versions()
        version = known[-1] + 1 if known else 0
        df.write.mode("overwrite").parquet(f"{self.path}/v={version}")
        if check:
            check(self._load(version))
        fs, mark = self._file(f"v={version}/{self.MARK}")
        fs.create(mark, True).close()
        return version

    def upsert(self, batch: DataFrame, key: list[str]) -> int:
        current = self.read()
        return self.replace(batch if current is None else upsert(current, batch, key))

    def matching(self, batch: DataFrame, key: list[str]) -> DataFrame | None:
        """The stored rows whose key is in the batch; None while nothing is stored."""
        stored = self.read()
        return None if stored is None else stored.join(batch.select(*key).distinct(), key, "left_semi")


class BucketedTable(VersionedTable):
    """A versioned table whose rows lie in buckets by the hash of their key.

    A version is a manifest: the folder that holds each bucket.  An upsert reads and
    writes the buckets of its batch's keys only; the new version names the old
    folders for all others.  As with ``VersionedTable``, a version shows
    only after all of its rows are written and checked.  The number of buckets belongs to
    the table; a manifest has that many entries, whatever the rows.
    """

    def __init__(self, spark: SparkSession, path: str, key: list[str], buckets: int = 256):
        super().__init__(spark, path)
        self.key, self.buckets = list(key), buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def manifest(self, version: int | None = None) -> dict | None:
        """{"schema": …, "buckets": {number: folder}} of the newest (or given) version."""
        known = self.versions()
        if not known:
            return None
        fs, path = self._file(f"v={known[-1] if version is None else version}/manifest.json")
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _rows(self, manifest: dict, buckets: list[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        held = manifest["buckets"]
        paths = [f"{self.path}/{held[b]}" for b in held if buckets is None or int(b) in buckets]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame | None:
        manifest = self.manifest(version)
        return None if manifest is None else self._rows(manifest)

    def _write(self, df: DataFrame) -> dict[str, str]:
        """Write the rows by bucket and return the folder of each bucket that has some.

        Buckets lie together, but by size: AQE splits a large one over tasks, each with a file in
        its folder, so that a task sorts a bounded part however many rows a bucket has.
        """
        run = f"data/{uuid.uuid4().hex}"
        placed = df.withColumn("_bucket", self.bucket())
        placed.hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/{run}")
        fs, pattern = self._file(f"{run}/_bucket=*")
        names = [f.getPath().getName() for f in fs.globStatus(pattern) or []]
        return {name.split("=")[1]: f"{run}/{name}" for name in names}

    def _publish(self, manifest: dict, check: Callable[[DataFrame], None] | None) -> int:
        if check:
            check(self._rows(manifest))
        known = self.versions()
        version = known[-1] + 1 if known else 0
        fs, path = self._file(f"v={version}/manifest.json")
        stream = fs.create(path, True)
        stream.write(json.dumps(manifest).encode())
        stream.close()
        fs, mark = self._file(f"v={version}/{self.MARK}")
        fs.create(mark, True).close()
        return version

    def replace(self, df: DataFrame, check: Callable[[DataFrame], None] | None = None) -> int:
        return self._publish({"schema": json.loads(df.schema.json()), "buckets": self._write(df)}, check)

    def touched(self, batch: DataFrame) -> list[int]:
        """The buckets of the batch's keys."""
        return [r[0] for r in batch.select(self.bucket().alias("b")).distinct().collect()]

    def matching(self, batch: DataFrame, key: list[str]) -> DataFrame | None:
        """As in ``VersionedTable``, from the batch's buckets alone."""
        manifest = self.manifest()
        if manifest is None:
            return None
        return self._rows(manifest, self.touched(batch)).join(batch.select(*key).distinct(), key, "left_semi")

    def upsert(self, batch: DataFrame, key: list[str], check: Callable[[DataFrame], None] | None = None) -> int:
        """Replace the batch's keys; buckets without any of them keep their files."""
        if list(key) != self.key:
            raise ValueError(f"the table is bucketed by {self.key}")
        manifest = self.manifest()
        if manifest is None:
            return self.replace(batch, check)
        with scratch_scope():
            batch = stage(batch, "batch")
            touched = self.touched(batch)
            fresh = self._write(upsert(self._rows(manifest, touched), batch, self.key))
        kept = {b: folder for b, folder in manifest["buckets"].items() if int(b) not in touched}
        return self._publish({**manifest, "buckets": {**kept, **fresh}}, check)

    def expire(self, keep: int = 2) -> int:
        """Forget all but the newest ``keep`` versions and delete the folders that none of them names."""
        known = self.versions()
        named = {f for v in known[-keep:] for f in self.manifest(v)["buckets"].values()}
        fs, pattern = self._file("data/*/_bucket=*")
        gone = 0
        for f in fs.globStatus(pattern) or []:
            path = f.getPath()
            if f"data/{path.getParent().getName()}/{path.getName()}" not in named:
                fs.delete(path, True)
                gone += 1
        for v in known[:-keep]:
            delete_path(self.spark, f"{self.path}/v={v}")
        return gone
