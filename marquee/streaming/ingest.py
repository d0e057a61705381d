"""New files of a landing folder, exactly once, as append or upsert."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.ranking import deduplicate
from ..operators.upsert import VersionedTable


def new_files(spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet",
              glob: str | None = None, max_files: int | None = None, **options) -> DataFrame:
    """Stream of the rows of files not processed before (the checkpoint remembers them)."""
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def append_available(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append everything that is available now to a parquet table, then stop."""
    query = (rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start(out))
    query.awaitTermination()
    return query


def upsert_available(rows: DataFrame, table: VersionedTable, key: list[str], checkpoint: str,
                     newest_by: list[str] | None = None) -> StreamingQuery:
    """Upsert everything that is available now into a versioned table, batch by batch; a bucketed one rewrites the batch's buckets only.

    Replaying a batch after a failure replaces the same keys again, so the
    outcome does not change.  ``newest_by`` keeps the newest row per key among
    the batch and what is stored, so an older row that comes late replaces nothing.
    """
    def apply(batch: DataFrame, _: int) -> None:
        if newest_by:
            stored = table.matching(batch, key)
            if stored is not None:
                batch = batch.unionByName(stored)
            batch = deduplicate(batch, key, [(c, "desc") for c in newest_by])
        table.upsert(batch, key)

    query = (rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def dedup_within(rows: DataFrame, key: list[str], event_time: str, delay: str) -> DataFrame:
    """First row per key, forgetting keys once the watermark has passed them."""
    return (rows.withColumn(event_time, F.col(event_time).cast("timestamp"))
            .withWatermark(event_time, delay).dropDuplicatesWithinWatermark(key))
