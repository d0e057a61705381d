"""Physical layout of written tables: the lookup paths readers need."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import is_scan, scratch_scope, stage


def write_sorted(df: DataFrame, path: str, by: list[str], bloom: list[str] = (), files: int | None = None) -> None:
    """Range-partitioned and sorted files: row-group min/max then prune lookups on ``by``.

    The range partitioner samples all ``by`` columns; give a unique last column
    so that one hot leading value still spreads over files.  It reads its input once for the
    sample and once for the rows, so rows that have to be computed are stored first and
    computed once.
    """
    with scratch_scope():
        df = df if is_scan(df) else stage(df, "unsorted")
        placed = df.repartitionByRange(files, *by) if files else df.repartitionByRange(*by)
        writer = placed.sortWithinPartitions(*by).write.mode("overwrite")
        if bloom:
            writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")   # sized by the values met
        for c in bloom:
            writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
        writer.parquet(path)


def write_bucketed(df: DataFrame, table: str, by: list[str], buckets: int) -> None:
    """A catalog table bucketed on its join key: joins on it need no shuffle."""
    # cluster first, so that each task writes its own buckets only
    df.repartition(buckets, *by).write.mode("overwrite").bucketBy(buckets, *by).sortBy(*by).saveAsTable(table)


def write_table(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").saveAsTable(table)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """A lazy named relation."""
    df.createOrReplaceTempView(name)
    return df
