"""Small assertions shared by the tests."""

from __future__ import annotations


def rows(df, *columns):
    """Rows as a sorted list of tuples (single values for one column)."""
    df = df.select(*columns) if columns else df
    out = [tuple(r) for r in df.collect()]
    out = [r[0] for r in out] if len(df.columns) == 1 else out
    return sorted(out, key=lambda r: str(r))


def values(spark, column, **inputs):
    """One expression over one row of inputs."""
    from pyspark.sql import functions as F
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in inputs.items()]) if inputs else spark.range(1)
    return df.select(column).first()[0]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def single_task_sort(df) -> bool:
    """TRUE when the plan sorts unaggregated rows in one task, as a window without keys does."""
    lines = plan(df).splitlines()
    for i, line in enumerate(lines[:-1]):
        if "Sort [" in line and "Exchange SinglePartition" in lines[i + 1]:
            if not any("Aggregate(" in below for below in lines[i + 2:i + 5]):
                return True
    return False
