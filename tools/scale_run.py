"""Build all layers over N copies of the derived catalogue and print seconds and raw rows per second.

usage: python tools/scale_run.py SF_DIR COPIES OUT_DIR
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from marquee.plans import build as B  # noqa: E402
from marquee.session import local_session, stage  # noqa: E402
from marquee.sources.catalogue import raw  # noqa: E402

IDS = {"title_basics": ["tconst"], "title_ratings": ["tconst"], "name_basics": ["nconst"], "title_crew": ["tconst"],
       "title_episode": ["tconst", "parentTconst"], "title_principals": ["tconst", "nconst"]}


def main() -> None:
    sf, copies, out = sys.argv[1], int(sys.argv[2]), sys.argv[3]
    spark = local_session("scale", 8, partitions=16, memory="20g")

    def copied(name: str):
        rows = raw(spark, sf, f"raw_{name}").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
        suffix = F.concat(F.lit("c"), F.col("_copy").cast("string"))
        return stage(rows.withColumns({c: F.concat(c, suffix) for c in IDS[name]}).drop("_copy"), f"copies-{name}")

    raws = {name: copied(name) for name in IDS}
    total = sum(df.count() for df in raws.values())
    marks = []

    def step(label, fn):
        start = time.perf_counter()
        result = fn()
        marks.append(time.perf_counter() - start)
        print(f"{label}: {marks[-1]:.1f}s", flush=True)
        return result

    def write(tables):
        for name, df in tables.items():
            step(f"  {name}", lambda: df.write.parquet(f"{out}/{name}"))
        return {name: spark.read.parquet(f"{out}/{name}") for name in tables}

    start = time.perf_counter()
    stg = write(B.staging_tables(raws, "2025-01-01"))
    shared = step("  shared joins", lambda: B.shared_joins(stg, "2025-01-01"))
    write(B.intermediate_tables(stg, shared))
    write(step("  mart preparation", lambda: B.mart_tables(stg, shared)))
    seconds = time.perf_counter() - start
    print(f"{total} raw rows, 15 tables in {seconds:.1f}s: {total / seconds:,.0f} raw rows/s")


if __name__ == "__main__":
    main()
