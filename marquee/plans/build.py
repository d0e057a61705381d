"""Building all layers: tables written, views lazy."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ..session import at_once, scratch_scope, stage
from ..sources.layout import write_sorted
from . import intermediate as I
from . import marts as M
from . import staging as S

# Lookup columns each stored table is sorted by; the last one is its key.
LAYOUT = {
    "stg_titles": ["title_type", "start_year", "tconst"], "stg_people": ["nconst"],
    "stg_directors": ["tconst", "director_nconst"], "stg_writers": ["tconst", "writer_nconst"],
    "stg_episodes": ["parentTconst", "tconst"], "stg_ratings": ["tconst"], "stg_credits": ["tconst", "composite_key"],
    "mart_titles": ["title_type", "decade", "tconst"], "mart_people": ["career_stage", "nconst"],
    "mart_genres": ["genre"], "mart_series": ["series_performance_tier", "series_tconst"],
}


def staging_tables(raw: dict[str, DataFrame], as_of=None, missing: str = "marker",
                   batch_date: str = "", run_id: str = "") -> dict[str, DataFrame]:
    """Lazy staging tables from the raw extracts, keyed by dataset name."""
    return {
        "stg_titles": S.titles(raw["title_basics"]), "stg_people": S.people(raw["name_basics"], as_of),
        "stg_directors": S.directors(raw["title_crew"]), "stg_writers": S.writers(raw["title_crew"]),
        "stg_episodes": S.episodes(raw["title_episode"], missing), "stg_ratings": S.ratings(raw["title_ratings"], missing),
        "stg_credits": S.credits(raw["title_principals"], batch_date, run_id),
    }


def shared_joins(stg: dict[str, DataFrame], as_of=None) -> dict[str, DataFrame]:
    """The joins more than one table reads, stored once."""
    joins = lazy_joins(stg, as_of)
    stored = at_once(stg["stg_titles"].sparkSession, *(partial(stage, df, f"shared-{name}") for name, df in joins.items()))
    return dict(zip(joins, stored, strict=True))


def lazy_joins(stg: dict[str, DataFrame], as_of=None) -> dict[str, DataFrame]:
    """The same joins, not stored: for views, which must show what their tables hold when they are read."""
    return {
        "complete": I.title_complete(stg["stg_titles"], stg["stg_ratings"]),
        "episodes": I.episode_rows(stg["stg_episodes"], stg["stg_titles"], stg["stg_ratings"], as_of),
    }


def intermediate_tables(stg: dict[str, DataFrame], shared: dict[str, DataFrame], stored: bool = True) -> dict[str, DataFrame]:
    return {
        "int_title_genres": I.title_genres(stg["stg_titles"]), "int_title_complete": shared["complete"],
        "int_filmography": I.filmography(stg["stg_people"], stg["stg_credits"], shared["complete"]),
        "int_hierarchy": I.hierarchy(shared["episodes"], stored),
    }


def mart_steps(stg: dict[str, DataFrame], shared: dict[str, DataFrame], hot_rows: int | None = None) -> dict[str, Callable[[], DataFrame]]:
    """The marts, each still to be made: making one may store what it reads more than once."""
    complete, rows = shared["complete"], shared["episodes"]
    return {
        "mart_titles": partial(M.title_mart, complete, hot_rows),
        "mart_people": partial(M.people_mart, stg["stg_people"], stg["stg_credits"], complete),
        "mart_genres": partial(M.genre_mart, complete), "mart_series": partial(M.series_mart, rows),
    }


def mart_tables(stg: dict[str, DataFrame], shared: dict[str, DataFrame], hot_rows: int | None = None) -> dict[str, DataFrame]:
    return {name: make() for name, make in mart_steps(stg, shared, hot_rows).items()}


def all_tables(raw: dict[str, DataFrame], as_of=None) -> dict[str, DataFrame]:
    """All fifteen tables without publishing any (tests, exploration)."""
    stg = staging_tables(raw, as_of)
    shared = shared_joins(stg, as_of)
    return {**stg, **intermediate_tables(stg, shared), **mart_tables(stg, shared)}


def build(spark: SparkSession, raw: dict[str, DataFrame], out: str, as_of=None, batch_date: str = "",
          run_id: str = "") -> dict[str, DataFrame]:
    """Write staging tables and marts below ``out``; intermediate tables stay lazy views over the stored staging tables.

    Later layers read the written staging tables, so each extract is scanned once.  The tables of a layer do
    not read each other and are written a few at a time.  What the marts
    store on the way is deleted as soon as they are written.
    """
    def write(name: str, make: Callable[[], DataFrame]) -> None:
        order = LAYOUT[name]
        # a key that leads the sort order is pruned by min/max already
        write_sorted(make(), f"{out}/{name}", order, bloom=order[-1:] if len(order) > 1 else [])

    def written(steps: dict[str, Callable[[], DataFrame]]) -> dict[str, DataFrame]:
        at_once(spark, *(partial(write, name, make) for name, make in steps.items()))
        return {name: spark.read.parquet(f"{out}/{name}") for name in steps}

    staging = staging_tables(raw, as_of, batch_date=batch_date, run_id=run_id)
    stg = written({name: (lambda df=df: df) for name, df in staging.items()})
    views = intermediate_tables(stg, lazy_joins(stg, as_of), stored=False)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    with scratch_scope():
        marts = written(mart_steps(stg, shared_joins(stg, as_of)))
    return {**stg, **views, **marts}
