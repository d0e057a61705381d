"""Cleaned tables, one per extract.

Each function is DataFrame -> DataFrame.  ``as_of`` pins "today";
``missing='null'`` makes the is_missing_* flags of ratings and episodes test for
NULL, while the default 'marker' tests for the extract's NULL marker, which a
loaded table no longer holds (the flags are then always FALSE).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_of_column
from ..functions.numeric import bounded_int
from ..functions.text import (
    MISSING_ORDINAL, NULL_MARKER, composite_key, default_text, empty_to_null, episode_title, flag_01, has_key,
    is_blank, mapped, marker_to_null, part, true_only,
)
from ..operators.columns import with_audit
from ..operators.ranking import asc, row_number
from ..operators.reshape import split_rows
from . import rulebook as R


def _missing(c: str, missing: str) -> Column:
    if missing not in ("marker", "null"):
        raise ValueError("missing must be 'marker' or 'null'")
    col = F.col(c)
    return col.isNull() if missing == "null" else true_only(col.cast("string") == NULL_MARKER)


def titles(raw: DataFrame) -> DataFrame:
    title = F.when(is_blank("primaryTitle"), R.UNKNOWN_TITLE).otherwise(episode_title("primaryTitle"))
    out = raw.where(has_key("tconst")).select(
        "tconst", F.col("titleType").alias("title_type"),
        title.alias("primary_title"), empty_to_null("originalTitle").alias("original_title"),
        flag_01("isAdult").alias("is_adult"),
        bounded_int("startYear", *R.TITLE_YEARS).alias("start_year"),
        bounded_int("endYear", *R.TITLE_YEARS).alias("end_year"),
        bounded_int("runtimeMinutes", *R.RUNTIME_MINUTES).alias("runtime_minutes"),
        marker_to_null("genres").alias("genres_raw"),
        *[part("genres", i).alias(f"{n}_genre") for i, n in enumerate(("primary", "secondary", "third"), 1)],
        is_blank("primaryTitle").alias("is_missing_title"),
        F.coalesce(F.col("genres") == NULL_MARKER, F.lit(True)).alias("is_missing_genres"),
    )
    return with_audit(out)


def people(raw: DataFrame, as_of=None) -> DataFrame:
    year = F.year(as_of_column(as_of))
    jobs, known = marker_to_null("primaryProfession"), marker_to_null("knownForTitles")

    def pieces(text: Column, names: list[str], what: str) -> list[Column]:
        # the first piece keeps '', later ones turn it into NULL
        cols = [part(text, i) for i in range(1, len(names) + 1)]
        return [(c if i == 0 else empty_to_null(c)).alias(f"{n}_{what}") for i, (c, n) in enumerate(zip(cols, names))]

    born, died = F.col("birthYear"), F.col("deathYear")
    out = raw.where(has_key("nconst")).select(
        "nconst", default_text("primaryName", R.UNKNOWN_PERSON).alias("primary_name"),
        bounded_int("birthYear", R.PERSON_FIRST_YEAR, year).alias("birth_year"),
        bounded_int("deathYear", R.PERSON_FIRST_YEAR, year).alias("death_year"),
        jobs.alias("professions_raw"), *pieces(jobs, ["first", "second", "third"], "profession"),
        known.alias("known_for_titles_raw"), *pieces(known, ["first", "second", "third", "fourth"], "title_known_for"),
        (died - born).alias("death_age"),
        F.when(died.isNull(), year.cast("double") - born).alias("actual_age"),
        died.isNotNull().alias("is_deceased"), is_blank("primaryName").alias("is_missing_name"),
        F.coalesce(F.col("primaryProfession") == NULL_MARKER, F.lit(True)).alias("is_missing_professions"),
    )
    return with_audit(out)


def crew(raw: DataFrame, role: str, one_row_per_title: bool = True) -> DataFrame:
    """Title x person rows of one comma list ('directors' or 'writers').

    The order number ranks ids alphabetically within a title.  The extract has
    one row per title (its declared key), so the list itself is sorted and
    numbered in the row: no shuffle, and no title can become a hot window.
    ``one_row_per_title=False`` ranks across rows instead.
    """
    one = role.rstrip("s")
    person, order = f"{one}_nconst", f"{one}_order"
    listed = raw.where(has_key(role) & (F.col(role) != NULL_MARKER))
    if one_row_per_title:
        ids = F.transform(F.split(F.col(role), ","), lambda x: F.trim(x))
        ids = F.array_sort(F.filter(ids, lambda x: ~x.isin("", NULL_MARKER)))
        rows = listed.select("tconst", F.posexplode(ids).alias("_at", person))
        rows = rows.withColumn(order, (F.col("_at") + 1).cast("bigint")).drop("_at")
    else:
        rows = split_rows(listed, role, person, drop=["", NULL_MARKER], keep=["tconst"])
        rows = row_number(rows, ["tconst"], [asc(person)], order)
    rows = rows.select("tconst", person, F.lit(False).alias(f"is_invalid_{one}"), order)
    return with_audit(rows)


def directors(raw: DataFrame, **options) -> DataFrame:
    return crew(raw, "directors", **options)


def writers(raw: DataFrame, **options) -> DataFrame:
    return crew(raw, "writers", **options)


def episodes(raw: DataFrame, missing: str = "marker") -> DataFrame:
    out = raw.where(F.col("tconst").isNotNull() & F.col("parentTconst").isNotNull()).select(
        "tconst", "parentTconst", F.col("seasonNumber").cast("int").alias("season_number"),
        F.col("episodeNumber").cast("int").alias("episode_number"),
        _missing("seasonNumber", missing).alias("is_missing_season"),
        _missing("episodeNumber", missing).alias("is_missing_episode"),
    )
    return with_audit(out)


def ratings(raw: DataFrame, missing: str = "marker") -> DataFrame:
    votes = F.col("numVotes").cast("int")
    out = raw.where(F.col("tconst").isNotNull()).select(
        "tconst", F.col("averageRating").cast("decimal(3,1)").alias("average_rating"), votes.alias("num_votes"),
        _missing("averageRating", missing).alias("is_missing_rating"),
        _missing("numVotes", missing).alias("is_missing_votes"),
        true_only(votes >= R.SIGNIFICANT_VOTES).alias("has_significant_votes"),
    )
    return with_audit(out)


def credit_key() -> Column:
    return composite_key("tconst", "nconst", F.coalesce(F.col("ordering").cast("string"), F.lit(MISSING_ORDINAL)))


def credits(raw: DataFrame, batch_date: str = "", run_id: str = "") -> DataFrame:
    """Title x person credits; maintained incrementally by ``composite_key``."""
    whole = F.col("tconst").isNotNull() & F.col("nconst").isNotNull() & F.col("ordering").isNotNull()
    out = raw.where(whole).select(
        credit_key().alias("composite_key"), "tconst", F.col("ordering").cast("int").alias("ordering"), "nconst",
        F.lower(F.trim("category")).alias("category"), marker_to_null("job").alias("job_title"),
        marker_to_null("characters").alias("characters"),
        mapped("category", R.ROLE_GROUPS, R.OTHER_ROLE).alias("role_category"),
        is_blank("category").alias("is_missing_category"),
    )
    return with_audit(out, batch_date, run_id).withColumnRenamed("run_id", "airflow_run_id")
