"""Joined and classified rows built from the staging tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_of_column, span_years
from ..functions.numeric import exact_avg, guarded_ratio
from ..functions.text import true_only
from ..operators.joins import parent_child
from ..operators.reshape import columns_to_ranked_rows
from ..session import stage
from . import rulebook as R

GENRE_COLUMNS = ["primary_genre", "secondary_genre", "third_genre"]


def title_genres(titles: DataFrame) -> DataFrame:
    """title x genre x rank: one scan that explodes the three genre columns."""
    return columns_to_ranked_rows(titles, ["tconst"], GENRE_COLUMNS, "genre", "genre_rank")


def title_complete(titles: DataFrame, ratings: DataFrame) -> DataFrame:
    """Titles with their rating, tiers and flags."""
    joined = titles.select(
        "tconst", "title_type", "primary_title", "original_title", "is_adult", "start_year", "end_year",
        "runtime_minutes", *GENRE_COLUMNS,
    ).join(ratings.select("tconst", "average_rating", "num_votes"), "tconst", "left")
    return joined.withColumns({
        "decade": R.DECADE.column(), "quality_tier": R.QUALITY_TIER.column(),
        "popularity_tier": R.POPULARITY_TIER.column(), "runtime_category": R.RUNTIME_CATEGORY.column(),
        "is_blockbuster_genre": true_only(F.col("primary_genre").isin(R.BLOCKBUSTER_GENRES)),
        "has_ratings": F.col("average_rating").isNotNull(),
        "has_reliable_votes": true_only(F.col("num_votes") >= R.RELIABLE_VOTES),
        "has_high_votes": true_only(F.col("num_votes") >= R.HIGH_VOTES),
        "loaded_at": F.current_timestamp(),
    })


def filmography(people: DataFrame, credits: DataFrame, title_complete: DataFrame) -> DataFrame:
    """person x title x role with decade and quality tier.

    Reads rated titles from a stored ``title_complete``: then both sides of
    either join are plain shuffles, which AQE can split for a hot title or person.
    """
    titles = title_complete.where(F.col("start_year").isNotNull()).select(
        "tconst", "primary_title", "start_year", "title_type", "average_rating", "num_votes")
    rows = (
        credits.select("nconst", "tconst", F.col("role_category").alias("role")).join(titles, "tconst")
        .join(people.select("nconst", F.col("primary_name").alias("person_name")), "nconst")
    )
    return rows.select(
        "nconst", "person_name", "tconst", "primary_title", "role", "start_year", "title_type", "average_rating",
        "num_votes", R.WORK_DECADE.column().alias("work_decade"), R.WORK_QUALITY.column().alias("work_quality_tier"),
    )


def episode_rows(episodes: DataFrame, titles: DataFrame, ratings: DataFrame, as_of=None) -> DataFrame:
    """Episodes with their series and rating; titles enter once as series and once as episodes."""
    links = episodes.select(F.col("tconst").alias("episode_tconst"), F.col("parentTconst").alias("series_tconst"),
                            "season_number", "episode_number")
    linked = parent_child(
        titles, links, "title_type", "tvSeries", "tvEpisode",
        parent=[F.col("tconst").alias("series_tconst"), F.col("primary_title").alias("series_title"),
                F.col("start_year").alias("series_start_year"), F.col("end_year").alias("series_end_year")],
        child=[F.col("tconst").alias("episode_tconst"), F.col("primary_title").alias("episode_title"),
               F.col("start_year").alias("episode_year")],
        parent_key="series_tconst", child_key="episode_tconst")
    rated = ratings.select(F.col("tconst").alias("episode_tconst"), F.col("average_rating").alias("episode_rating"),
                           F.col("num_votes").alias("episode_votes"))
    years = span_years("series_start_year", "series_end_year", as_of_column(as_of)).cast("double")
    return linked.join(rated, "episode_tconst", "left").select(
        "episode_tconst", "series_tconst", "episode_title", "series_title", "season_number", "episode_number",
        "episode_year", "series_start_year", "series_end_year", "episode_rating", "episode_votes",
        years.alias("series_duration_years"))


def hierarchy(rows: DataFrame, stored: bool = True) -> DataFrame:
    """Episode rows (see ``episode_rows``) with their series' totals and classes.

    The rows are read twice, for the totals and for the detail: pass a stored
    table, not the joins.  The totals are stored too: small ones are broadcast,
    otherwise AQE can split a hot series.  With ``stored=False`` nothing is written before the result is read, as
    a view needs it.  An episode id is unique, so counting rows counts
    episodes and the season count is the only distinct aggregate (no row expansion).
    """
    totals = rows.where(F.col("episode_rating").isNotNull()).groupBy("series_tconst").agg(
        F.max("series_duration_years").alias("series_years"),
        F.count(F.lit(1)).alias("total_episodes"), F.count_distinct("season_number").alias("total_seasons"),
        exact_avg("episode_rating").alias("avg_series_rating"),
        F.stddev_samp(F.col("episode_rating").cast("double")).alias("rating_consistency"),
        F.max("episode_rating").alias("highest_episode_rating"), F.min("episode_rating").alias("lowest_episode_rating"),
        F.avg("episode_votes").alias("avg_episode_votes"), F.sum("episode_votes").alias("total_audience_engagement"),
        F.max("season_number").alias("latest_season"),
    ).withColumns({
        "avg_episodes_per_season": guarded_ratio(F.col("total_episodes"), F.col("total_seasons"), 1),
        "rating_spread": F.round("rating_consistency", 10),
    })
    totals = stage(totals, "series-totals") if stored else totals
    joined = rows.join(totals, "series_tconst", "left").withColumn(
        "rating_gap", F.col("episode_rating") - F.col("avg_series_rating"))
    return joined.select(
        *rows.columns, "total_episodes", "total_seasons",
        F.col("avg_series_rating").cast("double").alias("avg_series_rating"), "rating_consistency",
        "highest_episode_rating", "lowest_episode_rating", "avg_episode_votes", "total_audience_engagement",
        "avg_episodes_per_season",
        R.LONGEVITY_CLASS.column().alias("series_longevity_class"), R.SERIES_TIER.column().alias("series_performance_tier"),
        R.EPISODE_QUALITY.column().alias("episode_quality_class"), R.SEASON_POSITION.column().alias("season_position"),
        R.CONSISTENCY_CLASS.column().alias("series_consistency_class"),
        R.ENGAGEMENT.column().alias("audience_engagement_level"))
