"""The four marts.  Rows are unordered; ``ordered`` applies the published order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import exact_avg, guarded_ratio
from ..operators.aggregates import with_shares
from ..operators.ranking import asc, desc, percent_rank, row_number, row_numbers
from ..session import stage
from . import rulebook as R
from .intermediate import GENRE_COLUMNS

MART_ORDER = {
    "mart_titles": ["weighted_score", "num_votes"],
    "mart_people": ["total_credits", "avg_project_rating"],
    "mart_genres": ["market_share", "avg_rating"],
    "mart_series": ["avg_series_rating", "total_episodes"],
}
MART_KEY = {"mart_titles": "tconst", "mart_people": "nconst", "mart_genres": "genre", "mart_series": "series_tconst"}


def ordered(name: str, df: DataFrame) -> DataFrame:
    """Published row order of a mart (descending, NULLs first)."""
    return df.orderBy(*[desc(c) for c in MART_ORDER[name]])


def positions(name: str, df: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """The published order as a column: ``position`` counts from 1, ties in the order of the mart's key."""
    order = [*[desc(c) for c in MART_ORDER[name]], asc(MART_KEY[name])]
    return row_number(stage(df, name), [], order, "position", hot_rows)


def weighted_score(rating: str = "average_rating", votes: str = "num_votes") -> Column:
    """Rating scaled by how many votes back it, as an exact decimal."""
    out = None
    for least, factor in R.CONFIDENCE:
        cond, value = F.col(votes) >= least, (F.col(rating) * F.lit(factor)).cast("decimal(6,3)")
        out = F.when(cond, value) if out is None else out.when(cond, value)
    return out.otherwise((F.col(rating) * F.lit(R.CONFIDENCE_FLOOR)).cast("decimal(6,3)"))


def title_mart(title_complete: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Percentiles, ranks and classes of every rated title with enough votes.

    The eligible rows are stored once; the percentiles then read one column
    each and all three ranks share one global sort (see ``row_numbers``).
    """
    base = stage(
        title_complete.where(F.col("average_rating").isNotNull() & (F.col("num_votes") >= R.MIN_RANKED_VOTES)).select(
            "tconst", "title_type", "primary_title", "start_year", "decade", "runtime_minutes", "primary_genre",
            "secondary_genre", "average_rating", "num_votes", weighted_score().alias("weighted_score"), "is_adult"),
        "ranked-titles")
    best_first = [desc("weighted_score"), desc("num_votes"), asc("tconst")]
    ranked = row_numbers(base, R.RANK_KEYS, best_first, hot_rows)
    ranked = percent_rank(ranked, "average_rating", "quality_percentile", hot_rows, counts_from=base)
    ranked = percent_rank(ranked, "num_votes", "popularity_percentile", hot_rows, counts_from=base)
    labelled = ranked.withColumns({
        "performance_tier": R.PERFORMANCE_TIER.column(), "popularity_segment": R.POPULARITY_SEGMENT.column(),
        "investment_category": R.INVESTMENT.column(), "discovery_category": R.DISCOVERY.column(),
        "longevity_indicator": R.LONGEVITY.column(),
    })
    return labelled.select(
        "tconst", "title_type", "primary_title", "start_year", "decade", "runtime_minutes", "primary_genre",
        "secondary_genre", "average_rating", "num_votes", "weighted_score", "quality_percentile",
        "popularity_percentile", *R.RANK_KEYS, "performance_tier", "popularity_segment", "investment_category",
        "discovery_category", "longevity_indicator", "is_adult",
        *[(F.col(rank) <= n).alias(flag) for flag, (rank, n) in R.TOP_FLAGS.items()],
        F.col("performance_tier").isin(R.PREMIUM_TIERS).alias("is_premium_content"))


_WORDS = range((R.TITLE_YEARS[1] - R.TITLE_YEARS[0]) // 64 + 1)


def year_words(year: str) -> list[Column]:
    """The distinct years of a group as bits: a few machine words that combine with OR before they are shuffled."""
    at = F.col(year) - F.lit(R.TITLE_YEARS[0])
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(at, F.lit(64)).cast("int"))
    return [F.bit_or(F.when(F.floor(at / 64) == w, bit)).alias(f"_years{w}") for w in _WORDS]


def years_in_words() -> Column:
    return reduce(lambda a, b: a + b, [F.bit_count(F.coalesce(F.col(f"_years{w}"), F.lit(0).cast("bigint"))) for w in _WORDS]).cast("bigint")


def people_mart(people: DataFrame, credits: DataFrame, title_complete: DataFrame) -> DataFrame:
    """Careers of persons with enough titles.

    Credits meet their title first (one shuffle on the title), shrink to one
    row per person and title in place, and only those partial careers travel to
    the person; names are joined last, to finished careers.  Ratings and votes
    weigh in once per credit row, titles count once.  Pass a stored
    ``title_complete``: AQE splits a hot title only between two plain shuffles.
    """
    titles = title_complete.where(F.col("start_year").isNotNull())
    rows = credits.select("nconst", "tconst", F.col("role_category").alias("role")).join(
        titles.select("tconst", "start_year", "average_rating", "num_votes"), "tconst")
    bit = {r: 1 << i for i, r in enumerate(R.CAREER_ROLES)}
    role_bits = F.lit(0)
    for r, b in bit.items():
        role_bits = F.when(F.col("role") == r, b).otherwise(role_bits)
    # the title's own columns depend on its id: as keys they need no aggregation buffer
    works = rows.groupBy("nconst", "tconst", "start_year", "average_rating", "num_votes").agg(
        F.count(F.lit(1)).alias("n"), F.bit_or(role_bits).alias("roles"))

    def within(column: str, low: int, high: int | None) -> Column:
        c = F.col(column)
        return (c >= low) if high is None else (c >= low) & (c < high)

    tenths = (F.col("average_rating") * 10).cast("bigint") * F.col("n")
    careers = works.groupBy("nconst").agg(
        F.min("start_year").alias("career_start_year"), F.max("start_year").alias("latest_work_year"),
        F.count(F.lit(1)).alias("total_credits"),
        *year_words("start_year"),
        *[F.count_if(F.col("roles").bitwiseAND(b) != 0).alias(f"{r}_credits") for r, b in bit.items()],
        F.sum(tenths).alias("_tenths"), F.sum(F.when(F.col("average_rating").isNotNull(), F.col("n"))).alias("_rated"),
        F.max("average_rating").alias("highest_rated_work"),
        F.sum(F.col("num_votes") * F.col("n")).alias("total_audience_reach"),
        *[F.count_if(within("start_year", *span)).alias(name) for name, span in R.COUNTED_ERAS.items()],
        *[F.count_if(within("average_rating", *span)).alias(name) for name, span in R.COUNTED_QUALITY.items()],
    ).where(F.col("total_credits") >= R.MIN_CAREER_CREDITS).withColumn("active_years", years_in_words())
    held = [F.when(F.col(f"{r}_credits") > 0, 1).otherwise(0) for r in R.CAREER_ROLES]
    named = careers.join(people.select("nconst", F.col("primary_name").alias("person_name")), "nconst").withColumns({
        "career_span_years": F.col("latest_work_year") - F.col("career_start_year"),
        "avg_credits_per_year": guarded_ratio(F.col("total_credits"), F.col("active_years"), 2),
        "avg_project_rating": F.col("_tenths").cast("decimal(18,0)") / (F.col("_rated") * 10).cast("decimal(18,0)"),
        "roles_held": held[0] + held[1] + held[2] + held[3],
    })
    labelled = named.withColumns({
        "career_stage": R.CAREER_STAGE.column(), "productivity_tier": R.PRODUCTIVITY.column(),
        "dominant_role": R.DOMINANT_ROLE.column(), "versatility_level": R.VERSATILITY.column(),
        "quality_reputation": R.REPUTATION.column(), "activity_pattern": R.ACTIVITY.column(),
    })
    return labelled.select(
        "nconst", "person_name", "career_start_year", "latest_work_year", "career_span_years", "total_credits",
        "active_years", "avg_credits_per_year", *[f"{r}_credits" for r in R.CAREER_ROLES],
        F.col("avg_project_rating").cast("double").alias("avg_project_rating"), "highest_rated_work",
        "total_audience_reach", "works_2020s", "works_2010s", "works_2000s", "works_1990s", "high_quality_works",
        "good_quality_works", "career_stage", "productivity_tier", "dominant_role", "versatility_level",
        "quality_reputation", "activity_pattern")


def genre_mart(title_complete: DataFrame) -> DataFrame:
    """Volume, quality, era mix and classes of each genre.

    A title row carries its genres, so it is exploded in place instead of being
    joined with its own genre rows; the only shuffle carries per-genre partials.
    """
    rating, votes, year = F.col("average_rating"), F.col("num_votes"), F.col("start_year")
    rows = title_complete.where(year >= R.GENRE_FIRST_YEAR).select(
        "title_type", "start_year", "average_rating", "num_votes",
        F.explode(F.array(*GENRE_COLUMNS)).alias("genre")).where(F.col("genre") != "")

    def era(first: int) -> Column:
        return year.between(first, first + 9)

    stats = rows.groupBy("genre").agg(
        F.count(F.lit(1)).alias("total_titles"),
        F.count_if(rating >= 7).alias("high_quality_titles"), F.count_if(votes >= 10000).alias("popular_titles"),
        exact_avg("average_rating").alias("avg_rating"),
        # at most one entry per rating value (0.0 .. 99.9) in the aggregation state
        F.percentile("average_rating", 0.5).alias("median_rating"),
        F.stddev_samp(rating.cast("double")).alias("rating_stddev"),
        F.sum("num_votes").alias("total_votes"), F.avg("num_votes").alias("avg_votes"),
        *[F.count_if(era(d)).alias(f"titles_{d}s") for d in R.COUNTED_DECADES],
        *[exact_avg(F.when(era(d), rating)).alias(f"avg_rating_{d}s") for d in R.RATED_DECADES],
        *[F.count_if(F.col("title_type") == t).alias(f"{n}_count")
          for t, n in (("movie", "movie"), ("tvSeries", "tv_series"), ("tvMovie", "tv_movie"))],
        F.count_if((rating >= 8) & (votes >= 50000)).alias("premium_titles"),
        F.count_if((rating >= 7.5) & (votes >= 100000)).alias("blockbuster_titles"),
    )
    market = with_shares(stats, {"market_share": "total_titles", "vote_share": "total_votes"})
    market = market.withColumn("rating_drift", F.col("avg_rating_2020s") - F.col("avg_rating_2010s")).withColumns({
        "production_trend": R.PRODUCTION_TREND.column(), "quality_trend": R.QUALITY_TREND.column(),
        "market_position": R.MARKET_POSITION.column(), "investment_priority": R.PRIORITY.column(),
        "content_strategy": R.STRATEGY.column(), "platform_fit": R.PLATFORM.column(),
    })

    def plain(c: str) -> Column:
        return F.col(c).cast("double").alias(c)

    return market.select(
        "genre", "total_titles", "market_share", "vote_share", plain("avg_rating"), plain("median_rating"),
        "rating_stddev", "total_votes", "avg_votes", "high_quality_titles", "popular_titles",
        *[f"titles_{d}s" for d in R.COUNTED_DECADES], *[plain(f"avg_rating_{d}s") for d in R.RATED_DECADES],
        "movie_count", "tv_series_count", "tv_movie_count", "premium_titles", "blockbuster_titles",
        "production_trend", "quality_trend", "market_position", "investment_priority", "content_strategy", "platform_fit",
        F.col("investment_priority").isin(R.INVESTMENT_TARGETS).alias("is_investment_target"),
        ((F.col("production_trend") == "Growing") & F.col("quality_trend").isin(R.GROWING_QUALITY))
        .alias("is_growth_opportunity"),
        F.col("market_position").isin(R.CORE_MARKET).alias("is_core_market"))


def series_mart(episode_rows: DataFrame) -> DataFrame:
    """Volume, quality and engagement of series with enough rated episodes."""
    rating = F.col("episode_rating")
    series = ["series_tconst", "series_title", "series_start_year", "series_end_year", "series_duration_years"]
    metrics = episode_rows.where(rating.isNotNull()).groupBy(*series).agg(
        F.count(F.lit(1)).alias("total_episodes"), F.count_distinct("season_number").alias("total_seasons"),
        exact_avg("episode_rating").alias("avg_series_rating"),
        F.stddev_samp(rating.cast("double")).alias("rating_consistency"),
        F.min(rating).alias("lowest_episode_rating"), F.max(rating).alias("highest_episode_rating"),
        F.avg("episode_votes").alias("avg_episode_votes"), F.sum("episode_votes").alias("total_series_votes"),
        F.max("season_number").alias("final_season"),
        F.count_if(rating >= F.lit(R.EXCELLENT_EPISODE).cast("decimal(3,1)")).alias("excellent_episodes"),
        F.count_if(rating <= F.lit(R.POOR_EPISODE).cast("decimal(3,1)")).alias("poor_episodes"),
    ).where(F.col("total_episodes") >= R.MIN_RATED_EPISODES).withColumns({
        "avg_episodes_per_season": guarded_ratio(F.col("total_episodes"), F.col("total_seasons"), 1),
        "rating_spread": F.round("rating_consistency", 10),
        "excellent_share": F.col("excellent_episodes") / F.col("total_episodes"),
        "poor_share": F.col("poor_episodes") / F.col("total_episodes"),
    }).withColumns({
        "longevity_class": R.MART_LONGEVITY.column(), "series_performance_tier": R.MART_SERIES_TIER.column(),
        "consistency_rating": R.MART_CONSISTENCY.column(), "quality_pattern": R.QUALITY_PATTERN.column(),
        "production_scale": R.PRODUCTION_SCALE.column(), "engagement_level": R.MART_ENGAGEMENT.column(),
    })
    return metrics.select(
        *series, "total_episodes", "total_seasons", "avg_episodes_per_season",
        F.col("avg_series_rating").cast("double").alias("avg_series_rating"), "rating_consistency",
        "lowest_episode_rating", "highest_episode_rating", "avg_episode_votes", "total_series_votes", "final_season",
        "excellent_episodes", "poor_episodes", "longevity_class", "series_performance_tier", "consistency_rating",
        "quality_pattern", "production_scale", "engagement_level",
        F.col("series_performance_tier").isin(R.PREMIUM_SERIES).alias("is_premium_series"),
        F.col("consistency_rating").isin(R.CONSISTENT_SERIES).alias("is_consistent_quality"),
        F.col("longevity_class").isin(R.LONG_SERIES).alias("is_long_running"))
