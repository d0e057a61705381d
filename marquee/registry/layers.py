"""The fifteen tables and the consumer queries over the derived catalogue."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from ..plans import consumers, intermediate as I, marts as M, rulebook as R, staging as S
from ..session import stage_once
from ..sources.catalogue import raw, sources_of
from .core import AS_OF, VIEWS, query, rounded
from .labels import LABELS

YEAR = AS_OF[:4]


def label(rules: str, alias: str) -> str:
    return f"{LABELS[rules]} AS {alias}"


def _list(values: list[str]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


# --- SQL of the layers ------------------------------------------------------------------

VIEWS["stg_titles"] = r"""
SELECT tconst, titleType AS title_type,
  CASE WHEN coalesce(primaryTitle, '') = '' THEN 'Unknown Title'
       WHEN primaryTitle LIKE 'Episode #%.%' THEN regexp_replace(primaryTitle, 'Episode #(\d+)\.(\d+)', 'S\1.E\2')
       ELSE primaryTitle END AS primary_title,
  nullif(originalTitle, '') AS original_title,
  CASE WHEN isAdult = '1' THEN true WHEN isAdult = '0' THEN false END AS is_adult,
  CASE WHEN startYear >= 1800 AND startYear <= 2030 THEN startYear END AS start_year,
  CASE WHEN endYear >= 1800 AND endYear <= 2030 THEN endYear END AS end_year,
  CASE WHEN runtimeMinutes >= 1 AND runtimeMinutes <= 2000 THEN runtimeMinutes END AS runtime_minutes,
  genres AS genres_raw, split_part(genres, ',', 1) AS primary_genre, split_part(genres, ',', 2) AS secondary_genre,
  split_part(genres, ',', 3) AS third_genre,
  coalesce(primaryTitle, '') = '' AS is_missing_title, genres IS NULL AS is_missing_genres
FROM raw_title_basics WHERE tconst <> ''"""
VIEWS["stg_people"] = f"""
SELECT nconst, CASE WHEN coalesce(primaryName, '') = '' THEN 'Unknown Person' ELSE primaryName END AS primary_name,
  CASE WHEN birthYear >= 1800 AND birthYear <= {YEAR} THEN birthYear END AS birth_year,
  CASE WHEN deathYear >= 1800 AND deathYear <= {YEAR} THEN deathYear END AS death_year,
  primaryProfession AS professions_raw, split_part(primaryProfession, ',', 1) AS first_profession,
  nullif(split_part(primaryProfession, ',', 2), '') AS second_profession,
  nullif(split_part(primaryProfession, ',', 3), '') AS third_profession,
  knownForTitles AS known_for_titles_raw, split_part(knownForTitles, ',', 1) AS first_title_known_for,
  nullif(split_part(knownForTitles, ',', 2), '') AS second_title_known_for,
  nullif(split_part(knownForTitles, ',', 3), '') AS third_title_known_for,
  nullif(split_part(knownForTitles, ',', 4), '') AS fourth_title_known_for,
  deathYear - birthYear AS death_age,
  CASE WHEN deathYear IS NULL THEN cast({YEAR} - birthYear AS double) END AS actual_age,
  deathYear IS NOT NULL AS is_deceased, coalesce(primaryName, '') = '' AS is_missing_name,
  primaryProfession IS NULL AS is_missing_professions
FROM raw_name_basics WHERE nconst <> ''"""
for _role in ("director", "writer"):
    VIEWS[f"stg_{_role}s"] = f"""
SELECT tconst, {_role}_nconst, false AS is_invalid_{_role},
  row_number() OVER (PARTITION BY tconst ORDER BY {_role}_nconst) AS {_role}_order
FROM (SELECT tconst, trim(unnest(string_split({_role}s, ','))) AS {_role}_nconst FROM raw_title_crew WHERE {_role}s <> '') p
WHERE {_role}_nconst <> ''"""
VIEWS["stg_episodes"] = """
SELECT tconst, parentTconst, seasonNumber AS season_number, episodeNumber AS episode_number,
  false AS is_missing_season, false AS is_missing_episode
FROM raw_title_episode WHERE tconst IS NOT NULL AND parentTconst IS NOT NULL"""
VIEWS["stg_ratings"] = """
SELECT tconst, averageRating AS average_rating, numVotes AS num_votes, false AS is_missing_rating,
  false AS is_missing_votes, coalesce(numVotes >= 1000, false) AS has_significant_votes
FROM raw_title_ratings WHERE tconst IS NOT NULL"""
VIEWS["stg_credits"] = """
SELECT tconst || '_' || nconst || '_' || cast(ordering AS varchar) AS composite_key, tconst, ordering, nconst,
  lower(trim(category)) AS category, job AS job_title, characters,
  CASE lower(category) WHEN 'actress' THEN 'actor' WHEN 'actor' THEN 'actor' WHEN 'director' THEN 'director'
    WHEN 'writer' THEN 'writer' WHEN 'producer' THEN 'producer' WHEN 'cinematographer' THEN 'cinematographer'
    WHEN 'composer' THEN 'composer' WHEN 'editor' THEN 'editor' WHEN 'self' THEN 'self' ELSE 'other' END AS role_category,
  coalesce(category, '') = '' AS is_missing_category, '2025-01-01' AS batch_date, 'run-1' AS airflow_run_id
FROM raw_title_principals WHERE tconst IS NOT NULL AND nconst IS NOT NULL AND ordering IS NOT NULL"""
VIEWS["int_title_genres"] = " UNION ALL ".join(
    f"SELECT tconst, {c} AS genre, {i} AS genre_rank FROM stg_titles WHERE {c} <> ''"
    for i, c in enumerate(I.GENRE_COLUMNS, 1))
VIEWS["int_title_complete"] = f"""
SELECT tconst, title_type, primary_title, original_title, is_adult, start_year, end_year, runtime_minutes,
  primary_genre, secondary_genre, third_genre, average_rating, num_votes,
  {label('decade', 'decade')}, {label('quality_tier', 'quality_tier')}, {label('popularity_tier', 'popularity_tier')},
  {label('runtime_category', 'runtime_category')},
  coalesce(primary_genre IN {_list(R.BLOCKBUSTER_GENRES)}, false) AS is_blockbuster_genre,
  average_rating IS NOT NULL AS has_ratings, coalesce(num_votes >= 500, false) AS has_reliable_votes,
  coalesce(num_votes >= 1000, false) AS has_high_votes
FROM stg_titles LEFT JOIN (SELECT tconst, average_rating, num_votes FROM stg_ratings) r USING (tconst)"""
VIEWS["int_filmography"] = f"""
SELECT nconst, primary_name AS person_name, tconst, primary_title, role_category AS role, start_year, title_type,
  average_rating, num_votes, {label('work_decade', 'work_decade')}, {label('work_quality', 'work_quality_tier')}
FROM stg_credits JOIN (SELECT nconst, primary_name FROM stg_people) p USING (nconst)
  JOIN (SELECT tconst, primary_title, start_year, title_type FROM stg_titles WHERE start_year IS NOT NULL) t USING (tconst)
  LEFT JOIN (SELECT tconst, average_rating, num_votes FROM stg_ratings) r USING (tconst)"""
VIEWS["episode_rows"] = f"""
SELECT e.tconst AS episode_tconst, e.parentTconst AS series_tconst, c.primary_title AS episode_title,
  s.primary_title AS series_title, season_number, episode_number, c.start_year AS episode_year,
  s.start_year AS series_start_year, s.end_year AS series_end_year, average_rating AS episode_rating,
  num_votes AS episode_votes, cast(coalesce(s.end_year, {YEAR}) - s.start_year + 1 AS double) AS series_duration_years
FROM stg_episodes e JOIN stg_titles s ON s.tconst = e.parentTconst AND s.title_type = 'tvSeries'
  JOIN stg_titles c ON c.tconst = e.tconst AND c.title_type = 'tvEpisode' LEFT JOIN stg_ratings r ON r.tconst = e.tconst"""
VIEWS["series_totals"] = """
SELECT series_tconst, max(series_duration_years) AS series_years, count(DISTINCT episode_tconst) AS total_episodes,
  count(DISTINCT season_number) AS total_seasons, round(avg(episode_rating), 9) AS avg_series_rating,
  stddev_samp(episode_rating) AS rating_consistency, round(stddev_samp(episode_rating), 10) AS rating_spread,
  max(episode_rating) AS highest_episode_rating, min(episode_rating) AS lowest_episode_rating,
  avg(episode_votes) AS avg_episode_votes, cast(sum(episode_votes) AS bigint) AS total_audience_engagement,
  round(count(DISTINCT episode_tconst) / greatest(count(DISTINCT season_number), 1), 1) AS avg_episodes_per_season,
  max(season_number) AS latest_season
FROM episode_rows WHERE episode_rating IS NOT NULL GROUP BY series_tconst"""
VIEWS["int_hierarchy"] = f"""
SELECT *, {label('longevity_class', 'series_longevity_class')}, {label('series_tier', 'series_performance_tier')},
  {label('episode_quality', 'episode_quality_class')}, {label('season_position', 'season_position')},
  {label('consistency_class', 'series_consistency_class')}, {label('engagement', 'audience_engagement_level')}
FROM (SELECT *, round(cast(episode_rating AS double) - avg_series_rating, 8) AS rating_gap
      FROM episode_rows LEFT JOIN series_totals USING (series_tconst)) x"""
VIEWS["scored_titles"] = """
SELECT *, cast(average_rating * CASE WHEN num_votes >= 100000 THEN 1.00 WHEN num_votes >= 10000 THEN 0.95
  WHEN num_votes >= 1000 THEN 0.90 ELSE 0.80 END AS decimal(6,3)) AS weighted_score
FROM int_title_complete WHERE average_rating IS NOT NULL AND num_votes >= 50"""
VIEWS["ranked_titles"] = """
SELECT *, percent_rank() OVER (ORDER BY num_votes) AS popularity_percentile,
  percent_rank() OVER (ORDER BY average_rating) AS quality_percentile,
  row_number() OVER (PARTITION BY title_type ORDER BY weighted_score DESC, num_votes DESC, tconst) AS type_rank,
  row_number() OVER (PARTITION BY primary_genre ORDER BY weighted_score DESC, num_votes DESC, tconst) AS genre_rank,
  row_number() OVER (PARTITION BY decade ORDER BY weighted_score DESC, num_votes DESC, tconst) AS decade_rank
FROM scored_titles"""
VIEWS["mart_titles"] = f"""
SELECT *, type_rank <= 100 AS is_top_100_in_type, genre_rank <= 50 AS is_top_50_in_genre,
  decade_rank <= 25 AS is_top_25_in_decade, performance_tier IN {_list(R.PREMIUM_TIERS)} AS is_premium_content
FROM (SELECT *, {label('performance_tier', 'performance_tier')}, {label('popularity_segment', 'popularity_segment')},
  {label('investment', 'investment_category')}, {label('discovery', 'discovery_category')},
  {label('longevity', 'longevity_indicator')} FROM ranked_titles) x"""


def _works(cond: str, alias: str) -> str:
    return f"count(DISTINCT CASE WHEN {cond} THEN tconst END) AS {alias}"


VIEWS["careers"] = f"""
SELECT nconst, person_name, min(start_year) AS career_start_year, max(start_year) AS latest_work_year,
  max(start_year) - min(start_year) AS career_span_years, count(DISTINCT tconst) AS total_credits,
  count(DISTINCT start_year) AS active_years,
  round(count(DISTINCT tconst) / greatest(count(DISTINCT start_year), 1), 2) AS avg_credits_per_year,
  {', '.join(_works(f"role = '{r}'", f'{r}_credits') for r in R.CAREER_ROLES)},
  round(avg(average_rating), 9) AS avg_project_rating, max(average_rating) AS highest_rated_work,
  cast(sum(num_votes) AS bigint) AS total_audience_reach,
  {', '.join(_works(f"work_decade = '{d}'", f'works_{d}') for d in ('2020s', '2010s', '2000s', '1990s'))},
  {_works("work_quality_tier = 'High Quality'", 'high_quality_works')},
  {_works("work_quality_tier = 'Good Quality'", 'good_quality_works')}
FROM int_filmography GROUP BY nconst, person_name HAVING count(DISTINCT tconst) >= 3"""
VIEWS["mart_people"] = f"""
SELECT * EXCLUDE (roles_held), {label('career_stage', 'career_stage')}, {label('productivity', 'productivity_tier')},
  {label('dominant_role', 'dominant_role')}, {label('versatility', 'versatility_level')},
  {label('reputation', 'quality_reputation')}, {label('activity', 'activity_pattern')}
FROM (SELECT *, {' + '.join(f'cast({r}_credits > 0 AS int)' for r in R.CAREER_ROLES)} AS roles_held FROM careers) x"""
VIEWS["genre_rows"] = """
SELECT genre, title_type, start_year, average_rating, num_votes
FROM int_title_genres JOIN int_title_complete USING (tconst) WHERE start_year >= 1950"""
VIEWS["genre_stats"] = f"""
SELECT genre, count(*) AS total_titles, count(*) FILTER (average_rating >= 7) AS high_quality_titles,
  count(*) FILTER (num_votes >= 10000) AS popular_titles, round(avg(average_rating), 9) AS avg_rating,
  quantile_cont(cast(average_rating AS double), 0.5) AS median_rating, stddev_samp(average_rating) AS rating_stddev,
  cast(sum(num_votes) AS bigint) AS total_votes, avg(num_votes) AS avg_votes,
  {', '.join(f'count(*) FILTER (start_year >= {d} AND start_year < {d + 10}) AS titles_{d}s' for d in R.COUNTED_DECADES)},
  {', '.join(f'round(avg(average_rating) FILTER (start_year >= {d} AND start_year < {d + 10}), 9) AS avg_rating_{d}s' for d in R.RATED_DECADES)},
  count(*) FILTER (title_type = 'movie') AS movie_count, count(*) FILTER (title_type = 'tvSeries') AS tv_series_count,
  count(*) FILTER (title_type = 'tvMovie') AS tv_movie_count,
  count(*) FILTER (average_rating >= 8 AND num_votes >= 50000) AS premium_titles,
  count(*) FILTER (average_rating >= 7.5 AND num_votes >= 100000) AS blockbuster_titles
FROM genre_rows GROUP BY genre"""
VIEWS["mart_genres"] = f"""
SELECT * EXCLUDE (rating_drift), investment_priority IN {_list(R.INVESTMENT_TARGETS)} AS is_investment_target,
  production_trend = 'Growing' AND quality_trend IN {_list(R.GROWING_QUALITY)} AS is_growth_opportunity,
  market_position IN {_list(R.CORE_MARKET)} AS is_core_market
FROM (SELECT *, {label('production_trend', 'production_trend')}, {label('quality_trend', 'quality_trend')},
  {label('market_position', 'market_position')}, {label('priority', 'investment_priority')},
  {label('strategy', 'content_strategy')}, {label('platform', 'platform_fit')}
  FROM (SELECT *, round(total_titles / (SELECT sum(total_titles) FROM genre_stats), 4) AS market_share,
          round(total_votes / (SELECT sum(total_votes) FROM genre_stats), 4) AS vote_share,
          round(avg_rating_2020s - avg_rating_2010s, 8) AS rating_drift FROM genre_stats) y) x"""
VIEWS["series_metrics"] = """
SELECT series_tconst, series_title, series_start_year, series_end_year, series_duration_years,
  count(DISTINCT episode_tconst) AS total_episodes, count(DISTINCT season_number) AS total_seasons,
  round(count(DISTINCT episode_tconst) / greatest(count(DISTINCT season_number), 1), 1) AS avg_episodes_per_season,
  round(avg(episode_rating), 9) AS avg_series_rating, stddev_samp(episode_rating) AS rating_consistency,
  round(stddev_samp(episode_rating), 10) AS rating_spread,
  min(episode_rating) AS lowest_episode_rating, max(episode_rating) AS highest_episode_rating,
  avg(episode_votes) AS avg_episode_votes, cast(sum(episode_votes) AS bigint) AS total_series_votes,
  max(season_number) AS final_season,
  count(DISTINCT CASE WHEN episode_rating >= 8 THEN episode_tconst END) AS excellent_episodes,
  count(DISTINCT CASE WHEN episode_rating <= 6 THEN episode_tconst END) AS poor_episodes
FROM episode_rows WHERE episode_rating IS NOT NULL
GROUP BY series_tconst, series_title, series_start_year, series_end_year, series_duration_years
HAVING count(DISTINCT episode_tconst) >= 6"""
VIEWS["mart_series"] = f"""
SELECT * EXCLUDE (rating_spread, excellent_share, poor_share),
  series_performance_tier IN {_list(R.PREMIUM_SERIES)} AS is_premium_series,
  consistency_rating IN {_list(R.CONSISTENT_SERIES)} AS is_consistent_quality,
  longevity_class IN {_list(R.LONG_SERIES)} AS is_long_running
FROM (SELECT *, {label('mart_longevity', 'longevity_class')}, {label('mart_series_tier', 'series_performance_tier')},
  {label('mart_consistency', 'consistency_rating')}, {label('quality_pattern', 'quality_pattern')},
  {label('production_scale', 'production_scale')}, {label('mart_engagement', 'engagement_level')}
  FROM (SELECT *, excellent_episodes / total_episodes AS excellent_share, poor_episodes / total_episodes AS poor_share
        FROM series_metrics) y) x"""

# --- Spark side -----------------------------------------------------------------------------


def stg(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """One staging table of the derived catalogue."""
    extract, build = {
        "stg_titles": ("title_basics", S.titles), "stg_people": ("name_basics", partial(S.people, as_of=AS_OF)),
        "stg_directors": ("title_crew", S.directors), "stg_writers": ("title_crew", S.writers),
        "stg_episodes": ("title_episode", S.episodes), "stg_ratings": ("title_ratings", S.ratings),
        "stg_credits": ("title_principals", partial(S.credits, batch_date="2025-01-01", run_id="run-1")),
    }[name]
    return build(raw(spark, sf, f"raw_{extract}"))


def join_ratings(spark, sf):
    return I.title_complete(stg(spark, sf, "stg_titles"), stg(spark, sf, "stg_ratings"))


def complete(spark, sf):
    """The join with ratings, stored once as ``plans.build`` does."""
    return stage_once(spark, (sf, sources_of(spark, sf), "title-complete"), lambda: join_ratings(spark, sf))


def episode_rows(spark, sf):
    sources = [stg(spark, sf, n) for n in ("stg_episodes", "stg_titles", "stg_ratings")]
    return stage_once(spark, (sf, sources_of(spark, sf), "episode-rows"), lambda: I.episode_rows(*sources, as_of=AS_OF))


def filmography(spark, sf):
    return I.filmography(stg(spark, sf, "stg_people"), stg(spark, sf, "stg_credits"), complete(spark, sf))


def title_mart(spark, sf, hot_rows=None):
    return M.title_mart(complete(spark, sf), hot_rows)


def people_mart(spark, sf):
    return M.people_mart(stg(spark, sf, "stg_people"), stg(spark, sf, "stg_credits"), complete(spark, sf))


def genre_mart(spark, sf):
    return M.genre_mart(complete(spark, sf))


def series_mart(spark, sf):
    return M.series_mart(episode_rows(spark, sf))


STAGING = ["stg_titles", "stg_people", "stg_directors", "stg_writers", "stg_episodes", "stg_ratings", "stg_credits"]
TABLES = {
    **{name: partial(lambda n, spark, sf: stg(spark, sf, n), name) for name in STAGING},
    "int_title_genres": lambda spark, sf: I.title_genres(stg(spark, sf, "stg_titles")),
    "int_title_complete": join_ratings, "int_filmography": filmography,
    "int_hierarchy": lambda spark, sf: I.hierarchy(episode_rows(spark, sf)),
    "mart_titles": title_mart, "mart_people": people_mart, "mart_genres": genre_mart, "mart_series": series_mart,
}

# columns the SQL must round or leave out to be comparable
_ROUND = {
    "stg_ratings": ["average_rating"], "int_title_complete": ["average_rating"], "int_filmography": ["average_rating"],
    "int_hierarchy": ["episode_rating", "avg_series_rating", "rating_consistency", "highest_episode_rating",
                      "lowest_episode_rating", "avg_episode_votes", "avg_episodes_per_season"],
    "mart_titles": ["average_rating", "weighted_score", "popularity_percentile", "quality_percentile"],
    "mart_people": ["avg_project_rating", "highest_rated_work", "avg_credits_per_year"],
    "mart_genres": ["avg_rating", "median_rating", "rating_stddev", "avg_votes", "market_share", "vote_share",
                    *[f"avg_rating_{d}s" for d in R.RATED_DECADES]],
    "mart_series": ["avg_series_rating", "rating_consistency", "lowest_episode_rating", "highest_episode_rating",
                    "avg_episode_votes", "avg_episodes_per_season"],
}
_DROP = {
    "int_hierarchy": ["series_years", "rating_spread", "rating_gap", "latest_season"],
    "mart_titles": ["original_title", "end_year", "third_genre", "quality_tier", "popularity_tier", "runtime_category",
                    "is_blockbuster_genre", "has_ratings", "has_reliable_votes", "has_high_votes"],
}


def _final_sql(name: str) -> str:
    drop = f" EXCLUDE ({', '.join(_DROP[name])})" if name in _DROP else ""
    changes = ", ".join(f"round(cast({c} AS double), 6) AS {c}" for c in _ROUND.get(name, []))
    replace = f" REPLACE ({changes})" if changes else ""
    return f"SELECT *{drop}{replace} FROM {name}"


for _name, _build in TABLES.items():
    query(_name, _final_sql(_name))(partial(lambda build, spark, sf: rounded(build(spark, sf)), _build))


@query("mart_titles_sliced", _final_sql("mart_titles"))
def mart_titles_sliced(spark, sf):
    """The title mart on its route for groups too large for one task."""
    return rounded(title_mart(spark, sf, hot_rows=0))


@query("consumer_top_movies", """
SELECT primary_title, cast(average_rating AS double) AS average_rating, num_votes,
  cast(weighted_score AS double) AS weighted_score, performance_tier
FROM mart_titles WHERE title_type = 'movie' AND num_votes >= 10000
ORDER BY mart_titles.weighted_score DESC, num_votes DESC, tconst LIMIT 10""")
def consumer_top_movies(spark, sf):
    return rounded(consumers.top_movies(title_mart(spark, sf)))


@query("consumer_versatile", """
SELECT person_name, total_credits, career_span_years, round(avg_project_rating, 6) AS avg_project_rating, dominant_role,
  versatility_level, quality_reputation
FROM mart_people WHERE versatility_level = 'Multi-Talented' AND avg_project_rating >= 7.0""")
def consumer_versatile(spark, sf):
    return rounded(consumers.versatile_people(people_mart(spark, sf)))


@query("consumer_genres", """
SELECT genre, market_share, production_trend, quality_trend, investment_priority, content_strategy
FROM mart_genres WHERE investment_priority IN ('High Priority', 'Medium Priority', 'Emerging Opportunity')""")
def consumer_genres(spark, sf):
    return rounded(consumers.genre_investments(genre_mart(spark, sf)))


@query("consumer_series", """
SELECT series_title, total_episodes, total_seasons, round(avg_series_rating, 6) AS avg_series_rating, consistency_rating,
  series_performance_tier, engagement_level
FROM mart_series WHERE series_performance_tier IN ('Premium Franchise', 'Quality Series')
  AND consistency_rating IN ('Very Consistent', 'Consistent')""")
def consumer_series(spark, sf):
    return rounded(consumers.premium_series(series_mart(spark, sf)))


# the published order made visible; rows that it leaves tied are in the order of their key
for _name, (_keys, _tie) in {name: (M.MART_ORDER[name], M.MART_KEY[name]) for name in M.MART_ORDER}.items():
    _sql = f"""SELECT {_tie}, row_number() OVER (ORDER BY {", ".join(f"{_name}.{c} DESC NULLS FIRST" for c in _keys)}, {_tie}) AS position FROM {_name}"""
    query(f"{_name}_published_order", _sql)(
        partial(lambda name, spark, sf: M.positions(name, TABLES[name](spark, sf)).select(M.MART_KEY[name], "position"), _name))
