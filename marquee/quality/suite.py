"""The checks declared for the fifteen tables."""

from __future__ import annotations

from ..plans import rulebook as R
from .runner import Check


def _not_null(table: str, *columns: str) -> list[Check]:
    return [Check(table, "not_null", {"column": c}) for c in columns]


def _unique(table: str, *columns: str) -> list[Check]:
    return [Check(table, "unique", {"column": c}) for c in columns]


def _values(table: str, column: str, values: list, severity: str = "error") -> Check:
    return Check(table, "accepted_values", {"column": column, "values": list(values)}, severity)


def _range(table: str, column: str, low, high) -> Check:
    return Check(table, "accepted_range", {"column": column, "min_value": low, "max_value": high}, "warn",
                 where=f"{column} is not null")


def _together(table: str, *columns: str) -> Check:
    return Check(table, "unique_combination", {"columns": list(columns)})


def _known(table: str, column: str, parent: str, field: str) -> Check:
    return Check(table, "relationships", {"column": column, "parent": parent, "field": field})


# Which column of which table is checked, against what.
STAGING = [
    *_not_null("stg_titles", "tconst", "title_type", "primary_title"), *_unique("stg_titles", "tconst"),
    _values("stg_titles", "title_type", R.TITLE_TYPES, "warn"),
    _range("stg_titles", "start_year", *R.TITLE_YEARS), _range("stg_titles", "runtime_minutes", *R.RUNTIME_MINUTES),
    *_unique("stg_ratings", "tconst"), *_not_null("stg_ratings", "tconst"),
    _range("stg_ratings", "average_rating", 1.0, 10.0), _range("stg_ratings", "num_votes", 1, 10_000_000),
    *_unique("stg_people", "nconst"), *_not_null("stg_people", "nconst", "primary_name"),
    _range("stg_people", "birth_year", 1800, 2025),
    *_not_null("stg_credits", "tconst", "ordering", "nconst", "category"),
    _values("stg_credits", "role_category", [*R.ROLE_GROUPS, R.OTHER_ROLE], "warn"),
    _together("stg_credits", "tconst", "ordering"),
    *_not_null("stg_directors", "tconst", "director_nconst"), _together("stg_directors", "tconst", "director_nconst"),
    *_not_null("stg_writers", "tconst", "writer_nconst"), _together("stg_writers", "tconst", "writer_nconst"),
    *_unique("stg_episodes", "tconst"), *_not_null("stg_episodes", "tconst", "parentTconst"),
    _range("stg_episodes", "season_number", 1, 300), _range("stg_episodes", "episode_number", 1, 5000),
]
INTERMEDIATE = [
    *_not_null("int_title_genres", "tconst", "genre", "genre_rank"), _together("int_title_genres", "tconst", "genre"),
    *_not_null("int_filmography", "nconst", "person_name", "tconst", "role"),
    _values("int_filmography", "work_decade", R.WORK_DECADE.labels),
    _values("int_filmography", "work_quality_tier", R.WORK_QUALITY.labels),
    _known("int_filmography", "nconst", "stg_people", "nconst"), _known("int_filmography", "tconst", "stg_titles", "tconst"),
    *_not_null("int_hierarchy", "episode_tconst", "series_tconst"), *_unique("int_hierarchy", "episode_tconst"),
    _values("int_hierarchy", "series_longevity_class", R.LONGEVITY_CLASS.labels),
    _values("int_hierarchy", "series_performance_tier", R.SERIES_TIER.labels),
    _values("int_hierarchy", "episode_quality_class", R.EPISODE_QUALITY.labels),
    _values("int_hierarchy", "season_position", R.SEASON_POSITION.labels),
    _values("int_hierarchy", "series_consistency_class", R.CONSISTENCY_CLASS.labels),
    _values("int_hierarchy", "audience_engagement_level", R.ENGAGEMENT.labels),
    _known("int_hierarchy", "episode_tconst", "stg_titles", "tconst"),
    *_not_null("int_title_complete", "tconst"), *_unique("int_title_complete", "tconst"),
    _values("int_title_complete", "decade", R.DECADE.labels),
    _values("int_title_complete", "quality_tier", R.QUALITY_TIER.labels),
    _values("int_title_complete", "popularity_tier", R.POPULARITY_TIER.labels),
    _values("int_title_complete", "runtime_category", R.RUNTIME_CATEGORY.labels),
]
MARTS = [check for table, key in (("mart_titles", "tconst"), ("mart_genres", "genre"), ("mart_people", "nconst"),
                                  ("mart_series", "series_tconst"))
         for check in (*_not_null(table, key), *_unique(table, key))]
ALL = STAGING + INTERMEDIATE + MARTS
