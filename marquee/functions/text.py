"""Text, key and URL functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The markers published extracts and existing keys use.
NULL_MARKER = r"\N"
MISSING_ORDINAL = "__MISSING__"
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def marker_to_null(c: str | Column, marker: str = NULL_MARKER) -> Column:
    return F.nullif(col(c), F.lit(marker))


def empty_to_null(c: str | Column) -> Column:
    return F.nullif(col(c), F.lit(""))


def default_text(c: str | Column, default: str) -> Column:
    """The text, or ``default`` where it is NULL or empty."""
    return F.coalesce(empty_to_null(c), F.lit(default))


def is_blank(c: str | Column) -> Column:
    """TRUE for NULL or empty text; never NULL."""
    return F.coalesce(col(c) == "", F.lit(True))


def has_key(c: str | Column) -> Column:
    """Row filter: the key is neither NULL nor empty (sargable, reaches the scan)."""
    return col(c).isNotNull() & (col(c) != "")


def part(c: str | Column, n: int, delimiter: str = ",") -> Column:
    """n-th piece of a delimited text; '' beyond the last piece, NULL for NULL."""
    return F.split_part(col(c), F.lit(delimiter), F.lit(n))


def episode_title(c: str | Column) -> Column:
    """First "Episode #<season>.<number>" of a matching title becomes "S<season>.E<number>"."""
    c = col(c)
    # replace-first: the lazy head anchors the match to the first occurrence
    rewritten = F.regexp_replace(c, r"(?s)^(.*?)Episode #(\d+)\.(\d+)", "$1S$2.E$3")
    return F.when(c.like("Episode #%.%"), rewritten).otherwise(c)


def composite_key(*parts: str | Column, sep: str = "_") -> Column:
    """Concatenation that is NULL as soon as one part is NULL."""
    cols = [col(p).cast("string") for p in parts]
    joined = [cols[0]]
    for c in cols[1:]:
        joined += [F.lit(sep), c]
    return F.concat(*joined)


def surrogate_key(*fields: str | Column, nulls_as_empty: bool = False) -> Column:
    """MD5 of the '-'-joined texts; NULL counts as a sentinel, or as '' on request."""
    missing = F.lit("" if nulls_as_empty else SURROGATE_NULL)
    return F.md5(F.concat_ws("-", *[F.coalesce(col(f).cast("string"), missing) for f in fields]))


def slug(c: str | Column) -> Column:
    """Lower case, runs of blanks/dashes to '_', other signs dropped, no leading digit."""
    s = F.lower(F.coalesce(col(c), F.lit("")))
    s = F.regexp_replace(s, "[ -]+", "_")
    s = F.regexp_replace(s, "[^a-z0-9_]+", "")
    return F.when(s.rlike("^[0-9]"), F.concat(F.lit("_"), s)).otherwise(s)


def _without(c: Column, *prefixes: str) -> Column:
    for p in prefixes:
        c = F.replace(c, F.lit(p), F.lit(""))
    return c


def url_host(c: str | Column) -> Column:
    bare = _without(col(c), "android-app://", "http://", "https://")
    return part(part(bare, 1, "/"), 1, "?")


def url_path(c: str | Column) -> Column:
    """Text after the first '/' of the scheme-less URL and before '?'."""
    bare = _without(col(c), "http://", "https://")
    start = F.coalesce(F.nullif(F.instr(bare, "/"), F.lit(0)), F.instr(bare, "?") - 1)
    return part(F.right(bare, F.length(bare) - start), 1, "?")


def url_parameter(c: str | Column, name: str) -> Column:
    """Value after the first ``name=`` (plain text search), NULL when absent or empty."""
    return F.nullif(part(part(c, 2, f"{name}="), 1, "&"), F.lit(""))


def flag_01(c: str | Column) -> Column:
    """'0' -> FALSE, '1' -> TRUE, anything else -> NULL."""
    return F.when(col(c) == "0", F.lit(False)).when(col(c) == "1", F.lit(True))


def true_only(cond: Column) -> Column:
    """A condition as a flag: NULL counts as FALSE."""
    return F.coalesce(cond, F.lit(False))


def mapped(c: str | Column, groups: dict[str, list[str]], default: str) -> Column:
    """Case-insensitive consolidation of labels into groups: one lookup in a constant map."""
    lookup = F.create_map(*[F.lit(x) for label, members in groups.items() for m in members for x in (m, label)])
    return F.coalesce(F.try_element_at(lookup, F.lower(col(c))), F.lit(default))
