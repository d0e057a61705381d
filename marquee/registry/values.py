"""Scalar functions, reshaping and generators over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import numeric as N
from ..functions import text as X
from ..functions.ladder import steps
from ..operators import generators as G
from ..operators import reshape as P
from ..operators.aggregates import column_values
from ..operators.columns import blanks_to_null, with_audit
from ..plans import rulebook as R
from ..plans.marts import weighted_score
from ..plans.staging import credit_key
from ..sources.catalogue import raw
from .core import query, rounded, table

# --- text, keys, URLs -------------------------------------------------------------------------


@query("surrogate_key", """
SELECT tconst, md5(coalesce(tconst, '_dbt_utils_surrogate_key_null_') || '-' || coalesce(genres, '_dbt_utils_surrogate_key_null_')
  || '-' || coalesce(cast(startYear AS varchar), '_dbt_utils_surrogate_key_null_')) AS key,
  md5(coalesce(genres, '')) AS blank_key FROM raw_title_basics""")
def surrogate_key(spark, sf):
    return raw(spark, sf, "raw_title_basics").select(
        "tconst", X.surrogate_key("tconst", "genres", "startYear").alias("key"),
        X.surrogate_key("genres", nulls_as_empty=True).alias("blank_key"))


@query("url_host", """
SELECT page_id, split_part(split_part(replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', ''), '/', 1), '?', 1) AS host
FROM pages""")
def url_host(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.url_host("url").alias("host"))


@query("url_path", r"""
SELECT page_id, split_part(CASE WHEN strpos(u, '/') > 0 THEN substr(u, strpos(u, '/') + 1) WHEN strpos(u, '?') > 0
  THEN substr(u, strpos(u, '?')) ELSE right(u, length(u) + 1) END, '?', 1) AS path
FROM (SELECT page_id, replace(replace(url, 'http://', ''), 'https://', '') AS u FROM pages) x""")
def url_path(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.url_path("url").alias("path"))


@query("url_param", """
SELECT page_id, nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page,
  nullif(split_part(split_part(url, 'ref=', 2), '&', 1), '') AS ref FROM pages""")
def url_param(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.url_parameter("url", "page").alias("page"), X.url_parameter("url", "ref").alias("ref"))


@query("slug", """
SELECT p_partkey, CASE WHEN regexp_matches(s, '^[0-9]') THEN '_' || s ELSE s END AS slug FROM (
  SELECT p_partkey, regexp_replace(regexp_replace(lower(p_size || ' ' || p_name || ' ' || p_type), '[ -]+', '_', 'g'), '[^a-z0-9_]+', '', 'g') AS s
  FROM part) x""")
def slug(spark, sf):
    text = F.concat_ws(" ", F.col("p_size").cast("string"), "p_name", "p_type")
    return table(spark, sf, "part").select("p_partkey", X.slug(text).alias("slug"))


@query("slug_text", """
SELECT doc_id, CASE WHEN regexp_matches(s, '^[0-9]') THEN '_' || s ELSE s END AS slug FROM (
  SELECT doc_id, regexp_replace(regexp_replace(lower(text), '[ -]+', '_', 'g'), '[^a-z0-9_]+', '', 'g') AS s FROM documents) x""")
def slug_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.slug("text").alias("slug"))


@query("episode_rewrite", r"""
SELECT tconst, CASE WHEN primaryTitle LIKE 'Episode #%.%' THEN regexp_replace(primaryTitle, 'Episode #(\d+)\.(\d+)', 'S\1.E\2')
  ELSE primaryTitle END AS title FROM raw_title_basics""")
def episode_rewrite(spark, sf):
    return raw(spark, sf, "raw_title_basics").select("tconst", X.episode_title("primaryTitle").alias("title"))


@query("composite_key", """
SELECT tconst || '_' || nconst || '_' || coalesce(cast(ordering AS varchar), '__MISSING__') AS composite_key,
  tconst || '_' || job AS nullable_key FROM raw_title_principals""")
def composite_key(spark, sf):
    return raw(spark, sf, "raw_title_principals").select(credit_key().alias("composite_key"), X.composite_key("tconst", "job").alias("nullable_key"))


@query("null_marker", """
SELECT tconst, nullif(coalesce(genres, '\\N'), '\\N') AS genres, nullif(primaryTitle, '') AS title FROM raw_title_basics""")
def null_marker(spark, sf):
    marked = F.coalesce("genres", F.lit(X.NULL_MARKER))
    return raw(spark, sf, "raw_title_basics").select("tconst", X.marker_to_null(marked).alias("genres"), X.empty_to_null("primaryTitle").alias("title"))


@query("default_text", """
SELECT nconst, CASE WHEN primaryName = '' OR primaryName IS NULL THEN 'Unknown Person' ELSE primaryName END AS name FROM raw_name_basics""")
def default_text(spark, sf):
    return raw(spark, sf, "raw_name_basics").select("nconst", X.default_text("primaryName", R.UNKNOWN_PERSON).alias("name"))


@query("flag_decode", """
SELECT tconst, CASE isAdult WHEN '0' THEN false WHEN '1' THEN true END AS is_adult FROM raw_title_basics""")
def flag_decode(spark, sf):
    return raw(spark, sf, "raw_title_basics").select("tconst", X.flag_01("isAdult").alias("is_adult"))


@query("role_map", """
SELECT role, count(*) AS n FROM (SELECT CASE WHEN lower(category) IN ('actor', 'actress') THEN 'actor'
  WHEN lower(category) IN ('director', 'writer', 'producer', 'cinematographer', 'composer', 'editor', 'self') THEN lower(category)
  ELSE 'other' END AS role FROM raw_title_principals) x GROUP BY role""")
def role_map(spark, sf):
    role = X.mapped("category", R.ROLE_GROUPS, R.OTHER_ROLE)
    return raw(spark, sf, "raw_title_principals").groupBy(role.alias("role")).agg(F.count(F.lit(1)).alias("n"))


@query("key_filter", """
SELECT tconst, split_part(genres, ',', 1) AS first_genre FROM raw_title_basics WHERE primaryTitle IS NOT NULL AND primaryTitle <> ''""")
def key_filter(spark, sf):
    return raw(spark, sf, "raw_title_basics").where(X.has_key("primaryTitle")).select("tconst", X.part("genres", 1).alias("first_genre"))


@query("quality_flags", """
SELECT tconst, coalesce(primaryTitle, '') = '' AS is_missing_title, genres IS NULL AS is_missing_genres FROM raw_title_basics""")
def quality_flags(spark, sf):
    return raw(spark, sf, "raw_title_basics").select("tconst", X.is_blank("primaryTitle").alias("is_missing_title"), F.col("genres").isNull().alias("is_missing_genres"))


@query("membership_flags", """
SELECT o_orderkey, o_orderstatus IN ('F', 'O') AS is_settled, o_totalprice >= 100000 AS is_large FROM orders""")
def membership_flags(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", X.true_only(F.col("o_orderstatus").isin("F", "O")).alias("is_settled"),
                                             X.true_only(F.col("o_totalprice") >= 100000).alias("is_large"))


@query("predicates", """
SELECT p_partkey, p_name FROM part WHERE p_size BETWEEN 5 AND 40 AND p_name ILIKE '%A%' AND NOT p_type LIKE '%Z%' AND p_brand NOT IN ('Brand#11')""")
def predicates(spark, sf):
    return table(spark, sf, "part").where(
        F.col("p_size").between(5, 40) & F.col("p_name").ilike("%A%") & ~F.col("p_type").like("%Z%") & ~F.col("p_brand").isin("Brand#11")
    ).select("p_partkey", "p_name")


@query("nullcheck", """
SELECT tconst, nullif(directors, '') AS directors, nullif(writers, '') AS writers FROM raw_title_crew""")
def nullcheck(spark, sf):
    return blanks_to_null(raw(spark, sf, "raw_title_crew"))


@query("text_cleanup", """
SELECT doc_id, lower(trim(source)) AS source, length(trim(text)) AS trimmed_length, coalesce(nullif(lang, ''), 'unknown') AS lang FROM documents""")
def text_cleanup(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.lower(F.trim("source")).alias("source"), F.length(F.trim("text")).cast("bigint").alias("trimmed_length"),
        X.default_text("lang", "unknown").alias("lang"))


@query("casts", """
SELECT p_partkey, cast(p_size AS varchar) AS size_text, cast(p_retailprice AS decimal(18,2))::double AS price,
  try_cast(p_brand AS integer) AS no_number, CASE WHEN p_size > 25 THEN 'true' ELSE 'false' END AS big, greatest(p_size, 10) AS at_least_10,
  least(p_size, 10) AS at_most_10 FROM part""")
def casts(spark, sf):
    size = F.col("p_size")
    return rounded(table(spark, sf, "part").select(
        "p_partkey", size.cast("string").alias("size_text"), F.col("p_retailprice").cast("decimal(18,2)").alias("price"),
        F.col("p_brand").try_cast("int").alias("no_number"), (size > 25).cast("string").alias("big"),
        F.greatest(size, F.lit(10)).alias("at_least_10"), F.least(size, F.lit(10)).alias("at_most_10")))


@query("audit_columns", "SELECT o_orderkey, '2025-01-01' AS batch_date, 'run-7' AS run_id, true AS is_loaded FROM orders")
def audit_columns(spark, sf):
    rows = with_audit(table(spark, sf, "orders").select("o_orderkey"), "2025-01-01", "run-7")
    return rows.withColumn("is_loaded", F.col("loaded_at").isNotNull()).drop("loaded_at")


# --- numbers and dates -------------------------------------------------------------------------------


@query("safe_add", """
SELECT nconst, coalesce(birthYear, 0) + coalesce(deathYear, 0) + 1 AS total FROM raw_name_basics""")
def safe_add(spark, sf):
    return raw(spark, sf, "raw_name_basics").select("nconst", N.safe_add("birthYear", "deathYear", F.lit(1)).alias("total"))


@query("safe_subtract", """
SELECT nconst, coalesce(deathYear, 0) - coalesce(birthYear, 0) AS years FROM raw_name_basics""")
def safe_subtract(spark, sf):
    return raw(spark, sf, "raw_name_basics").select("nconst", N.safe_subtract("deathYear", "birthYear").alias("years"))


@query("safe_divide", """
SELECT tconst, round(endYear / nullif(runtimeMinutes, 0), 6) AS ratio,
  round((startYear * endYear) / nullif(runtimeMinutes - 7, 0), 6) AS of_expressions FROM raw_title_basics""")
def safe_divide(spark, sf):
    ratio = N.safe_divide("endYear", "runtimeMinutes")
    expressions = N.safe_divide(F.col("startYear") * F.col("endYear"), F.col("runtimeMinutes") - 7)
    return rounded(raw(spark, sf, "raw_title_basics").select("tconst", ratio.alias("ratio"), expressions.alias("of_expressions")))


@query("width_bucket", """
SELECT o_orderkey, cast(CASE WHEN o_totalprice < 50000 THEN 0 WHEN o_totalprice >= 250000 THEN 9
  ELSE floor(8 * (o_totalprice - 50000) / 200000) + 1 END AS bigint) AS bucket FROM orders""")
def width_bucket(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", N.width_bucket("o_totalprice", 50000, 250000, 8).alias("bucket"))


@query("haversine", """
SELECT o_orderkey, round(d, 3) AS miles, round(d * 1.60934, 3) AS kilometres FROM (
  SELECT o_orderkey, 2 * 3961 * asin(sqrt(pow(sin(radians((b1 - a1) / 2)), 2)
    + cos(radians(a1)) * cos(radians(b1)) * pow(sin(radians((b2 - a2) / 2)), 2))) AS d
  FROM (SELECT o_orderkey, o_orderkey % 160 - 80.0 AS a1, o_orderkey % 350 - 175.0 AS a2, o_custkey % 160 - 80.0 AS b1,
    o_custkey % 350 - 175.0 AS b2 FROM orders) x) y""")
def haversine(spark, sf):
    def at(c: str, n: int):
        return (F.col(c) % n - n / 2).cast("double")
    points = [at("o_orderkey", 160), at("o_orderkey", 350), at("o_custkey", 160), at("o_custkey", 350)]
    return rounded(table(spark, sf, "orders").select(
        "o_orderkey", N.haversine(*points).alias("miles"), N.haversine(*points, unit="km").alias("kilometres")), 3)


@query("bounded_int", """
SELECT nconst, CASE WHEN birthYear BETWEEN 1800 AND 1900 THEN birthYear END AS birth_year FROM raw_name_basics""")
def bounded_int(spark, sf):
    return raw(spark, sf, "raw_name_basics").select("nconst", N.bounded_int(F.col("birthYear").cast("string"), 1800, 1900).alias("birth_year"))


@query("life_span", """
SELECT nconst, deathYear - birthYear AS death_age, CASE WHEN deathYear IS NULL THEN 2025 - birthYear END AS age,
  coalesce(deathYear, 2025) - birthYear + 1 AS span_years FROM raw_name_basics""")
def life_span(spark, sf):
    today = D.as_of_column("2025-01-01")
    born, died = F.col("birthYear"), F.col("deathYear")
    return raw(spark, sf, "raw_name_basics").select(
        "nconst", (died - born).alias("death_age"), F.when(died.isNull(), F.year(today) - born).alias("age"),
        D.span_years(born, died, today).alias("span_years"))


@query("weighted_score", """
SELECT tconst, round(cast(averageRating * CASE WHEN numVotes >= 100000 THEN 1.00 WHEN numVotes >= 10000 THEN 0.95
  WHEN numVotes >= 1000 THEN 0.90 ELSE 0.80 END AS double), 6) AS weighted_score FROM raw_title_ratings""")
def weighted(spark, sf):
    return rounded(raw(spark, sf, "raw_title_ratings").select("tconst", weighted_score("averageRating", "numVotes").alias("weighted_score")))


PRICE_LADDER = steps("o_totalprice", ">=", [(300000, "huge"), (200000, "large"), (100000, "medium")], "small")


@query("ladder", f"SELECT o_orderkey, {PRICE_LADDER.sql()} AS size_class FROM orders")
def ladder(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", PRICE_LADDER.column().alias("size_class"))


@query("rounding", """
SELECT l_orderkey, l_partkey, l_suppkey, round(cast(l_extendedprice AS decimal(18,2)) , 1)::double AS tenth,
  cast(ceil(l_quantity) AS bigint) AS up, abs(l_linenumber - 4) AS distance, l_linenumber % 3 AS rest FROM lineitem""")
def rounding(spark, sf):
    line = F.col("l_linenumber")
    return rounded(table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", F.round(F.col("l_extendedprice").cast("decimal(18,2)"), 1).alias("tenth"),
        F.ceil("l_quantity").alias("up"), F.abs(line - 4).alias("distance"), F.pmod(line, F.lit(3)).alias("rest")))


@query("date_parts", """
SELECT o_orderkey, date_trunc('month', o_orderdate)::timestamp AS month, o_orderdate + INTERVAL 3 MONTH AS in_three_months,
  o_orderdate + INTERVAL 10 DAY AS in_ten_days, o_orderdate - INTERVAL 5 HOUR AS five_hours_before,
  date_diff('month', o_orderdate, TIMESTAMP '2000-03-31') AS months, date_diff('year', o_orderdate, TIMESTAMP '2000-03-31') AS years,
  date_diff('day', o_orderdate, TIMESTAMP '2000-03-31') AS days, date_diff('quarter', o_orderdate, TIMESTAMP '2000-03-31') AS quarters,
  cast(floor((DATE '2000-03-31' - DATE '1970-01-04') / 7) - floor((o_orderdate::date - DATE '1970-01-04') / 7) AS bigint) AS weeks
FROM orders""")
def date_parts(spark, sf):
    d, end = F.col("o_orderdate"), F.lit("2000-03-31")

    def moved(part, n):
        return D.date_add(part, n, d).cast("timestamp_ntz")
    return table(spark, sf, "orders").select(
        "o_orderkey", D.date_trunc("month", d).cast("timestamp_ntz").alias("month"), moved("month", 3).alias("in_three_months"),
        moved("day", 10).alias("in_ten_days"), moved("hour", -5).alias("five_hours_before"),
        *[D.date_diff(p, d, end).alias(f"{p}s") for p in ("month", "year", "day", "quarter", "week")])


# --- reshape -----------------------------------------------------------------------------------------


@query("pivot_event_types", """
SELECT user_id, cast(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS bigint) AS click,
  cast(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS bigint) AS error,
  cast(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS bigint) AS purchase,
  cast(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS bigint) AS signup,
  cast(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS bigint) AS view
FROM events GROUP BY user_id""")
def pivot_event_types(spark, sf):
    """Column names come from the data (a short list, checked)."""
    events = table(spark, sf, "events")
    return P.pivot(events, ["user_id"], "event_type", column_values(events, "event_type", at_most=100))


@query("pivot_distinct", """
SELECT event_type, count(DISTINCT CASE WHEN value >= 10 THEN user_id END) AS from_10,
  count(DISTINCT CASE WHEN value >= 50 THEN user_id END) AS from_50 FROM events GROUP BY event_type""")
def pivot_distinct(spark, sf):
    return P.pivot(table(spark, sf, "events"), ["event_type"], "value", [10, 50], agg="count", cmp=">=", prefix="from_",
                   then_value=F.col("user_id"), else_value=None, distinct=True)


@query("pivot_distinct_default", """
SELECT event_type, count(DISTINCT CASE WHEN user_id % 3 = 0 THEN value ELSE 10 END) AS u0,
  count(DISTINCT CASE WHEN user_id % 3 = 1 THEN value ELSE 10 END) AS u1 FROM events GROUP BY event_type""")
def pivot_distinct_default(spark, sf):
    """An else value is one more distinct value, unless a matching row has it."""
    events = table(spark, sf, "events").withColumn("third", F.col("user_id") % 3)
    return P.pivot(events, ["event_type"], "third", [0, 1], agg="count", prefix="u", then_value=F.col("value"), else_value=10, distinct=True)


@query("pivot_prefix", """
SELECT o_orderpriority, round(sum(CASE WHEN o_orderstatus = 'F' THEN cast(o_totalprice AS decimal(18,2)) ELSE 0 END)::double, 2) AS status_f_total,
  round(sum(CASE WHEN o_orderstatus = 'O' THEN cast(o_totalprice AS decimal(18,2)) ELSE 0 END)::double, 2) AS status_o_total
FROM orders GROUP BY o_orderpriority""")
def pivot_prefix(spark, sf):
    price = F.col("o_totalprice").cast("decimal(18,2)")
    return rounded(P.pivot(table(spark, sf, "orders"), ["o_orderpriority"], "o_orderstatus", ["F", "O"], prefix="status ",
                           suffix="-total", then_value=price, else_value=0, slugify=True))


@query("unpivot_part", """
SELECT p_partkey, 'p_name' AS field_name, p_name AS value FROM part UNION ALL SELECT p_partkey, 'p_brand', p_brand FROM part
UNION ALL SELECT p_partkey, 'p_type', p_type FROM part UNION ALL SELECT p_partkey, 'p_size', cast(p_size AS varchar) FROM part""")
def unpivot_part(spark, sf):
    return P.unpivot(table(spark, sf, "part"), keep=["p_partkey"], remove=["P_RETAILPRICE"])


@query("unpivot_bool", """
SELECT tconst, 'is_adult' AS prop, CASE isAdult WHEN '1' THEN 'true' WHEN '0' THEN 'false' END AS val FROM raw_title_basics
UNION ALL SELECT tconst, 'startYear', cast(startYear AS varchar) FROM raw_title_basics""")
def unpivot_bool(spark, sf):
    rows = raw(spark, sf, "raw_title_basics").select("tconst", X.flag_01("isAdult").alias("is_adult"), "startYear")
    return P.unpivot(rows, keep=["tconst"], field_name="prop", value_name="val")


@query("split_rows", """
SELECT p_partkey, trim(unnest(string_split(p_name, ' '))) AS word FROM part""")
def split_rows(spark, sf):
    return P.split_rows(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", "word", " ", drop=[])


@query("split_words", """
SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) x WHERE trim(word) <> ''
GROUP BY word""")
def split_words(spark, sf):
    """Words of whole texts; equal words are combined before they are shuffled."""
    words = table(spark, sf, "documents").select(F.explode(F.split("text", " ")).alias("word")).where(F.trim("word") != "")
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("split_cols", """
SELECT tconst, split_part(genres, ',', 1) AS g1, split_part(genres, ',', 2) AS g2, split_part(genres, ',', 3) AS g3 FROM raw_title_basics""")
def split_cols(spark, sf):
    return P.split_columns(raw(spark, sf, "raw_title_basics").select("tconst", "genres"), "genres", ["g1", "g2", "g3"]).drop("genres")


@query("ranked_unpivot", """
SELECT o_orderkey, o_orderstatus AS tag, 1 AS tag_rank FROM orders UNION ALL SELECT o_orderkey, o_orderpriority, 2 FROM orders""")
def ranked_unpivot(spark, sf):
    return P.columns_to_ranked_rows(table(spark, sf, "orders"), ["o_orderkey"], ["o_orderstatus", "o_orderpriority"], "tag", "tag_rank")


# --- generators ---------------------------------------------------------------------------------------


@query("series_numbers", """
SELECT generated_number, c_custkey IS NOT NULL AS is_customer
FROM generate_series(1, (SELECT max(c_custkey) + 10 FROM customer)) g(generated_number) LEFT JOIN customer ON c_custkey = generated_number""")
def series_numbers(spark, sf):
    customer = table(spark, sf, "customer").select(F.col("c_custkey").alias("generated_number"), F.lit(True).alias("is_customer"))
    upper = customer.agg(F.max("generated_number")).first()[0] + 10
    return G.fill_spine(G.number_series(spark, upper), "generated_number", customer, []) \
        .withColumn("is_customer", X.true_only(F.col("is_customer")))


def _order_days(spark, sf):
    orders = table(spark, sf, "orders")
    first, last = orders.agg(F.date_trunc("month", F.min("o_orderdate")).cast("string"),
                             F.date_add(F.max("o_orderdate"), 1).cast("string")).first()
    return orders, first[:10], last


_SPAN = "(SELECT date_trunc('month', min(o_orderdate))::date FROM orders)"


@query("date_spine_day", f"""
SELECT d::date AS day, count(o_orderkey) AS orders
FROM generate_series({_SPAN}::timestamp, (SELECT max(o_orderdate)::date FROM orders)::timestamp, INTERVAL 1 DAY) g(d)
LEFT JOIN orders ON o_orderdate::date = d::date GROUP BY 1""")
def date_spine_day(spark, sf):
    orders, first, last = _order_days(spark, sf)
    spine = G.date_spine(spark, "day", first, last).select(F.col("date_day").cast("date").alias("day"))
    facts = orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("orders"))
    return G.fill_spine(spine, "day", facts, ["orders"])


@query("date_spine_month", f"""
SELECT d::date AS month FROM generate_series({_SPAN}::timestamp,
  (SELECT date_trunc('month', max(o_orderdate) + INTERVAL 1 DAY)::timestamp FROM orders) - INTERVAL 1 DAY, INTERVAL 1 MONTH) g(d)""")
def date_spine_month(spark, sf):
    _, first, last = _order_days(spark, sf)
    return G.date_spine(spark, "month", first, last).select(F.col("date_month").cast("date").alias("month"))


@query("spine_filled_revenue", f"""
SELECT d::date AS day, round(coalesce(sum(cast(o_totalprice AS decimal(18,2))), 0)::double, 2) AS revenue
FROM generate_series({_SPAN}::timestamp, (SELECT max(o_orderdate)::date FROM orders)::timestamp, INTERVAL 1 DAY) g(d)
LEFT JOIN orders ON o_orderdate::date = d::date GROUP BY 1""")
def spine_filled_revenue(spark, sf):
    orders, first, last = _order_days(spark, sf)
    spine = G.date_spine(spark, "day", first, last).select(F.col("date_day").cast("date").alias("day"))
    facts = orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("revenue"))
    return rounded(G.fill_spine(spine, "day", facts, ["revenue"]))
