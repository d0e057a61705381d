"""Fixed values of the layers: bounds, label ladders, role groups and thresholds.

The values must equal the published tables' for queries on them to keep working.
"""

from __future__ import annotations

from decimal import Decimal

from ..functions.ladder import Ladder, rules, steps

# --- fixed values: validity bounds -------------------------------------------------
TITLE_YEARS = (1800, 2030)
PERSON_FIRST_YEAR = 1800
RUNTIME_MINUTES = (1, 2000)
SIGNIFICANT_VOTES = 1000
RELIABLE_VOTES = 500
HIGH_VOTES = 1000
UNKNOWN_TITLE = "Unknown Title"
UNKNOWN_PERSON = "Unknown Person"

# --- fixed values: role consolidation ----------------------------------------------
ROLE_GROUPS = {
    "actor": ["actor", "actress"], "director": ["director"], "writer": ["writer"], "producer": ["producer"],
    "cinematographer": ["cinematographer"], "composer": ["composer"], "editor": ["editor"], "self": ["self"],
}
OTHER_ROLE = "other"
CAREER_ROLES = ["actor", "director", "writer", "producer"]
BLOCKBUSTER_GENRES = ["Action", "Adventure", "Sci-Fi", "Fantasy"]
TITLE_TYPES = ["short", "movie", "tvMovie", "tvSeries", "tvEpisode", "tvMiniSeries", "tvSpecial", "tvPilot",
               "video", "videoGame", "tvShort"]


def _decades(first: int, last: int, default: str) -> Ladder:
    return steps("start_year", ">=", [(y, f"{y}s") for y in range(last, first - 1, -10)], default)


# --- fixed values: title ladders -----------------------------------------------------
DECADE = _decades(1960, 2020, "Old Classic")
QUALITY_TIER = rules(
    ("average_rating >= 8.5 AND num_votes < 26", "Hidden Gem"), ("average_rating >= 8.5 AND num_votes >= 26", "Acclaimed"),
    ("average_rating >= 7.0", "Solid"), ("average_rating >= 6.0", "Watchable"), ("average_rating < 6.0", "Weak"),
    default="Low rated")
POPULARITY_TIER = Ladder(
    (("num_votes IS NULL", "Unknown"),) + steps("num_votes", "<=", [
        (7, "Bottom 10%"), (10, "Bottom 20%"), (13, "Bottom 30%"), (18, "Bottom 40%"), (26, "Bottom 50%"),
        (40, "Top 50–40%"), (71, "Top 40–30%"), (149, "Top 30–20%"), (478, "Top 20–10%")], "").rules,
    "Top 10%")
RUNTIME_CATEGORY = Ladder(
    (("runtime_minutes IS NULL", "Unknown"),)
    + steps("runtime_minutes", "<", [(30, "Short"), (90, "Standard"), (180, "Long")], "").rules, "Epic")

# --- fixed values: person and credit ladders ------------------------------------------
WORK_DECADE = _decades(1990, 2020, "Legacy")
WORK_QUALITY = Ladder(
    steps("average_rating", ">=", [("8.0", "High Quality"), ("7.0", "Good Quality"), ("6.0", "Average Quality")], "").rules
    + (("average_rating IS NOT NULL", "Below Average"),), "Unrated")
CAREER_STAGE = steps("career_span_years", ">=", [
    (40, "Veteran (40+ years)"), (20, "Established (20-39 years)"), (10, "Experienced (10-19 years)"),
    (5, "Mid-Career (5-9 years)")], "Emerging (0-4 years)")
PRODUCTIVITY = steps("total_credits", ">=", [
    (100, "Highly Prolific (100+)"), (50, "Very Active (50-99)"), (20, "Active (20-49)"), (10, "Moderate (10-19)")],
    "Limited Activity (3-9)")
DOMINANT_ROLE = rules(
    ("actor_credits >= director_credits AND actor_credits >= writer_credits AND actor_credits >= producer_credits", "Actor"),
    ("director_credits >= writer_credits AND director_credits >= producer_credits", "Director"),
    ("writer_credits >= producer_credits", "Writer"), ("producer_credits > 0", "Producer"), default="Other")
VERSATILITY = rules(("roles_held >= 3", "Multi-Talented"), ("roles_held = 2", "Dual-Role"), default="Specialist")
REPUTATION = rules(
    ("avg_project_rating >= 7.5 AND high_quality_works >= 5", "Quality Specialist"),
    ("avg_project_rating >= 7.0 AND total_credits >= 20", "Consistent Quality"),
    ("avg_project_rating >= 6.5", "Good Track Record"), ("avg_project_rating IS NOT NULL", "Mixed Results"),
    default="Unrated Work")
ACTIVITY = rules(
    ("works_2020s >= works_2010s AND works_2020s >= works_2000s", "Current Era Active"),
    ("works_2010s >= works_2000s AND works_2010s >= works_1990s", "Peak 2010s"),
    ("works_2000s >= works_1990s", "Peak 2000s"), ("works_1990s > 0", "Legacy Era"), default="Varied Activity")
MIN_CAREER_CREDITS = 3
# the rungs of WORK_DECADE and WORK_QUALITY a career counts, as [from, below)
COUNTED_ERAS = {"works_2020s": (2020, None), "works_2010s": (2010, 2020), "works_2000s": (2000, 2010), "works_1990s": (1990, 2000)}
COUNTED_QUALITY = {"high_quality_works": (8, None), "good_quality_works": (7, 8)}

# --- fixed values: episode and series ladders -------------------------------------------
LONGEVITY_CLASS = steps("series_years", ">=", [
    (15, "Long-Running (15+ years)"), (10, "Established (10-14 years)"), (5, "Mid-Length (5-9 years)"),
    (3, "Short-Run (3-4 years)")], "Limited Series (1-2 years)")
SERIES_TIER = rules(
    ("avg_series_rating >= 8.5 AND total_episodes >= 20", "Premium Series"),
    ("avg_series_rating >= 8.0 AND total_episodes >= 10", "High Quality"), ("avg_series_rating >= 7.5", "Good Series"),
    ("avg_series_rating >= 7.0", "Average Series"), ("avg_series_rating IS NOT NULL", "Below Average"), default="Unrated")
# rating_gap = episode rating minus series average
EPISODE_QUALITY = Ladder(
    (("episode_rating IS NULL", "Unrated"),) + steps("rating_gap", ">=", [
        ("0.5", "Standout Episode"), ("0.2", "Above Average"), ("-0.2", "Typical"), ("-0.5", "Below Average")], "").rules,
    "Poor Episode")
SEASON_POSITION = rules(
    ("season_number = 1", "Premiere Season"), ("season_number = latest_season", "Latest Season"),
    ("season_number <= 3", "Early Seasons"), ("season_number >= latest_season - 2", "Recent Seasons"),
    default="Middle Seasons")
CONSISTENCY_CLASS = steps("rating_spread", "<=", [
    ("0.3", "Very Consistent"), ("0.5", "Consistent"), ("0.8", "Moderately Variable"), ("1.2", "Variable")],
    "Highly Variable")
ENGAGEMENT = Ladder(
    steps("avg_episode_votes", ">=", [
        (5000, "High Engagement"), (1000, "Moderate Engagement"), (100, "Low Engagement")], "").rules
    + (("avg_episode_votes IS NOT NULL", "Minimal Engagement"),), "No Engagement Data")

MART_LONGEVITY = steps("series_duration_years", ">=", [
    (20, "Generational (20+ years)"), (10, "Long-Running (10-19 years)"), (5, "Established (5-9 years)"),
    (3, "Multi-Season (3-4 years)")], "Short-Run (1-2 years)")
MART_SERIES_TIER = rules(
    ("avg_series_rating >= 8.5 AND total_episodes >= 50", "Premium Franchise"),
    ("avg_series_rating >= 8.0 AND total_episodes >= 20", "Quality Series"),
    ("avg_series_rating >= 7.5 AND total_episodes >= 10", "Strong Series"),
    ("avg_series_rating >= 7.0", "Solid Series"), ("avg_series_rating >= 6.5", "Average Series"), default="Below Average")
MART_CONSISTENCY = steps("rating_spread", "<=", [
    ("0.5", "Very Consistent"), ("0.8", "Consistent"), ("1.2", "Moderately Variable"), ("1.5", "Variable")],
    "Highly Variable")
QUALITY_PATTERN = rules(
    ("excellent_share >= 0.5", "Excellence Driven"), ("excellent_share >= 0.3", "Quality Focused"),
    ("poor_share <= 0.1", "Consistent Quality"), ("poor_share >= 0.3", "Quality Issues"), default="Mixed Quality")
PRODUCTION_SCALE = steps("total_episodes", ">=", [
    (200, "Epic Scale (200+)"), (100, "Large Scale (100-199)"), (50, "Medium Scale (50-99)"),
    (20, "Standard Scale (20-49)")], "Limited Scale (6-19)")
MART_ENGAGEMENT = steps("avg_episode_votes", ">=", [
    (10000, "High Engagement"), (5000, "Strong Engagement"), (1000, "Moderate Engagement"), (100, "Limited Engagement")],
    "Minimal Engagement")
MIN_RATED_EPISODES = 6
EXCELLENT_EPISODE = "8.0"
POOR_EPISODE = "6.0"
PREMIUM_SERIES = ["Premium Franchise", "Quality Series"]
CONSISTENT_SERIES = ["Very Consistent", "Consistent"]
LONG_SERIES = ["Generational (20+ years)", "Long-Running (10-19 years)"]

# --- fixed values: title performance --------------------------------------------------------
MIN_RANKED_VOTES = 50
CONFIDENCE = [(100000, Decimal("1.0")), (10000, Decimal("0.95")), (1000, Decimal("0.9"))]
CONFIDENCE_FLOOR = Decimal("0.8")
RANK_KEYS = {"type_rank": ["title_type"], "genre_rank": ["primary_genre"], "decade_rank": ["decade"]}
TOP_FLAGS = {"is_top_100_in_type": ("type_rank", 100), "is_top_50_in_genre": ("genre_rank", 50),
             "is_top_25_in_decade": ("decade_rank", 25)}


def _both(quality: str, popularity: str) -> str:
    return f"quality_percentile {quality} AND popularity_percentile {popularity}"


PERFORMANCE_TIER = rules(
    (_both(">= 0.95", ">= 0.9"), "Masterpiece"), (_both(">= 0.9", ">= 0.7"), "Blockbuster Hit"),
    (_both(">= 0.85", ">= 0.5"), "Critical Success"), (_both(">= 0.6", ">= 0.85"), "Popular Hit"),
    ("quality_percentile >= 0.7", "Quality Content"), ("popularity_percentile >= 0.7", "Mainstream Appeal"),
    ("quality_percentile >= 0.5 OR popularity_percentile >= 0.5", "Above Average"), default="Standard Content")
PREMIUM_TIERS = ["Masterpiece", "Blockbuster Hit", "Critical Success"]
POPULARITY_SEGMENT = steps("popularity_percentile", ">=", [
    ("0.9", "Mass Market"), ("0.7", "Broad Appeal"), ("0.4", "Moderate Reach"), ("0.2", "Niche Appeal")],
    "Limited Audience")
INVESTMENT = rules(
    ("weighted_score >= 8.5 AND num_votes >= 50000", "Premium Investment"),
    ("weighted_score >= 8.0 AND num_votes >= 10000", "Strong Investment"),
    ("weighted_score >= 7.5 OR num_votes >= 100000", "Solid Investment"),
    ("weighted_score >= 7.0 OR num_votes >= 10000", "Moderate Investment"), default="High Risk Investment")
DISCOVERY = rules(
    (_both(">= 0.8", "<= 0.3"), "Hidden Gem"), (_both(">= 0.7", "<= 0.5"), "Underrated"),
    (_both("<= 0.3", ">= 0.7"), "Overrated"), (_both(">= 0.6", ">= 0.6"), "Well-Deserved Success"),
    default="Standard Discovery")
LONGEVITY = rules(
    ("start_year <= 2000 AND popularity_percentile >= 0.6", "Timeless Classic"),
    ("start_year <= 2010 AND quality_percentile >= 0.8", "Enduring Quality"),
    ("start_year >= 2020 AND popularity_percentile >= 0.7", "Recent Hit"),
    ("start_year >= 2015 AND quality_percentile >= 0.8", "Modern Classic"), default="Standard Longevity")

# --- fixed values: genre market ----------------------------------------------------------------
GENRE_FIRST_YEAR = 1950
COUNTED_DECADES = list(range(1950, 2030, 10))
RATED_DECADES = list(range(1990, 2030, 10))
PRODUCTION_TREND = rules(
    ("titles_2020s > titles_2010s", "Growing"), ("titles_2020s < titles_2010s * 0.7", "Declining"), default="Stable")
# rating_drift = average rating of the 2020s minus the 2010s
QUALITY_TREND = rules(
    ("rating_drift > 0.2", "Quality Improving"), ("rating_drift < -0.2", "Quality Declining"), default="Quality Stable")
MARKET_POSITION = steps("market_share", ">=", [
    ("0.1", "Dominant Genre"), ("0.05", "Major Genre"), ("0.02", "Established Genre")], "Niche Genre")
PRIORITY = rules(
    ("avg_rating >= 7.0 AND market_share >= 0.05 AND titles_2020s >= titles_2010s", "High Priority"),
    ("avg_rating >= 6.5 AND market_share >= 0.02", "Medium Priority"), ("avg_rating >= 6.0", "Low Priority"),
    default="Not Recommended")
STRATEGY = rules(
    ("premium_titles >= 10 AND avg_rating >= 7.5", "Premium Content Focus"),
    ("blockbuster_titles >= 5 AND avg_votes >= 50000", "Blockbuster Strategy"),
    ("high_quality_titles >= 100", "Quality-First Approach"), ("market_share >= 0.05", "Volume Strategy"),
    default="Niche Targeting")
PLATFORM = rules(
    ("tv_series_count > movie_count", "Streaming Platform"), ("blockbuster_titles >= 3", "Theater Release"),
    ("avg_votes < 10000", "Art House / Festival"), default="Multi-Platform")
INVESTMENT_TARGETS = ["High Priority", "Medium Priority"]
CORE_MARKET = ["Dominant Genre", "Major Genre"]
GROWING_QUALITY = ["Quality Improving", "Quality Stable"]

# label of a priority no rule produces, but which published queries ask for
CONSUMER_PRIORITIES = [*INVESTMENT_TARGETS, "Emerging Opportunity"]
