"""The labels of the layers in plain SQL, for checking.

Written out apart from the ladders that the tables are built with: a threshold
changed in one place alone shows as a difference."""

# --- fixed values: label rules in SQL -------------------------------------------------------
LABELS = {
    "decade": """CASE
        WHEN start_year >= 2020 THEN '2020s'
        WHEN start_year >= 2010 THEN '2010s'
        WHEN start_year >= 2000 THEN '2000s'
        WHEN start_year >= 1990 THEN '1990s'
        WHEN start_year >= 1980 THEN '1980s'
        WHEN start_year >= 1970 THEN '1970s'
        WHEN start_year >= 1960 THEN '1960s'
        ELSE 'Old Classic' END""",
    "quality_tier": """CASE
        WHEN average_rating >= 8.5 AND num_votes < 26 THEN 'Hidden Gem'
        WHEN average_rating >= 8.5 AND num_votes >= 26 THEN 'Acclaimed'
        WHEN average_rating >= 7.0 THEN 'Solid'
        WHEN average_rating >= 6.0 THEN 'Watchable'
        WHEN average_rating < 6.0 THEN 'Weak'
        ELSE 'Low rated' END""",
    "popularity_tier": """CASE
        WHEN num_votes IS NULL THEN 'Unknown'
        WHEN num_votes <= 7 THEN 'Bottom 10%'
        WHEN num_votes <= 10 THEN 'Bottom 20%'
        WHEN num_votes <= 13 THEN 'Bottom 30%'
        WHEN num_votes <= 18 THEN 'Bottom 40%'
        WHEN num_votes <= 26 THEN 'Bottom 50%'
        WHEN num_votes <= 40 THEN 'Top 50–40%'
        WHEN num_votes <= 71 THEN 'Top 40–30%'
        WHEN num_votes <= 149 THEN 'Top 30–20%'
        WHEN num_votes <= 478 THEN 'Top 20–10%'
        ELSE 'Top 10%' END""",
    "runtime_category": """CASE
        WHEN runtime_minutes IS NULL THEN 'Unknown'
        WHEN runtime_minutes < 30 THEN 'Short'
        WHEN runtime_minutes < 90 THEN 'Standard'
        WHEN runtime_minutes < 180 THEN 'Long'
        ELSE 'Epic' END""",
    "work_decade": """CASE
        WHEN start_year >= 2020 THEN '2020s'
        WHEN start_year >= 2010 THEN '2010s'
        WHEN start_year >= 2000 THEN '2000s'
        WHEN start_year >= 1990 THEN '1990s'
        ELSE 'Legacy' END""",
    "work_quality": """CASE
        WHEN average_rating >= 8.0 THEN 'High Quality'
        WHEN average_rating >= 7.0 THEN 'Good Quality'
        WHEN average_rating >= 6.0 THEN 'Average Quality'
        WHEN average_rating IS NOT NULL THEN 'Below Average'
        ELSE 'Unrated' END""",
    "longevity_class": """CASE
        WHEN series_years >= 15 THEN 'Long-Running (15+ years)'
        WHEN series_years >= 10 THEN 'Established (10-14 years)'
        WHEN series_years >= 5 THEN 'Mid-Length (5-9 years)'
        WHEN series_years >= 3 THEN 'Short-Run (3-4 years)'
        ELSE 'Limited Series (1-2 years)' END""",
    "series_tier": """CASE
        WHEN avg_series_rating >= 8.5 AND total_episodes >= 20 THEN 'Premium Series'
        WHEN avg_series_rating >= 8.0 AND total_episodes >= 10 THEN 'High Quality'
        WHEN avg_series_rating >= 7.5 THEN 'Good Series'
        WHEN avg_series_rating >= 7.0 THEN 'Average Series'
        WHEN avg_series_rating IS NOT NULL THEN 'Below Average'
        ELSE 'Unrated' END""",
    "episode_quality": """CASE
        WHEN episode_rating IS NULL THEN 'Unrated'
        WHEN rating_gap >= 0.5 THEN 'Standout Episode'
        WHEN rating_gap >= 0.2 THEN 'Above Average'
        WHEN rating_gap >= -0.2 THEN 'Typical'
        WHEN rating_gap >= -0.5 THEN 'Below Average'
        ELSE 'Poor Episode' END""",
    "season_position": """CASE
        WHEN season_number = 1 THEN 'Premiere Season'
        WHEN season_number = latest_season THEN 'Latest Season'
        WHEN season_number <= 3 THEN 'Early Seasons'
        WHEN season_number >= latest_season - 2 THEN 'Recent Seasons'
        ELSE 'Middle Seasons' END""",
    "consistency_class": """CASE
        WHEN rating_spread <= 0.3 THEN 'Very Consistent'
        WHEN rating_spread <= 0.5 THEN 'Consistent'
        WHEN rating_spread <= 0.8 THEN 'Moderately Variable'
        WHEN rating_spread <= 1.2 THEN 'Variable'
        ELSE 'Highly Variable' END""",
    "engagement": """CASE
        WHEN avg_episode_votes >= 5000 THEN 'High Engagement'
        WHEN avg_episode_votes >= 1000 THEN 'Moderate Engagement'
        WHEN avg_episode_votes >= 100 THEN 'Low Engagement'
        WHEN avg_episode_votes IS NOT NULL THEN 'Minimal Engagement'
        ELSE 'No Engagement Data' END""",
    "performance_tier": """CASE
        WHEN quality_percentile >= 0.95 AND popularity_percentile >= 0.9 THEN 'Masterpiece'
        WHEN quality_percentile >= 0.9 AND popularity_percentile >= 0.7 THEN 'Blockbuster Hit'
        WHEN quality_percentile >= 0.85 AND popularity_percentile >= 0.5 THEN 'Critical Success'
        WHEN quality_percentile >= 0.6 AND popularity_percentile >= 0.85 THEN 'Popular Hit'
        WHEN quality_percentile >= 0.7 THEN 'Quality Content'
        WHEN popularity_percentile >= 0.7 THEN 'Mainstream Appeal'
        WHEN quality_percentile >= 0.5 OR popularity_percentile >= 0.5 THEN 'Above Average'
        ELSE 'Standard Content' END""",
    "popularity_segment": """CASE
        WHEN popularity_percentile >= 0.9 THEN 'Mass Market'
        WHEN popularity_percentile >= 0.7 THEN 'Broad Appeal'
        WHEN popularity_percentile >= 0.4 THEN 'Moderate Reach'
        WHEN popularity_percentile >= 0.2 THEN 'Niche Appeal'
        ELSE 'Limited Audience' END""",
    "investment": """CASE
        WHEN weighted_score >= 8.5 AND num_votes >= 50000 THEN 'Premium Investment'
        WHEN weighted_score >= 8.0 AND num_votes >= 10000 THEN 'Strong Investment'
        WHEN weighted_score >= 7.5 OR num_votes >= 100000 THEN 'Solid Investment'
        WHEN weighted_score >= 7.0 OR num_votes >= 10000 THEN 'Moderate Investment'
        ELSE 'High Risk Investment' END""",
    "discovery": """CASE
        WHEN quality_percentile >= 0.8 AND popularity_percentile <= 0.3 THEN 'Hidden Gem'
        WHEN quality_percentile >= 0.7 AND popularity_percentile <= 0.5 THEN 'Underrated'
        WHEN quality_percentile <= 0.3 AND popularity_percentile >= 0.7 THEN 'Overrated'
        WHEN quality_percentile >= 0.6 AND popularity_percentile >= 0.6 THEN 'Well-Deserved Success'
        ELSE 'Standard Discovery' END""",
    "longevity": """CASE
        WHEN start_year <= 2000 AND popularity_percentile >= 0.6 THEN 'Timeless Classic'
        WHEN start_year <= 2010 AND quality_percentile >= 0.8 THEN 'Enduring Quality'
        WHEN start_year >= 2020 AND popularity_percentile >= 0.7 THEN 'Recent Hit'
        WHEN start_year >= 2015 AND quality_percentile >= 0.8 THEN 'Modern Classic'
        ELSE 'Standard Longevity' END""",
    "career_stage": """CASE
        WHEN career_span_years >= 40 THEN 'Veteran (40+ years)'
        WHEN career_span_years >= 20 THEN 'Established (20-39 years)'
        WHEN career_span_years >= 10 THEN 'Experienced (10-19 years)'
        WHEN career_span_years >= 5 THEN 'Mid-Career (5-9 years)'
        ELSE 'Emerging (0-4 years)' END""",
    "productivity": """CASE
        WHEN total_credits >= 100 THEN 'Highly Prolific (100+)'
        WHEN total_credits >= 50 THEN 'Very Active (50-99)'
        WHEN total_credits >= 20 THEN 'Active (20-49)'
        WHEN total_credits >= 10 THEN 'Moderate (10-19)'
        ELSE 'Limited Activity (3-9)' END""",
    "dominant_role": """CASE
        WHEN actor_credits >= director_credits AND actor_credits >= writer_credits AND actor_credits >= producer_credits THEN 'Actor'
        WHEN director_credits >= writer_credits AND director_credits >= producer_credits THEN 'Director'
        WHEN writer_credits >= producer_credits THEN 'Writer'
        WHEN producer_credits > 0 THEN 'Producer'
        ELSE 'Other' END""",
    "versatility": """CASE
        WHEN roles_held >= 3 THEN 'Multi-Talented'
        WHEN roles_held = 2 THEN 'Dual-Role'
        ELSE 'Specialist' END""",
    "reputation": """CASE
        WHEN avg_project_rating >= 7.5 AND high_quality_works >= 5 THEN 'Quality Specialist'
        WHEN avg_project_rating >= 7.0 AND total_credits >= 20 THEN 'Consistent Quality'
        WHEN avg_project_rating >= 6.5 THEN 'Good Track Record'
        WHEN avg_project_rating IS NOT NULL THEN 'Mixed Results'
        ELSE 'Unrated Work' END""",
    "activity": """CASE
        WHEN works_2020s >= works_2010s AND works_2020s >= works_2000s THEN 'Current Era Active'
        WHEN works_2010s >= works_2000s AND works_2010s >= works_1990s THEN 'Peak 2010s'
        WHEN works_2000s >= works_1990s THEN 'Peak 2000s'
        WHEN works_1990s > 0 THEN 'Legacy Era'
        ELSE 'Varied Activity' END""",
    "production_trend": """CASE
        WHEN titles_2020s > titles_2010s THEN 'Growing'
        WHEN titles_2020s < titles_2010s * 0.7 THEN 'Declining'
        ELSE 'Stable' END""",
    "quality_trend": """CASE
        WHEN rating_drift > 0.2 THEN 'Quality Improving'
        WHEN rating_drift < -0.2 THEN 'Quality Declining'
        ELSE 'Quality Stable' END""",
    "market_position": """CASE
        WHEN market_share >= 0.1 THEN 'Dominant Genre'
        WHEN market_share >= 0.05 THEN 'Major Genre'
        WHEN market_share >= 0.02 THEN 'Established Genre'
        ELSE 'Niche Genre' END""",
    "priority": """CASE
        WHEN avg_rating >= 7.0 AND market_share >= 0.05 AND titles_2020s >= titles_2010s THEN 'High Priority'
        WHEN avg_rating >= 6.5 AND market_share >= 0.02 THEN 'Medium Priority'
        WHEN avg_rating >= 6.0 THEN 'Low Priority'
        ELSE 'Not Recommended' END""",
    "strategy": """CASE
        WHEN premium_titles >= 10 AND avg_rating >= 7.5 THEN 'Premium Content Focus'
        WHEN blockbuster_titles >= 5 AND avg_votes >= 50000 THEN 'Blockbuster Strategy'
        WHEN high_quality_titles >= 100 THEN 'Quality-First Approach'
        WHEN market_share >= 0.05 THEN 'Volume Strategy'
        ELSE 'Niche Targeting' END""",
    "platform": """CASE
        WHEN tv_series_count > movie_count THEN 'Streaming Platform'
        WHEN blockbuster_titles >= 3 THEN 'Theater Release'
        WHEN avg_votes < 10000 THEN 'Art House / Festival'
        ELSE 'Multi-Platform' END""",
    "mart_longevity": """CASE
        WHEN series_duration_years >= 20 THEN 'Generational (20+ years)'
        WHEN series_duration_years >= 10 THEN 'Long-Running (10-19 years)'
        WHEN series_duration_years >= 5 THEN 'Established (5-9 years)'
        WHEN series_duration_years >= 3 THEN 'Multi-Season (3-4 years)'
        ELSE 'Short-Run (1-2 years)' END""",
    "mart_series_tier": """CASE
        WHEN avg_series_rating >= 8.5 AND total_episodes >= 50 THEN 'Premium Franchise'
        WHEN avg_series_rating >= 8.0 AND total_episodes >= 20 THEN 'Quality Series'
        WHEN avg_series_rating >= 7.5 AND total_episodes >= 10 THEN 'Strong Series'
        WHEN avg_series_rating >= 7.0 THEN 'Solid Series'
        WHEN avg_series_rating >= 6.5 THEN 'Average Series'
        ELSE 'Below Average' END""",
    "mart_consistency": """CASE
        WHEN rating_spread <= 0.5 THEN 'Very Consistent'
        WHEN rating_spread <= 0.8 THEN 'Consistent'
        WHEN rating_spread <= 1.2 THEN 'Moderately Variable'
        WHEN rating_spread <= 1.5 THEN 'Variable'
        ELSE 'Highly Variable' END""",
    "quality_pattern": """CASE
        WHEN excellent_share >= 0.5 THEN 'Excellence Driven'
        WHEN excellent_share >= 0.3 THEN 'Quality Focused'
        WHEN poor_share <= 0.1 THEN 'Consistent Quality'
        WHEN poor_share >= 0.3 THEN 'Quality Issues'
        ELSE 'Mixed Quality' END""",
    "production_scale": """CASE
        WHEN total_episodes >= 200 THEN 'Epic Scale (200+)'
        WHEN total_episodes >= 100 THEN 'Large Scale (100-199)'
        WHEN total_episodes >= 50 THEN 'Medium Scale (50-99)'
        WHEN total_episodes >= 20 THEN 'Standard Scale (20-49)'
        ELSE 'Limited Scale (6-19)' END""",
    "mart_engagement": """CASE
        WHEN avg_episode_votes >= 10000 THEN 'High Engagement'
        WHEN avg_episode_votes >= 5000 THEN 'Strong Engagement'
        WHEN avg_episode_votes >= 1000 THEN 'Moderate Engagement'
        WHEN avg_episode_votes >= 100 THEN 'Limited Engagement'
        ELSE 'Minimal Engagement' END""",
}
