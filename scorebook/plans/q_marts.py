"""Gold marts over the analogue star schema (q17-q21)."""

from __future__ import annotations

from .analogue import with_summary
from .queries import register
from .warehouse import Warehouse

# Oracle building blocks --------------------------------------------------

PLAYER_CTE = """
pl AS (
  SELECT CAST(s_suppkey AS INTEGER) AS player_id,
         concat_ws('-', split_part(s_name, '#', 1), split_part(s_name, '#', 2)) AS player_name,
         CAST(row_number() OVER (ORDER BY s_suppkey) AS BIGINT) AS player_ref_key
  FROM supplier
)"""

STYLES = ["economy", "large", "medium", "promo", "small", "standard"]

PIVOT_SQL_COLS = ",\n  ".join(
    f"count(*) FILTER (WHERE lower(p.p_type) = '{s}') AS {s}" for s in STYLES)

PIVOT_CTE = f"""
piv AS (
  SELECT s.season AS season_key, pl.player_name, pl.player_ref_key, s.match_type AS flag,
  {PIVOT_SQL_COLS}
  FROM summary s
  JOIN pl ON pl.player_id = s.player_id
  JOIN part p ON p.p_partkey = s.dismissal_bowler_id
  WHERE s.dismissal_bowler_id <> 0
  GROUP BY ALL
)"""

BAT_CTE = """
bat AS (
  SELECT pl.player_name, pl.player_ref_key, s.match_type AS flag, s.season AS season_key,
         CAST(sum(s.runs_scored) AS BIGINT) AS total_runs,
         CAST(sum(s.fours_count) AS BIGINT) AS total_fours,
         CAST(sum(s.six_count) AS BIGINT) AS total_sixes,
         CAST(sum(s.catch_taken) AS BIGINT) AS total_catch_taken,
         avg(s.strike_rate) AS avg_strike_rate,
         avg(s.strike_rate) FILTER (WHERE s.balls_faced > 0) AS avg_strike_rate_faced
  FROM summary s JOIN pl ON pl.player_id = s.player_id
  GROUP BY ALL
),
bat_ranked AS (
  SELECT *,
    CAST(rank() OVER (PARTITION BY season_key, flag ORDER BY total_runs DESC) AS INTEGER) AS runs_rank,
    CAST(rank() OVER (PARTITION BY season_key, flag ORDER BY avg_strike_rate DESC) AS INTEGER) AS strike_rate_rank,
    CAST(rank() OVER (PARTITION BY season_key, flag ORDER BY total_fours DESC) AS INTEGER) AS fours_rank,
    CAST(rank() OVER (PARTITION BY season_key, flag ORDER BY total_sixes DESC) AS INTEGER) AS sixes_rank
  FROM bat
)"""


@register("q17_win_count_mart", with_summary("""
SELECT f.season, f.series_name, t.n_name AS team_name, f.match_type AS flag,
       t.n_nationkey AS team_code, count(*) AS match_win_count
FROM (SELECT DISTINCT match_type, series_name, season, match_id,
             player_of_the_match_player_id, team_1, team_2, toss_own_by, own_team,
             toss_choice, match_day, match_month, match_year
      FROM summary) f
JOIN nation t ON upper(replace(t.n_name, '-', ' ')) = f.toss_own_by
GROUP BY ALL
"""))
def q17_win_count_mart(spark, sf_dir):
    """Star join fact -> 5 dimensions, count per season/series/team/format."""
    return Warehouse(spark, sf_dir).win_count()


@register("q43_win_count_by_winner", with_summary("""
SELECT f.season, f.series_name, t.n_name AS team_name, f.match_type AS flag,
       t.n_nationkey AS team_code, count(*) AS match_win_count
FROM (SELECT DISTINCT match_type, series_name, season, match_id,
             player_of_the_match_player_id, team_1, team_2, toss_own_by, own_team,
             toss_choice, match_day, match_month, match_year
      FROM summary) f
JOIN nation t ON upper(replace(t.n_name, '-', ' ')) = f.own_team
GROUP BY ALL
"""))
def q43_win_count_by_winner(spark, sf_dir):
    """The win count keyed on the winning side (q17 keeps the source's toss owner)."""
    return Warehouse(spark, sf_dir).win_count("match_own_team_ref_key")


@register("q18_dismissal_style_pivot", with_summary("""
SELECT * FROM piv
""", PLAYER_CTE, PIVOT_CTE))
def q18_dismissal_style_pivot(spark, sf_dir):
    return Warehouse(spark, sf_dir).dismissal_pivot()


@register("q19_batting_mart_with_styles", with_summary("""
SELECT b.*, """ + ", ".join(f"coalesce(piv.{s}, 0) AS {s}" for s in STYLES) + """
FROM bat_ranked b
LEFT JOIN piv ON piv.player_ref_key = b.player_ref_key AND piv.season_key = b.season_key
             AND piv.flag = b.flag AND piv.player_name = b.player_name
""", PLAYER_CTE, PIVOT_CTE, BAT_CTE))
def q19_batting_mart_with_styles(spark, sf_dir):
    return Warehouse(spark, sf_dir).batting_with_styles()


@register("q20_batting_mart_ranks", with_summary("""
SELECT * FROM bat_ranked
""", PLAYER_CTE, BAT_CTE))
def q20_batting_mart_ranks(spark, sf_dir):
    return Warehouse(spark, sf_dir).batting()


@register("q21_bowling_mart", with_summary("""
SELECT pl.player_name AS Player_name, s.match_type AS flag, s.season AS season_key,
       CAST(sum(s.overs_bowled) AS DECIMAL(20,1)) AS total_bowled_overs,
       CAST(sum(s.maiden_over) AS BIGINT) AS total_maiden_bowled_overs,
       sum(s.economy) AS Economy,
       CAST(sum(s.dots_ball_bowled) AS BIGINT) AS total_dot_bowled,
       CAST(sum(s.fours_scored_by_batter) AS BIGINT) AS fours_given,
       CAST(sum(s.six_scored_by_batter) AS BIGINT) AS six_given,
       CAST(sum(s.wide_ball) AS BIGINT) AS total_wide_balls_bowled,
       CAST(sum(s.no_balls) AS BIGINT) AS total_no_balls_bowled,
       CAST(sum(s.runs_given) AS BIGINT) AS total_runs_given,
       CAST(sum(s.wickets_taken) AS BIGINT) AS total_wickets,
       CAST(sum(CAST(floor(s.overs_bowled) * 6 + round((s.overs_bowled - floor(s.overs_bowled)) * 10) AS INTEGER)) AS BIGINT)
         AS total_balls_bowled,
       CAST(sum(s.runs_given) AS BIGINT) * CAST(6.0 AS DOUBLE)
         / nullif(CAST(sum(CAST(floor(s.overs_bowled) * 6 + round((s.overs_bowled - floor(s.overs_bowled)) * 10) AS INTEGER)) AS BIGINT), 0)
         AS runs_per_over
FROM summary s JOIN pl ON pl.player_id = s.player_id
GROUP BY ALL
HAVING sum(s.overs_bowled) <> 0 OR sum(s.maiden_over) <> 0 OR sum(s.economy) <> 0
    OR sum(s.dots_ball_bowled) <> 0 OR sum(s.fours_scored_by_batter) <> 0
    OR sum(s.six_scored_by_batter) <> 0 OR sum(s.wide_ball) <> 0 OR sum(s.no_balls) <> 0
    OR sum(s.runs_given) <> 0
""", PLAYER_CTE))
def q21_bowling_mart(spark, sf_dir):
    return Warehouse(spark, sf_dir).bowling()
