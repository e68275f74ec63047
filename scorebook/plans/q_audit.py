"""Audit checks over the analogue warehouse (q36-q39)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit
from .analogue import read, with_summary
from .q_model import DMD, DPL
from .queries import register
from .warehouse import Warehouse


@register("q36_distinct_match_count_check", with_summary("""
SELECT 'silver_match_type_pairs' AS check_name, count(*) AS row_count
FROM (SELECT DISTINCT match_id, match_type FROM summary)
UNION ALL
SELECT 'silver_match_keys', count(*)
FROM (SELECT DISTINCT match_type, series_name, season, match_id FROM summary)
UNION ALL
SELECT 'dim_match_details', count(*)
FROM (SELECT DISTINCT match_type, series_name, season, match_id FROM summary)
"""))
def q36_distinct_match_count_check(spark, sf_dir):
    """Distinct (match, type) pairs and distinct 4-column match keys in the
    silver table against the rows of the match dimension."""
    w = Warehouse(spark, sf_dir)
    return (audit.distinct_count(w.ms, ["match_id", "match_type"], "silver_match_type_pairs")
            .unionByName(audit.distinct_count(
                w.ms, ["match_type", "series_name", "season", "match_id"], "silver_match_keys"))
            .unionByName(w.dmd.agg(F.count(F.lit(1)).alias("row_count"))
                         .select(F.lit("dim_match_details").alias("check_name"), "row_count")))


@register("q37_record_mapping_counts", with_summary("""
SELECT 'silver_match_summary' AS table_name, count(*) AS row_count FROM summary
UNION ALL SELECT 'fact_batting_scorecard', count(*) FROM summary
UNION ALL SELECT 'fact_bowling_scorecard', count(*) FROM summary
"""))
def q37_record_mapping_counts(spark, sf_dir):
    """Facts and silver must hold the same number of rows."""
    w = Warehouse(spark, sf_dir)
    return audit.row_counts({"silver_match_summary": w.ms, "fact_batting_scorecard": w.fbat,
                             "fact_bowling_scorecard": w.fbowl})


@register("q38_null_audit", with_summary("""
SELECT 'dim_match_type' AS table_name, CAST(0 AS BIGINT) AS null_rows, count(*) AS total_rows
FROM (SELECT DISTINCT match_type FROM summary)
UNION ALL SELECT 'dim_series_names_info', 0, count(*) FROM (SELECT DISTINCT series_name FROM summary)
UNION ALL SELECT 'dim_seasons_info', 0, count(*) FROM (SELECT DISTINCT season FROM summary)
UNION ALL SELECT 'dim_match_details', 0, count(*)
  FROM (SELECT DISTINCT match_type, series_name, season, match_id FROM summary)
UNION ALL SELECT 'dim_team_info', 0, count(*) FROM nation
UNION ALL SELECT 'dim_player_details', 0, count(*) FROM supplier
UNION ALL SELECT 'dim_date', 0, count(*)
  FROM (SELECT DISTINCT match_day, match_month, match_year FROM summary)
UNION ALL SELECT 'dim_toss_choice', 0, count(*) FROM (SELECT DISTINCT toss_choice FROM summary)
UNION ALL SELECT 'dim_venue_location', 0, count(*) FROM (SELECT DISTINCT venue_location FROM summary)
UNION ALL SELECT 'dim_stadium', 0, count(*)
  FROM (SELECT DISTINCT venue_id, stadium, venue_location FROM summary)
UNION ALL SELECT 'part with gaps', count(*) FILTER (WHERE p_partkey % 7 = 0 OR p_size % 5 = 0), count(*) FROM part
UNION ALL SELECT 'silver season', count(*) FILTER (WHERE match_id % 11 = 0), count(*) FROM summary
"""))
def q38_null_audit(spark, sf_dir):
    """Rows with a null in any column, for all ten dimensions, for a table with
    nulls put in two of its columns, and for silver with seasons that are no number."""
    w = Warehouse(spark, sf_dir)
    gaps = read(spark, sf_dir, "part").select(
        F.when(F.col("p_partkey") % 7 != 0, F.col("p_name")).alias("p_name"),
        F.when(F.col("p_size") % 5 != 0, F.col("p_size")).alias("p_size"), "p_brand")
    odd = w.ms.select(F.when(F.col("match_id") % 11 == 0, F.lit("2007/08"))
                      .otherwise(F.col("season").cast("string")).alias("season"))
    lost = audit.lost_rows(odd, "season").select(
        F.lit("silver season").alias("table_name"), F.col("lost_rows").alias("null_rows"), "total_rows")
    return audit.null_audit({
        "dim_match_type": w.dmt, "dim_series_names_info": w.dsn, "dim_seasons_info": w.dss,
        "dim_match_details": w.dmd, "dim_team_info": w.dteam, "dim_player_details": w.dpl,
        "dim_date": w.ddate, "dim_toss_choice": w.dtoss, "dim_venue_location": w.dvl,
        "dim_stadium": w.dstadium, "part with gaps": gaps}).unionByName(lost)


DRILL_COLS = ["match_id", "player_id", "match_type", "series_name", "season", "runs_scored",
              "balls_faced", "fours_count", "six_count", "catch_taken"]


@register("q39_drill_through", with_summary(f"""
SELECT {", ".join("s." + c for c in DRILL_COLS)}
FROM summary s
WHERE s.match_id IN (
    SELECT dmd.match_number FROM dmd
    WHERE dmd.match_surrogate_key = (SELECT match_ref_key FROM top1))
  AND s.player_id = (SELECT dpl.player_id FROM dpl
                     WHERE dpl.player_surrogate_key = (SELECT player_ref_key FROM top1))
""", DMD, DPL, f"""top1 AS (
  SELECT dmd.match_surrogate_key AS match_ref_key, dpl.player_surrogate_key AS player_ref_key
  FROM summary s
  JOIN dmd ON dmd.match_type = s.match_type AND dmd.series_name = s.series_name
          AND dmd.season = s.season AND dmd.match_number = s.match_id
  JOIN dpl ON dpl.player_id = s.player_id
  ORDER BY s.runs_scored DESC, match_ref_key, player_ref_key
  LIMIT 1)"""))
def q39_drill_through(spark, sf_dir):
    """Top batting fact row (most runs; lowest keys on ties) -> its player
    and match dimension rows -> the silver rows behind it, by semi joins."""
    w = Warehouse(spark, sf_dir)
    return drill_through(w, w.batting_rows, "runs_scored", DRILL_COLS)


def drill_through(w: Warehouse, rows, measure: str, columns: list[str]):
    """The silver rows behind the fact row with the largest ``measure``."""
    top = (rows.orderBy(F.desc(measure), "match_ref_key", "player_ref_key")
           .limit(1).select("match_ref_key", "player_ref_key"))
    match_no = (w.dmd.join(top, w.dmd.match_surrogate_key == top.match_ref_key, "left_semi")
                .select(F.col("match_number").alias("match_id")))
    player = (w.dpl.join(top, w.dpl.player_surrogate_key == top.player_ref_key, "left_semi")
              .select("player_id"))
    s = w.ms.select(*columns)
    return (s.join(match_no, "match_id", "left_semi")
            .join(player, s.player_id == player.player_id, "left_semi"))


BOWLER_COLS = ["match_id", "player_id", "match_type", "series_name", "season", "runs_given",
               "wickets_taken", "maiden_over", "dots_ball_bowled", "wide_ball", "no_balls"]


@register("q45_bowler_drill_through", with_summary(f"""
SELECT {", ".join("s." + c for c in BOWLER_COLS)}
FROM summary s
WHERE s.match_id IN (
    SELECT dmd.match_number FROM dmd
    WHERE dmd.match_surrogate_key = (SELECT match_ref_key FROM top1))
  AND s.player_id = (SELECT dpl.player_id FROM dpl
                     WHERE dpl.player_surrogate_key = (SELECT player_ref_key FROM top1))
""", DMD, DPL, """top1 AS (
  SELECT dmd.match_surrogate_key AS match_ref_key, dpl.player_surrogate_key AS player_ref_key
  FROM summary s
  JOIN dmd ON dmd.match_type = s.match_type AND dmd.series_name = s.series_name
          AND dmd.season = s.season AND dmd.match_number = s.match_id
  JOIN dpl ON dpl.player_id = s.player_id
  ORDER BY s.runs_given DESC, match_ref_key, player_ref_key
  LIMIT 1)"""))
def q45_bowler_drill_through(spark, sf_dir):
    """As q39 from the bowling fact: the row that gave most runs."""
    w = Warehouse(spark, sf_dir)
    return drill_through(w, w.bowling_rows, "runs_given", BOWLER_COLS)
