"""Star tables and marts grown load by load, the unknown member, bucketed tables (q46-q50).

The silver rows of the analogue come in three loads, cut by order date inside a
season, so that seasons and formats get matches from two loads.  The oracles compute
the same from all rows at once.
"""

from __future__ import annotations

import calendar
import uuid

from pyspark.sql import functions as F

from ..operators import star
from ..session import WRITING, materialise, path_exists, scratch_path, settings
from ..sources import catalog
from ..sources.versions import VersionedTables
from . import gold
from .analogue import summary, with_summary
from .q_marts import BAT_CTE, PLAYER_CTE
from .q_model import DPL
from .queries import register
from .warehouse import Warehouse, bowler_styles, player_master, team_codes

#: First (year, month) of the second and the third load.
CUTS = [(1996, 7), (1998, 10)]


#: Base of the grown tables of a session and a folder of driver tables: three queries read them.
_GROWN: dict[tuple[str, str], str] = {}


def grown(spark, sf_dir):
    """The tables after three builds, one for each load, each published; built once a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _GROWN and path_exists(spark, f"{_GROWN[key]}/log"):
        return VersionedTables(spark, _GROWN[key])
    names = F.array(*[F.lit(m.upper()) for m in calendar.month_name[1:]])
    month = F.col("season") * 100 + F.array_position(names, F.col("match_month"))
    number = sum((F.when(month >= y * 100 + m, 1).otherwise(0) for y, m in CUTS), F.lit(0))
    # A folder for each load, which a build reads by itself; a task keeps their files open side by side.
    with settings(spark, {**WRITING, "spark.sql.maxConcurrentOutputFileWriters": str(len(CUTS) + 1)}):
        silver = materialise(summary(spark, sf_dir).withColumn("load", number), "silver_loads", partition_by=["load"])
    tables = VersionedTables(spark, scratch_path(spark, "gold"))
    for k in range(len(CUTS) + 1):
        build = tables.begin()
        gold.update(build, silver.where(F.col("load") == k).drop("load"), player_master(spark, sf_dir),
                    team_codes(spark, sf_dir), [f"load-{k}"], bowler_styles(spark, sf_dir))
        build.publish()
        tables.prune()
    _GROWN[key] = tables.base
    return tables


@register("q46_batting_fact_by_loads", with_summary("""
SELECT season, match_type, match_id AS match_number, CAST(player_id AS INTEGER) AS player_id,
       runs_scored, balls_faced AS ball_faced, fours_count AS fours_scored, six_count AS sixes_scored, strike_rate,
       catch_taken, dismissal_bowler_id AS dimissial_player_id, true AS key_is_dense
FROM summary
"""))
def q46_batting_fact_by_loads(spark, sf_dir):
    """The batting fact after three loads, each of which added parts to the seasons and formats
    it had matches in; surrogate keys resolved through the merged dimensions."""
    tables = grown(spark, sf_dir)
    fact = tables.read("fact_batting_scorecard")
    key = "batting_scorecard_surrogate_key"
    r = fact.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("d"), F.min(key).alias("lo"),
                 F.max(key).alias("hi")).first()
    dense = r["n"] == r["d"] and (r["lo"], r["hi"]) == (1, r["n"])
    match = tables.read("dim_match_details").select(F.col("match_surrogate_key").alias("match_ref_key"), "match_number")
    player = tables.read("dim_player_details").select(F.col("player_surrogate_key").alias("player_ref_key"), "player_id")
    return fact.join(match, "match_ref_key").join(player, "player_ref_key").select(
        "season", "match_type", "match_number", "player_id", "runs_scored", "ball_faced", "fours_scored", "sixes_scored",
        "strike_rate", "catch_taken", "dimissial_player_id", F.lit(dense).alias("key_is_dense"))


@register("q47_batting_mart_by_loads", with_summary("""
SELECT b.*, c.economy, c.large, c.medium, c.promo, c.small, c.standard
FROM bat_ranked b JOIN (
  SELECT s.season AS season_key, pl.player_ref_key, s.match_type AS flag,
         count(*) FILTER (WHERE lower(p.p_type) = 'economy') AS economy,
         count(*) FILTER (WHERE lower(p.p_type) = 'large') AS large,
         count(*) FILTER (WHERE lower(p.p_type) = 'medium') AS medium,
         count(*) FILTER (WHERE lower(p.p_type) = 'promo') AS promo,
         count(*) FILTER (WHERE lower(p.p_type) = 'small') AS small,
         count(*) FILTER (WHERE lower(p.p_type) = 'standard') AS standard
  FROM summary s JOIN pl ON pl.player_id = s.player_id
  LEFT JOIN part p ON p.p_partkey = s.dismissal_bowler_id AND s.dismissal_bowler_id <> 0
  GROUP BY ALL) c ON c.season_key = b.season_key AND c.player_ref_key = b.player_ref_key AND c.flag = b.flag
""", PLAYER_CTE, BAT_CTE))
def q47_batting_mart_by_loads(spark, sf_dir):
    """The batting mart after three loads, from sums and counts that add up; ranks worked
    out anew only in the seasons and formats a load touched."""
    styles = bowler_styles(spark, sf_dir)
    tables = grown(spark, sf_dir)
    return gold.mart_tables(tables.begin(), styles)["batting_analysis"]


@register("q48_bowling_and_win_marts_by_loads", with_summary("""
SELECT pl.player_name AS name, s.match_type AS flag, s.season, CAST(sum(s.runs_given) AS BIGINT) AS n,
       CAST(sum(s.overs_bowled) AS DOUBLE) AS overs, sum(s.economy) AS economy
FROM summary s JOIN pl ON pl.player_id = s.player_id
GROUP BY ALL
HAVING sum(s.overs_bowled) <> 0 OR sum(s.maiden_over) <> 0 OR sum(s.economy) <> 0
    OR sum(s.dots_ball_bowled) <> 0 OR sum(s.fours_scored_by_batter) <> 0
    OR sum(s.six_scored_by_batter) <> 0 OR sum(s.wide_ball) <> 0 OR sum(s.no_balls) <> 0
    OR sum(s.runs_given) <> 0
UNION ALL
SELECT f.series_name || ' ' || f.toss_own_by, f.match_type, f.season, count(*), NULL, NULL
FROM (SELECT DISTINCT match_type, series_name, season, match_id,
             player_of_the_match_player_id, team_1, team_2, toss_own_by, own_team,
             toss_choice, match_day, match_month, match_year FROM summary) f
GROUP BY ALL
""", PLAYER_CTE))
def q48_bowling_and_win_marts_by_loads(spark, sf_dir):
    """The bowling mart and the matches per toss owner after three loads."""
    held = gold.mart_tables(grown(spark, sf_dir).begin(), bowler_styles(spark, sf_dir))
    bowling = held["bowling_analysis"].select(
        F.col("Player_name").alias("name"), "flag", F.col("season_key").alias("season"),
        F.col("total_runs_given").alias("n"), F.col("total_bowled_overs").cast("double").alias("overs"),
        F.col("Economy").alias("economy"))
    wins = held["format_wise_analysis"].select(
        F.concat_ws(" ", "series_name", "team_name").alias("name"), "flag", "season", F.col("match_win_count").alias("n"),
        F.lit(None).cast("double").alias("overs"), F.lit(None).cast("double").alias("economy"))
    return bowling.unionByName(wins)


@register("q49_match_fact_with_unknown_member", with_summary("""
SELECT DISTINCT
  md5(concat_ws('-', s.match_type, s.series_name, CAST(s.season AS VARCHAR), CAST(s.match_id AS VARCHAR))) AS match_ref_key,
  coalesce(dpl.player_hash_value, md5('UNKNOWN')) AS player_of_the_match_ref_key,
  coalesce(dpl.player_surrogate_key, -1) AS player_of_the_match_key,
  coalesce(t4.team_hash_value, md5('UNKNOWN')) AS match_own_team_ref_key,
  coalesce(t4.team_name, 'UNKNOWN') AS winner
FROM summary s
LEFT JOIN dpl ON dpl.player_id = s.player_of_the_match_player_id AND s.match_id % 5 <> 0
LEFT JOIN team t4 ON t4.team_name = s.own_team AND s.match_type <> 'P'
""", DPL, """team AS (
  SELECT upper(replace(n_name, '-', ' ')) AS team_name,
         md5(concat_ws('-', CAST(n_nationkey AS VARCHAR), n_name)) AS team_hash_value
  FROM nation)"""))
def q49_match_fact_with_unknown_member(spark, sf_dir):
    """Ties (matches of type P have no winner) and matches without a player of the match keep
    their row in the match fact, with references to the dimensions' unknown member."""
    w = Warehouse(spark, sf_dir)
    w._silver = w.ms.withColumns({
        "own_team": F.when(F.col("match_type") == "P", F.lit("TIE")).otherwise(F.col("own_team")),
        "player_of_the_match_player_id": F.when(F.col("match_id") % 5 == 0, F.lit(None).cast("long"))
        .otherwise(F.col("player_of_the_match_player_id"))})
    w.__dict__["ms"] = w._silver
    fact = star.fact_match_rows(w.match_table, w.dmd, w.dpl, w.dteam, w.dtoss, w.ddate, keep_unmatched=True)
    players = star.with_unknown(w.dpl).select(F.col("player_hash_value").alias("player_of_the_match_ref_key"),
                                              F.col("player_surrogate_key").alias("player_of_the_match_key"))
    teams = star.with_unknown(w.dteam).select(F.col("team_hash_value").alias("match_own_team_ref_key"),
                                              F.col("team_name").alias("winner"))
    return (fact.join(players, "player_of_the_match_ref_key").join(teams, "match_own_team_ref_key")
            .select("match_ref_key", "player_of_the_match_ref_key", "player_of_the_match_key", "match_own_team_ref_key",
                    "winner").distinct())


BUCKETS = 8


def colocated(w: Warehouse, buckets=BUCKETS):
    """The batting fact joined to the match dimension, both bucketed on the match key."""
    spark = w.spark
    name = f"scorebook_buckets_{uuid.uuid4().hex[:8]}"
    catalog.create_database(spark, name)
    fact = catalog.save_bucketed(w.batting_rows, name, "fact_batting_scorecard", scratch_path(spark, "bucketed_fact"),
                                 "match_ref_key", buckets)
    members = w.dmd.select("match_surrogate_key", "match_number", "season_ref_key")
    match = catalog.save_bucketed(members, name, "dim_match_details", scratch_path(spark, "bucketed_matches"),
                                  "match_surrogate_key", buckets)
    return fact.join(match, fact.match_ref_key == match.match_surrogate_key)


@register("q50_bucketed_match_totals", with_summary("""
SELECT s.match_id AS match_number, s.match_type, s.season, CAST(sum(s.runs_scored) AS BIGINT) AS runs, count(*) AS rows
FROM summary s GROUP BY ALL
"""))
def q50_bucketed_match_totals(spark, sf_dir):
    """Totals of each match from fact and match dimension, bucketed tables on the match key: joined and
    grouped without an exchange of the fact."""
    w = Warehouse(spark, sf_dir)
    totals = colocated(w).groupBy("match_ref_key", "match_number", "season_ref_key").agg(
        F.sum("runs_scored").alias("runs"), F.count(F.lit(1)).alias("rows"))
    return (totals.join(w.dss.select(F.col("season_hash_value").alias("season_ref_key"), "season"), "season_ref_key")
            .join(w.matches.select("match_ref_key", F.col("__mt").alias("match_type")), "match_ref_key")
            .select("match_number", "match_type", "season", "runs", "rows"))
