"""Dimensions, facts and the insert-only upsert (q24, q28, q32-q35, q40)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import model
from .analogue import read, with_summary
from .queries import register
from .warehouse import Warehouse

CUTOFF = "1998-01-01"

# Oracle dimension CTEs (keys = row_number in natural-key order) ------------

DMT = """dmt AS (
  SELECT CAST(row_number() OVER (ORDER BY match_type) AS BIGINT) AS match_type_surrogate_key,
         md5(match_type) AS match_type_hash_value, match_type
  FROM (SELECT DISTINCT match_type FROM summary WHERE match_type IS NOT NULL))"""

DMD = """dmd AS (
  SELECT CAST(row_number() OVER (ORDER BY match_type, series_name, season, match_number) AS BIGINT)
           AS match_surrogate_key,
         md5(concat_ws('-', match_type, series_name, CAST(season AS VARCHAR),
                       CAST(match_number AS VARCHAR))) AS match_details_hash_value,
         match_number, md5(match_type) AS match_type_ref_key,
         md5(series_name) AS series_name_ref_key, md5(CAST(season AS VARCHAR)) AS season_ref_key,
         match_type, series_name, season
  FROM (SELECT DISTINCT match_type, series_name, season, match_id AS match_number FROM summary))"""

DPL = """dpl AS (
  SELECT CAST(row_number() OVER (ORDER BY s_suppkey) AS BIGINT) AS player_surrogate_key,
         md5(CAST(s_suppkey AS VARCHAR)) AS player_hash_value, CAST(s_suppkey AS INTEGER) AS player_id
  FROM supplier)"""

TEAM_REF = """team AS (
  SELECT upper(replace(n_name, '-', ' ')) AS team_name,
         md5(concat_ws('-', CAST(n_nationkey AS VARCHAR), n_name)) AS team_hash_value
  FROM nation)"""


@register("q24_insert_only_upsert", f"""
WITH cust AS (
  SELECT DISTINCT c.c_custkey, c.c_name, o.o_orderdate < TIMESTAMP '{CUTOFF}' AS early
  FROM customer c JOIN orders o ON o.o_custkey = c.c_custkey
), b1 AS (SELECT DISTINCT c_custkey, c_name FROM cust WHERE early),
b2 AS (SELECT DISTINCT c_custkey, c_name FROM cust),
t1 AS (SELECT CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS customer_surrogate_key,
              md5(CAST(c_custkey AS VARCHAR)) AS customer_hash_value, c_custkey, c_name FROM b1),
new AS (SELECT * FROM b2 WHERE c_custkey NOT IN (SELECT c_custkey FROM t1))
SELECT * FROM t1
UNION ALL
SELECT CAST((SELECT coalesce(max(customer_surrogate_key), 0) FROM t1)
            + row_number() OVER (ORDER BY c_custkey) AS BIGINT),
       md5(CAST(c_custkey AS VARCHAR)), c_custkey, c_name
FROM new
""")
def q24_insert_only_upsert(spark, sf_dir):
    """Two loads into one dimension by insert-only merge; keys of the first
    load stay, new members get keys after the largest; a repeated load adds
    nothing."""
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    o = read(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    cust = c.join(o, c.c_custkey == o.o_custkey)
    b1 = (cust.filter(F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp"))
          .select("c_custkey", "c_name"))
    b2 = cust.select("c_custkey", "c_name")
    t1 = model.build_dim(b1, ["c_custkey"], "customer_surrogate_key", "customer_hash_value",
                         extra={"c_name": None})
    t2 = model.upsert_insert_only(t1, b2, ["c_custkey"], "customer_surrogate_key",
                                  "customer_hash_value")
    t2 = t2.checkpoint(eager=True)
    # the same load again inserts nothing
    return model.upsert_insert_only(t2, b2, ["c_custkey"], "customer_surrogate_key",
                                    "customer_hash_value")


@register("q28_match_dimension", with_summary("""
SELECT match_surrogate_key, match_details_hash_value, match_number, match_type_ref_key,
       series_name_ref_key, season_ref_key FROM dmd
""", DMD))
def q28_match_dimension(spark, sf_dir):
    """Match dimension from three dimensions by a 3-way join + distinct."""
    return Warehouse(spark, sf_dir).dmd


@register("q32_stadium_dimension", with_summary("""
SELECT CAST(row_number() OVER (ORDER BY stadium_id, stadium_name, venue_ref_key) AS BIGINT)
         AS stadium_surrogate_key,
       md5(concat_ws('-', CAST(stadium_id AS VARCHAR), stadium_name, venue_ref_key)) AS stadium_hash_value,
       stadium_id, stadium_name, venue_ref_key
FROM (SELECT DISTINCT CAST(venue_id AS INTEGER) AS stadium_id, stadium AS stadium_name,
             md5(venue_location) AS venue_ref_key FROM summary)
"""))
def q32_stadium_dimension(spark, sf_dir):
    """Stadium dimension joined to its parent (venue location) by name,
    storing the parent's hash key."""
    return Warehouse(spark, sf_dir).dstadium


def _without_key(fact, key):
    """The fact's content, and whether its key is dense and unique: keys of facts
    follow no order, so their values are not compared."""
    r = fact.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(key).alias("d"),
                 F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    dense = r["n"] == r["d"] and (r["n"] == 0 or (r["lo"], r["hi"]) == (1, r["n"]))
    return fact.drop(key).withColumn("key_is_dense", F.lit(dense))


@register("q33_factless_match_fact", with_summary("""
SELECT *, true AS key_is_dense
FROM (
  SELECT DISTINCT
    md5(concat_ws('-', s.match_type, s.series_name, CAST(s.season AS VARCHAR), CAST(s.match_id AS VARCHAR))) AS match_ref_key,
    md5(s.toss_choice) AS toss_choice_ref_key,
    md5(concat_ws('-', CAST(s.match_day AS VARCHAR), s.match_month, CAST(s.match_year AS VARCHAR))) AS match_date_ref_key,
    dpl.player_hash_value AS player_of_the_match_ref_key,
    t1.team_hash_value AS team_1_ref_key,
    t2.team_hash_value AS team_2_ref_key,
    t3.team_hash_value AS toss_own_team_ref_key,
    t4.team_hash_value AS match_own_team_ref_key
  FROM summary s
  JOIN dpl ON dpl.player_id = s.player_of_the_match_player_id
  JOIN team t1 ON t1.team_name = s.team_1
  JOIN team t2 ON t2.team_name = s.team_2
  JOIN team t3 ON t3.team_name = s.toss_own_by
  JOIN team t4 ON t4.team_name = s.own_team
)
""", DPL, TEAM_REF))
def q33_factless_match_fact(spark, sf_dir):
    """Factless fact: computed-key (MD5) joins and the team dimension in four roles."""
    return _without_key(Warehouse(spark, sf_dir).fmi, "match_surrogate_key")


FACT_FROM = """
FROM summary s
JOIN dmt ON dmt.match_type_hash_value = md5(s.match_type)
JOIN dmd ON dmd.match_details_hash_value = md5(concat_ws('-', s.match_type, s.series_name,
            CAST(s.season AS VARCHAR), CAST(s.match_id AS VARCHAR)))
JOIN dpl ON dpl.player_id = s.player_id"""


@register("q34_batting_fact", with_summary(f"""
SELECT *, true AS key_is_dense
FROM (
  SELECT dmd.match_surrogate_key AS match_ref_key, dmt.match_type_surrogate_key AS match_type_ref_key,
         dpl.player_surrogate_key AS player_ref_key,
         s.runs_scored, s.balls_faced AS ball_faced, s.minutes_send, s.fours_count AS fours_scored,
         s.six_count AS sixes_scored, s.strike_rate, s.catch_taken,
         s.outed_bowler_style AS dimissial_player_name, s.dismissal_bowler_id AS dimissial_player_id
  {FACT_FROM}
)
""", DMT, DMD, DPL))
def q34_batting_fact(spark, sf_dir):
    """Batting fact on surrogate keys (3 joins, two on MD5 keys)."""
    return _without_key(Warehouse(spark, sf_dir).fbat, "batting_scorecard_surrogate_key")


@register("q35_bowling_fact", with_summary(f"""
SELECT *, true AS key_is_dense
FROM (
  SELECT dmd.match_surrogate_key AS match_ref_key, dmt.match_type_surrogate_key AS match_type_ref_key,
         dpl.player_surrogate_key AS player_ref_key,
         s.overs_bowled AS over_bowled, s.maiden_over, s.wickets_taken, s.economy,
         s.dots_ball_bowled AS dots_balls_bowled, s.fours_scored_by_batter AS fours_scored_batter,
         s.six_scored_by_batter AS sixs_scored_batter, s.wide_ball AS wide_ball_count,
         s.no_balls AS no_ball_count, s.runs_given
  {FACT_FROM}
)
""", DMT, DMD, DPL))
def q35_bowling_fact(spark, sf_dir):
    return _without_key(Warehouse(spark, sf_dir).fbowl, "bowling_scorecard_surrogate_key")


@register("q40_date_dimension", with_summary("""
SELECT CAST(row_number() OVER (ORDER BY match_year, match_month, match_date) AS BIGINT) AS date_surrogate_key,
       md5(concat_ws('-', CAST(match_date AS VARCHAR), match_month, CAST(match_year AS VARCHAR))) AS date_hash_value,
       match_date, match_month, match_year
FROM (SELECT DISTINCT match_day AS match_date, match_month, match_year FROM summary)
"""))
def q40_date_dimension(spark, sf_dir):
    return Warehouse(spark, sf_dir).ddate
