"""The scorecard model laid over the driver's tables.

The warehouse operators are written against scorecard column names; the
driver's TPC-H-like tables are mapped onto them here, once, so the same
operators run on data that grows with the scale factor:

=============================  ==============================================
scorecard                      driver tables
=============================  ==============================================
match (match_id)               order (``l_orderkey``)
match type / series / season   ``o_orderstatus`` / ``o_orderpriority`` / year
match day / month / year       parts of ``o_orderdate``
player (player_id, name)       supplier (``l_suppkey``, ``s_name``)
team 1                         customer's nation
team 2                         the nation seven keys on
toss owner                     team 1 of even orders, team 2 of odd ones
winning side                   team 2 of orders divisible by 3, else team 1
player of the match            supplier 0 to 9, by the customer
venue location -> stadium      region -> ground of the customer's nation
toss choice                    by the order's key
bowler of a dismissal, style   part (``l_partkey``), lower(``p_type``)
batting / bowling measures     integer measures derived from the line
=============================  ==============================================

``SUMMARY_SQL`` is the same mapping as DuckDB SQL, used by the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import small_side, table_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan a driver table."""
    return spark.read.parquet(table_path(sf_dir, name))


def _round_int(c) -> F.Column:
    return F.round(c).cast("int")


def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player x match rows (the silver match summary) from the driver tables."""
    # The measures are taken from a line before it moves: a few small numbers.
    li = read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus",
        F.col("l_quantity").cast("int").alias("qty"), _round_int(F.col("l_tax") * 100).alias("tax100"),
        _round_int(F.col("l_discount") * 100).alias("disc100"),
        F.when(F.col("l_linestatus") == "F", F.floor(F.col("l_extendedprice") / 1000).cast("int"))
        .otherwise(0).alias("given"))
    o = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    p = read(spark, sf_dir, "part").select("p_partkey", "p_type")
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    cn = n.select(F.col("n_nationkey").alias("cn_key"), F.col("n_name").alias("team_1"),
                  F.col("n_regionkey").alias("cn_region"))
    sn = n.select(F.col("n_nationkey").alias("sn_key"), F.col("n_name").alias("team_2"))
    other = (F.col("c_nationkey") + 7) % 25
    rg = r.select(F.col("r_regionkey").alias("rg_key"), F.col("r_name").alias("venue_location"))

    # Orders meet their customers by themselves, and the lines meet the orders last, so the rows of a
    # match lie together; names come in once nothing moves any more where the tables allow it.
    # A match's date parts are worked out once, not for each of its lines.
    oc = o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "c_nationkey",
        F.year("o_orderdate").alias("season"), F.dayofmonth("o_orderdate").alias("match_day"),
        F.upper(F.date_format("o_orderdate", "MMMM")).alias("match_month"))
    j = (li.join(small_side(p), li.l_partkey == p.p_partkey)
         .join(oc, li.l_orderkey == oc.o_orderkey)
         .join(small_side(s), li.l_suppkey == s.s_suppkey)
         .join(cn, oc.c_nationkey == cn.cn_key)
         .join(sn, other == sn.sn_key)
         .join(rg, cn.cn_region == rg.rg_key))

    played = F.col("l_linestatus") == "F"
    bowled = F.col("l_linestatus") == "F"
    qty, tax100, disc100 = F.col("qty"), F.col("tax100"), F.col("disc100")
    return j.select(
        F.col("l_orderkey").alias("match_id"),
        F.col("o_orderstatus").alias("match_type"),
        F.col("o_orderpriority").alias("series_name"),
        "season", "match_day", "match_month", F.col("season").alias("match_year"),
        F.col("team_1"),
        F.col("team_2"),
        F.when(F.col("l_orderkey") % 2 == 0, F.col("team_1")).otherwise(F.col("team_2")).alias("toss_own_by"),
        F.when(F.col("l_orderkey") % 4 < 2, F.lit("BATTING")).otherwise(F.lit("BOWLING")).alias("toss_choice"),
        F.when(F.col("l_orderkey") % 3 == 0, F.col("team_2")).otherwise(F.col("team_1")).alias("own_team"),
        (F.col("o_custkey") % 10).alias("player_of_the_match_player_id"),
        F.col("c_nationkey").alias("venue_id"),
        F.col("venue_location"),
        F.concat("team_1", F.lit(" GROUND")).alias("stadium"),
        F.col("l_suppkey").alias("player_id"),
        F.col("s_name").alias("player_name"),
        F.col("l_linenumber").alias("batting_position"),
        qty.alias("runs_scored"),
        (qty + F.col("l_linenumber")).alias("balls_faced"),
        (F.col("l_linenumber") * 3).alias("minutes_send"),
        F.col("l_linenumber").alias("fours_count"),
        tax100.alias("six_count"),
        (disc100 * 10).cast("double").alias("strike_rate"),
        F.when(played, F.col("l_partkey")).otherwise(F.lit(0)).cast("long")
        .alias("dismissal_bowler_id"),
        F.when(played, F.lower("p_type")).alias("outed_bowler_style"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("catch_taken"),
        F.when(bowled, (F.col("l_linenumber").cast("decimal(10,1)")
                        + (tax100 % 6).cast("decimal(10,1)") / 10).cast("decimal(10,1)"))
        .otherwise(F.lit(0).cast("decimal(10,1)")).alias("overs_bowled"),
        F.when(bowled & (disc100 == 0), 1).otherwise(0).alias("maiden_over"),
        F.col("given").alias("runs_given"),
        F.when(bowled & (F.col("l_returnflag") == "A"), 1).otherwise(0).alias("wickets_taken"),
        F.when(bowled, disc100.cast("double")).otherwise(F.lit(0.0)).alias("economy"),
        F.when(bowled, F.col("l_linenumber") * 2).otherwise(0).alias("dots_ball_bowled"),
        F.when(bowled, tax100 % 3).otherwise(0).alias("fours_scored_by_batter"),
        F.when(bowled, tax100 % 2).otherwise(0).alias("six_scored_by_batter"),
        F.when(bowled, disc100 % 2).otherwise(0).alias("wide_ball"),
        F.when(bowled, disc100 % 3).otherwise(0).alias("no_balls"),
    )


SUMMARY_SQL = """
summary AS (
  SELECT
    l.l_orderkey AS match_id,
    o.o_orderstatus AS match_type,
    o.o_orderpriority AS series_name,
    CAST(year(o.o_orderdate) AS INTEGER) AS season,
    CAST(day(o.o_orderdate) AS INTEGER) AS match_day,
    upper(monthname(o.o_orderdate)) AS match_month,
    CAST(year(o.o_orderdate) AS INTEGER) AS match_year,
    cn.n_name AS team_1,
    sn.n_name AS team_2,
    CASE WHEN l.l_orderkey % 2 = 0 THEN cn.n_name ELSE sn.n_name END AS toss_own_by,
    CASE WHEN l.l_orderkey % 4 < 2 THEN 'BATTING' ELSE 'BOWLING' END AS toss_choice,
    CASE WHEN l.l_orderkey % 3 = 0 THEN sn.n_name ELSE cn.n_name END AS own_team,
    o.o_custkey % 10 AS player_of_the_match_player_id,
    c.c_nationkey AS venue_id,
    r.r_name AS venue_location,
    cn.n_name || ' GROUND' AS stadium,
    l.l_suppkey AS player_id,
    s.s_name AS player_name,
    l.l_linenumber AS batting_position,
    CAST(l.l_quantity AS INTEGER) AS runs_scored,
    CAST(l.l_quantity AS INTEGER) + l.l_linenumber AS balls_faced,
    l.l_linenumber * 3 AS minutes_send,
    l.l_linenumber AS fours_count,
    CAST(round(l.l_tax * 100) AS INTEGER) AS six_count,
    CAST(CAST(round(l.l_discount * 100) AS INTEGER) * 10 AS DOUBLE) AS strike_rate,
    CAST(CASE WHEN l.l_linestatus = 'F' THEN l.l_partkey ELSE 0 END AS BIGINT) AS dismissal_bowler_id,
    CASE WHEN l.l_linestatus = 'F' THEN lower(p.p_type) END AS outed_bowler_style,
    CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS catch_taken,
    CASE WHEN l.l_linestatus = 'F'
         THEN CAST(CAST(l.l_linenumber AS DECIMAL(10,1))
                   + CAST(CAST(round(l.l_tax * 100) AS INTEGER) % 6 AS DECIMAL(10,1)) / 10
                   AS DECIMAL(10,1))
         ELSE CAST(0 AS DECIMAL(10,1)) END AS overs_bowled,
    CASE WHEN l.l_linestatus = 'F' AND CAST(round(l.l_discount * 100) AS INTEGER) = 0 THEN 1 ELSE 0 END AS maiden_over,
    CASE WHEN l.l_linestatus = 'F' THEN CAST(floor(l.l_extendedprice / 1000) AS INTEGER) ELSE 0 END AS runs_given,
    CASE WHEN l.l_linestatus = 'F' AND l.l_returnflag = 'A' THEN 1 ELSE 0 END AS wickets_taken,
    CASE WHEN l.l_linestatus = 'F' THEN CAST(CAST(round(l.l_discount * 100) AS INTEGER) AS DOUBLE) ELSE 0.0 END AS economy,
    CASE WHEN l.l_linestatus = 'F' THEN l.l_linenumber * 2 ELSE 0 END AS dots_ball_bowled,
    CASE WHEN l.l_linestatus = 'F' THEN CAST(round(l.l_tax * 100) AS INTEGER) % 3 ELSE 0 END AS fours_scored_by_batter,
    CASE WHEN l.l_linestatus = 'F' THEN CAST(round(l.l_tax * 100) AS INTEGER) % 2 ELSE 0 END AS six_scored_by_batter,
    CASE WHEN l.l_linestatus = 'F' THEN CAST(round(l.l_discount * 100) AS INTEGER) % 2 ELSE 0 END AS wide_ball,
    CASE WHEN l.l_linestatus = 'F' THEN CAST(round(l.l_discount * 100) AS INTEGER) % 3 ELSE 0 END AS no_balls
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN nation cn ON c.c_nationkey = cn.n_nationkey
  JOIN nation sn ON (c.c_nationkey + 7) % 25 = sn.n_nationkey
  JOIN region r ON cn.n_regionkey = r.r_regionkey
)"""


def with_summary(sql_body: str, *ctes: str) -> str:
    """Prefix an oracle query with the summary CTE (and further CTEs)."""
    parts = [SUMMARY_SQL.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + sql_body.strip()
