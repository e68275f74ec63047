"""Joins of the assembly and entity resolution (q14-q16, q22, q23)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text
from ..operators import resolve
from ..session import partitions_for
from .analogue import read
from .queries import register


# ------------------------------------------------------------------ q14
@register("q14_full_outer_chain", """
WITH li AS (
  SELECT l.l_orderkey AS match_id, s.s_name AS player_name, l.*
  FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey
), sheet AS (
  SELECT match_id, CASE WHEN l_returnflag = 'R' THEN 'on sheet ' || player_name ELSE player_name END AS player_name,
         max(CASE WHEN l_linenumber = 1 THEN 'Y' ELSE 'N' END) AS captain_flag
  FROM li GROUP BY 1, 2
), bowl AS (
  SELECT match_id, CASE WHEN l_linestatus <> 'F' THEN 'bowled ' || player_name ELSE player_name END AS player_name,
         CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS runs_given
  FROM li GROUP BY 1, 2
), bat AS (
  SELECT match_id,
         CASE WHEN l_shipdate < TIMESTAMP '1999-01-01' THEN 'batted ' || player_name ELSE player_name END AS player_name,
         CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS runs_scored
  FROM li GROUP BY 1, 2
)
SELECT * FROM sheet FULL OUTER JOIN bowl USING (match_id, player_name)
                    FULL OUTER JOIN bat USING (match_id, player_name)
""")
def q14_full_outer_chain(spark, sf_dir):
    """Team sheet, bowling and batting of each match joined by full outer
    joins on (match, player name); a player missing from one side keeps the
    row with nulls there.  All lines are in all three: gaps come from names that one
    side writes otherwise."""
    li = (read(spark, sf_dir, "lineitem")
          .join(read(spark, sf_dir, "supplier").select("s_suppkey", "s_name"),
                F.col("l_suppkey") == F.col("s_suppkey"))
          .withColumnsRenamed({"l_orderkey": "match_id", "s_name": "player_name"}))
    keys = ["match_id", "player_name"]

    def named(other, word):
        name = F.when(other, F.concat(F.lit(word), "player_name")).otherwise(F.col("player_name"))
        return li.withColumn("player_name", name).groupBy(*keys)

    quantity = F.sum(F.col("l_quantity").cast("int"))
    sheet = (named(F.col("l_returnflag") == "R", "on sheet ")
             .agg(F.max((F.col("l_linenumber") == 1).cast("int")).alias("__cap"))
             .select(*keys, F.when(F.col("__cap") == 1, "Y").otherwise("N")
                     .alias("captain_flag")))
    bowl = named(F.col("l_linestatus") != "F", "bowled ").agg(quantity.alias("runs_given"))
    bat = named(F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp"), "batted ").agg(quantity.alias("runs_scored"))
    return sheet.join(bowl, keys, "full").join(bat, keys, "full")


# ------------------------------------------------------------------ q15
@register("q15_left_join_fill_counts", """
WITH c AS (SELECT CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE -o_custkey END AS o_custkey, count(*) AS n
           FROM orders GROUP BY 1)
SELECT cu.c_custkey AS player_id, coalesce(c.n, 0) AS catch_taken
FROM customer cu LEFT JOIN c ON c.o_custkey = cu.c_custkey
""")
def q15_left_join_fill_counts(spark, sf_dir):
    """Counts per key (catches per fielder) left-joined to all keys, gaps 0; orders that are not
    finished count for a key that nobody has."""
    o = read(spark, sf_dir, "orders").withColumn(
        "o_custkey", F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).otherwise(-F.col("o_custkey")))
    catches = resolve.catches_per_fielder(o.withColumn("__m", F.lit(0)), "__m", "o_custkey")
    players = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("player_id"),
                                                     F.lit(0).alias("__m"))
    return resolve.add_catches(players, catches, "__m").select("player_id", "catch_taken")


# ------------------------------------------------------------------ q16
@register("q16_master_and_bowler_role_joins", """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey AS player_id, s.s_name AS player_name,
       CASE WHEN l.l_linestatus = 'F' THEN l.l_partkey END AS dismissal_bowler_id,
       lower(p.p_type) AS outed_bowler_style
FROM lineitem l
JOIN supplier s ON CASE WHEN s.s_acctbal < 0 THEN -s.s_suppkey ELSE s.s_suppkey END = l.l_suppkey
LEFT JOIN part p ON p.p_partkey = CASE WHEN l.l_linestatus = 'F' THEN l.l_partkey END
""")
def q16_master_and_bowler_role_joins(spark, sf_dir):
    """Inner join to the master (rows of players not in it drop out) and one
    left join to the bowler role over the whole set: rows whose dismissal
    names no bowler keep a null style (no split and re-union)."""
    li = read(spark, sf_dir, "lineitem")
    # A supplier in debt is in the master under an id that no line has.
    master = read(spark, sf_dir, "supplier").select(
        F.when(F.col("s_acctbal") < 0, -F.col("s_suppkey")).otherwise(F.col("s_suppkey")).alias("player_id"),
        F.col("s_name").alias("player_name"))
    bowlers = read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("dismissal_bowler_id"),
        F.lower("p_type").alias("outed_bowler_style"))
    t = li.select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("player_id"),
                  F.when(F.col("l_linestatus") == "F", F.col("l_partkey"))
                  .alias("dismissal_bowler_id"))
    t = t.join(master, "player_id")
    return resolve.left_join_known(t, bowlers, "dismissal_bowler_id")


# ------------------------------------------------------------------ q22
@register("q22_surname_resolution", r"""
WITH m AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, regexp_extract(p.p_name, '(\S+)\s*$', 1) AS mention
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
), people AS (
  SELECT DISTINCT l.l_orderkey, p.p_partkey, p.p_name
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
), cand AS (
  SELECT DISTINCT m.l_orderkey, m.mention, pe.p_partkey,
         CASE WHEN pe.p_name = m.mention THEN 0 WHEN contains(pe.p_name, m.mention) THEN 1 ELSE 2 END AS score
  FROM (SELECT DISTINCT l_orderkey, mention FROM m) m
  JOIN people pe ON pe.l_orderkey = m.l_orderkey
               AND list_contains(string_split(pe.p_name, ' '), lower(m.mention))
), best AS (
  SELECT l_orderkey, mention, min(score) AS s FROM cand GROUP BY ALL
), pick AS (
  SELECT c.l_orderkey, c.mention, min(c.p_partkey) AS resolved_id, count(*) AS n_candidates
  FROM cand c JOIN best b ON b.l_orderkey = c.l_orderkey AND b.mention = c.mention AND b.s = c.score
  GROUP BY ALL
)
SELECT m.l_orderkey, m.l_linenumber, m.l_partkey, m.mention, pick.resolved_id, pick.n_candidates
FROM m LEFT JOIN pick ON pick.l_orderkey = m.l_orderkey AND pick.mention = m.mention
""")
def q22_surname_resolution(spark, sf_dir):
    """Each line names a word of its part; resolve it to a part of the same
    order whose name holds that word; first hit by lowest key."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    p = read(spark, sf_dir, "part").select("p_partkey", "p_name")
    lp = li.join(p, li.l_partkey == p.p_partkey)
    mentions = lp.select("l_orderkey", "l_linenumber", "l_partkey",
                         F.regexp_extract("p_name", r"(\S+)\s*$", 1).alias("mention"))
    people = lp.select("l_orderkey", "p_partkey", "p_name")
    return resolve.resolve_mentions(mentions, people, "l_orderkey", "mention", "p_name",
                                    "p_partkey", partitions=partitions_for(li)).select(
        "l_orderkey", "l_linenumber", "l_partkey", "mention", "resolved_id", "n_candidates")


# ------------------------------------------------------------------ q44
_ANY_ID = "(p_partkey - 100) * 5000000000007"


@register("q44_resolution_of_any_id", rf"""
WITH lp AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, {_ANY_ID} AS id, p.p_name,
         regexp_extract(p.p_name, '(\S+)\s*$', 1) AS mention
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
), cand AS (
  SELECT DISTINCT m.l_orderkey, m.mention, pe.id,
         CASE WHEN pe.p_name = m.mention THEN 0 WHEN contains(pe.p_name, m.mention) THEN 1 ELSE 2 END AS score
  FROM lp m JOIN lp pe ON pe.l_orderkey = m.l_orderkey
                      AND list_contains(string_split(pe.p_name, ' '), lower(m.mention))
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, mention ORDER BY score, id) AS rn FROM cand
)
SELECT lp.l_orderkey, lp.l_linenumber, lp.l_partkey, lp.mention, o.id AS resolved_id
FROM lp LEFT JOIN ordered o ON o.l_orderkey = lp.l_orderkey AND o.mention = lp.mention AND o.rn = 1
""")
def q44_resolution_of_any_id(spark, sf_dir):
    """As q22 over ids beyond 10^12 and below zero."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    p = read(spark, sf_dir, "part").select("p_partkey", "p_name", F.expr(_ANY_ID).alias("id"))
    lp = li.join(p, li.l_partkey == p.p_partkey)
    mentions = lp.select("l_orderkey", "l_linenumber", "l_partkey",
                         F.regexp_extract("p_name", r"(\S+)\s*$", 1).alias("mention"))
    people = lp.select("l_orderkey", "id", "p_name")
    return resolve.resolve_mentions(mentions, people, "l_orderkey", "mention", "p_name", "id",
                                    partitions=partitions_for(li)).select(
        "l_orderkey", "l_linenumber", "l_partkey", "mention", "resolved_id")


# ------------------------------------------------------------------ q23
CANON_WORDS = ["red", "red-widget", "widget", "small", "small-gear", "gear", "blue", "old",
               "cold", "hot-rod", "rod", "large-anvil", "anvil", "new-bolt", "bolt"]


def _canon_sql():
    vals = ", ".join(f"('{w}')" for w in CANON_WORDS)
    return f"""
WITH w AS (SELECT * FROM (VALUES {vals}) AS t(word)),
hits AS (
  SELECT p.p_partkey, w.word,
         row_number() OVER (PARTITION BY p.p_partkey ORDER BY length(w.word) DESC, lower(w.word)) AS rn
  FROM part p JOIN w ON contains(lower(replace(p.p_name, ' ', '-')), lower(w.word))
)
SELECT p.p_partkey, replace(p.p_name, ' ', '-') AS slug, replace(h.word, '-', ' ') AS canonical
FROM part p LEFT JOIN hits h ON h.p_partkey = p.p_partkey AND h.rn = 1
"""


@register("q23_longest_contained_name", _canon_sql())
def q23_longest_contained_name(spark, sf_dir):
    """Canonical name = the longest listed name contained in the slug."""
    p = read(spark, sf_dir, "part").select(
        "p_partkey", F.regexp_replace("p_name", " ", "-").alias("slug"))
    return p.withColumn("canonical", text.canonical_team("slug", CANON_WORDS))
