"""Gold marts over the star schema.

Each mart is a grouped aggregate with map-side partial aggregation over a base: a fact
joined to a handful of written dimensions (``star_base``), or the silver rows joined to
the player dimension alone (``silver_base``), which gives the same rows without keys
that the mart drops again.  The batting mart's aggregate is
written once; its four ranks are computed together from it, over distinct
values cut into ranges, so no group is ranked in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import overs_to_balls
from ..session import materialise, small_side


WIN_GROUPS = ["season", "series_name", "team_name", "flag", "team_code"]


def win_count_mart(fmi: DataFrame, dmd: DataFrame, dmt: DataFrame, dss: DataFrame,
                   dsn: DataFrame, dteam: DataFrame, team_ref: str = "toss_own_team_ref_key",
                   count_name: str = "match_win_count") -> DataFrame:
    """Matches per season, series, team and format, from the star tables.

    ``team_ref`` = 'toss_own_team_ref_key' is the source pipeline's count
    (keyed on the toss owner although named for wins);
    'match_own_team_ref_key' counts wins."""
    pairs = match_pairs(fmi, dmd, dmt, dss, dsn, [team_ref])
    return team_counts(pairs, dteam, team_ref, count_name)


def match_pairs(fmi: DataFrame, dmd: DataFrame, dmt: DataFrame, dss: DataFrame, dsn: DataFrame,
                team_refs: Sequence[str]) -> DataFrame:
    """Matches per season, series, format and the teams in the roles ``team_refs`` (by their
    references): counted once for all roles, so that matches meet their dimension once."""
    j = (fmi.select("match_ref_key", *team_refs)
         .join(dmd.select(F.col("match_details_hash_value").alias("match_ref_key"),
                          "match_type_ref_key", "season_ref_key", "series_name_ref_key"),
               "match_ref_key")
         .join(dmt.select(F.col("match_type_hash_value").alias("match_type_ref_key"),
                          F.col("match_type").alias("flag")), "match_type_ref_key")
         .join(dss.select(F.col("season_hash_value").alias("season_ref_key"), "season"),
               "season_ref_key")
         .join(dsn.select(F.col("series_name_hash_value").alias("series_name_ref_key"),
                          "series_name"), "series_name_ref_key"))
    return j.groupBy("season", "series_name", "flag", *team_refs).agg(F.count(F.lit(1)).alias("__n"))


def team_counts(pairs: DataFrame, dteam: DataFrame, team_ref: str, count_name: str = "match_win_count") -> DataFrame:
    """Matches per ``WIN_GROUPS`` from ``match_pairs``, for the team in the role ``team_ref``."""
    j = pairs.join(dteam.select(F.col("team_hash_value").alias(team_ref), "team_name", "team_code"), team_ref)
    return j.groupBy(*WIN_GROUPS).agg(F.sum("__n").alias(count_name))


#: Role of a team in a match -> column of the silver table.
TEAM_ROLES = {"team_1_ref_key": "team_1", "team_2_ref_key": "team_2",
              "toss_own_team_ref_key": "toss_own_by", "match_own_team_ref_key": "own_team"}


def whole_matches(matches: DataFrame, dpl: DataFrame, dteam: DataFrame,
                  team_ref: str = "toss_own_team_ref_key") -> DataFrame:
    """The match fact's rows (of ``match_rows``) under natural names, with the team in the role
    ``team_ref``: no dimension is keyed that the marts drop again.  As in the fact, a match
    counts if the dimensions hold all its references."""
    number = lambda c: F.col(c).cast("string").try_cast("int")
    m = matches.drop("venue_id", "venue_location", "stadium").distinct()
    m = m.dropna(subset=["match_type", "series_name", "season", "toss_choice", "match_month"])
    m = m.where(number("match_day").isNotNull() & number("match_year").isNotNull())
    m = m.join(dpl.select(F.col("player_id").alias("player_of_the_match")), "player_of_the_match")
    for role, col in TEAM_ROLES.items():
        own = ["team_code"] if role == team_ref else []
        t = dteam.select(F.col("team_name").alias("__name"), *own)
        m = m.join(t, m[col] == t["__name"])
        m = m.withColumnRenamed("__name", "team_name") if own else m.drop("__name")
    return m.withColumn("flag", F.col("match_type"))


def win_counts(matches: DataFrame, count_name: str = "match_win_count") -> DataFrame:
    """``win_count_mart`` over ``whole_matches``."""
    return matches.groupBy(*WIN_GROUPS).agg(F.count(F.lit(1)).alias(count_name))


def star_base(fact: DataFrame, dpl: DataFrame, dmt: DataFrame, dmd: DataFrame,
              dss: DataFrame) -> DataFrame:
    """A fact with player name, format and season from the star tables."""
    return (fact
            .join(dpl.select(F.col("player_surrogate_key").alias("player_ref_key"),
                             player_name().alias("player_name")), "player_ref_key")
            .join(dmt.select(F.col("match_type_surrogate_key").alias("match_type_ref_key"),
                             F.col("match_type").alias("flag")), "match_type_ref_key")
            .join(dmd.select(F.col("match_surrogate_key").alias("match_ref_key"),
                             "season_ref_key"), "match_ref_key")
            .join(dss.select(F.col("season_hash_value").alias("season_ref_key"),
                             F.col("season").alias("season_key")), "season_ref_key"))


def player_name() -> F.Column:
    return F.concat_ws("-", "player_first_name", "player_last_name")


def silver_base(ms: DataFrame, dpl: DataFrame, columns: Sequence[F.Column]) -> DataFrame:
    """As ``star_base`` from the silver table: format and season are its own columns, so only
    the player dimension is joined.  Rows that no fact can hold are left out here too."""
    return named(silver_rows(ms, columns), dpl).drop("__pid")


def silver_rows(ms: DataFrame, columns: Sequence[F.Column]) -> DataFrame:
    """The rows of ``silver_base`` with the player's id (``__pid``) alone."""
    rows = ms.select(F.col("player_id").try_cast("int").alias("__pid"), F.col("match_type").alias("flag"),
                     F.col("season").cast("string").try_cast("int").alias("season_key"), "series_name", *columns)
    return rows.dropna(subset=["flag", "season_key", "series_name"]).drop("series_name")


def named(rows: DataFrame, dpl: DataFrame) -> DataFrame:
    """``rows`` with key and name of the player ``__pid``; those of unknown players drop out."""
    players = dpl.select(F.col("player_id").alias("__pid"), F.col("player_surrogate_key").alias("player_ref_key"),
                         player_name().alias("player_name"))
    return rows.join(small_side(players), "__pid")


def style_list(bowler_styles: DataFrame) -> list[str]:
    """The styles of the bowler table in order: the columns of the pivot."""
    found = bowler_styles.select(F.lower("bowling_style").alias("s")).distinct()
    return sorted(r["s"] for r in found.where(F.col("s").isNotNull()).collect())


STYLE_GROUPS = ["season_key", "player_name", "player_ref_key", "flag"]


def dismissal_style_counts(rows: DataFrame, dpl: DataFrame, bowler_styles: DataFrame) -> DataFrame:
    """Long form of the pivot, for any number of styles: dismissals per player, format, season and
    style of the dismissing bowler, from ``silver_rows``.  They are counted per player's id, and
    names join the counts, so that no name moves with a dismissal."""
    lk = small_side(bowler_styles.select(F.col("player_id").alias("dimissial_player_id"),
                                         F.lower("bowling_style").alias("bowling_style")))
    counts = (rows.select("__pid", "flag", "season_key", "dimissial_player_id")
              .filter(F.col("dimissial_player_id") != 0).join(lk, "dimissial_player_id")
              .groupBy("__pid", "flag", "season_key", "bowling_style").agg(F.count(F.lit(1)).alias("dismissals")))
    return named(counts, dpl).select(*STYLE_GROUPS, "bowling_style", "dismissals")


def dismissal_style_pivot(counts: DataFrame, styles: Sequence[str]) -> DataFrame:
    """Count of a batter's dismissals by the dismissing bowler's style, from
    ``dismissal_style_counts``; rows with bowler id 0 (not dismissed by a bowler) are left
    out there.  ``styles`` are the columns (``style_list`` of the bowler table)."""
    p = counts.groupBy(*STYLE_GROUPS).pivot("bowling_style", list(styles)).agg(F.sum("dismissals"))
    return p.fillna(0, subset=list(styles))


RANKS = [("total_runs", "runs_rank"), ("avg_strike_rate", "strike_rate_rank"),
         ("total_fours", "fours_rank"), ("total_sixes", "sixes_rank")]


BATTING_GROUPS = ["player_name", "player_ref_key", "flag", "season_key"]


def batting_totals(base: DataFrame) -> DataFrame:
    """Batting totals per player, format and season."""
    return base.groupBy(*BATTING_GROUPS).agg(
        F.sum("runs_scored").alias("total_runs"),
        F.sum("fours_scored").alias("total_fours"),
        F.sum("sixes_scored").alias("total_sixes"),
        F.sum("catch_taken").alias("total_catch_taken"),
        F.avg("strike_rate").alias("avg_strike_rate"),
        # over batters who faced a ball; null for those who never did
        F.avg(F.when(F.col("ball_faced") > 0, F.col("strike_rate"))).alias("avg_strike_rate_faced"))


def batting_sums(rows: DataFrame, dpl: DataFrame) -> DataFrame:
    """``batting_totals`` of ``silver_rows`` as sums and counts, which can be added up over loads;
    players are named once they are summed."""
    faced = F.col("ball_faced") > 0
    sums = rows.groupBy("__pid", "flag", "season_key").agg(
        F.sum("runs_scored").alias("total_runs"),
        F.sum("fours_scored").alias("total_fours"),
        F.sum("sixes_scored").alias("total_sixes"),
        F.sum("catch_taken").alias("total_catch_taken"),
        F.sum("strike_rate").alias("strike_rate_sum"), F.count("strike_rate").alias("strike_rate_rows"),
        F.sum(F.when(faced, F.col("strike_rate"))).alias("faced_sum"),
        F.count(F.when(faced, F.col("strike_rate"))).alias("faced_rows"))
    return named(sums, dpl).select(*BATTING_GROUPS, *[c for c in sums.columns if c not in ("__pid", "flag", "season_key")])


def batting_from_sums(sums: DataFrame) -> DataFrame:
    """``batting_totals`` from ``batting_sums``."""
    mean = lambda total, rows: F.when(F.col(rows) > 0, F.col(total) / F.col(rows))
    return sums.select(*BATTING_GROUPS, "total_runs", "total_fours", "total_sixes", "total_catch_taken",
                       mean("strike_rate_sum", "strike_rate_rows").alias("avg_strike_rate"),
                       mean("faced_sum", "faced_rows").alias("avg_strike_rate_faced"))


def batting_mart(base: DataFrame) -> DataFrame:
    """Batting totals per player, format and season with four ranks."""
    return ranked_batting(batting_totals(base))


def ranked_batting(totals: DataFrame) -> DataFrame:
    return add_ranks(materialise(totals, "batting_totals"), ["season_key", "flag"],
                     ["player_name", "player_ref_key"], RANKS)


def add_ranks(df: DataFrame, groups: list[str], rest: list[str],
              ranks: Sequence[tuple[str, str]]) -> DataFrame:
    """Add, for each (value, out) of ``ranks``, out = RANK() OVER (PARTITION BY groups
    ORDER BY value DESC), nulls last.  ``df`` must be a written table whose rows are
    known by ``groups`` + ``rest``.

    rank(v) = 1 + rows of the group with a greater value.  Rows are counted per
    (measure, group, value); these counts are cut into ranges of the whole order and
    written with their range; a running total within a range and the totals of the ranges
    before it give the rank.  So neither a large group nor a value that many rows share
    meets in one task.  The ranks go back to the very values they were counted from."""
    def longs(df):
        return df.select(*groups, *rest, F.explode(F.array(*[
            F.struct(F.lit(out).alias("measure"), F.col(value).cast("double").alias("value"))
            for value, out in ranks])).alias("m")).select(*groups, *rest, "m.*")

    keys = ["measure", *groups]
    counts = longs(df).groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
    order = [*[F.col(k) for k in keys], F.col("value").desc_nulls_last()]
    cut = materialise(counts.repartitionByRange(*order).withColumn("range", F.spark_partition_id()),
                      "rank_counts")
    # One row for each range and group in it.
    totals = cut.groupBy(*keys, "range").agg(F.sum("n").alias("t"))
    before = Window.partitionBy(*keys).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "range", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("off"))
    within = (Window.partitionBy("range", *keys).orderBy(F.col("value").desc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in [*keys, "range"]]
    table = (cut.withColumn("up", F.coalesce(F.sum("n").over(within), F.lit(0))).alias("a")
             .join(offsets.alias("b"), same)
             .select(*[F.col(f"a.{k}").alias(f"__{k}") for k in keys], F.col("a.value").alias("__value"),
                     (F.lit(1) + F.col("up") + F.col("off")).cast("int").alias("rank")))
    met = longs(df).join(table, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in [*keys, "value"]])
    back = met.groupBy(*groups, *rest).agg(*[
        F.max(F.when(F.col("measure") == out, F.col("rank"))).alias(out) for _, out in ranks])
    back = back.select(*[F.col(c).alias(f"__{c}") for c in [*groups, *rest]], *[out for _, out in ranks])
    return (df.join(back, [df[c].eqNullSafe(back[f"__{c}"]) for c in [*groups, *rest]])
            .drop(*[f"__{c}" for c in [*groups, *rest]]))


def batting_mart_with_styles(bat: DataFrame, piv: DataFrame) -> DataFrame:
    """Batting mart left-joined with the dismissal pivot; missing counts -> 0."""
    keys = ["player_ref_key", "season_key", "flag", "player_name"]
    style_cols = [c for c in piv.columns if c not in keys]
    return bat.join(piv, on=keys, how="left").fillna(0, subset=style_cols)


BOWLING_SUMS = [
    ("over_bowled", "total_bowled_overs"),
    ("maiden_over", "total_maiden_bowled_overs"),
    ("economy", "Economy"),
    ("dots_balls_bowled", "total_dot_bowled"),
    ("fours_scored_batter", "fours_given"),
    ("sixs_scored_batter", "six_given"),
    ("wide_ball_count", "total_wide_balls_bowled"),
    ("no_ball_count", "total_no_balls_bowled"),
    ("runs_given", "total_runs_given"),
]


BOWLING_GROUPS = ["Player_name", "flag", "season_key"]


def bowling_totals(base: DataFrame) -> DataFrame:
    """Bowling totals per player name, format and season, and balls bowled (overs
    notation turned into balls)."""
    return base.withColumnRenamed("player_name", "Player_name").groupBy(*BOWLING_GROUPS).agg(
        *[F.sum(src).alias(out) for src, out in BOWLING_SUMS],
        F.sum("wickets_taken").alias("total_wickets"),
        F.sum(overs_to_balls("over_bowled")).alias("total_balls_bowled"))


def bowled(totals: DataFrame) -> DataFrame:
    """The rows of ``bowling_totals`` that are not all zero (players who did bowl), with
    the runs given per over."""
    keep = reduce(lambda x, y: x | y, [F.col(out) != 0 for _, out in BOWLING_SUMS])
    return totals.filter(keep).withColumn(
        "runs_per_over", F.when(F.col("total_balls_bowled") > 0,
                                F.col("total_runs_given") * F.lit(6.0) / F.col("total_balls_bowled")))


def bowling_mart(base: DataFrame) -> DataFrame:
    return bowled(bowling_totals(base))
