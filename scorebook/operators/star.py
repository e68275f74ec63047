"""Star schema from the silver match summary: 10 dimensions, 3 facts.

Dimensions are small (their rows are distinct values of low-cardinality
columns) and written as tables, so the planner knows their size: a join to
one under the broadcast threshold leaves the fact where it is, and any other
is a shuffle join; no dimension is broadcast unchecked.  Facts are as large as
the summary: they join on natural columns, and hash keys are computed per match, not
per row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import DEFAULT_BATTING_STYLE, DEFAULT_BOWLING_STYLE, DEFAULT_DOB
from ..functions.keys import hash_key
from ..session import small_side
from .clean import one_row_per
from .model import assign_fact_keys, assign_surrogate_keys


# ------------------------------------------------------------------ dims

def match_rows(ms: DataFrame) -> DataFrame:
    """The distinct combinations of a match's attributes, under natural names: a few rows
    per match.  Dimensions, match fact and win counts are taken from these, so they run per
    match and not per player."""
    return ms.select(
        "match_type", "series_name", F.col("season").cast("string").try_cast("int").alias("season"), "match_id",
        F.col("player_of_the_match_player_id").try_cast("int").alias("player_of_the_match"),
        "team_1", "team_2", "toss_own_by", "own_team", "toss_choice",
        "match_day", "match_month", "match_year", "venue_id", "venue_location", "stadium").distinct()


SMALL_DIM_SETS = {
    "match_type": ["match_type"],
    "series_name": ["series_name"],
    "season": ["season"],
    "toss_choice": ["toss_choice"],
    "venue_location": ["venue_location"],
    "date": ["match_day", "match_month", "match_year"],
    "stadium": ["venue_id", "stadium", "venue_location"],
}


def small_dims(matches: DataFrame) -> dict[str, DataFrame]:
    """The seven dimensions of distinct silver values, from one scan of ``match_rows``.

    One GROUPING SETS aggregate (map-side partial aggregation, so only
    distinct values per task are shuffled) gives all value sets, and one pass
    numbers them, each set for itself in the order of its natural key.  Rows
    with a null natural key are left out (``audit.lost_rows`` reports them)."""
    cols = ["match_type", "series_name", "season", "toss_choice", "venue_location",
            "match_day", "match_month", "match_year", "venue_id", "stadium"]
    sets = list(SMALL_DIM_SETS.values())
    g = matches.select(*cols).groupingSets([[F.col(c) for c in st] for st in sets], *cols).agg(
        F.grouping_id().alias("gid"))
    # A set's number has a one for each column it does not group by.
    which = F.lit(None).cast("string")
    for name, st in SMALL_DIM_SETS.items():
        gid = int("".join("0" if c in st else "1" for c in cols), 2)
        which = F.when(F.col("gid") == gid, F.lit(name)).otherwise(which)
    values = g.select("*", which.alias("dim_set")).drop("gid")

    def of(per_set: dict[str, F.Column], kind: str) -> F.Column:
        out = F.lit(None).cast(kind)
        for name, value in per_set.items():
            out = F.when(F.col("dim_set") == name, value.cast(kind)).otherwise(out)
        return out

    number = lambda c: F.col(c).cast("string").try_cast("int")
    # A natural key as (number, text, number, text), in the order keys follow.
    keys = values.select(
        "dim_set",
        of({"season": number("season"), "date": number("match_year"),
            "stadium": number("venue_id")}, "int").alias("n1"),
        of({"match_type": F.col("match_type"), "series_name": F.col("series_name"),
            "toss_choice": F.col("toss_choice"), "venue_location": F.col("venue_location"),
            "date": F.col("match_month"), "stadium": F.col("stadium")}, "string").alias("t1"),
        of({"date": number("match_day")}, "int").alias("n2"),
        of({"stadium": F.when(F.col("venue_location").isNotNull(), hash_key("venue_location"))},
           "string").alias("t2")).distinct()
    whole = (F.when(F.col("dim_set") == "season", F.col("n1").isNotNull())
             .when(F.col("dim_set") == "date", F.col("n1").isNotNull() & F.col("t1").isNotNull()
                   & F.col("n2").isNotNull())
             .when(F.col("dim_set") == "stadium", F.col("n1").isNotNull() & F.col("t1").isNotNull()
                   & F.col("t2").isNotNull())
             .otherwise(F.col("t1").isNotNull()))
    keyed = assign_surrogate_keys(keys.where(whole), ["n1", "t1", "n2", "t2"], "key",
                                  groups=["dim_set"])

    def dim(name: str, key: str, hash_col: str, natural: list, hashed: list) -> DataFrame:
        return keyed.where(F.col("dim_set") == name).select(
            F.col("key").alias(key), hash_key(*hashed).alias(hash_col),
            *[F.col(c).alias(out) for c, out in natural])

    return {
        "match_type": dim("match_type", "match_type_surrogate_key", "match_type_hash_value",
                          [("t1", "match_type")], ["t1"]),
        "series_name": dim("series_name", "series_surrogate_key", "series_name_hash_value",
                           [("t1", "series_name")], ["t1"]),
        "season": dim("season", "season_surrogate_key", "season_hash_value",
                      [("n1", "season")], ["n1"]),
        "toss_choice": dim("toss_choice", "toss_surrogate_key", "toss_hash_value",
                           [("t1", "toss_choice")], ["t1"]),
        "venue_location": dim("venue_location", "venue_surrogate_key", "venue_hash_value",
                              [("t1", "venue_name")], ["t1"]),
        "date": dim("date", "date_surrogate_key", "date_hash_value",
                    [("n2", "match_date"), ("t1", "match_month"), ("n1", "match_year")],
                    ["n2", "t1", "n1"]),
        "stadium": dim("stadium", "stadium_surrogate_key", "stadium_hash_value",
                       [("n1", "stadium_id"), ("t1", "stadium_name"), ("t2", "venue_ref_key")],
                       ["n1", "t1", "t2"]),
    }


def dim_match_details(matches: DataFrame, dmt: DataFrame, dsn: DataFrame, dss: DataFrame) -> DataFrame:
    """One row per (type, series, season, match number) of ``match_rows``, referring to
    the three dimensions by their hash keys."""
    m = (matches.select("match_type", "series_name", "season", F.col("match_id").alias("match_number"))
         .dropDuplicates(["match_type", "series_name", "season", "match_number"]))
    # Numbered under the natural columns alone: hashes are worked out where the table is read or
    # written, and neither sorted nor moved.
    m = (m.join(dmt.select("match_type"), "match_type", "left_semi")
         .join(dsn.select("series_name"), "series_name", "left_semi")
         .join(dss.select("season"), "season", "left_semi"))
    natural = ["match_type", "series_name", "season", "match_number"]
    keyed = assign_surrogate_keys(m.select(*natural), natural, "match_surrogate_key")
    keyed = (keyed.join(dmt.select("match_type", F.col("match_type_hash_value").alias("match_type_ref_key")), "match_type")
             .join(dsn.select("series_name", F.col("series_name_hash_value").alias("series_name_ref_key")), "series_name")
             .join(dss.select("season", F.col("season_hash_value").alias("season_ref_key")), "season")
             .withColumn("match_details_hash_value", hash_key(*natural)))
    return keyed.select("match_surrogate_key", "match_details_hash_value", "match_number",
                        "match_type_ref_key", "series_name_ref_key", "season_ref_key")


def dim_team_info(codes: DataFrame, code_col: str = "Team_ID", name_col: str = "Team_Name") -> DataFrame:
    """Team dimension from the code table; the hash is of code and the raw
    name, the stored name is upper case with '-' as space."""
    src = codes.select(
        hash_key(code_col, name_col).alias("team_hash_value"),
        F.upper(F.regexp_replace(F.col(name_col), "-", " ")).alias("team_name"),
        F.col(code_col).cast("int").alias("team_code")).dropDuplicates(["team_code", "team_name"])
    keyed = assign_surrogate_keys(src, ["team_code", "team_name"], "team_surrogate_key")
    return keyed.select("team_surrogate_key", "team_hash_value", "team_name", "team_code")


def dim_player(master: DataFrame) -> DataFrame:
    """Player dimension with defaults; exactly one row per player id (the
    smallest by name, birth date and styles when the master holds several)."""
    m = master.select(
        F.col("player_id").try_cast("int").alias("player_id"),
        "player_first_name", "player_last_name",
        F.coalesce(F.col("player_DOB"), F.lit(DEFAULT_DOB)).alias("dob_text"),
        F.coalesce(F.col("batting_style"), F.lit(DEFAULT_BATTING_STYLE)).alias("batting_style"),
        F.coalesce(F.col("bowling_style"), F.lit(DEFAULT_BOWLING_STYLE)).alias("bowling_style"),
    )
    one = one_row_per(m, "player_id").select(
        hash_key("player_id").alias("player_hash_value"), "player_id",
        "player_first_name", "player_last_name",
        F.coalesce(F.try_to_date("dob_text"), F.to_date(F.lit(DEFAULT_DOB))).alias("date_of_birth"),
        "batting_style", "bowling_style")
    keyed = assign_surrogate_keys(one, ["player_id"], "player_surrogate_key")
    return keyed.select("player_surrogate_key", "player_hash_value", "player_id",
                        "player_first_name", "player_last_name", "date_of_birth",
                        "batting_style", "bowling_style")


# ----------------------------------------------------------------- facts

MATCH_REFS = ["match_ref_key", "toss_choice_ref_key", "match_date_ref_key",
              "player_of_the_match_ref_key", "team_1_ref_key", "team_2_ref_key",
              "toss_own_team_ref_key", "match_own_team_ref_key"]
#: Fact column, silver column, type (None: as in silver).
BATTING_MEASURES = [
    ("runs_scored", "runs_scored", "int"), ("ball_faced", "balls_faced", "int"),
    ("minutes_send", "minutes_send", "int"), ("fours_scored", "fours_count", "int"),
    ("sixes_scored", "six_count", "int"), ("strike_rate", "strike_rate", "double"),
    ("catch_taken", "catch_taken", "int")]
BOWLING_MEASURES = [
    ("over_bowled", "overs_bowled", None), ("maiden_over", "maiden_over", "int"),
    ("wickets_taken", "wickets_taken", "int"), ("economy", "economy", "double"),
    ("dots_balls_bowled", "dots_ball_bowled", "int"),
    ("fours_scored_batter", "fours_scored_by_batter", "int"),
    ("sixs_scored_batter", "six_scored_by_batter", "int"),
    ("wide_ball_count", "wide_ball", "int"), ("no_ball_count", "no_balls", "int"),
    ("runs_given", "runs_given", "int")]


def measures(which: list[tuple[str, str, str | None]]) -> list[F.Column]:
    return [(F.col(c).cast(kind) if kind else F.col(c)).alias(out) for out, c, kind in which]


def batting_measures(ms: DataFrame) -> list[F.Column]:
    """The measures of a batting row, with the bowler who dismissed the batter."""
    name = "dismissal" if "dismissal" in ms.columns else "outed_bowler_style"
    return [*measures(BATTING_MEASURES), F.col(name).alias("dimissial_player_name"),
            F.col("dismissal_bowler_id").cast("long").alias("dimissial_player_id")]


def fact_match_rows(matches: DataFrame, dmd: DataFrame, dpl: DataFrame, dteam: DataFrame,
                    dtoss: DataFrame, ddate: DataFrame, keep_unmatched: bool = False,
                    keep: Sequence[str] = ()) -> DataFrame:
    """Factless match fact without its own key, from ``match_rows``: one row per distinct
    combination of the match's references; the team dimension plays four roles.

    ``keep_unmatched=False`` keeps the inner-join meaning (a match whose
    winner or player of the match has no dimension row drops out);
    ``True`` keeps it with references to the dimensions' unknown member.
    ``keep`` are columns of ``match_rows`` to carry."""
    how = "left" if keep_unmatched else "inner"
    match_hash = "__mh" if keep_unmatched else "match_ref_key"
    m = matches.withColumns({
        match_hash: hash_key("match_type", "series_name", "season", "match_id"),
        "__dh": hash_key("match_day", "match_month", "match_year")})

    def referred(df, dim, key, hash_col, on, out):
        d = dim.select(F.col(key).alias(f"__{out}"), F.col(hash_col).alias(out))
        joined = df.join(small_side(d), df[on] == d[f"__{out}"], how).drop(f"__{out}")
        return joined.withColumn(out, F.coalesce(out, F.lit(UNKNOWN_HASH))) if keep_unmatched else joined

    if keep_unmatched:
        j = referred(m, dmd, "match_details_hash_value", "match_details_hash_value", "__mh", "match_ref_key")
    else:
        # The match's own hash is its reference: rows move to it once, and are made distinct there.
        j = m.join(dmd.select(F.col("match_details_hash_value").alias("match_ref_key")), "match_ref_key", "left_semi")
    j = referred(j, dpl, "player_id", "player_hash_value", "player_of_the_match", "player_of_the_match_ref_key")
    for col, out in (("team_1", "team_1_ref_key"), ("team_2", "team_2_ref_key"),
                     ("toss_own_by", "toss_own_team_ref_key"), ("own_team", "match_own_team_ref_key")):
        j = referred(j, dteam, "team_name", "team_hash_value", col, out)
    j = referred(j, dtoss, "toss_choice", "toss_hash_value", "toss_choice", "toss_choice_ref_key")
    j = referred(j, ddate, "date_hash_value", "date_hash_value", "__dh", "match_date_ref_key")
    return j.select(*MATCH_REFS, *keep).dropDuplicates()


#: Key and hash of the member that stands for whatever a dimension does not hold.
UNKNOWN_KEY, UNKNOWN_TEXT = -1, "UNKNOWN"
UNKNOWN_HASH = hashlib.md5(UNKNOWN_TEXT.encode()).hexdigest()


def with_unknown(dim: DataFrame) -> DataFrame:
    """``dim`` with its unknown member: key -1, hash and references of 'UNKNOWN',
    'UNKNOWN' in text columns, -1 in numbers, the default date."""
    key, hash_col, *_ = dim.columns

    def value(field):
        if field.name == hash_col or field.name.endswith("_ref_key"):
            return F.lit(UNKNOWN_HASH)
        kind = field.dataType.simpleString()
        return {"string": F.lit(UNKNOWN_TEXT), "date": F.to_date(F.lit(DEFAULT_DOB))}.get(
            kind, F.lit(UNKNOWN_KEY).cast(kind)).alias(field.name)

    member = dim.sparkSession.range(1).select(*[value(f).alias(f.name) for f in dim.schema.fields])
    return dim.unionByName(member)


def match_lookup(dmd: DataFrame, dmt: DataFrame, dsn: DataFrame, dss: DataFrame) -> DataFrame:
    """Natural key of a match -> its surrogate key: facts join on these four columns, so
    no MD5 is computed for each of their rows, and text of 32 characters is not shuffled."""
    return (dmd.select(F.col("match_surrogate_key").alias("match_ref_key"), F.col("match_number").alias("__mn"),
                       "match_type_ref_key", "series_name_ref_key", "season_ref_key")
            .join(dmt.select(F.col("match_type_hash_value").alias("match_type_ref_key"),
                             F.col("match_type_surrogate_key").alias("__mt_key"),
                             F.col("match_type").alias("__mt")), "match_type_ref_key")
            .join(dsn.select(F.col("series_name_hash_value").alias("series_name_ref_key"),
                             F.col("series_name").alias("__sn")), "series_name_ref_key")
            .join(dss.select(F.col("season_hash_value").alias("season_ref_key"),
                             F.col("season").alias("__ss")), "season_ref_key")
            .select("match_ref_key", F.col("__mt_key").alias("match_type_ref_key"), "__mt", "__sn", "__ss", "__mn"))


def _fact_refs(ms: DataFrame, matches: DataFrame, dpl: DataFrame) -> DataFrame:
    """``ms`` with the surrogate keys of match, format and player; ``matches`` is a ``match_lookup``."""
    players = dpl.select(F.col("player_id").alias("__pid"), F.col("player_surrogate_key").alias("player_ref_key"))
    j = ms.withColumns({"__season": F.col("season").cast("string").try_cast("int"),
                        "__pid": F.col("player_id").try_cast("int")})
    j = j.join(small_side(players), "__pid")
    return j.join(matches, (j.match_type == matches["__mt"]) & (j.series_name == matches["__sn"])
                  & (j["__season"] == matches["__ss"]) & j.match_id.eqNullSafe(matches["__mn"]))


FACT_REFS = ["match_ref_key", "match_type_ref_key", "player_ref_key"]


def fact_batting_rows(ms: DataFrame, matches: DataFrame, dpl: DataFrame, keep: Sequence[F.Column] = ()) -> DataFrame:
    return _fact_refs(ms, matches, dpl).select(*FACT_REFS, *batting_measures(ms), *keep)


def fact_bowling_rows(ms: DataFrame, matches: DataFrame, dpl: DataFrame, keep: Sequence[F.Column] = ()) -> DataFrame:
    return _fact_refs(ms, matches, dpl).select(*FACT_REFS, *measures(BOWLING_MEASURES), *keep)


def fact_rows(ms: DataFrame, matches: DataFrame, dpl: DataFrame, keep: Sequence[F.Column] = ()) -> DataFrame:
    """The rows of the batting and the bowling fact side by side: their references are the same, and
    are looked up once (``BATTING_COLUMNS``, ``BOWLING_COLUMNS``)."""
    return _fact_refs(ms, matches, dpl).select(*FACT_REFS, *batting_measures(ms), *measures(BOWLING_MEASURES), *keep)


BATTING_COLUMNS = [*FACT_REFS, *[out for out, _, _ in BATTING_MEASURES], "dimissial_player_name", "dimissial_player_id"]
BOWLING_COLUMNS = [*FACT_REFS, *[out for out, _, _ in BOWLING_MEASURES]]


def keyed_fact(rows: DataFrame, key_col: str) -> DataFrame:
    """A fact with its surrogate key first: dense and unique, in no order."""
    return assign_fact_keys(rows, key_col).select(key_col, *rows.columns)
