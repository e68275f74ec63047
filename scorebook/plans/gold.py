"""Star tables and marts brought up to date load by load.

``update`` takes the silver rows of the loads that the written tables do not hold yet and
adds them to a ``Build``: what it reads and writes follows the new rows and the (season,
format) groups they fall in, not the history.

* Dimensions grow by an insert-only merge on their hash key: new members become a part, with
  keys after the largest.
* Facts grow by parts in the folders of the seasons and formats that got matches; other
  folders are not touched, and fact keys, once given, stay.  Their files are sorted by player
  and match, so a drill-through of one player reads few row groups.
* Marts are kept as sums and counts.  Those of the new rows are added to the ones held for the
  same groups; averages come from sum and count, and ranks are worked out anew in the groups
  that changed and in no others.

The row and null counts of the audit are taken as the tables are written.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators import marts, model, star
from ..session import WRITING, concurrently, materialise, partitioned_by_any, settings
from ..sources.versions import Build
from .warehouse import Warehouse

#: Star table -> attribute of ``Warehouse``.
DIMS = {
    "dim_match_type": "dmt", "dim_series_names_info": "dsn", "dim_seasons_info": "dss",
    "dim_match_details": "dmd", "dim_team_info": "dteam", "dim_player_details": "dpl",
    "dim_date": "ddate", "dim_toss_choice": "dtoss", "dim_venue_location": "dvl",
    "dim_stadium": "dstadium",
}
FACTS = {"fact_match_info": "fmi", "fact_batting_scorecard": "fbat", "fact_bowling_scorecard": "fbowl"}
STAR = DIMS | FACTS
FACT_KEYS = {"fact_match_info": "match_surrogate_key", "fact_batting_scorecard": "batting_scorecard_surrogate_key",
             "fact_bowling_scorecard": "bowling_scorecard_surrogate_key"}
FACT_FOLDERS = ["season", "match_type"]
#: Mart of matches per team -> the team's role.
WINS = {"format_wise_analysis": "toss_own_team_ref_key", "format_wise_winners": "match_own_team_ref_key"}


def within(df: DataFrame, columns: Sequence[str], groups: Sequence[tuple]) -> DataFrame:
    """The rows whose ``columns`` are one of ``groups``: seasons and formats, so a few
    hundred at most; on partition columns the other folders are not listed."""
    any_of = reduce(lambda x, y: x | y, [
        reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(columns, g)]) for g in groups],
        F.lit(False))
    return df.where(any_of)


def merge_dimension(build: Build, table: str, members: DataFrame, unknown: bool) -> None:
    """Add the members the table does not hold, known by the hash key (second column)."""
    key, hash_col, *rest = members.columns
    start = build.next.numbers.get(f"key {table}", 0) + 1
    first = not build.has(table)
    if first:
        new = members
    else:
        new = members.drop(key).join(build.read(table).select(hash_col), hash_col, "left_anti")
        new = model.assign_surrogate_keys(new, [*rest, hash_col], key, start)
    new = new.select(*members.columns)
    added = first and unknown
    n = build.write(table, star.with_unknown(new) if added else new) - int(added)
    if added:
        build.next.numbers["unknown members"] = 1
    build.next.numbers[f"key {table}"] = start - 1 + n


#: Bytes of written rows that a task reads (and sorts, where it writes a fact).
TASK_BYTES = 64 * 1024 * 1024


def in_folders(rows: DataFrame, name: str) -> DataFrame:
    """The rows of facts, written with their places.  They lie by season and format: few files for each
    folder, and many tasks for one that holds many rows; the facts are written from there as they lie."""
    return model.placed(rows.hint("rebalance", *FACT_FOLDERS), name)


def append_fact(build: Build, table: str, rows: DataFrame) -> None:
    """Add ``rows`` (``in_folders``) with keys after the largest given so far."""
    start = build.next.numbers.get(f"key {table}", 0) + 1
    keyed = model.assign_fact_keys(rows, FACT_KEYS[table], start)
    columns = [c for c in rows.columns if c not in (*FACT_FOLDERS, model.PLACE)]
    lookups = [c for c in ("player_ref_key", "match_ref_key") if c in columns]
    n = build.write(table, keyed.select(FACT_KEYS[table], *columns, *FACT_FOLDERS), FACT_FOLDERS, sort_by=lookups,
                    rebalance=False)
    build.next.numbers[f"key {table}"] = start - 1 + n


def add_to_state(build: Build, table: str, sums: DataFrame, folders: Sequence[str], groups: Sequence[tuple],
                 keys: Sequence[str]) -> DataFrame:
    """Add the sums and counts of ``sums`` to those held for its ``groups``, and give
    the sums of these groups back."""
    held = sums
    if build.has(table):
        held = within(build.read(table), folders, groups).unionByName(sums)
    kinds = dict(sums.dtypes)
    summed = held.groupBy(*keys).agg(*[F.sum(c).cast(kinds[c]).alias(c) for c in sums.columns if c not in keys])
    build.write(table, summed.select(*sums.columns), folders, replace=True)
    return within(build.read(table), folders, groups)


def update(build: Build, new: DataFrame, master: DataFrame, codes: DataFrame, sources: Sequence[str],
           styles: DataFrame | None = None, keep_unmatched: bool = False) -> None:
    """Add the silver rows ``new``, of the loads named ``sources``, to the tables of ``build``.

    ``styles`` maps a bowler's id to a bowling style (the player dimension, if not given).
    With ``keep_unmatched`` each dimension has an unknown member (key -1) and a match whose
    winner or player of the match no dimension holds (a tie) refers to it; without, it
    drops out of the match fact, as in an inner join."""
    spark = build.tables.spark
    with settings(spark, {**WRITING, "spark.sql.files.maxPartitionBytes": str(TASK_BYTES)}), partitioned_by_any(spark):
        add(build, new, master, codes, sources, styles, keep_unmatched)


def add(build: Build, new: DataFrame, master: DataFrame, codes: DataFrame, sources: Sequence[str],
        styles: DataFrame | None, keep_unmatched: bool) -> None:
    """``update`` in the session's settings."""
    season = F.col("season").cast("string").try_cast("int")
    found = Warehouse.from_silver(new, master, codes)
    # Tables that do not depend on each other are written side by side.
    concurrently(lambda: found.small, lambda: found.dteam, lambda: found.dpl)
    concurrently(*[partial(merge_dimension, build, table, getattr(found, attribute), keep_unmatched)
                   for table, attribute in DIMS.items()])
    dim = {attribute: build.read(table) for table, attribute in DIMS.items()}
    groups = sorted(tuple(r) for r in found.match_table.select("season", "match_type").distinct().collect()
                    if r["season"] is not None and r["match_type"] is not None)
    lookup = star.match_lookup(dim["dmd"], dim["dmt"], dim["dsn"], dim["dss"])
    lookup = within(lookup, ["__ss", "__mt"], groups)

    seen = Observation()
    watched = new.observe(seen, F.count(F.lit(1)).alias("rows"), F.count(F.when(season.isNull(), 1)).alias("lost"))
    folders = [season.alias("season"), F.col("match_type")]
    batting = marts.silver_rows(new, star.batting_measures(new))
    bowling = marts.silver_base(new, dim["dpl"], star.measures(star.BOWLING_MEASURES))
    styles = dim["dpl"].select("player_id", "bowling_style") if styles is None else styles
    # The marts' sums and counts; their folders are the facts', under the marts' names.
    where = ["season_key", "flag"]

    def match_tables():
        matches = star.fact_match_rows(found.match_table, dim["dmd"], dim["dpl"], dim["dteam"], dim["dtoss"], dim["ddate"],
                                       keep_unmatched, keep=FACT_FOLDERS)
        if build.has("fact_match_info"):
            old = within(build.read("fact_match_info"), FACT_FOLDERS, groups)
            matches = matches.join(old.select(*star.MATCH_REFS), star.MATCH_REFS, "left_anti")
        matches = in_folders(matches, "new_matches")
        append_fact(build, "fact_match_info", matches)
        pairs = materialise(marts.match_pairs(matches, dim["dmd"], dim["dmt"], dim["dss"], dim["dsn"], list(WINS.values())),
                            "match_pairs")
        for table, role in WINS.items():
            add_to_state(build, table, marts.team_counts(pairs, dim["dteam"], role), ["season", "flag"], groups, marts.WIN_GROUPS)

    def player_facts():
        rows = in_folders(star.fact_rows(watched, lookup, dim["dpl"], folders), "fact_rows")
        for table, columns in (("fact_batting_scorecard", star.BATTING_COLUMNS), ("fact_bowling_scorecard", star.BOWLING_COLUMNS)):
            append_fact(build, table, rows.select(*columns, *FACT_FOLDERS, model.PLACE))

    def batting_mart():
        totals = add_to_state(build, "batting_sums", marts.batting_sums(batting, dim["dpl"]), where, groups, marts.BATTING_GROUPS)
        build.write("batting_ranked", marts.ranked_batting(marts.batting_from_sums(totals)), where, replace=True)

    concurrently(
        player_facts, match_tables, batting_mart,
        lambda: add_to_state(build, "dismissal_styles", marts.dismissal_style_counts(batting, dim["dpl"], styles), where, groups,
                             [*marts.STYLE_GROUPS, "bowling_style"]),
        lambda: add_to_state(build, "bowling_sums", marts.bowling_totals(bowling), where, groups, marts.BOWLING_GROUPS))
    for name in ("rows", "lost"):
        build.next.numbers[f"silver {name}"] = build.next.numbers.get(f"silver {name}", 0) + seen.get[name]
    build.next.sources |= set(sources)


def mart_tables(build: Build, styles: DataFrame | None = None) -> dict[str, DataFrame]:
    """The marts as this build leaves them."""
    styles = build.read("dim_player_details").select("player_id", "bowling_style") if styles is None else styles
    pivot = marts.dismissal_style_pivot(build.read("dismissal_styles"), marts.style_list(styles))
    return {**{name: build.read(name) for name in WINS},
            "batting_analysis": marts.batting_mart_with_styles(build.read("batting_ranked"), pivot),
            "bowling_analysis": marts.bowled(build.read("bowling_sums"))}


def audit(build: Build, match_keys: int) -> DataFrame:
    """The checks of a build, one row each: name, value, expected (null: for information).
    All counts but the distinct ``match_keys`` of silver were taken as the tables were written."""
    held = build.next.numbers
    spare = int(held.get("unknown members", 0))
    silver = held.get("silver rows", 0)
    rows = [("silver rows", silver, None)]
    rows += [(f"{t} rows", held.get(f"rows {t}", 0), silver) for t in ("fact_batting_scorecard", "fact_bowling_scorecard")]
    rows.append(("dim_match_details rows", held.get("rows dim_match_details", 0) - spare, match_keys))
    rows.append(("silver rows without a season", held.get("silver lost", 0), 0))
    rows += [(f"{t} rows with a null", held.get(f"nulls {t}", 0), 0) for t in DIMS]
    return build.tables.spark.createDataFrame(rows, "check_name string, value long, expected long")
