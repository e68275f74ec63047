"""Readers for the scorecard CSV trees, with declared schemas.

Every part is one scan over all match folders at once (a path glob), with
the match folder taken from ``_metadata.file_path``.  Which folders are there
is known from file names alone; a load then reads the files of new folders only.
Measures are read as text and cast safely later, so '-' and '4.3' behave the same in
every file.  Header lines are read as rows and compared with the declared columns, and
lines with too few or too many fields are set aside (``MatchFiles.malformed``): a file
with its columns in another order is reported, not read under wrong names.

Layout under ``root``::

  players-details/<batch>/<file>                              (no header)
  match-details/batting-scorecard/<match>/scorecard/batting*  (header)
  match-details/bowling-scorecard/<match>/scorecard/bowling*  (header)
  match-details/team-details/<match>/player*.csv              (header, one)
  match-details/venue-details/<match>/<stadium>-<state>-<id>.csv (header, one)
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fixed import BATTING_COLUMNS, BOWLING_COLUMNS

S = T.StringType()

MASTER_SCHEMA = T.StructType([
    T.StructField("ID", T.IntegerType()), T.StructField("First_name", S),
    T.StructField("Last_name", S), T.StructField("DOB", S),
    T.StructField("Playing_type", S), T.StructField("Country_code", T.IntegerType())])
BATTING_SCHEMA = T.StructType([T.StructField(c, S) for c in BATTING_COLUMNS])
BOWLING_SCHEMA = T.StructType([T.StructField(c, S) for c in BOWLING_COLUMNS])
SHEET_SCHEMA = T.StructType([T.StructField("player_name", S), T.StructField("player_id", S),
                             T.StructField("captain_flag", S)])
VENUE_SCHEMA = T.StructType([T.StructField(c, S) for c in [
    "Toss", "Series", "Season", "Player_Of_The_Match", "Match_number", "Match_date", "Points"]])


#: Part -> (tree, path below the match folder, how a file of it is named).
PARTS = {
    "team sheet": ("team-details", "*.csv", "player"),
    "venue": ("venue-details", "*.csv", ""),
    "batting": ("batting-scorecard", "scorecard/*", "batting"),
    "bowling": ("bowling-scorecard", "scorecard/*", "bowling"),
}
_TREES = "|".join(tree for tree, _, _ in PARTS.values())


#: The header line of each part's files.
HEADERS = {
    "team sheet": ["PLAYER_NAME", "PLAYER_ID", "CAPTAIN_FLAG"],
    "venue": ["TOSS", "SERIES", "SEASON", "PLAYER_OF_THE_MATCH", "MATCH_NUMBER", "MATCH_DATE", "POINTS"],
    "batting": ["PLAYER_NAME", "DISMISSAL", "RUNS_SCORED", "BALL_FACED", "MINUTES_SEND", "FOURS_SCORED",
                "SIXES_SCORED", "STRIKE_RATE"],
    "bowling": ["PLAYER_NAME", "OVERS_BOWLED", "MAIDEN_OVER", "RUNS_GIVEN", "WICKETS_TAKEN", "ECONOMY",
                "DOT_BALLS", "FOURS_GIVEN", "SIXES_GIVEN", "WIDE_BALLS", "NO_BALLS"],
}
CORRUPT = "_corrupt"


def _csv(spark: SparkSession, schema: T.StructType, glob: str) -> DataFrame:
    return (spark.read.schema(schema).option("header", False).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT).option("recursiveFileLookup", False).csv(glob))


def slug_of(path: F.Column) -> F.Column:
    """The match folder of a file's path."""
    return F.regexp_extract(path, rf"/match-details/(?:{_TREES})/([^/]+)/", 1)


def tree_of(path: F.Column) -> F.Column:
    """The tree of a match file's path."""
    return F.regexp_extract(path, rf"/match-details/({_TREES})/", 1)


def _match_csv(spark: SparkSession, schema: T.StructType, root: str, part: str,
               slugs: Sequence[str] | None) -> DataFrame:
    """One scan of a part's files, header lines and malformed lines (``_corrupt``) included.
    With ``slugs`` only those folders: the condition is on the file's path alone, so Spark
    drops the other files before it reads any."""
    tree, below, prefix = PARTS[part]
    path = F.col("_metadata.file_path")
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, S)])
    df = _csv(spark, with_corrupt, f"{root}/match-details/{tree}/*/{below}")
    if slugs is not None:
        df = df.where(slug_of(path).isin(list(slugs)))
    df = df.select("*", slug_of(path).alias("match_slug"), F.col("_metadata.file_name").alias("file"))
    return df.where(F.lower("file").startswith(prefix)) if prefix else df


def _token(c: str) -> F.Column:
    return F.upper(F.trim(F.regexp_replace(F.col(c), "^\ufeff", "")))


def header_line(part: str, columns: Sequence[str]) -> F.Column:
    """Whether a line consists of header names alone, in whatever order and number."""
    names = HEADERS[part]
    known = [_token(c).isNull() | _token(c).isin(names) for c in columns]
    return reduce(lambda x, y: x & y, known, _token(columns[0]).isNotNull())


def right_header(part: str, columns: Sequence[str]) -> F.Column:
    """Whether a line is the part's header, column for column."""
    same = [_token(c).eqNullSafe(F.lit(n)) for c, n in zip(columns, HEADERS[part])]
    return reduce(lambda x, y: x & y, same, F.col(CORRUPT).isNull())


def list_match_files(spark: SparkSession, root: str) -> DataFrame:
    """(match_slug, part, file, length, modified) of every match file that is not without
    a byte, from the listing alone: no content is read."""
    found = None
    for part, (tree, below, prefix) in PARTS.items():
        glob = f"{root}/match-details/{tree}/*/{below}"
        try:
            files = spark.read.format("binaryFile").load(glob).select("path", "length", "modificationTime")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue  # no match has a file of this part yet
        name = F.element_at(F.split("path", "/"), -1)
        files = files.where(F.lower(name).startswith(prefix)) if prefix else files
        files = files.select(slug_of(F.col("path")).alias("match_slug"), F.lit(part).alias("part"),
                             name.alias("file"), "length", F.col("modificationTime").alias("modified"))
        found = files if found is None else found.unionByName(files)
    if found is None:
        return spark.createDataFrame([], "match_slug string, part string, file string, length long, modified timestamp")
    return found


def fingerprints(files: DataFrame) -> DataFrame:
    """(match_slug, fingerprint): changes when a file of the match is added, removed or
    written anew."""
    each = F.xxhash64("part", "file", "length", "modified")
    return files.groupBy("match_slug").agg(F.xxhash64(F.sort_array(F.collect_set(each))).alias("fingerprint"))


def read_master(spark: SparkSession, root: str) -> DataFrame:
    """Player master: 'bat,bowl' split into two styles; country code kept."""
    m = spark.read.schema(MASTER_SCHEMA).option("mode", "PERMISSIVE").csv(f"{root}/players-details/*/*")
    parts = F.split("Playing_type", ",")
    return m.select(
        F.col("ID").alias("player_id"), F.trim("First_name").alias("player_first_name"),
        F.trim("Last_name").alias("player_last_name"), F.trim("DOB").alias("player_DOB"),
        F.col("Country_code").alias("country_representative"),
        F.trim(F.get(parts, 0)).alias("batting_style"),
        F.trim(F.get(parts, 1)).alias("bowling_style"))


@dataclass
class MatchFiles:
    files: DataFrame  # (match_slug, part, file, ..) from the listing alone
    lines: dict[str, DataFrame]  # every line of a part's files, with its kind

    def rows(self, part: str) -> DataFrame:
        """The rows of a part that fit its columns."""
        df = self.lines[part].where(F.col("kind") == "row").drop("kind", CORRUPT)
        return df.withColumn("venue_file", F.col("file")) if part == "venue" else df

    batting = property(lambda self: self.rows("batting"))
    bowling = property(lambda self: self.rows("bowling"))
    sheet = property(lambda self: self.rows("team sheet"))
    venue = property(lambda self: self.rows("venue"))

    def malformed(self) -> DataFrame:
        """(match_slug, part, file, record, reason) of the lines that are no rows."""
        parts = [df.where(F.col("kind").isin("malformed", "other header")).select(
            "match_slug", F.lit(part).alias("part"), "file", F.coalesce(CORRUPT, F.concat_ws(",", *df.columns[:-4]))
            .alias("record"), F.when(F.col("kind") == "malformed", F.lit("wrong number of fields or open quote"))
            .otherwise(F.lit("unexpected header")).alias("reason")) for part, df in self.lines.items()]
        return reduce(DataFrame.unionByName, parts)

    def file_gates(self, available: DataFrame) -> DataFrame:
        """Per match: the first missing, duplicated, empty or malformed part, or null."""
        from ..operators import load

        def named(part):
            return self.files.where(F.col("part") == part).select("match_slug", "file")

        rows = {p: self.rows(p) for p in PARTS}
        filled = {p: df if p == "venue" else df.filter(F.col("player_name").isNotNull())
                  for p, df in rows.items()}
        out = load.presence_gates(available, "match_slug", [
            (p, named(p), filled[p], p in ("team sheet", "venue")) for p in rows
        ]).select("match_slug", "reason")
        for part, df in self.lines.items():
            of_file = df.groupBy("match_slug", "file").agg(
                F.count(F.when(F.col("kind") == "header", 1)).alias("good"),
                F.count(F.when(F.col("kind") == "other header", 1)).alias("other"),
                F.count(F.when(F.col("kind") == "malformed", 1)).alias("bad"))
            faults = of_file.groupBy("match_slug").agg(
                F.max((F.col("other") > 0) | (F.col("good") != 1)).alias("header"), F.max(F.col("bad") > 0).alias("bad"))
            out = out.join(faults, "match_slug", "left").select("match_slug", F.coalesce(
                "reason", F.when(F.col("header"), F.lit(f"unexpected {part} header")),
                F.when(F.col("bad"), F.lit(f"malformed {part} rows"))).alias("reason"))
        return out


def read_match_files(spark: SparkSession, root: str, files: DataFrame | None = None,
                     slugs: Sequence[str] | None = None,
                     stage: Callable[[DataFrame, str], DataFrame] = lambda df, name: df) -> MatchFiles:
    """The lines of the match folders ``slugs`` (all, if not given).  ``stage(df, name)`` may
    write the lines of a part once and give them back."""
    files = list_match_files(spark, root) if files is None else files

    def read(part, schema):
        columns = schema.fieldNames()
        try:
            df = _match_csv(spark, schema, root, part, slugs)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            # a part that no match has yet is an empty table
            df = spark.createDataFrame([], T.StructType(
                [*schema.fields, *[T.StructField(c, S) for c in (CORRUPT, "match_slug", "file")]]))
        kind = (F.when(right_header(part, columns), F.lit("header"))
                .when(header_line(part, columns), F.lit("other header"))
                .when(F.col(CORRUPT).isNotNull(), F.lit("malformed")).otherwise(F.lit("row")))
        return stage(df.withColumn("kind", kind), f"bronze-{part.replace(' ', '-')}")

    schemas = {"team sheet": SHEET_SCHEMA, "venue": VENUE_SCHEMA, "batting": BATTING_SCHEMA,
               "bowling": BOWLING_SCHEMA}
    return MatchFiles(files=files, lines={p: read(p, schema) for p, schema in schemas.items()})
