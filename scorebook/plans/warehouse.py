"""Silver -> star -> gold over the driver tables (the analogue of the scorecard
warehouse), built with the same operators as the scorecard pipeline.

The silver summary is written once to the shared scratch folder and read
back: every dimension and fact then scans a column-pruned parquet table
instead of re-running the seven-way join, and the lineage is cut there.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import marts, star
from ..session import materialise, scratch_path
from ..sources.sinks import write_table
from .analogue import read, summary


def player_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier as the player master: 'Supplier#000000012' -> first and last
    name; no birth date or styles (the dimension's defaults apply)."""
    s = read(spark, sf_dir, "supplier")
    parts = F.split("s_name", "#")
    return s.select(
        F.col("s_suppkey").cast("int").alias("player_id"),
        F.get(parts, 0).alias("player_first_name"),
        F.get(parts, 1).alias("player_last_name"),
        F.lit(None).cast("string").alias("player_DOB"),
        F.lit(None).cast("string").alias("country_representative"),
        F.lit(None).cast("string").alias("batting_style"),
        F.lit(None).cast("string").alias("bowling_style"))


def team_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation as the team code table."""
    return read(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("int").alias("Team_ID"), F.col("n_name").alias("Team_Name"))


def bowler_styles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part as the dismissing bowler, its type as the bowling style."""
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("player_id"), F.col("p_type").alias("bowling_style"))


class Warehouse:
    """Lazily built tables of one run; each is built once and reused.

    Built over the driver tables by default; pass ``silver``, ``master``,
    ``codes`` and ``styles`` to build it over a loaded scorecard silver table
    (see ``from_silver``)."""

    def __init__(self, spark: SparkSession, sf_dir: str | None = None,
                 materialize: bool = True, silver: DataFrame | None = None,
                 master: DataFrame | None = None, codes: DataFrame | None = None,
                 styles: DataFrame | None = None):
        self.spark, self.sf_dir, self.materialize = spark, sf_dir, materialize
        self._silver, self._master, self._codes, self._styles = silver, master, codes, styles

    @classmethod
    def from_silver(cls, silver: DataFrame, master: DataFrame, codes: DataFrame) -> "Warehouse":
        """Star schema and marts over a scorecard silver table; the dismissing
        bowler's style comes from the player dimension (one row per id, defaults
        applied), so every dismissal by a bowler counts once under some style."""
        w = cls(silver.sparkSession, silver=silver, master=master, codes=codes)
        w._styles = w.dpl.select("player_id", "bowling_style")
        return w

    @cached_property
    def ms(self) -> DataFrame:
        if self._silver is not None:
            return self._silver
        df = summary(self.spark, self.sf_dir)
        if not self.materialize:
            return df
        # a scratch copy read by column-pruned scans; the loaded silver table
        # of the scorecard load is the one partitioned by season and format
        path = scratch_path(self.spark, "silver_match_summary")
        write_table(df, path)
        return self.spark.read.parquet(path)

    SMALL = {"dmt": "match_type", "dsn": "series_name", "dss": "season", "ddate": "date",
             "dtoss": "toss_choice", "dvl": "venue_location", "dstadium": "stadium"}

    def replace(self, attribute: str, df: DataFrame) -> None:
        """Use the written table ``df`` from here on."""
        if attribute in self.SMALL:
            self.small[self.SMALL[attribute]] = df
        else:
            self.__dict__[attribute] = df

    @cached_property
    def small(self) -> dict[str, DataFrame]:
        """The seven small dimensions, from one scan."""
        return star.small_dims(self.match_table)

    @cached_property
    def match_table(self) -> DataFrame:
        """The attributes of matches, from one silver scan."""
        return materialise(star.match_rows(self.ms), "match_rows")

    @property
    def dmt(self):
        return self.small["match_type"]

    @property
    def dsn(self):
        return self.small["series_name"]

    @property
    def dss(self):
        return self.small["season"]

    @property
    def ddate(self):
        return self.small["date"]

    @property
    def dtoss(self):
        return self.small["toss_choice"]

    @property
    def dvl(self):
        return self.small["venue_location"]

    @property
    def dstadium(self):
        return self.small["stadium"]

    @cached_property
    def dmd(self):
        return star.dim_match_details(self.match_table, self.dmt, self.dsn, self.dss)

    @cached_property
    def dteam(self):
        codes = self._codes if self._codes is not None else team_codes(self.spark, self.sf_dir)
        return star.dim_team_info(codes)

    @cached_property
    def dpl(self):
        master = (self._master if self._master is not None
                  else player_master(self.spark, self.sf_dir))
        return star.dim_player(master)

    @cached_property
    def matches(self):
        """Natural key of a match -> surrogate key."""
        return star.match_lookup(self.dmd, self.dmt, self.dsn, self.dss)

    @cached_property
    def match_rows(self):
        return star.fact_match_rows(self.match_table, self.dmd, self.dpl, self.dteam, self.dtoss,
                                    self.ddate)

    @cached_property
    def batting_rows(self):
        return star.fact_batting_rows(self.ms, self.matches, self.dpl)

    @cached_property
    def bowling_rows(self):
        return star.fact_bowling_rows(self.ms, self.matches, self.dpl)

    # The facts as tables, with their own keys.
    @cached_property
    def fmi(self):
        return star.keyed_fact(self.match_rows, "match_surrogate_key")

    @cached_property
    def fbat(self):
        return star.keyed_fact(self.batting_rows, "batting_scorecard_surrogate_key")

    @cached_property
    def fbowl(self):
        return star.keyed_fact(self.bowling_rows, "bowling_scorecard_surrogate_key")

    # ------------------------------------------------------------ marts
    # From the silver rows and the one or two dimensions whose columns they show.
    @cached_property
    def batting_base(self):
        return marts.silver_base(self.ms, self.dpl, star.batting_measures(self.ms))

    @cached_property
    def bowling_base(self):
        return marts.silver_base(self.ms, self.dpl, star.measures(star.BOWLING_MEASURES))

    @cached_property
    def styles(self):
        return self._styles if self._styles is not None else bowler_styles(self.spark, self.sf_dir)

    def win_count(self, team_ref="toss_own_team_ref_key", count_name="match_win_count"):
        return marts.win_counts(marts.whole_matches(star.match_rows(self.ms), self.dpl, self.dteam, team_ref), count_name)

    def dismissal_pivot(self):
        rows = marts.silver_rows(self.ms, star.batting_measures(self.ms))
        return marts.dismissal_style_pivot(marts.dismissal_style_counts(rows, self.dpl, self.styles),
                                           marts.style_list(self.styles))

    def batting(self):
        return marts.batting_mart(self.batting_base)

    def batting_with_styles(self):
        return marts.batting_mart_with_styles(self.batting(), self.dismissal_pivot())

    def bowling(self):
        return marts.bowling_mart(self.bowling_base)
