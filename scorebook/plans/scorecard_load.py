"""End-to-end run over scorecard CSV trees: bronze -> silver -> star -> gold.

``run_load`` loads every match folder not yet loaded (all at once),
``build_gold`` brings the star tables, the marts and the audit up to date.
Paths are folders of the shared storage (HDFS / object store).
"""

from __future__ import annotations

from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fixed import PLAYERS_PER_MATCH
from ..operators import load
from ..session import concurrently, materialise, released, remove_path
from ..sources import catalog, readers, sinks
from ..sources.versions import Snapshot, StaleBuild, VersionedTables
from . import gold
from .match_summary import KEY, Assembly, assemble, write_load
from .q_clean import team_code_table
from .warehouse import Warehouse


def paths(warehouse: str) -> dict[str, str]:
    w = warehouse.rstrip("/")
    return {"master": f"{w}/silver/player_master", "silver": f"{w}/silver/match_summary",
            "ledger": f"{w}/silver/processed_matches", "quarantine": f"{w}/silver/quarantine",
            "malformed": f"{w}/silver/malformed_rows", "gold": f"{w}/gold", "stage": f"{w}/staging/match_summary"}


#: Folder names that a load turns into a condition on the files' paths.  Beyond them (a first
#: load) all folders are read and joined with the names instead; the rows are the same.
PATH_NAMES = 10_000


def run_load(spark: SparkSession, root: str, warehouse: str, load_id: str | None = None,
             expected_rows: int | None = PLAYERS_PER_MATCH,
             among: DataFrame | None = None) -> Assembly | None:
    """``load_new`` without leaving intermediate tables but the outcome of each match."""
    with released(spark):
        return load_new(spark, root, warehouse, load_id, expected_rows, among)


def load_new(spark: SparkSession, root: str, warehouse: str, load_id: str | None = None,
             expected_rows: int | None = PLAYERS_PER_MATCH,
             among: DataFrame | None = None) -> Assembly | None:
    """Load all match folders under ``root`` that the ledger does not list as loaded, nor
    as failed with the files they have now (of ``among``, if given), into the silver tables;
    None when there are none.

    Folders, lengths and times come from a listing without content; only the files of the
    folders to load are read, once, and their lines staged.  Lines that do not fit their
    part's columns are set aside, and their match goes to quarantine."""
    p = paths(warehouse)
    load_id = load_id or load.load_id_now(spark)
    files = readers.list_match_files(spark, root)
    available = readers.fingerprints(files)
    if among is not None:
        available = available.join(among.select(KEY).distinct(), KEY, "left_semi")
    chosen = materialise(load.new_matches(available, load.read_ledger(spark, p["ledger"]), KEY), "new_folders")
    some = [r[KEY] for r in chosen.select(KEY).limit(PATH_NAMES + 1).collect()]
    if not some:
        return None
    slugs = sorted(some) if len(some) <= PATH_NAMES else None
    master = publish_master(spark, root, warehouse)
    stage = f"{p['stage']}/{load.attempt_id(load_id)}"

    def staged(df: DataFrame, name: str) -> DataFrame:
        if slugs is None:
            df = df.join(chosen.select(KEY), KEY, "left_semi").select(df.columns)
        df.write.parquet(f"{stage}/{name}")
        return spark.read.schema(df.schema).parquet(f"{stage}/{name}")

    found = readers.read_match_files(spark, root, files.join(chosen, KEY, "left_semi"), slugs, staged)
    asm = assemble(found.sheet.drop("file"), found.batting.drop("file"), found.bowling.drop("file"),
                   found.venue.drop("file"), master, team_code_table(spark), load_id,
                   expected_rows=expected_rows, file_gates=found.file_gates(chosen), stage_path=stage)
    asm = write_load(asm, p["silver"], p["ledger"], p["quarantine"], load_id, chosen,
                     (found.malformed(), p["malformed"]))
    # The rows are in silver now: what the assembly staged is not read again.
    loaded = asm.matches.where(F.col("reason").isNull()).select(KEY)
    remove_path(spark, stage)
    try:
        rows = read_silver(spark, warehouse).join(loaded, KEY, "left_semi")
    except LookupError:  # no load has put a match into silver yet
        rows = spark.createDataFrame([], asm.summary.drop("reason").schema)
    return Assembly(summary=rows.withColumn("reason", F.lit(None).cast("string")), matches=asm.matches)


def read_silver(spark: SparkSession, warehouse: str) -> DataFrame:
    """The committed silver match summary; the partition column season stays text.

    The ledger is the commit record: only rows of the (match, attempt) it lists
    as loaded are read, so rows of an attempt that failed before its ledger write
    stay invisible, also when it is repeated under the same load id."""
    p = paths(warehouse)
    ledger = load.read_ledger(spark, p["ledger"])
    try:
        rows = spark.read.parquet(p["silver"])
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        raise LookupError(f"no match has been loaded into {p['silver']} yet") from e
    return (rows.withColumn("season", F.col("season").cast("string"))
            .join(load.committed(ledger, KEY), [KEY, "load_attempt"], "left_semi"))


def read_quarantine(spark: SparkSession, warehouse: str) -> DataFrame:
    """The committed quarantine: matches that failed a gate and have not been loaded
    since, with the reason of their latest attempt."""
    p = paths(warehouse)
    ledger = load.read_ledger(spark, p["ledger"])
    done = ledger.where(F.col("status") == "loaded").select(F.col("processed_match_details").alias(KEY))
    return (spark.read.parquet(p["quarantine"])
            .join(load.committed(ledger, KEY, "quarantined"), [KEY, "load_attempt"], "left_semi")
            .join(done, KEY, "left_anti"))


def read_malformed(spark: SparkSession, warehouse: str) -> DataFrame:
    """The lines set aside by the attempts that the ledger lists: match, part, file, line, reason."""
    p = paths(warehouse)
    tried = load.read_ledger(spark, p["ledger"]).select("load_attempt").distinct()
    return spark.read.parquet(p["malformed"]).join(tried, "load_attempt", "left_semi")


def master_tables(spark: SparkSession, warehouse: str) -> VersionedTables:
    return VersionedTables(spark, paths(warehouse)["master"])


def publish_master(spark: SparkSession, root: str, warehouse: str) -> DataFrame:
    """The player master of the CSV tree as a new version; readers of the last one keep it."""
    tables = master_tables(spark, warehouse)
    build = tables.begin()
    build.write("player_master", readers.read_master(spark, root), replace=True)
    try:
        build.publish()
    except StaleBuild:
        pass  # another load has published the master since: its version is read
    tables.prune()
    return tables.read("player_master")


def star_tables(spark: SparkSession, warehouse: str) -> VersionedTables:
    """Star tables and marts: read a table with ``.read(name)``."""
    return VersionedTables(spark, f"{paths(warehouse)['gold']}/star")


def build_gold(spark: SparkSession, warehouse: str, database: str | None = None,
               rebuild: bool = False, keep_unmatched: bool = False) -> dict[str, DataFrame]:
    """Bring star tables, marts and the audit up to date with the loads they do not hold.

    All of it is one version, published at the end: a build that fails leaves the last
    version as it is, and the next one starts from there, so keys once given stay.
    ``rebuild`` starts from nothing; ``keep_unmatched`` as in ``gold.update``, for a
    first build.  The marts are written as CSV too.  With ``database`` the tables are
    registered under names."""
    p = paths(warehouse)
    silver = read_silver(spark, warehouse)
    tables = star_tables(spark, warehouse)
    build = tables.begin(rebuild)
    ledger = load.committed(load.read_ledger(spark, p["ledger"]), KEY)
    # One name for each load since the last build.
    attempts = sorted(r["load_attempt"] for r in ledger.select("load_attempt").distinct().collect()
                      if r["load_attempt"] not in build.held.sources)
    with released(spark):
        if attempts or not build.has("dim_match_details"):
            gold.update(build, silver.where(F.col("load_attempt").isin(attempts)),
                        master_tables(spark, warehouse).read("player_master"), team_code_table(spark), attempts,
                        keep_unmatched=keep_unmatched)
        out = gold.mart_tables(build)
        concurrently(*[partial(sinks.write_csv_mart, df, f"{p['gold']}/{name}") for name, df in out.items()])
        keys = silver.select("match_type", "series_name", "season", "match_id").distinct().count()
        build.write("audit", gold.audit(build, keys), replace=True)
    out["audit"] = build.read("audit")
    held = build.publish()
    if database:
        register(spark, warehouse, database, held)
    tables.prune()
    w = Warehouse.from_silver(silver, master_tables(spark, warehouse).read("player_master"), team_code_table(spark))
    for name, attribute in gold.STAR.items():
        w.replace(attribute, build.read(name))
    out["warehouse"] = w
    return out


def register(spark: SparkSession, warehouse: str, database: str, held: Snapshot) -> list[str]:
    """The tables of a published version, silver, ledger and master under names."""
    p = paths(warehouse)
    tables, master = star_tables(spark, warehouse), master_tables(spark, warehouse)
    catalog.create_database(spark, database)
    for owner, names, version in ((tables, [*gold.STAR, "audit"], held),
                                  (master, ["player_master"], master.snapshot())):
        for name in names:
            catalog.register_parts(spark, database, name, f"{owner.base}/{name}", owner.read(name, version).schema,
                                   version.parts.get(name, []))
    return catalog.register_all(spark, database, {"match_summary": p["silver"], "processed_matches": p["ledger"]})
