"""Tables published by version: write-once parts and an append-only log.

Nothing is ever overwritten or deleted to publish.  A build

1. *begins* a version: one small file in the log, under a name no other build has;
2. writes its rows as *parts*, folders that carry the version's name
   (``<table>/[<partition>=<value>/..]version=<name>``);
3. *publishes*: one more file in the log, which names every part that is current, of this
   version and of the ones before.  A single file appears whole or not at all, so
   this is the commit: a build that dies earlier leaves parts that nothing names.

Readers take the newest published version and see the parts it names and no others, so
tables of one version belong together, also while a build writes the next.  ``prune`` removes
what the newest ``keep`` versions do not name; until then readers of older ones are
served.

A log that is lost must not be taken for a first run, or keys would be given out anew:
``begin`` raises if there are parts of versions that the log does not know.  Two builds
at a time do not lose each other's rows either: the second to publish raises.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import path_exists, remove_path

LOG_SCHEMA = "event string, kind string, name string, text string, value long, version string"


class LostLog(RuntimeError):
    """There are parts of versions that the log does not know."""


class StaleBuild(RuntimeError):
    """Another build has published since this one began."""


@dataclass
class Snapshot:
    """What one version names: parts and schema of each table, numbers, and names."""

    version: str = ""
    parts: dict[str, list[str]] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)
    numbers: dict[str, int] = field(default_factory=dict)
    sources: set[str] = field(default_factory=set)

    def rows(self) -> list[tuple]:
        out = [("published", "part", table, part, None) for table, parts in self.parts.items() for part in parts]
        out += [("published", "schema", table, text, None) for table, text in self.schemas.items()]
        out += [("published", "number", name, None, value) for name, value in self.numbers.items()]
        return out + [("published", "source", name, None, None) for name in self.sources]


class VersionedTables:
    """The tables under ``base``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.log_path = f"{self.base}/log"

    # ------------------------------------------------------------ the log
    def _log(self) -> DataFrame:
        if not path_exists(self.spark, self.log_path):
            return self.spark.createDataFrame([], LOG_SCHEMA)
        return self.spark.read.schema(LOG_SCHEMA).parquet(self.log_path)

    def _append(self, rows: list[tuple], version: str) -> None:
        """One file, so one rename: it is there as a whole or not at all."""
        df = self.spark.createDataFrame([(*r, version) for r in rows], LOG_SCHEMA)
        df.coalesce(1).write.mode("append").partitionBy("version").parquet(self.log_path)

    def versions(self, event: str) -> list[str]:
        """Names of the versions with ``event``, oldest first (a row for each build)."""
        rows = self._log().where(F.col("event") == event).select("version").distinct().collect()
        return sorted(r["version"] for r in rows)

    def snapshot(self, version: str | None = None) -> Snapshot:
        """The newest published version, or ``version``; an empty one before the first."""
        if version is None:
            published = self.versions("published")
            if not published:
                return Snapshot()
            version = published[-1]
        out = Snapshot(version)
        rows = self._log().where((F.col("version") == version) & (F.col("event") == "published")).collect()
        for r in rows:
            if r["kind"] == "part":
                out.parts.setdefault(r["name"], []).append(r["text"])
            elif r["kind"] == "schema":
                out.schemas[r["name"]] = r["text"]
            elif r["kind"] == "number":
                out.numbers[r["name"]] = r["value"]
            elif r["kind"] == "source":
                out.sources.add(r["name"])
        return out

    # ------------------------------------------------------------ folders
    def _part_paths(self, table: str = "*", version: str = "*") -> list[str]:
        """Folders of parts, relative to ``base``, from names alone."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        fs = path(self.base).getFileSystem(self.spark._jsc.hadoopConfiguration())
        root = fs.makeQualified(path(self.base)).toString().rstrip("/")
        out = []
        for depth in range(4):
            glob = "/".join([self.base, table, *["*=*"] * depth, f"version={version}"])
            for status in fs.globStatus(path(glob)) or []:
                relative = status.getPath().toString()[len(root) + 1:]
                if not relative.startswith("log/"):
                    out.append(relative)
        return out

    # ------------------------------------------------------------ builds
    def begin(self, rebuild: bool = False) -> Build:
        """A new version over the newest published one (over none with ``rebuild``)."""
        known = set(self.versions("begun"))
        strange = sorted({p.rsplit("version=", 1)[1] for p in self._part_paths()} - known)
        if strange and not rebuild:
            raise LostLog(f"{self.log_path} does not know the versions {strange[:3]} of parts under {self.base}; "
                          "restore the log, or rebuild with new keys")
        published = self.versions("published")
        number = max([int(v.split("-")[0]) for v in known], default=0) + 1
        version = f"{number:09d}-{uuid.uuid4().hex[:12]}"
        self._append([("begun", "build", None, None, None)], version)
        before = published[-1] if published else ""
        held = Snapshot() if rebuild or not before else self.snapshot(before)
        return Build(self, version, before, held)

    def read(self, table: str, snapshot: Snapshot | None = None) -> DataFrame:
        """``table`` as of ``snapshot`` (the newest): its parts, by their paths and schema."""
        held = self.snapshot() if snapshot is None else snapshot
        if table not in held.schemas:
            raise LookupError(f"{table} has not been published under {self.base}")
        schema = T.StructType.fromJson(json.loads(held.schemas[table]))
        parts = held.parts.get(table, [])
        if not parts:
            return self.spark.createDataFrame([], schema)
        with_version = T.StructType([*schema.fields, T.StructField("version", T.StringType())])
        return (self.spark.read.schema(with_version).option("basePath", f"{self.base}/{table}")
                .parquet(*[f"{self.base}/{p}" for p in parts]).drop("version"))

    def prune(self, keep: int = 2) -> list[str]:
        """Remove the parts that none of the newest ``keep`` published versions names, except those of
        builds begun since; returns them."""
        published = self.versions("published")
        if not published:
            return []
        named = {p for v in published[-keep:] for parts in self.snapshot(v).parts.values() for p in parts}
        gone = [p for p in self._part_paths()
                if p not in named and p.rsplit("version=", 1)[1] <= published[-1]]
        for p in gone:
            remove_path(self.spark, f"{self.base}/{p}")
        return gone


class Build:
    """A version being written."""

    def __init__(self, tables: VersionedTables, version: str, before: str, held: Snapshot):
        self.tables, self.version, self.before, self.held = tables, version, before, held
        self.next = Snapshot(version, {t: list(p) for t, p in held.parts.items()}, dict(held.schemas),
                             dict(held.numbers), set(held.sources))

    def read(self, table: str) -> DataFrame:
        """``table`` as this build leaves it."""
        return self.tables.read(table, self.next)

    def has(self, table: str) -> bool:
        return table in self.next.schemas

    def write(self, table: str, df: DataFrame, partition_by: Sequence[str] = (), replace: bool = False,
              sort_by: Sequence[str] = (), rebalance: bool = True) -> int:
        """Add ``df`` as new parts of ``table``, and return its rows, counted as they are written.

        Files are sorted by ``sort_by``, with Bloom filters on these columns, so a lookup of one
        value reads the row groups that can hold it.  Without ``rebalance`` rows are not moved:
        for those that lie by partition already.

        With ``replace`` a new part takes the place of all older ones of its partition (of all,
        without ``partition_by``).  ``rows <table>`` and ``nulls <table>`` (rows with a null in any
        column) among the numbers are kept up to date for tables that only grow."""
        seen = Observation()
        columns = [*[c for c in df.columns if c not in partition_by], *partition_by]
        any_null = F.lit(False)
        for c in columns:
            any_null = any_null | F.col(c).isNull()
        dealt = df.select(*columns)
        if partition_by and rebalance:
            # Few files for each value, and many tasks for a value that holds many rows.
            dealt = dealt.hint("rebalance", *partition_by)
        counted = dealt.observe(seen, F.count(F.lit(1)).alias("rows"), F.count(F.when(any_null, F.lit(1))).alias("nulls"))
        out = counted.withColumn("version", F.lit(self.version))
        if sort_by:
            out = out.sortWithinPartitions(*partition_by, "version", *sort_by)
        writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        for c in sort_by:
            writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
        writer.partitionBy(*partition_by, "version").parquet(f"{self.tables.base}/{table}")
        new = self.tables._part_paths(table, self.version)
        old = [p for p in self.next.parts.get(table, []) if p not in new]
        if replace:
            taken = {p.rsplit("version=", 1)[0] for p in new}
            old = [p for p in old if partition_by and p.rsplit("version=", 1)[0] not in taken]
        self.next.parts[table] = old + new
        nullable = T.StructType([T.StructField(f.name, f.dataType) for f in df.select(*columns).schema.fields])
        self.next.schemas[table] = nullable.json()
        if not replace:
            for name in ("rows", "nulls"):
                number = f"{name} {table}"
                self.next.numbers[number] = self.next.numbers.get(number, 0) + seen.get[name]
        return seen.get["rows"]

    def publish(self) -> Snapshot:
        """Make what was written the newest version."""
        published = self.tables.versions("published")
        if (published[-1] if published else "") != self.before:
            raise StaleBuild(f"{published[-1]} was published after {self.version} began; build again")
        self.tables._append(self.next.rows() or [("published", "empty", None, None, None)], self.version)
        return self.next
