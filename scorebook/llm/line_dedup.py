"""Line dedup with levelled sorted runs of line hashes (DataFrame functions only).

A line is known by its key: the line with ``[\\x20\\x09-\\x0D]`` stripped at both
ends and A-Z lower-cased.  Keys of at least ``min_chars`` code points that occur
in at least ``min_docs`` documents lose all their lines except in the largest
``doc_id`` that holds them.

Method.  Documents are cut into batches, in falling ranges of ``doc_id``, so that the document
which keeps a line is known when its key is first seen.  Each batch becomes one *run*: a
table sorted by key hash with, per key, how many documents hold it and the largest of
them.  A key that the runs hold in ``min_docs`` documents is complete: the next batch is
anti-joined with the complete keys of the runs in a merge of both, and adds only its own
others.  ``fanout`` runs of a level are merged into one run of the next level (counts add,
maxima combine), as in a log-structured merge tree, so a corpus that grows by batches
rewrites each entry only once per level, and a line that is in every batch is written by the
first.  At the end the batches are merge-joined with the repeated keys of the remaining runs,
and the lines found there are taken out.  ``LineRuns`` is the incremental store behind it;
``dedup_lines`` feeds it a whole table.

Keys are compared by their 64-bit and a second, independent 32-bit hash.

Defined results: a null or empty text is one empty line and stays as it is; a
line repeated inside one document counts once for that document and is kept or
dropped in all its places; ties cannot occur, because ``doc_id`` decides; rows that
share a ``doc_id`` count as one document; a null ``doc_id`` counts as one document
and is the smallest; an empty table gives an empty result; other columns are
carried through unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import materialise

MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 4
FANOUT = 4

_SPACE = " \t\n\x0b\x0c\r"
_AZ, _az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line):
    """Key of a line.  ``lower`` equals lower-casing A-Z on pure ASCII text, where
    it is much cheaper than ``translate``."""
    trimmed = F.btrim(line, F.lit(_SPACE))
    plain = F.octet_length(trimmed) == F.char_length(trimmed)
    return F.when(plain, F.lower(trimmed)).otherwise(F.translate(trimmed, _AZ, _az))


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


class LineRuns:
    """Levelled runs of (key hash, documents, largest document).

    Each run is a parquet table under the shared scratch folder, sorted by key
    within its partitions.  ``add`` writes a new run at level 0 and compacts;
    ``repeated`` gives the keys that occur in at least ``min_docs`` documents.
    A document must be added once and in one batch: its count is per batch.  With
    ``complete_at``, keys that the runs hold in so many documents are left out of later
    batches; these must then come in falling order of the documents."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, complete_at: int | None = None):
        if fanout < 2:
            raise ValueError("fanout must be at least 2")
        self.spark, self.fanout, self.complete_at = spark, fanout, complete_at
        self.root = scratch_path(spark, "line-runs")
        self.levels: list[list[str]] = []
        self._next = 0

    def _write(self, run: DataFrame) -> str:
        path = f"{self.root}/run-{self._next}"
        self._next += 1
        run.sortWithinPartitions("h", "g").write.parquet(path)
        return path

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema("h long, g int, docs long, last long").parquet(*paths)

    def add(self, keys: DataFrame) -> None:
        """Add a batch of distinct (h, g, doc) as a run, then compact full levels.

        The batch is summed up by key before it meets the runs, so a line of a third of all
        documents is one row there."""
        run = keys.groupBy("h", "g").agg(F.count(F.lit(1)).alias("docs"), F.max("doc").alias("last"))
        if self.complete_at is not None and any(self.levels):
            run = run.join(self.repeated(self.complete_at).select("h", "g"), ["h", "g"], "left_anti")
        self._put(0, self._write(run.select("h", "g", "docs", "last")))

    def _put(self, level: int, path: str) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._put(level + 1, self._write(self._merge(full)))

    def _merge(self, paths: list[str]) -> DataFrame:
        return (self._read(paths).groupBy("h", "g")
                .agg(F.sum("docs").alias("docs"), F.max("last").alias("last")))

    def repeated(self, min_docs: int) -> DataFrame:
        """Keys in at least ``min_docs`` documents, with the largest document."""
        paths = [p for level in self.levels for p in level]
        runs = self._read(paths) if len(paths) == 1 else self._merge(paths)
        return runs.where(F.col("docs") >= min_docs).select("h", "g", "last")


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                  batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """(doc, version, dropped): per text the positions of the lines to take out.

    ``docs`` has ``doc``, ``version`` (a hash of the text, which tells rows of one
    ``doc`` apart) and ``text``."""
    spark = docs.sparkSession
    # Falling ranges of the documents; a null one is the smallest.
    shares = [1 - (b + 1) / batches for b in range(batches - 1)]
    cuts = docs.agg(F.percentile_approx("doc", F.lit(shares) if shares else F.lit([0.0])).alias("c")).first()["c"] or []
    batch = sum((F.when(F.coalesce(F.col("doc") <= c, F.lit(True)), 1).otherwise(0) for c in cuts[:batches - 1]), F.lit(0))
    line = F.posexplode(_lines(F.col("text"))).alias("pos", "line")
    key = (docs.select("doc", "version", line).where(F.char_length("line") >= min_chars)
           .select("doc", "version", "pos", line_key(F.col("line")).alias("key"))
           .where(F.char_length("key") >= min_chars)
           .select("doc", "version", "pos", F.xxhash64("key").alias("h"), F.hash("key").alias("g"),
                   batch.cast("int").alias("batch")))
    path = scratch_path(spark, "line-keys")
    key.write.parquet(path)
    keys = spark.read.schema(
        "doc long, version long, pos int, h long, g int, batch int").parquet(path)
    runs = LineRuns(spark, fanout, min_docs)
    for b in range(batches):
        runs.add(keys.where(F.col("batch") == b).select("h", "g", "doc").distinct())
    repeated = materialise(runs.repeated(min_docs), "line-repeated")
    hit = keys.join(repeated, ["h", "g"]).where(~F.col("doc").eqNullSafe(F.col("last")))
    return hit.groupBy("doc", "version").agg(F.collect_set("pos").alias("dropped"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text_col``, and two more columns:
    ``line_count`` (lines before) and ``lines_dropped``.  A null text stays null."""
    version = F.xxhash64(text_col)
    found = dropped_lines(docs.select(F.col(id_col).alias("doc"), version.alias("version"),
                                      F.col(text_col).alias("text")),
                          min_chars, min_docs, batches, fanout)
    found = found.toDF("__doc", "__version", "__dropped")
    joined = docs.join(found, docs[id_col].eqNullSafe(found["__doc"])
                       & (F.xxhash64(docs[text_col]) == found["__version"]), "left")
    # The lines are a column of their own: inside the lambda below they would be split anew for each line.
    split = joined.withColumn("__lines", _lines(F.col(text_col)))
    lines, dropped = F.col("__lines"), F.col("__dropped")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped)
    cleaned = (F.when(dropped.isNull(), F.col(text_col))
               .otherwise(F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")))
    return split.withColumns({
        "line_count": F.size(lines).cast("long"),
        "lines_dropped": F.coalesce(F.size(dropped), F.lit(0)).cast("long"),
        text_col: cleaned}).drop("__doc", "__version", "__dropped", "__lines")


def digest(docs: DataFrame) -> DataFrame:
    """The query over ``documents``: doc_id, n_lines, n_dropped, kept_sha256."""
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", F.col("line_count").alias("n_lines"),
                      F.col("lines_dropped").alias("n_dropped"),
                      F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
repeated AS (
  SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (
  SELECT d.doc_id, d.pos, d.line, r.k IS NOT NULL AND d.doc_id <> r.last AS gone
  FROM keyed d LEFT JOIN repeated r ON d.k = r.k)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines,
       CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
