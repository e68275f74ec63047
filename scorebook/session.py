"""Spark session settings and the shared scratch folder.

The session is ANSI on (the Spark 4 default), UTC, AQE on with skew-join
handling, and no UI.  Shuffle partitions default to a value sized for the
local tests; on a cluster pass ``shuffle_partitions`` sized to the data
(about 128-256 MB of shuffle per partition) or leave AQE to coalesce.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Runtime (AQE) broadcast only below this size: the size check behind
    # every join to a dimension whose row count is not fixed in advance.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "scorebook",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    The cluster names it in ``spark.checkpoint.dir``; only when that is unset
    and the session is local (tests) is a folder of our own chosen.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder (HDFS/S3) for it")
    local = tempfile.mkdtemp(prefix="scorebook-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


#: Scratch folders of the ``released`` blocks that are open, innermost last.
_SCOPES: list[list[str]] = []


@contextmanager
def released(spark: SparkSession):
    """Remove, at the end of the block, the intermediate tables written in it.

    For jobs that write their results somewhere else before the block ends; what they
    return must not read scratch tables, but for ``lasting`` ones."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            remove_path(spark, path)


def scratch_path(spark: SparkSession, name: str, lasting: bool = False) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/scorebook/{name}-{uuid.uuid4().hex[:12]}"
    if _SCOPES and not lasting:
        _SCOPES[-1].append(path)
    return path


def concurrently(*tasks, workers: int = 4) -> list:
    """The results of functions without arguments, each run in a thread: small Spark jobs
    that do not depend on each other share the cluster instead of queueing."""
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    with ThreadPoolExecutor(workers) as pool:
        futures = [pool.submit(inheritable_thread_target(spark)(t)) for t in tasks]
        return [f.result() for f in futures]


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate tables in whatever store holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialise(df, name: str, lasting: bool = False, partition_by=()):
    """Write ``df`` under the shared checkpoint folder and read it back.

    The written table cuts the lineage, is read again by lost tasks, and has a
    size the planner knows, so a small one is broadcast before the other side
    of a join is shuffled, and a large one is not."""
    path = scratch_path(df.sparkSession, name, lasting)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_bytes(df) -> int:
    """Bytes of the files behind a written table, from its listing (no job)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """The session with these settings in the block.  Not for blocks that run side by side."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


#: For blocks that write tables.  Shuffle files are removed when the job that made them ends, not
#: when the driver's memory is next collected; and a generated method that the JVM would only
#: interpret (it compiles none beyond 8,000 bytes) is not used: its operators run one by one, compiled.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
           "spark.sql.codegen.hugeMethodLimit": "8000"}


@contextmanager
def partitioned_by_any(spark: SparkSession):
    """In the block, rows partitioned by some of a join's keys are joined where they are, instead of
    moving again to be partitioned by all.  For jobs run in the block over rows that are
    dealt out by such a key; a task that grows too large by it is still split as a skewed one."""
    with settings(spark, {"spark.sql.requireAllClusterKeysForCoPartition": "false"}):
        yield


#: Estimated bytes of files, of the columns that are read, behind the rows of one partition.
PARTITION_BYTES = 4 * 1024 * 1024


def partitions_for(df) -> int:
    """How many partitions to deal the rows of ``df``, a scan, out to: one a core at least, and one
    for every ``PARTITION_BYTES`` of the files it is read from (from their listing, no job).

    For grouping that hardly shrinks its rows: a hash map of them takes many times their size in the
    files, so a task's share must not grow with the table as a scan's or a coalesced partition does."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-written_bytes(df) // PARTITION_BYTES))


#: Estimated bytes up to which a table is broadcast whatever the session's own threshold.
BROADCAST_BYTES = 8 * 1024 * 1024


def small_side(df):
    """``df`` marked for broadcast if the planner's estimate, from the sizes of the files it is read
    from, is within ``BROADCAST_BYTES``; else (or with broadcasts switched off) as it is.

    For lookups of a few columns: a fact joined to one of them stays where it lies, at any
    threshold of the session; a larger lookup is a shuffle join."""
    off = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().startswith("-")
    return df if off or written_bytes(df) > BROADCAST_BYTES else df.hint("broadcast")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
