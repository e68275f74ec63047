"""Snapshots, partitioned appends, ledger and load gates (q01-q04)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import load
from ..session import scratch_path
from ..sources import sinks
from .analogue import read
from .queries import register

CUTOFF = "1998-01-01"
LOAD_A, LOAD_B = "20240101000000", "20240102000000"


@register("q01_snapshot_roundtrip", "SELECT * FROM nation")
def q01_snapshot_roundtrip(spark, sf_dir):
    """Snapshot a table to the shared folder (replace), read it back."""
    path = scratch_path(spark, "nation_snapshot")
    n = read(spark, sf_dir, "nation")
    sinks.snapshot(n, path)
    sinks.snapshot(n, path)           # replacing gives the same table, not twice the rows
    return spark.read.parquet(path)


@register("q02_partitioned_append", f"""
SELECT o_orderstatus,
       CASE WHEN o_orderdate < TIMESTAMP '{CUTOFF}' THEN '{LOAD_A}' ELSE '{LOAD_B}' END AS record_created_timestamp,
       count(*) AS n_rows, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_cents
FROM orders GROUP BY ALL
""")
def q02_partitioned_append(spark, sf_dir):
    """Two loads appended to one table partitioned by status and load id;
    read back with a schema (so the load id stays a string) and counted."""
    path = scratch_path(spark, "orders_by_load")
    o = read(spark, sf_dir, "orders")
    early = F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp")
    sinks.append_partitioned(o.filter(early).withColumn("record_created_timestamp", F.lit(LOAD_A)),
                             path, ["o_orderstatus", "record_created_timestamp"])
    sinks.append_partitioned(o.filter(~early).withColumn("record_created_timestamp", F.lit(LOAD_B)),
                             path, ["o_orderstatus", "record_created_timestamp"])
    schema = T.StructType(o.schema.fields + [
        T.StructField("record_created_timestamp", T.StringType())])
    back = spark.read.schema(schema).parquet(path)
    return back.groupBy("o_orderstatus", "record_created_timestamp").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("total_cents"))


@register("q03_ledger_anti_join", f"""
SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS match_slug FROM lineitem
WHERE CAST(l_orderkey AS VARCHAR) NOT IN (
  SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderdate < TIMESTAMP '{CUTOFF}')
""")
def q03_ledger_anti_join(spark, sf_dir):
    """Ledger of processed matches (orders before the cut-off, appended as
    one load) and the matches still to load: available minus ledger."""
    path = scratch_path(spark, "ledger")
    o = read(spark, sf_dir, "orders")
    done = (o.filter(F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp"))
            .select(F.col("o_orderkey").cast("string").alias("match_slug"),
                    F.lit(None).cast("string").alias("reason")))
    load.append_ledger(load.ledger_rows(done, "match_slug", "reason", LOAD_A), path)
    ledger = load.read_ledger(spark, path)
    available = (read(spark, sf_dir, "lineitem")
                 .select(F.col("l_orderkey").cast("string").alias("match_slug")).distinct())
    return load.new_matches(available, ledger)


EXPECTED_LINES = 4


@register("q04_load_gate_quarantine", f"""
WITH lc AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1),
     fc AS (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1)
SELECT o.o_orderkey AS match_id,
       coalesce(lc.n, 0) AS line_rows,
       coalesce(fc.n, 0) AS bowled_rows,
       CASE WHEN coalesce(lc.n, 0) = 0 THEN 'missing lines file'
            WHEN coalesce(fc.n, 0) = 0 THEN 'empty bowling file'
            WHEN lc.n <> {EXPECTED_LINES} THEN 'unexpected row count' END AS reason,
       CASE WHEN coalesce(lc.n, 0) = 0 OR coalesce(fc.n, 0) = 0 OR lc.n <> {EXPECTED_LINES}
            THEN 'quarantined' ELSE 'loaded' END AS status
FROM orders o
LEFT JOIN lc ON lc.l_orderkey = o.o_orderkey
LEFT JOIN fc ON fc.l_orderkey = o.o_orderkey
""")
def q04_load_gate_quarantine(spark, sf_dir):
    """Per-match gates with a reason code: part missing, part empty, row
    count different from the expected number; failed matches are marked
    for quarantine, the rest for load."""
    o = read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("match_id"))
    li = read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("match_id"),
                                                "l_linestatus")
    lines = load.counts_by_key(li, "match_id", "line_rows")
    bowled = load.counts_by_key(li.filter(F.col("l_linestatus") == "F"), "match_id",
                                "bowled_rows")
    g = (o.join(lines, "match_id", "left").join(bowled, "match_id", "left")
         .fillna(0, subset=["line_rows", "bowled_rows"]))
    g = g.withColumn("reason", load.first_reason(
        (F.col("line_rows") == 0, "missing lines file"),
        (F.col("bowled_rows") == 0, "empty bowling file"),
        (F.col("line_rows") != EXPECTED_LINES, "unexpected row count")))
    return g.withColumn("status", F.when(F.col("reason").isNull(), F.lit("loaded"))
                        .otherwise(F.lit("quarantined")))
