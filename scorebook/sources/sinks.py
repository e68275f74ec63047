"""Sinks: parquet tables (overwrite / partitioned append), CSV marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                mode: str = "overwrite") -> None:
    """Write a parquet table, optionally partitioned by columns.

    No shuffle is added before a partitioned write: each task sorts its rows
    by the partition columns and writes one file per value it holds, so a
    partition value holding a third of all rows is still written by many
    tasks in parallel."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def append_partitioned(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    write_table(df, path, partition_by, mode="append")


def snapshot(df: DataFrame, path: str) -> None:
    """Replace a table with the current content of ``df``."""
    write_table(df, path, mode="overwrite")


def write_csv_mart(df: DataFrame, path: str) -> None:
    """Gold mart as CSV with a header; replaces the folder."""
    df.write.mode("overwrite").option("header", True).csv(path)
