"""Audit checks as DataFrames (one row per check), never driver loops."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table: rows with a null in any column, and all rows."""
    parts = []
    for name, df in tables.items():
        any_null = None
        for c in df.columns:
            cond = F.col(c).isNull()
            any_null = cond if any_null is None else (any_null | cond)
        parts.append(df.agg(
            F.count(F.when(any_null, F.lit(1))).alias("null_rows"),
            F.count(F.lit(1)).alias("total_rows")).select(
            F.lit(name).alias("table_name"), "null_rows", "total_rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def lost_rows(df: DataFrame, season_col: str = "season") -> DataFrame:
    """Rows that no dimension and so no fact can hold, because their season is not a
    number (or null): one row with their count and that of all rows."""
    season = F.col(season_col).cast("string").try_cast("int")
    return df.agg(F.count(F.when(season.isNull(), F.lit(1))).alias("lost_rows"),
                  F.count(F.lit(1)).alias("total_rows"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table: its row count, one row each (union of global counts)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def distinct_count(df: DataFrame, cols: list[str], name: str) -> DataFrame:
    """Distinct combinations of ``cols`` as one (check_name, row_count) row."""
    return (df.select(*cols).distinct().agg(F.count(F.lit(1)).alias("row_count"))
            .select(F.lit(name).alias("check_name"), "row_count"))
