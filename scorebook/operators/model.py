"""Dimensional-model operators: surrogate keys, dimensions, insert-only upsert.

Surrogate keys are dense (start, start + 1, ...) and follow the natural key, so a
rebuild gives the same keys.  A dimension's members are written once; the size of
what was written says how they are numbered:

* up to ``SMALL_BYTES`` by a window over the written table, where it is read: one task
  sorts a bounded table, and nothing else is written;
* beyond it the members are range-partitioned and sorted, written with their place
  (task and row number in the task), and the place is turned into a number by adding
  up the rows of the tasks before.

Both give the same keys.  Facts are numbered as they were written, without a sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import hash_key
from ..session import materialise, written_bytes

#: Bytes on disk up to which a written table is sorted by one task.
SMALL_BYTES = 4 * 1024 * 1024

_POS_BITS = 33  # monotonically_increasing_id = partition index << 33 | row position


def _number(placed: DataFrame, key_col: str, start: int, groups: Sequence[str] = ()) -> DataFrame:
    """``placed`` (a written table with ``__mid``) with dense numbers for its places,
    anew in each of ``groups``, whose rows lie together in a task."""
    groups = list(groups)
    placed = placed.withColumn("__pid", F.shiftrightunsigned("__mid", _POS_BITS).cast("int"))
    counts = placed.groupBy(*groups, "__pid").agg(F.count(F.lit(1)).alias("__n"),
                                                  F.min("__mid").alias("__first"))
    # One row per task (and group): the running total is bounded by their number.
    before = Window.orderBy("__pid") if not groups else Window.partitionBy(*groups).orderBy("__pid")
    offsets = counts.select(
        *groups, "__pid", "__first",
        F.coalesce(F.sum("__n").over(before.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("__off"))
    keyed = placed.join(F.broadcast(offsets), [*groups, "__pid"])
    number = F.lit(start) + F.col("__off") + F.col("__mid") - F.col("__first")
    return keyed.withColumn(key_col, number.cast("long")).drop("__mid", "__pid", "__off", "__first")


def assign_surrogate_keys(df: DataFrame, order_cols: Sequence[str], key_col: str,
                          start: int = 1, groups: Sequence[str] = ()) -> DataFrame:
    """Add ``key_col`` = start + rank of the row in ``order_cols`` order (within
    each of ``groups``, which must be few).

    Rows equal in all ``order_cols`` follow each other by their other columns, so that
    their keys are the same wherever the table is read.  In the large way the sorted rows are
    written with their places: range bounds are sampled anew by every exchange, so two
    passes over an unwritten one could cut the tasks differently."""
    members = materialise(df, "members")
    rest = [c for c in df.columns if c not in (*groups, *order_cols)]
    order = [*order_cols, *rest]
    if written_bytes(members) <= SMALL_BYTES:
        window = Window.partitionBy(*groups).orderBy(*order) if groups else Window.orderBy(*order)
        return members.withColumn(key_col, (F.row_number().over(window) + F.lit(start - 1)).cast("long"))
    placed = materialise(members.repartitionByRange(*groups, *order).sortWithinPartitions(*groups, *order)
                         .withColumn("__mid", F.monotonically_increasing_id()), "sorted")
    return materialise(_number(placed, key_col, start, groups).select(*df.columns, key_col), "keyed")


#: Column of a row's place in a written table.
PLACE = "__mid"


def placed(df: DataFrame, name: str = "placed") -> DataFrame:
    """``df`` written once, with each row's place: facts that are columns of one such table are
    numbered from it without being written before."""
    return materialise(df.withColumn(PLACE, F.monotonically_increasing_id()), name)


def assign_fact_keys(df: DataFrame, key_col: str, start: int = 1) -> DataFrame:
    """Add a dense, unique ``key_col`` to a large table without sorting or
    shuffling it: its rows are written once and numbered where they lie (those of ``placed``
    have been written)."""
    return _number(df if PLACE in df.columns else placed(df), key_col, start)


def build_dim(df: DataFrame, natural_cols: Sequence[str], key_col: str, hash_col: str,
              hash_cols: Sequence | None = None, extra: dict | None = None) -> DataFrame:
    """Distinct natural keys -> (surrogate key, hash key, natural columns).

    Rows with a null natural key are left out (the key columns are NOT NULL);
    the null audit reports the source rows instead."""
    natural_cols = list(natural_cols)
    d = df.select(*natural_cols, *((extra or {}).keys()))
    d = d.dropna(subset=natural_cols).dropDuplicates(natural_cols)
    d = d.withColumn(hash_col, hash_key(*(hash_cols or natural_cols)))
    d = assign_surrogate_keys(d, natural_cols, key_col)
    return d.select(key_col, hash_col, *natural_cols, *((extra or {}).keys()))


def max_key(df: DataFrame, key_col: str) -> int:
    """Largest key of a table (0 when empty): one scalar to the driver."""
    row = df.agg(F.max(key_col).alias("m")).first()
    return int(row["m"]) if row and row["m"] is not None else 0


def upsert_insert_only(target: DataFrame, source: DataFrame, natural_cols: Sequence[str],
                       key_col: str, hash_col: str | None = None,
                       hash_cols: Sequence | None = None) -> DataFrame:
    """MERGE .. WHEN NOT MATCHED THEN INSERT, as a set operation.

    New natural keys (anti join against the target) get keys after the
    target's largest key, in natural-key order; existing rows keep theirs.
    Returns the whole new table (target rows + inserted rows)."""
    natural_cols = list(natural_cols)
    src = source.dropna(subset=natural_cols).dropDuplicates(natural_cols)
    new = src.join(target.select(*natural_cols), natural_cols, "left_anti")
    if hash_col:
        new = new.withColumn(hash_col, hash_key(*(hash_cols or natural_cols)))
    base = max_key(target, key_col)
    new = assign_surrogate_keys(new, natural_cols, key_col, start=base + 1)
    return target.unionByName(new.select(*target.columns))

