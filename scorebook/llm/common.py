"""Helpers shared by the corpus operators.

Rules that hold for every operator of this package:

* the input is reduced to the columns the operator needs before anything else,
  so extra columns, also ones named like an operator's own, cannot clash;
* a null ``doc_id`` (or ``vec_id``, ``page_id``) is a key like any other unless
  the operator's docstring says otherwise;
* intermediate tables go to the folder the session names in
  ``spark.checkpoint.dir`` (``scorebook.session.scratch_path``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import materialise, remove_path, table_path  # noqa: F401 - materialise is for the operators

#: Arrow batches handed to Python stay below this size (or hold one row).
BATCH_BYTES = 4 * 1024 * 1024
BATCH_ROWS = 4096


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def remove_written(df: DataFrame) -> None:
    """Delete the folder of a table that ``materialise`` wrote and nothing reads any more."""
    files = df.inputFiles()
    if files:
        remove_path(df.sparkSession, files[0].rsplit("/", 1)[0])


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session by bytes as well as by rows, so
    that a Python worker's memory does not follow the length of the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None],
                schema: str) -> DataFrame:
    """``mapInArrow`` over one batch at a time."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None:
                    yield out
    return df.mapInArrow(run, schema)


def shared(spark: SparkSession, model) -> Callable:
    """Broadcast a dataclass of plain data (bounded by its maker) and give a function
    that returns it in a task.  Its fields are sent, not its class, so executors need
    no copy of the package."""
    held, kind, made = spark.sparkContext.broadcast(dict(vars(model))), type(model), []

    def get():
        if not made:
            made.append(kind(**held.value))
        return made[0]

    return get


def utf8_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column (null: empty) and its row offsets, without
    making a Python string per row."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


_UPPER = np.arange(256, dtype=np.uint8)
_UPPER[65:91] += 32
#: Lower-cases A-Z and nothing else.
ASCII_LOWER = _UPPER

_MASK = (1 << 64) - 1


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """The splitmix64 finaliser over an array of unsigned 64-bit values."""
    with np.errstate(over="ignore"):
        z = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & _MASK)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


_BYTE = mix64(np.arange(256, dtype=np.uint64), 12345)
_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
_STEP_INV = np.uint64(pow(int(_STEP), -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte run ``data[start:end]``.

    A polynomial in an odd base modulo 2^64 over random byte values, taken from
    prefix sums, then finalised together with the length."""
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * _powers(_STEP, len(data)), out=sums[1:])
        poly = (sums[ends] - sums[starts]) * _powers(_STEP_INV, len(data) + 1)[starts]
        return mix64(poly ^ ((ends - starts).astype(np.uint64) << np.uint64(40)), 7)


def byte_chunks(offsets: np.ndarray, limit: int = BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose bytes stay below ``limit``, or that hold one row."""
    row, n = 0, len(offsets) - 1
    while row < n:
        last = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        last = min(max(last, row + 1), n)
        yield row, last
        row = last
