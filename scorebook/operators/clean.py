"""Column-list cleaning operators (DataFrame -> DataFrame).

Each applies one expression to a list of columns in a single ``withColumns``
(one projection, no per-column plan growth).  Use with ``df.transform``.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.keys import safe_double, safe_int


def _present(df: DataFrame, cols: Iterable[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in cols if c in have]


def trim_columns(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    cols = _present(df, cols if cols is not None else df.columns)
    string_cols = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.withColumns({c: F.trim(F.col(c)) for c in cols if c in string_cols})


def cast_int_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """To INT; text that is no number ('-', '') becomes null instead of failing."""
    return df.withColumns({c: safe_int(c) for c in _present(df, cols)})


def cast_double_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.withColumns({c: safe_double(c) for c in _present(df, cols)})


def fill_null_zero(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """null -> 0 in the given columns (typed to each column)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    out = {}
    for c in _present(df, cols):
        zero = F.lit("0") if isinstance(types[c], T.StringType) else F.lit(0).cast(types[c])
        out[c] = F.coalesce(F.col(c), zero)
    return df.withColumns(out)


def fill_dash_zero(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """'-' -> '0' in string columns; other types cannot hold '-'."""
    cols = _present(df, cols if cols is not None else df.columns)
    string_cols = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return df.withColumns({
        c: F.when(F.col(c) == "-", F.lit("0")).otherwise(F.col(c))
        for c in cols if c in string_cols})


def upper_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.upper(F.col(c).cast("string")) for c in _present(df, cols)})


def recode(df: DataFrame, col: str, mapping: Mapping) -> DataFrame:
    """Replace values found in ``mapping`` (old -> new); others unchanged.

    ``mapping`` is a fixed small dict, so it becomes one literal map lookup."""
    if not mapping:
        return df
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return df.withColumn(col, F.coalesce(F.try_element_at(m, F.col(col)), F.col(col)))


def recode_first(df: DataFrame, col: str, mapping: Mapping[str, list]) -> DataFrame:
    """Replace by the first of a list of new values."""
    return recode(df, col, {k: v[0] for k, v in mapping.items() if v})


def code_to_name(df: DataFrame, code_col: str, name_col: str, codes: DataFrame,
                 code_key: str, code_name: str) -> DataFrame:
    """Look a code up in a code table (left join; unknown codes give null).

    The code table is a fixed literal relation, so it is broadcast."""
    lookup = codes.select(F.col(code_key).alias("__code"), F.col(code_name).alias(name_col))
    out = df.drop(name_col) if name_col in df.columns else df
    return (out.join(F.broadcast(lookup), out[code_col] == F.col("__code"), "left")
            .drop("__code"))


def split_style(df: DataFrame, src: str, first: str, second: str, drop: bool = True) -> DataFrame:
    """'a,b' -> two columns; missing second part -> null."""
    parts = F.split(F.col(src), ",")
    out = df.withColumns({first: F.get(parts, 0), second: F.get(parts, 1)})
    return out.drop(src) if drop else out


def one_row_per(df: DataFrame, key: str) -> DataFrame:
    """One row per value of ``key``: the smallest by the other columns in order.
    A grouped minimum (combined before the shuffle), so it is the same in every
    run, and a key repeated in many rows stays cheap.  Null keys are left out."""
    rest = [c for c in df.columns if c != key]
    return (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.min(F.struct(*rest)).alias("__r")).select(key, "__r.*").select(*df.columns))
