"""Key and cast expressions (JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def md5_text(c) -> Column:
    """MD5 of a value's text form (``MD5(CAST(x AS STRING))``)."""
    return F.md5(_c(c).cast("string"))


def hash_key(*cols) -> Column:
    """MD5 of the '-'-joined text of the columns; nulls are skipped, as
    ``concat_ws`` does.  One column gives ``MD5(col)``."""
    if len(cols) == 1:
        return md5_text(cols[0])
    return F.md5(F.concat_ws("-", *[_c(c).cast("string") for c in cols]))


def safe_int(c) -> Column:
    """Text or number to INT; bad text gives null instead of an error.

    Goes through DOUBLE first so that '4.5' becomes 4 (the non-ANSI cast
    result) rather than null."""
    return _c(c).try_cast("double").try_cast("int")


def safe_double(c) -> Column:
    return _c(c).try_cast("double")


def overs_to_balls(c) -> Column:
    """Cricket overs notation (4.3 = 4 overs and 3 balls) to balls."""
    o = _c(c).cast("double")
    return (F.floor(o) * 6 + F.round((o - F.floor(o)) * 10)).cast("int")
