"""Fill-in-middle transformation by repeated-capture matching.

A text is cut into units, its lines with their line feeds.  One ``fullmatch`` of
``(unit)*`` by the regex library keeps every repetition of the group, so
``match.ends(1)`` gives at once the number of units and the offset behind each of them;
both cuts are looked up there.  No loop goes over the lines, and the quantifiers are
possessive, so the match is linear in the text and never backs up.

The draws are the first four 8-digit groups of the hex SHA-256 of ``seed:doc_id``: two
choose the cuts (0 to n units each, the smaller first), the third whether the document
is transformed, the fourth its form.  They depend on nothing but the id, so a task that
is run again gives the same rows.

Forms: ``plain`` is the text itself; ``psm`` is mark P, prefix, mark S, suffix, mark M,
middle; ``spm`` is mark S, suffix, mark P, prefix, mark M, middle.  ``restored`` gives
the text back from output and form alone.

Defined results: a null text is the empty one; an empty text and one that holds a mark
are plain, so an output that is not plain holds each mark once; prefix, middle and
suffix may be empty; a null doc_id draws from ``seed:`` with nothing behind; rows that
repeat give equal results; texts of any length are one match over one row, in batches
bounded by bytes; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, map_batches

SEED = 7
#: Documents in a hundred that are transformed, and those of them that become spm.
RATE = 100
SPM = 50
MARKS = ("<P>", "<S>", "<M>")

_UNITS = regex.compile(r"([^\n]*+\n|[^\n]++)*+")


def draws(doc_id, seed: int = SEED) -> list[Column]:
    """h1 to h4 of each row."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def transformed(text: str, h1: int, h2: int, h3: int, h4: int, rate: int = RATE, spm: int = SPM,
                marks: tuple[str, str, str] = MARKS) -> tuple[int, str, int | None, int | None, str]:
    """n, form, prefix_chars, middle_chars, output of one text."""
    ends = [0, *_UNITS.fullmatch(text).ends(1)]
    n = len(ends) - 1
    if not text or any(m in text for m in marks) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    first, second = sorted((ends[h1 % (n + 1)], ends[h2 % (n + 1)]))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    p, s, m = marks
    if h4 % 100 < spm:
        return n, "spm", first, second - first, "".join((s, suffix, p, prefix, m, middle))
    return n, "psm", first, second - first, "".join((p, prefix, s, suffix, m, middle))


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM,
                   marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output of every row of ``docs``."""
    bounded_batches(docs.sparkSession)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, *hs = (batch.column(k).to_pylist() for k in range(1, 6))
        out = [transformed(t or "", *h, rate, spm, marks) for t, *h in zip(texts, *hs)]
        n, form, prefix, middle, output = zip(*out)
        return pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                                pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()),
                                pa.array(output, pa.string())],
                               names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    return map_batches(rows.select("doc_id", "text", *draws(F.col("doc_id"), seed)), run,
                       "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that was transformed, from output and form."""
    # A transformed output holds each mark once: an empty part, then the three parts in the order of the form.
    parts = F.split(output, "|".join(rf"\Q{m}\E" for m in marks), -1)
    part = lambda k: F.get(parts, F.lit(k))
    return (F.when(form == "psm", F.concat(part(1), part(3), part(2)))
            .when(form == "spm", F.concat(part(2), part(3), part(1))).otherwise(output))


def digest(docs: DataFrame) -> DataFrame:
    """The query over ``documents``: outputs and restored texts by their SHA-256."""
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    out = fill_in_middle(docs)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
                      sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


ORACLE_SQL = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u
  FROM documents),
cut AS (
  SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS x, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS y,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                   OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 100 THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn),
part AS (
  SELECT doc_id, t, n, form, array_to_string(u[1:least(x, y)], '') AS p,
         array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS m,
         array_to_string(u[greatest(x, y) + 1:], '') AS s
  FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM part
"""
