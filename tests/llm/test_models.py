"""Quality grades and language identification."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scorebook.llm import lang_id, quality

from .conftest import needs_data

BIGGER = "/root/testdata/sf0.01"


@needs_data
def test_quality_on_ratings_it_has_not_seen(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    back = F.pmod(F.xxhash64(F.lit("test"), "doc_id"), F.lit(4)) == 0
    scored = quality.graded(docs.join(labels.where(back), "doc_id"), quality.fitted(docs, labels.where(~back)))
    rows = scored.select((F.col("quality") + 1 - F.col("toxic")).alias("g"), "expected_grade", "kept").collect()
    good = [r for r in rows if r.g == 2]
    bad = [r for r in rows if r.g < 2]
    assert np.mean([r.kept for r in good]) > 0.97
    assert np.mean([not r.kept for r in bad]) > 0.6
    assert np.mean([r.expected_grade for r in good]) > np.mean([r.expected_grade for r in bad]) + 0.5


def test_cumulative_link_recovers_order():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 3, 600)
    rows = [np.unique(np.concatenate([rng.integers(2000, 2400, 8), [10 + g] if rng.random() < 0.9 else []])).astype(np.int32)
            for g in y]
    model = quality.fit(rows, y, l1=0.05)
    ge = model.at_least(model.scores(rows))
    assert (np.diff(model.thresholds) > 0).all() and (ge[:, 0] >= ge[:, 1]).all()
    means = [ge.sum(axis=1)[y == g].mean() for g in range(3)]
    assert means[0] + 0.4 < means[1] and means[1] + 0.4 < means[2]


def test_quality_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(5, 1, 0), (6, None, 0), (7, 0, None), (None, 1, 0), (8, 1, 0), (9, 0, 1), (99, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in quality.grades(odd_docs, labels).collect()}
    assert len(rows) == 11 and not rows[1].kept and not rows[2].kept and not rows[3].kept
    assert rows[1].expected_grade == rows[2].tail_probability == 0
    none = labels.where("false")
    kept = {r.doc_id: r.kept for r in quality.grades(odd_docs, none).collect()}
    assert kept == {k: k not in (1, 2, 3) for k in kept}
    assert quality.grades(no_docs, labels).count() == 0
    out = quality.graded(odd_docs, quality.fitted(odd_docs, labels))
    assert out.columns == [*(c for c in odd_docs.columns if c != "kept"), "expected_grade", "tail_probability", "kept"]


def test_every_language_gets_a_codeword(spark):
    """Many languages of one document, also without a doc_id."""
    rows = [(k * 1000 + d, f"text number {d} of {k}", f"l{k}") for k in range(3) for d in range(20)]
    ids = [r.id for r in spark.range(200).where(~lang_id.held_out("id")).limit(16).collect()]
    rows += [(i, f"words of {i}", f"one{i}") for i in ids] + [(None, f"none {k}", f"null{k}") for k in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert set(lang_id.fitted(docs).langs) == {r[2] for r in rows}


@needs_data
def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{BIGGER}/documents.parquet")
    rows = lang_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 100 and np.mean([r.lang_pred == r.lang for r in rows]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


@needs_data
def test_language_ignores_lang_of_held_out(spark):
    docs = spark.read.parquet(f"{BIGGER}/documents.parquet").select("doc_id", "text", "lang")
    other = docs.withColumn("lang", F.when(lang_id.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    assert sorted(lang_id.identify(docs).collect()) == sorted(lang_id.identify(other).collect())


def test_language_odd_rows(spark, odd_docs, no_docs):
    rows = {r.doc_id: r for r in lang_id.identify(odd_docs).collect()}
    assert len(rows) == 11
    assert all(rows[k].lang_pred == "und" and rows[k].score == 0 for k in (1, 2, 3, 6))
    assert rows[10].lang_pred == "en" and rows[10].score == 1  # one language to learn
    assert rows[None].held_out is False
    assert lang_id.identify(no_docs).count() == 0
    untold = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in lang_id.identify(untold).collect()} == {"und"}


@pytest.mark.parametrize("n", [2, 3, 4, 6, 7, 20])
def test_codewords_are_apart(n):
    code = lang_id.codewords(n).astype(int)
    apart = (code.shape[1] - code @ code.T) // 2
    least = apart[~np.eye(n, dtype=bool)].min()
    assert least >= (1 << (n - 2) if n <= lang_id.EXHAUSTIVE else 8)
    assert (np.abs(code.sum(axis=0)) < n).all()


def test_decoding_corrects_a_wrong_bit():
    code = lang_id.codewords(4)
    ones = np.ones(code.shape[1])
    model = lang_id.OutputCode(list("abcd"), code, np.zeros((lang_id.SLOTS, code.shape[1])), ones, ones)
    for k in range(4):
        for bit in range(code.shape[1]):
            margins = 3.0 * code[k]
            margins[bit] *= -1
            share = model.shares(margins[None])[0]
            assert share.argmax() == k


def test_grams_stay_in_their_row():
    data, at = lang_id.utf8_bytes(pa.array(["ab", "c", None, "AB!!"]))
    slots, rows = lang_id.grams(data, at)
    alone = [sorted(lang_id.grams(*lang_id.utf8_bytes(pa.array([t])))[0].tolist()) for t in ["ab", "c", "", "ab "]]
    assert [sorted(slots[rows == r].tolist()) for r in range(4)] == alone
