"""The pipeline's stages on the small tables and on odd rows."""

import corpus_pipeline
from scorebook.llm.common import read_table
import pytest

from .conftest import SF, needs_data
from .test_dedup import brute_lines, brute_near


@needs_data
def test_each_stage(spark):
    docs = read_table(spark, SF, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "line_dedup", "near_dedup", "decontamination", "packing"]
    good = stages["quality"](spark, docs, SF).cache()
    assert 0 < good.count() <= docs.count()
    lines = stages["line_dedup"](spark, good, SF).cache()
    assert {r.doc_id: r.text for r in lines.collect()} == {d: t for d, _, _, t in brute_lines(
        [(r.doc_id, r.text) for r in good.collect()])}
    assert all(r.n_chars == len(r.text) for r in lines.collect())
    near = stages["near_dedup"](spark, lines, SF).cache()
    kept = {d for d, _, _, k in brute_near([(r.doc_id, r.text) for r in lines.collect()]) if k}
    assert sorted(r.doc_id for r in near.collect()) == sorted(kept)
    clean = stages["decontamination"](spark, near, SF).cache()
    items = [r.text for r in read_table(spark, SF, "benchmark").collect()]
    held = {r.doc_id for r in near.collect() if any(t in r.text for t in items)}
    assert held.isdisjoint(r.doc_id for r in clean.collect())
    assert all(x.columns == docs.columns for x in (good, lines, near, clean))
    packed = stages["packing"](spark, clean, SF)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in clean.collect()}


@needs_data
@pytest.mark.parametrize("empty", [False, True])
def test_stages_take_odd_rows(spark, odd_docs, no_docs, empty):
    docs = (no_docs if empty else odd_docs).select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in corpus_pipeline.STAGES[1:]:
        out = stage(spark, docs, SF)
        n = out.count()
        if name != "packing":
            assert out.columns == docs.columns
            docs = out
        assert (n == 0) == empty
