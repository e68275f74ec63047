"""Decontamination against brute-force BM25."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from scorebook.llm import decontam

from .conftest import SF, needs_data

WORDS = [f"w{k}" for k in range(300)] + [f"a{k}x{j}" for k in range(40) for j in range(3)]


def text(rng, n):
    return " ".join(rng.choices(WORDS[:300], weights=[1 / (k + 1) for k in range(300)], k=n))


@pytest.fixture(scope="module")
def items():
    rng = random.Random(4)
    return [(k, f"{text(rng, rng.randint(6, 25))}? {' '.join(f'a{k}x{j}' for j in range(3))} {text(rng, 3)}.") for k in range(40)]


def scores(items, passage):
    docs = [x.lower().replace("?", " ").replace(".", " ").split() for _, x in items]
    mean, df = sum(map(len, docs)) / len(docs), Counter(w for d in docs for w in set(d))
    out = []
    for d in docs:
        tf = Counter(d)
        weight = {w: math.log1p((len(docs) - df[w] + 0.5) / (df[w] + 0.5)) * n * (decontam.K1 + 1)
                  / (n + decontam.K1 * (1 - decontam.B + decontam.B * len(d) / mean)) for w, n in tf.items()}
        out.append(sum(v for w, v in weight.items() if w in passage) / sum(weight.values()))
    return np.array(out)


@pytest.fixture(scope="module")
def index(spark, items):
    return decontam.shards(spark.createDataFrame(items, "item_id long, text string"))[0]


def hashed(words):
    return {w: int(next(decontam._words(pa.array([w])))[2][0]) for w in words}


def test_block_max_wand_finds_all_above_threshold(index, items):
    rng, code = random.Random(5), hashed(WORDS)
    place = {int(h): k for k, h in enumerate(index.vocabulary)}
    for threshold in (0.05, 0.2, 0.4, 0.6):
        for _ in range(40):
            passage = set(rng.sample(WORDS, rng.randint(1, 120)))
            if rng.random() < 0.5:
                passage |= set(rng.choice(items)[1].lower().replace("?", " ").replace(".", " ").split())
            terms = np.array(sorted(place[code[w]] for w in passage if code[w] in place))
            true = scores(items, passage)
            found = dict(decontam.block_max_wand(index, terms, threshold))
            assert {index.ids[k] for k in found} == {k for k, s in enumerate(true) if s >= threshold - 1e-6}
            assert all(abs(true[index.ids[k]] - s) < 1e-9 for k, s in found.items())


def test_planted_items_are_found_and_clean_texts_left(spark, items):
    rng = random.Random(6)
    rows, want = [], set()
    for d in range(60):
        words = text(rng, rng.randint(0, 400))
        if d % 3 == 0:
            k, item = rng.choice(items)
            item = item.upper().replace(" ", "\n", 1) if d % 2 else item
            words = f"{text(rng, rng.randint(0, 200))} {item} {words}"
            want.add((d, k))
        elif d % 3 == 1:
            words += " " + rng.choice(items)[1].split("?")[0]  # a question without its answer
        rows.append((d, words))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench).collect()}
    assert want <= found
    assert {d for d, _ in found} == {d for d, _ in want}
    kept = {r.doc_id for r in decontam.clean(docs, bench).collect()}
    assert kept == {d for d, _ in rows} - {d for d, _ in want}


def test_shards_give_the_same(spark, items, monkeypatch):
    docs = spark.createDataFrame([(k, f"before {x} after") for k, x in items[:10]], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    one = sorted(tuple(r)[:2] for r in decontam.contaminated(docs, bench).collect())
    monkeypatch.setattr(decontam, "SHARD_ITEMS", 12)
    assert len(decontam.shards(bench)) > 1
    assert sorted(tuple(r)[:2] for r in decontam.contaminated(docs, bench).collect()) == one


def test_many_items_are_one_pass(spark):
    """5,000 items, ten shards: the texts are read once; smaller groups give the same."""
    rng = random.Random(8)
    items = [(k, f"item{k} {text(rng, 8)} q{k}z? answer{k} {text(rng, 2)} end{k}.") for k in range(5000)]
    docs = spark.createDataFrame([(k, f"{text(rng, 30)} {items[k * 7][1]} {text(rng, 30)}") for k in range(40)],
                                 "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.contaminated(docs, bench)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    pairs = sorted(tuple(r)[:2] for r in found.collect())
    assert {(k, k * 7) for k in range(40)} <= set(pairs)
    assert sorted(tuple(r)[:2] for r in decontam.contaminated(docs, bench, pass_shards=4).collect()) == pairs


def test_odd_rows(spark, odd_docs, no_docs):
    schema = "item_id long, text string, doc_id long, words int"
    bench = spark.createDataFrame([(1, None, 1, 1), (2, "", 2, 2), (3, "Second THE same", 0, 0), (3, "Second THE same", 0, 0),
                                   (None, "w1 no such words here", 1, 1), (5, "one two", 1, 1)], schema)
    found = {(r.doc_id, r.item_id) for r in decontam.contaminated(odd_docs, bench).collect()}
    assert found == {(5, 5)}
    out = decontam.clean(odd_docs, bench)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count() - 2
    none = spark.createDataFrame([], schema)
    assert decontam.contaminated(odd_docs, none).count() == 0
    assert decontam.clean(odd_docs, none).count() == odd_docs.count()
    assert decontam.contaminated(no_docs, bench).count() == 0


def test_answer_split():
    for text, answer in (("Who? Me", "Me"), ("What is it? Tell me.\nA thing", "Tell me.\nA thing"),
                         ("A line\nan answer.", "an answer."), ("One. Two. Three.", "Three."), ("a b c d", "c d"),
                         ("word", "")):
        assert text[decontam.answer_at(text):].strip() == answer


@needs_data
def test_driver_documents(spark):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    found = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, bench).collect()}
    items = {r.item_id: r.text for r in bench.collect()}
    verbatim = {(r.doc_id, k) for r in docs.collect() for k, t in items.items() if t in r.text}
    assert verbatim <= found
