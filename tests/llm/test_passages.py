"""Substring dedup against brute force over all windows."""

import hashlib
import random

import numpy as np
import pytest

from scorebook.llm import passage_dedup


def brute(rows, window=20):
    """rows: (doc_id, text) with distinct texts for a doc_id."""
    order = sorted({(d is not None, d or 0, d, t or "") for d, t in rows}, key=lambda r: r[:2])
    seen, out = set(), {}
    for *_, d, t in order:
        words = t.encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            key = tuple(words[i:i + window])
            if key in seen:
                gone[i:i + window] = [True] * window
            seen.add(key)
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out[d, t] = (d, len(words), sum(gone), hashlib.sha256(kept).hexdigest())
    return sorted((out[d, t or ""] for d, t in rows), key=str)


def digests(df, **options):
    found = passage_dedup.dedup_passages(df, **options)
    return sorted(((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.text.encode()).hexdigest())
                   for r in found.collect()), key=str)


def made(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


def test_passages_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert sorted((tuple(r) for r in passage_dedup.digest(odd_docs).collect()), key=str) == brute(rows)


def test_passages_empty_table(no_docs):
    assert digests(no_docs) == []


def corpus(rng, n):
    vocabulary = [f"w{k}" for k in range(60)] + ["é", "\U0001F600", "x" * 50]
    passages = [rng.choices(vocabulary, k=rng.choice([10, 19, 20, 21, 35, 60])) for _ in range(6)]
    phrase = rng.choices(vocabulary, k=8)
    rows = []
    for k in range(n):
        words = []
        for _ in range(rng.randint(0, 5)):
            kind = rng.random()
            words += (rng.choice(passages) if kind < 0.35 else phrase if kind < 0.6 else ["a"] * rng.randint(1, 70)
                      if kind < 0.65 else rng.choices(vocabulary, k=rng.randint(0, 45)))
            if rng.random() < 0.1 and words:
                words[rng.randrange(len(words))] = "changed"
        rows.append((k if k % 37 else None, rng.choice([" ", "\n", "\t "]).join(words) + f" end{k}" * (k % 37 == 0)))
    rows += [(1000 + k, rows[k][1]) for k in range(0, n, 9)]
    one_null = [r for r in rows if r[0] is not None] + [r for r in rows if r[0] is None][:1]
    return one_null + one_null[3:5]


@pytest.mark.parametrize("options", [{}, {"hot": 3, "hot_share": 40}, {"hot": 1, "hot_share": 10**9}, {"group": 1},
                                     {"window": 5, "group": 2}])
def test_passages_random(spark, options):
    rows = corpus(random.Random(len(options)), 150)
    assert digests(made(spark, rows), **options) == brute(rows, options.get("window", 20))


def test_hot_phrase_and_many_copies(spark):
    rng = random.Random(4)
    line = " ".join(f"common{k}" for k in range(9))
    copy = " ".join(f"copy{k}" for k in range(120))
    rows = [(k, " ".join([f"{rng.random()}" for _ in range(25)] + [line] + [f"{rng.random()}" for _ in range(25)]))
            for k in range(400)] + [(1000 + k, copy) for k in range(300)]
    assert digests(made(spark, rows), hot=20, hot_share=10**6) == brute(rows)


def test_super_kmers_cover_each_window_once():
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 9, 500).astype(np.uint64)
    first = np.array([0, 0, 30, 49, 69, 300, 310, 500])
    row, start, n, mini = passage_dedup.super_kmers(hashes, first)
    windows = [(r, s + k) for r, s, m in zip(row, start, n) for k in range(m - 19)]
    assert windows == [(r, s) for r in range(7) for s in range(first[r + 1] - first[r] - 19)]
    assert max(n) <= 2 * 20 - 5
    by_words = {}
    for r, s, m, x in zip(row, start, n, mini):
        for k in range(m - 19):
            at = first[r] + s + k
            assert by_words.setdefault(tuple(hashes[at:at + 20]), x) == x


def test_texts_are_shuffled_once(spark):
    """Both joins of the texts read one exchange when neither other side is small."""
    rows = corpus(random.Random(9), 60)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        found = passage_dedup.dedup_passages(made(spark, rows))
        found.collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "ReusedExchange" in plan
        assert digests(made(spark, rows)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old)
