"""Vantage-point search against brute force."""

import numpy as np
import pytest

from scorebook.llm import vp_search


def brute(rows, k=20, every=20):
    use = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v):
            use.setdefault((i, tuple(v)), None)
    lengths = [len(v) for _, v in use]
    common = max(sorted(set(lengths)), key=lengths.count) if lengths else 0
    use = [x for x in use if len(x[1]) == common]
    out = []
    asked = {}
    for i, v in use:
        if i % every == 0:
            asked[i] = min(asked.get(i, v), v)
    for i, v in asked.items():
        hits = []
        for j, w in use:
            if j != i:
                s = 0.0
                for a, b in zip(w, v):
                    s += a * b
                hits.append((-s, j))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(hits)[:k])]
    return sorted(out)


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, id int, v string")
    return sorted(tuple(r) for r in vp_search.nearest(df, **options).collect())


def as_rows(ids, x):
    return [(int(i), [float(a) for a in v], 1, 2, None) for i, v in zip(ids, np.asarray(x, np.float32))]


def test_exact_over_shards_and_blocks(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 8)) * rng.uniform(0.5, 2, (900, 1))
    x[100:220] = x[7]  # a large group of copies, queries among them
    x[300:340] = np.round(x[300:340])
    rows = as_rows(range(900), x)
    got = found(spark, rows, shard_points=200, query_block=16, query_part=20, leaf=10)
    assert got == brute([(r[0], r[1]) for r in rows])


def test_ties_at_the_cut(spark):
    rng = np.random.default_rng(2)
    x = rng.choice([-1.0, 0.0, 1.0], (500, 3))
    rows = as_rows(range(500), x)
    assert found(spark, rows, leaf=8) == brute([(r[0], r[1]) for r in rows])
    unit = np.tile(np.eye(64), (1, 1))
    rows = as_rows(range(64), unit)  # every other vector is equally far
    assert found(spark, rows, leaf=4) == brute([(r[0], r[1]) for r in rows])


def test_odd_vectors(spark):
    rows = [(0, [1.0, 2.0], None, None, None), (1, None, 1, 1, "x"), (2, [0.0, 0.0], 1, 1, "x"), (3, [None, 1.0], 1, 1, "x"),
            (4, [float("nan"), 1.0], 1, 1, "x"), (5, [float("inf"), 1.0], 1, 1, "x"), (6, [1.0], 1, 1, "x"), (7, [], 1, 1, "x"),
            (None, [1.0, 1.0], 1, 1, "x"), (8, [3.0, 1.0], 1, 1, "x"), (8, [3.0, 1.0], 1, 1, "x"), (9, [1.0, 2.0], 1, 1, "x"),
            (20, [-1.0, 0.5], 1, 1, "x"), (20, [5.0, 5.0], 1, 1, "x")]
    assert found(spark, rows) == brute([(r[0], r[1]) for r in rows])
    assert found(spark, rows[1:3]) == [] and found(spark, []) == []


def test_smaller_factor_compares_less():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 16))
    x = centres[rng.integers(0, 40, 4000)] + 0.2 * rng.normal(size=(4000, 16))
    q = x[::50]
    exact, loose = vp_search.Search(x, q, 21, 1.0, 32), vp_search.Search(x, q, 21, 0.5, 32)
    true = np.sort(((q[:, None, :] - x[None]) ** 2).sum(axis=2), axis=1)[:, :21]
    assert np.allclose(exact.dist ** 2, true, atol=1e-9)
    recall = np.mean([len(set(a) & set(b)) / 21 for a, b in zip(exact.place, loose.place)])
    assert loose.compared < exact.compared < 80 * 4000 * 0.9 and recall > 0.9
    with pytest.raises(ValueError):
        vp_search.Search(x, q, 5, 0.0)
