"""Line dedup and near-duplicates against brute force."""

import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st
import numpy as np

from scorebook.llm import line_dedup, near_dedup, sketch
from scorebook.llm.common import utf8_bytes
from scorebook.llm.components import components

import pyarrow as pa

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_lines(rows, min_chars=20, min_docs=3):
    """rows: (doc_id, text) -> list of (doc_id, n_lines, n_dropped, kept text)."""
    key = lambda line: line.strip(SPACE).translate(LOWER)
    held = {}
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                held.setdefault(key(line), set()).add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        last = lambda x: max((i for i in held[x] if i is not None), default=None)
        kept = [x for x in lines if not (key(x) in held and len(held[key(x)]) >= min_docs and last(key(x)) != d)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def as_digest(rows):
    return sorted(((d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in rows), key=str)


def digest_rows(df):
    return sorted((tuple(r) for r in line_dedup.digest(df).collect()), key=str)


def test_lines_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert digest_rows(odd_docs) == as_digest(brute_lines(rows))


def test_lines_empty_table(no_docs):
    assert line_dedup.digest(no_docs).count() == 0


def test_lines_random(spark):
    rng = random.Random(3)
    pool = [f"{'Line' if k % 3 else ' line'} number {k:>12} of the pool É{'é' * (k % 2)}{' ' * (k % 4)}" for k in range(12)]
    pool += ["short", "", "   ", "İstanbul is a city of some length", "istanbul is a city of some length"]
    rows = [(k // 2 if k % 10 == 0 else k, "\n".join(rng.choices(pool, k=rng.randint(1, 9)))) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert digest_rows(df) == as_digest(brute_lines(rows))


def test_lines_carry_other_columns(odd_docs):
    out = line_dedup.dedup_lines(odd_docs)
    assert out.columns == [*odd_docs.columns, "line_count", "lines_dropped"]
    assert out.count() == odd_docs.count()
    assert out.where("doc_id = 1").first()["text"] is None


def test_runs_merge_by_level(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    for b in range(5):
        runs.add(spark.createDataFrame([(1, 1, b), (2 + b, 1, b)], "h long, g int, doc long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert [tuple(r) for r in runs.repeated(3).collect()] == [(1, 1, 4)]


def test_line_plan_is_native(spark, odd_docs):
    plan = line_dedup.digest(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def brute_near(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][0] is None or rows[j][0] is None:
                continue
            both = len(sets[i] & sets[j])
            if (both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both)) or \
                    (rows[i][0] == rows[j][0] and sets[i] and sets[j]):
                up[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, len(s), None if d is None else low[find(i)], d is not None and low[find(i)] == d)
                   for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def near_rows(df, **options):
    return sorted((tuple(r) for r in near_dedup.near_duplicates(df, **options).collect()), key=str)


def test_near_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert near_rows(odd_docs) == brute_near(rows)


def test_near_empty_table(no_docs):
    assert near_dedup.near_duplicates(no_docs).count() == 0


def test_near_group_of_edited_copies(spark):
    """One large group around the threshold: buckets too large to pair up."""
    rng = random.Random(5)
    base = [f"w{rng.randint(0, 400)}" for _ in range(90)]
    rows = []
    for k in range(70):
        words = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3, 4, 5])):
            words[rng.randrange(90)] = f"new{rng.random()}"
        rows.append((k * 3, " ".join(words)))
    rows += [(1000 + k, rows[k][1]) for k in range(0, 20, 2)]
    rows += [(11, rows[4][1]), (11, "another text under the same id as a copy")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert near_rows(df, small=2) == brute_near(rows)


def test_prefix_pairs_lose_no_link(spark):
    rng = np.random.default_rng(2)
    bases = [rng.choice(500, n, replace=False) for n in (4, 9, 17, 30, 55)]
    sets = []
    for k in range(60):
        own = bases[k % 5].copy()
        where = rng.random(len(own)) < rng.choice([0.02, 0.1, 0.2])
        own[where] = rng.integers(0, 500, where.sum())
        sets.append(np.unique(own[:len(own) - rng.integers(0, 2)]))
    df = spark.createDataFrame([(k, [int(x) for x in s]) for k, s in enumerate(sets)], "doc_id long, shingles array<long>")
    labels = spark.createDataFrame([(k, k) for k in range(len(sets))], "doc_id long, label long")
    found = {tuple(r) for r in near_dedup.confirmed(near_dedup.prefix_pairs(df, labels), df).collect()}
    true = {(a, b) for a in range(60) for b in range(a + 1, 60)
            if 100 * len(np.intersect1d(sets[a], sets[b])) >= 75 * len(np.union1d(sets[a], sets[b]))}
    assert found == true and true


def test_near_crowded_buckets_of_repeated_rows(spark):
    """Rows that occur twice, and a doc_id with two sets of one size, in buckets too large to pair up."""
    rng = random.Random(11)
    base = [f"w{k}" for k in range(300)]
    rows = []
    for k in range(24):
        words = list(base)
        for at in rng.sample(range(300), rng.choice([3, 5, 7, 9])):
            words[at] = f"new{rng.random()}"
        rows += [(k * 3, " ".join(words))] * (1 + k % 2)
    rows += [(3, rows[0][1].replace("w7 ", "other "))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert near_rows(df, small=2) == brute_near(rows)


def test_prefix_pairs_take_each_set_once(spark):
    rng = np.random.default_rng(4)
    base = rng.choice(1 << 40, 300, replace=False)
    sets = []
    for k in range(12):
        own = base.copy()
        own[rng.choice(300, 18 + k, replace=False)] = rng.integers(0, 1 << 40, 18 + k)
        sets.append([int(x) for x in np.unique(own)])
    once = spark.createDataFrame(list(enumerate(sets)), "doc_id long, shingles array<long>")
    labels = spark.createDataFrame([(k, k) for k in range(12)], "doc_id long, label long")
    true = {(a, b) for a in range(12) for b in range(a + 1, 12)
            if 100 * len({*sets[a]} & {*sets[b]}) >= 75 * len({*sets[a]} | {*sets[b]})}
    assert true
    # A second set of one doc_id and of one size changes nothing about the first.
    other = spark.createDataFrame([(0, [int(x) for x in rng.choice(1 << 40, len(sets[0]), replace=False)])], once.schema)
    for df in (once.unionByName(once.where("doc_id % 2 = 0")), once.unionByName(other)):
        pairs = near_dedup.prefix_pairs(df, labels)
        assert {tuple(r) for r in near_dedup.confirmed(pairs, once).collect()} == true


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 6), (6, 5), (5, 9), (20, 21), (None, 4), (30, 30)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 5: 5, 6: 5, 7: 5, 8: 5, 9: 5, 20: 20, 21: 20}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab É\n\t", max_size=40), min_size=1, max_size=6))
def test_shingle_sets_count(texts):
    got = [len(s) for s in sketch.shingle_sets(*utf8_bytes(pa.array(texts)))]
    for t, n in zip(texts, got):
        w = t.encode().lower().split()
        assert n == (len({tuple(w[k:k + 5]) for k in range(len(w) - 4)}) if len(w) >= 5 else min(1, len(w)))


def test_sketch_agreement_follows_similarity():
    rng = np.random.default_rng(1)
    for share in (0.2, 0.5, 0.8):
        agree = []
        for _ in range(60):
            common = rng.integers(0, 1 << 62, int(200 * share)).astype(np.uint64)
            rest = rng.integers(0, 1 << 62, 2 * int(100 * (1 - share))).astype(np.uint64)
            a, b = (np.unique(np.concatenate([common, r])) for r in np.split(rest, 2))
            x, y = sketch.fast_similarity_sketch(a), sketch.fast_similarity_sketch(b)
            agree.append((x == y).mean())
        true = len(common) / (len(common) + len(rest))
        assert abs(np.mean(agree) - true) < 0.03


def test_sketch_fills_every_coordinate():
    for n in (1, 2, 3, 7, 40, 500):
        s = sketch.fast_similarity_sketch(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(977))
        assert len(s) == sketch.BINS and (s != 0).all()


def test_complete_keys_leave_later_batches(spark):
    """Batches in falling order: a key complete in the runs is not written again."""
    runs = line_dedup.LineRuns(spark, fanout=8, complete_at=2)
    for d in (9, 8, 7):
        runs.add(spark.createDataFrame([(1, 1, d), (1, 1, d - 100 if d == 9 else d), (2 + d, 1, d)], "h long, g int, doc long"))
    written = [sorted(r["h"] for r in spark.read.parquet(p).collect()) for p in runs.levels[0]]
    assert written == [[1, 11], [10], [9]]
    assert [tuple(r) for r in runs.repeated(2).collect()] == [(1, 1, 2, 9)] or [
        (r["h"], r["last"]) for r in runs.repeated(2).collect()] == [(1, 9)]


def test_lines_in_any_number_of_batches(spark):
    rng = random.Random(6)
    pool = [f"line number {k:>12} of the pool" for k in range(9)]
    rows = [(k if k % 7 else None, "\n".join(rng.choices(pool, k=4) + [f"a line of its own, {k:>9}"])) for k in range(50)]
    rows = [r for r in rows if r[0] is not None] + [r for r in rows if r[0] is None][:1]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {d: t for d, _, _, t in brute_lines(rows)}
    for batches in (1, 2, 9):
        got = {r.doc_id: r.text for r in line_dedup.dedup_lines(df, batches=batches, fanout=3).collect()}
        assert got == want
