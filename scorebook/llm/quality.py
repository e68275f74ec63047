"""Quality grades by ordinal cumulative-link regression on hashed text.

The ratings of ``labels`` give three grades: ``quality + (1 - toxic)``, so 0 is a poor
and toxic text, 1 has one of the two faults, 2 is good and clean.  One weight
vector is shared by all thresholds:

    P(grade <= k | x) = sigmoid(theta_k - w . x),   theta_0 < theta_1

``x`` are hashed features: which words occur (lower-cased, 2^18 slots) and binned
measures of the text's form (share of capitals, marks, digits, bars, repeated words,
length of words, lines and text).  Selection takes the expected grade or the tail
probability P(grade >= 2).

Scale.  The model is fitted on at most ``SAMPLE`` rated documents (those with the
smallest hash of their doc_id), which bounds what the driver holds; scoring is one
pass over the whole texts without a shuffle.

Defined results: a null, empty or wordless text has expected grade 0, tail
probability 0 and is not kept; ratings with a null are not used; with no ratings at
all (or of one grade only) the model is constant and keeps every text with words;
rows that share a doc_id are scored each for itself; a null doc_id is scored like
any other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, byte_chunks, map_batches, run_hashes, shared, utf8_bytes
from .sketch import NOT_WORD, word_spans

#: Rated documents the model is fitted on at most.
SAMPLE = 6000
SLOTS = 1 << 18
#: A word slot gets a weight if it occurs in so many documents of the sample.
LEAST_DOCS = 8
#: Weight of the penalty, times the root of the sample's size: what chance alone makes of a slot's slope.
L1 = 0.05
#: Squared penalty of the second fit.
L2 = 0.1
GRADES = 3
TAIL = 2
KEEP_AT = 0.5

_BINS = 16
_FORMS = 9
_FORM_SLOTS = _BINS * _FORMS


def _forms(raw: np.ndarray, words: np.ndarray, lengths: np.ndarray) -> list[int]:
    """Slots of a text's binned measures of form."""
    n = max(len(raw), 1)
    kinds = np.bincount(raw, minlength=256)
    letters = max(int(kinds[65:91].sum() + kinds[97:123].sum() + kinds[128:].sum()), 1)
    marks = int(kinds[33:48].sum() + kinds[58:65].sum() + kinds[91:97].sum() + kinds[123:127].sum())
    share = lambda x: min(_BINS - 1, int(x * _BINS))
    step = lambda x: min(_BINS - 1, int(np.log2(1 + x)))
    distinct = len(np.unique(words))
    repeats = int((words[1:] == words[:-1]).sum())
    measures = [
        share(kinds[65:91].sum() / letters),
        share(4 * marks / n),
        share(4 * kinds[48:58].sum() / n),
        share(16 * kinds[124] / n),
        share(1 - distinct / max(len(words), 1)) if len(words) < 200 else _BINS - 1 - share(distinct ** 2 / len(words) ** 2),
        share(2 * repeats / max(len(words), 1)),
        min(_BINS - 1, int(lengths.mean())) if len(lengths) else 0,
        step(len(words)),
        step(n / (1 + kinds[10])),
    ]
    return [k * _BINS + m for k, m in enumerate(measures)]


def features(column: pa.Array) -> list[np.ndarray]:
    """Sorted distinct slots of each text; none for a text without words."""
    raw, raw_at = utf8_bytes(column)
    low, low_at = utf8_bytes(pc.utf8_lower(column))
    out = []
    for a, b in byte_chunks(low_at):
        part = low[low_at[a]:low_at[b]]
        starts, ends, first = word_spans(part, low_at[a:b + 1] - low_at[a], NOT_WORD)
        hashes = run_hashes(part, starts, ends)
        lengths = ends - starts
        slots = _FORM_SLOTS + (hashes >> np.uint64(20)).astype(np.int64) % (SLOTS - _FORM_SLOTS)
        for r in range(b - a):
            lo, hi = first[r], first[r + 1]
            if lo == hi:
                out.append(np.zeros(0, np.int32))
                continue
            form = _forms(raw[raw_at[a + r]:raw_at[a + r + 1]], hashes[lo:hi], lengths[lo:hi])
            out.append(np.concatenate([form, np.unique(slots[lo:hi])]).astype(np.int32))
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class CumulativeLink:
    weights: np.ndarray  # one for each slot, shared by the thresholds
    thresholds: np.ndarray  # rising, one less than there are grades

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        return np.array([self.weights[r].sum(dtype=np.float64) for r in rows])

    def at_least(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. grades-1, a column each."""
        return 1 - _sigmoid(self.thresholds[None, :] - scores[:, None])


def fit(rows: list[np.ndarray], grades: np.ndarray, n_grades: int = GRADES, slots: int = SLOTS,
        least_docs: int = LEAST_DOCS, l1: float = L1, steps: int = 300, rate: float = 0.1) -> CumulativeLink:
    """Maximum likelihood by Adam over the whole sample, twice: with an absolute
    penalty, which leaves only slots that tell grades apart, then over those slots with
    a slight squared penalty, so that their weights are not held small."""
    if not len(rows):
        return CumulativeLink(np.zeros(slots, np.float32), np.linspace(-40, -20, n_grades - 1))
    flat = np.concatenate(rows)
    seen = np.bincount(flat, minlength=slots)
    used = np.flatnonzero(seen >= min(least_docs, len(rows)))
    place = np.full(slots, -1, np.int64)
    place[used] = np.arange(len(used))
    col = place[flat]
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])[col >= 0]
    col = col[col >= 0]
    y, n = np.asarray(grades), len(rows)
    share = np.clip(np.cumsum(np.bincount(y, minlength=n_grades))[:-1] / n, 1e-3, 1 - 1e-3)
    theta = np.log(share / (1 - share))
    # theta_0 and the logarithms of the gaps keep the thresholds in order.
    params = np.concatenate([np.zeros(len(used)), theta[:1], np.log(np.maximum(np.diff(theta), 1e-2))])
    d = len(used)
    for chosen in (False, True):
        live = params[:d] != 0 if chosen else np.ones(d, bool)
        m, v = np.zeros_like(params), np.zeros_like(params)
        for t in range(1, steps + 1):
            gaps = np.exp(params[d + 1:])
            theta = params[d] + np.concatenate([[0], np.cumsum(gaps)])
            s = np.bincount(row, weights=params[:d][col], minlength=n)
            upper = np.where(y < n_grades - 1, _sigmoid(theta[np.minimum(y, n_grades - 2)] - s), 1.0)
            lower = np.where(y > 0, _sigmoid(theta[np.maximum(y - 1, 0)] - s), 0.0)
            p = np.maximum(upper - lower, 1e-9)
            d_score = 1 - upper - lower
            grad = np.zeros_like(params)
            grad[:d] = np.bincount(col, weights=d_score[row], minlength=d)
            grad[:d] = (grad[:d] + L2 * params[:d]) * live if chosen else grad[:d]
            d_theta = np.zeros(n_grades - 1)
            np.add.at(d_theta, y[y < n_grades - 1], -(upper * (1 - upper) / p)[y < n_grades - 1])
            np.add.at(d_theta, y[y > 0] - 1, (lower * (1 - lower) / p)[y > 0])
            grad[d] = d_theta.sum()
            grad[d + 1:] = np.cumsum(d_theta[::-1])[::-1][1:] * gaps
            m = 0.9 * m + 0.1 * grad
            v = 0.99 * v + 0.01 * grad ** 2
            pace = rate * (0.5 + 0.5 * np.cos(np.pi * t / steps)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-8)
            params -= pace * (m / (1 - 0.9 ** t))
            if not chosen:
                params[:d] = np.sign(params[:d]) * np.maximum(np.abs(params[:d]) - pace[:d] * l1 * np.sqrt(n), 0)
    weights = np.zeros(slots, np.float32)
    weights[used] = params[:d]
    theta = params[d] + np.concatenate([[0], np.cumsum(np.exp(params[d + 1:]))])
    return CumulativeLink(weights, theta)


def rated_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[list[np.ndarray], np.ndarray]:
    """Features and grades of at most ``sample`` rated documents."""
    rated = (labels.where(F.col("quality").isNotNull() & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .select("doc_id", (F.col("quality") + 1 - F.col("toxic")).cast("int").alias("grade")))
    few = rated.orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(sample)
    texts = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").select("grade", "text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([batch.column(0), pa.array(features(batch.column(1)), pa.list_(pa.int32()))],
                               names=["grade", "slots"])

    got = map_batches(texts, run, "grade int, slots array<int>").where(F.size("slots") > 0).toArrow()
    rows = [np.asarray(x.values) for x in got.column("slots").combine_chunks()] if got.num_rows else []
    return rows, np.array(got.column("grade").to_pylist(), np.int64)


def fitted(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> CumulativeLink:
    return fit(*rated_sample(docs, labels, sample))


def graded(docs: DataFrame, model: CumulativeLink, tail: int = TAIL, keep_at: float = KEEP_AT) -> DataFrame:
    """``docs`` with expected_grade, tail_probability and kept."""
    bounded_batches(docs.sparkSession)
    held = shared(docs.sparkSession, model)
    names = [c for c in docs.columns if c not in ("expected_grade", "tail_probability", "kept")]
    docs = docs.select(names)
    text_at = names.index("text")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = features(batch.column(text_at))
        ge = held().at_least(held().scores(rows))
        ge[[not len(r) for r in rows]] = 0
        p = ge[:, tail - 1]
        return pa.record_batch([*batch.columns, pa.array(ge.sum(axis=1)), pa.array(p), pa.array(p >= keep_at)],
                               names=[*names, "expected_grade", "tail_probability", "kept"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields),
                        "expected_grade double, tail_probability double, kept boolean"])
    return map_batches(docs, run, schema)


def grades(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, expected_grade, tail_probability, kept of every document."""
    scored = graded(docs.select("doc_id", "text"), fitted(docs, labels))
    return scored.select("doc_id", "expected_grade", "tail_probability", "kept")
