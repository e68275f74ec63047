"""Language identification by error-correcting output codes.

Every language has a codeword; for each bit a binary classifier tells the languages with a
one from those with a zero by byte n-grams (n = 1 .. 3).  A text's margins are
decoded to the codeword with the least loss, where each bit counts by how often its
classifier was right on held-back sample texts (loss-weighted decoding).  The
share of the nearest codeword in exp(-loss) is the score; a text whose two nearest
codewords are close is flagged as ambiguous.

Codewords: for up to ``EXHAUSTIVE`` languages the exhaustive code (all ways to cut
them in two), else the seeded random code with the largest least distance
of ``TRIALS`` drawn ones.

Scale.  Classifiers are fitted on about ``SAMPLE`` documents of each language, chosen
by a hash of their doc_id; their n-gram counts are summed in 16 tasks, and
the driver gets one count vector for each language and task.  Prediction is one pass over
whole texts, in numpy over the bytes of a batch, without a shuffle.

Features are hashed n-grams over the text with A-Z lower-cased and every run of
other ASCII characters that are not letters as one space; language, source and
doc_id never enter a prediction.

Defined results: a null text, or one without a letter, is ``und`` with score 0; with
nothing to learn from every text is ``und``; with one language every text with
letters gets it, with score 1; ties go to the language that sorts first; rows that share a
doc_id are predicted each for itself; a null doc_id is never held out; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ASCII_LOWER, bounded_batches, byte_chunks, map_batches, mix64, shared, utf8_bytes

UNKNOWN = "und"
#: Documents of a language that the classifiers are fitted on, by expectation.
SAMPLE = 1500
SLOTS = 1 << 14
EXHAUSTIVE = 6
TRIALS = 200
#: Languages of up to so many documents hold none back for calibration.
FEW = 8
#: Two codewords whose shares differ by less are too close to call.
CLOSE = 0.2
FOLDS = 5

_CLASS = np.full(256, 32, np.uint8)
_CLASS[65:91] = ASCII_LOWER[65:91]
_CLASS[97:123] = np.arange(97, 123)
_CLASS[128:] = np.arange(128, 256)


def held_out(doc_id="doc_id"):
    """Documents that take no part in learning."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the n-grams of all rows, and where each row's begin."""
    n_rows = len(offsets) - 1
    kind = _CLASS[data]
    row = np.repeat(np.arange(n_rows), np.diff(offsets))
    keep = np.ones(len(kind), bool)
    keep[1:] = (kind[1:] != 32) | (kind[:-1] != 32) | (row[1:] != row[:-1])
    kind, row = kind[keep].astype(np.uint32), row[keep]
    slots, rows = [], []
    for n in (1, 2, 3):
        if len(kind) < n:
            continue
        m = len(kind) - n + 1
        code = kind[:m].copy()
        for k in range(1, n):
            code = (code << np.uint32(8)) | kind[k:k + m]
        code = (code + np.uint32(n << 24)) * np.uint32(2654435761)
        inside = row[:m] == row[n - 1:]
        slots.append((code >> np.uint32(18))[inside].astype(np.int32))
        rows.append(row[:m][inside])
    slots, rows = np.concatenate(slots or [np.zeros(0, np.int32)]), np.concatenate(rows or [np.zeros(0, int)])
    return slots, rows


def has_letters(column: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.match_substring_regex(column, r"\pL"), False).to_numpy(zero_copy_only=False)


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n rows of +1 and -1, a column for each binary classifier."""
    if n < 2:
        return np.zeros((n, 0), np.int8)
    if n <= EXHAUSTIVE:
        cuts = np.arange(1, 1 << (n - 1))
        return np.where((cuts[None, :] >> np.arange(n)[:, None]) & 1, 1, -1).astype(np.int8)
    rng, bits, best = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n))), None
    for _ in range(TRIALS):
        code = rng.choice(np.array([-1, 1], np.int8), (n, bits))
        code = code[:, np.abs(code.sum(axis=0)) < n]
        apart = (code.shape[1] - code.astype(int) @ code.T.astype(int)) // 2
        least = apart[~np.eye(n, dtype=bool)].min()
        if best is None or least > best[0]:
            best = least, code
    return best[1]


@dataclass
class OutputCode:
    langs: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # slots x bits, mean log odds of the bit
    scale: np.ndarray  # a bit's margin is its mean log odds times this
    trust: np.ndarray  # weight of a bit's loss

    def margins(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Margins of all rows, a column for each bit."""
        out = np.zeros((len(offsets) - 1, self.code.shape[1]))
        for a, b in byte_chunks(offsets, 1 << 20):
            part = offsets[a:b + 1] - offsets[a]
            slots, rows = grams(data[offsets[a]:offsets[b]], part)
            counts = np.maximum(np.bincount(rows, minlength=b - a), 1)
            for k in range(out.shape[1]):
                out[a:b, k] = np.bincount(rows, weights=self.weights[slots, k], minlength=b - a) / counts
        return out

    def shares(self, margins: np.ndarray) -> np.ndarray:
        """exp(-loss) of every language's codeword, as shares of a row."""
        loss = np.log1p(np.exp(-np.clip(margins * self.scale, -30, 30)[:, None, :] * self.code[None]))
        near = -(loss * self.trust).sum(axis=2)
        near = np.exp(near - near.max(axis=1, keepdims=True))
        return near / near.sum(axis=1, keepdims=True)


def learn(counts: dict[str, np.ndarray], langs: list[str]) -> OutputCode:
    """Weights of the bits from n-gram counts of each language, which weigh alike."""
    code = codewords(len(langs))
    share = np.array([(counts[x] + 0.5) / (counts[x].sum() + 0.5 * SLOTS) for x in langs])
    weights = np.zeros((SLOTS, code.shape[1]), np.float32)
    for k in range(code.shape[1]):
        weights[:, k] = np.log(share[code[:, k] > 0].mean(axis=0)) - np.log(share[code[:, k] < 0].mean(axis=0))
    ones = np.ones(code.shape[1])
    return OutputCode(langs, code, weights, ones, ones)


def calibrate(model: OutputCode, margins: np.ndarray, langs: np.ndarray) -> OutputCode:
    """Scale and trust of each bit from texts that its weights have not seen."""
    known = np.isin(langs, model.langs)
    margins, langs = margins[known], langs[known]
    if not len(langs) or not model.code.shape[1]:
        return model
    sign = model.code[[model.langs.index(x) for x in langs]]
    signed = margins * sign
    scale = 4 / np.maximum(np.median(np.abs(margins), axis=0), 1e-6)
    right = ((signed > 0).sum(axis=0) + 1) / (len(langs) + 2)
    trust = np.log(right / (1 - right)).clip(0.05, None)
    return OutputCode(model.langs, model.code, model.weights, scale, trust / trust.mean())


def fitted(docs: DataFrame, sample: int = SAMPLE) -> OutputCode:
    """The model from texts and languages of documents that are not held out."""
    bounded_batches(docs.sparkSession)
    usable = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out())
    # A hash of doc_id and text, even over 0 .. 1, decides who is in the sample; the document
    # with the lowest is learned from in any case, so every language gets a codeword.
    own = F.xxhash64("doc_id", "text")
    sizes = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(own).alias("low"))
    even = F.pmod(own, F.lit(1 << 30)) / float(1 << 30)
    back = (F.pmod(F.xxhash64(F.lit("back"), "doc_id", "text"), F.lit(4)) == 0) & (F.col("n") > FEW) & (own != F.col("low"))
    # One row for each language is sent to the texts; the texts are not dealt out by language.
    texts = (usable.join(F.broadcast(sizes), "lang").where((even < sample / F.col("n")) | (own == F.col("low")))
             .select("lang", "text", back.alias("back"))
             .repartition(16))

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            batch = batch.filter(pc.invert(batch.column(2)))
            names = batch.column(0).dictionary_encode()
            langs, code = names.dictionary.to_pylist(), np.asarray(names.indices)
            data, offsets = utf8_bytes(batch.column(1))
            for a, b in byte_chunks(offsets, 1 << 20):
                slots, rows = grams(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                both = np.bincount(code[a + rows] * SLOTS + slots, minlength=len(langs) * SLOTS)
                for x, part in zip(langs, both.reshape(len(langs), SLOTS)):
                    sums[x] = sums.get(x, 0) + part
        if sums:
            yield pa.record_batch([pa.array(list(sums)), pa.array([v.astype(np.int64) for v in sums.values()],
                                                                  pa.list_(pa.int64()))], names=["lang", "counts"])

    counts: dict[str, np.ndarray] = {}
    for r in texts.mapInArrow(count, "lang string, counts array<long>").toLocalIterator():
        counts[r["lang"]] = counts.get(r["lang"], 0) + np.array(r["counts"], np.int64)
    model = learn(counts, sorted(counts))
    if model.code.shape[1] == 0:
        return model
    held = shared(docs.sparkSession, model)

    def margins(batch: pa.RecordBatch) -> pa.RecordBatch:
        m = held().margins(*utf8_bytes(batch.column(1)))
        return pa.record_batch([batch.column(0), pa.array(list(m), pa.list_(pa.float64()))], names=["lang", "margins"])

    rows = map_batches(texts.where("back").select("lang", "text"), margins, "lang string, margins array<double>").collect()
    return calibrate(model, np.array([r["margins"] for r in rows]).reshape(len(rows), -1),
                     np.array([r["lang"] for r in rows], object))


def predicted(docs: DataFrame, model: OutputCode) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous of every document."""
    bounded_batches(docs.sparkSession)
    held = shared(docs.sparkSession, model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        text, model = batch.column(2), held()
        n, some = len(text), has_letters(batch.column(2))
        langs, score, close = np.full(n, UNKNOWN, object), np.zeros(n), np.zeros(n, bool)
        if model.langs:
            share = model.shares(model.margins(*utf8_bytes(text)))
            top = np.argmax(share, axis=1)
            langs[some] = np.array(model.langs, object)[top[some]]
            ranked = np.sort(share, axis=1)
            score[some] = ranked[some, -1]
            if len(model.langs) > 1:
                close[some] = (ranked[:, -1] - ranked[:, -2] < CLOSE)[some]
        return pa.record_batch([batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(score),
                                pa.array(close)], names=["doc_id", "held_out", "lang_pred", "score", "ambiguous"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return map_batches(rows, run, "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")


def identify(docs: DataFrame) -> DataFrame:
    return predicted(docs, fitted(docs.select("doc_id", "text", "lang")))
