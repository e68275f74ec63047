"""Benchmark decontamination: BM25 over an inverted index of the test items, searched
with block-max WAND by every training passage, then a check of question and answer.

Index.  A test item's words are its postings; an impact is the BM25 weight of
a word in an item, divided by the item's score against itself, so that an item scores
1 for a passage that holds all its words and one threshold serves long and short items.
Postings are in blocks of ``BLOCK`` items with the largest impact of each.  The index
is cut into shards of bounded size by a hash of the item.  ``PASS_SHARDS`` shards (8,192
items) are broadcast together and searched in one pass over the texts, whose words are
hashed once for all of them; a benchmark of more items takes a pass for each such group,
and the driver holds one group at a time.

Search.  A document is cut into passages: windows of twice the longest item of the
shard, half a window apart, so every item lies whole in one of them.  Block maxima are
first summed over all words of a passage: where no block can reach the threshold
the passage is done (this is WAND's pivot test for all blocks at once, in numpy).  The
others go through ``block_max_wand``, which moves posting cursors by pivot and skips
blocks by their maxima, and gives every item at or above the threshold.  Nothing is
cut off by rank.

Check.  An item is taken as a question and an answer: split after the last question
mark, else at the last line feed, else before the last sentence, else in the middle.  Both must
be covered by the passage and half a window on either side: the share of their word
trigrams (words, if shorter) found there must reach ``QUESTION`` and ``ANSWER``.

Words are runs of letters and digits, lower-cased, compared by 64-bit hashes.

Defined results: texts and items that are null or without words match nothing; equal
items with different ids each match; rows that share a doc_id are searched each for
itself and reported together with their best figures; a null doc_id is reported like
any other; ties keep all items; an empty table on either side gives an empty
result; other columns are ignored (``clean`` carries them through).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, byte_chunks, map_batches, materialise, run_hashes, shared, utf8_bytes
from .sketch import NOT_WORD, word_spans

K1, B = 1.2, 0.75
#: A passage's score must reach this share of the item's own.
THRESHOLD = 0.6
QUESTION = ANSWER = 0.5
#: Items in a posting block.
BLOCK = 4
#: Items, and words of items, that a shard of the index holds on average at most.
SHARD_ITEMS = 512
SHARD_WORDS = 100_000
#: Shards that are searched in one pass.
PASS_SHARDS = 16
GRAM = 3


def _words(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Chunks of a string column: first and last row, word hashes, first word of each row."""
    data, offsets = utf8_bytes(pc.utf8_lower(column))
    for a, b in byte_chunks(offsets):
        part = data[offsets[a]:offsets[b]]
        starts, ends, first = word_spans(part, offsets[a:b + 1] - offsets[a], NOT_WORD)
        yield a, b, run_hashes(part, starts, ends).astype(np.int64), first


def answer_at(text: str) -> int:
    """Where an item's answer begins, in characters."""
    for pattern in (r"(?s).*\?(?=.*\w)", r"(?s).*\S\n(?=.*\w)", r"(?s).*\w[.!]\s+(?=\w)"):
        found = re.match(pattern, text.rstrip())
        if found and re.search(r"\w", found.group()):
            return found.end()
    gaps = [m.end() for m in re.finditer(r"\s+(?=\w)", text)]
    return gaps[len(gaps) // 2] if gaps else len(text)


def item_words(items: DataFrame) -> DataFrame:
    """item_id, words (hashes in order), question_words of every item with words."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        heads = pa.array([t[:answer_at(t)] for t in texts], pa.string())
        words, n_question = [], []
        for a, b, hashes, first in _words(pa.array(texts, pa.string())):
            words += [hashes[first[r]:first[r + 1]] for r in range(b - a)]
        for a, b, _, first in _words(heads):
            n_question += np.diff(first).tolist()
        return pa.record_batch([batch.column(0), pa.array(words, pa.list_(pa.int64())),
                                pa.array(n_question, pa.int64())], names=["item_id", "words", "question_words"])

    rows = map_batches(items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct(), run,
                       "item_id long, words array<long>, question_words long")
    return rows.where(F.size("words") > 0)


def posting_rows(words: DataFrame) -> DataFrame:
    """shard, item_id, words, question_words, and the item's terms with their impacts."""
    words = materialise(words, "items")
    total = words.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("words")), F.lit(0)).alias("w")).first()
    n, shards = total["n"], max(1, -(-total["n"] // SHARD_ITEMS), -(-total["w"] // SHARD_WORDS))
    mean = total["w"] / max(n, 1)
    keyed = words.withColumn("key", F.struct("item_id", "words"))
    terms = (keyed.select("key", F.size("words").alias("len"), F.explode("words").alias("term"))
             .groupBy("key", "len", "term").agg(F.count(F.lit(1)).alias("tf")))
    held = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log1p((F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    tf = F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / mean))
    weighed = terms.join(held, "term").select("key", F.struct("term", (idf * tf).alias("weight")).alias("w"))
    grouped = weighed.groupBy("key").agg(F.sort_array(F.collect_list("w")).alias("terms"))
    return (keyed.join(grouped, "key").withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
            .select("shard", "item_id", "words", "question_words", "terms"))


@dataclass
class Shard:
    """One part of the index.  ``first`` cuts ``items`` and ``impacts`` by vocabulary
    entry; ``peaks`` has the largest impact of each entry in each block."""
    ids: list[int]
    words: list[np.ndarray]
    question_words: list[int]
    vocabulary: np.ndarray
    first: np.ndarray
    items: np.ndarray
    impacts: np.ndarray
    peaks: np.ndarray
    half: int
    block: int

    @classmethod
    def build(cls, rows: list, block: int = BLOCK) -> Shard:
        rows = sorted(rows, key=lambda r: (r["item_id"] is not None, r["item_id"], len(r["words"])))
        terms = np.array([t["term"] for r in rows for t in r["terms"]], np.int64)
        weight = np.array([t["weight"] for r in rows for t in r["terms"]])
        item = np.repeat(np.arange(len(rows)), [len(r["terms"]) for r in rows])
        weight = weight / np.bincount(item, weights=weight)[item]
        order = np.lexsort((item, terms))
        vocabulary, first = np.unique(terms[order], return_index=True)
        item, weight = item[order], weight[order]
        peaks = np.zeros((len(vocabulary), -(-len(rows) // block)), np.float32)
        at = np.repeat(np.arange(len(vocabulary)), np.diff(np.append(first, len(terms))))
        np.maximum.at(peaks, (at, item // block), np.nextafter(weight.astype(np.float32), np.float32(2)))
        return cls([r["item_id"] for r in rows], [np.array(r["words"], np.int64) for r in rows],
                   [r["question_words"] for r in rows], vocabulary, np.append(first, len(terms)),
                   item, weight, peaks, max(len(r["words"]) for r in rows), block)


def block_max_wand(index: Shard, terms: np.ndarray, threshold: float) -> list[tuple[int, float]]:
    """All (item, score) of at least ``threshold`` for a set of vocabulary entries."""
    lists = []
    for t in terms:
        lo, hi = index.first[t], index.first[t + 1]
        impacts = index.impacts[lo:hi]
        lists.append([0, index.items[lo:hi].tolist(), impacts.tolist(), float(impacts.max()), index.peaks[t]])
    found, low = [], threshold - 1e-6
    lists = [x for x in lists if x[1]]
    while lists:
        lists.sort(key=lambda x: x[1][x[0]])
        reach, pivot = 0.0, -1
        for k, x in enumerate(lists):
            reach += x[3]
            if reach >= low:
                pivot = k
                break
        if pivot < 0:
            break
        item = lists[pivot][1][lists[pivot][0]]
        while pivot + 1 < len(lists) and lists[pivot + 1][1][lists[pivot + 1][0]] == item:
            pivot += 1
        block = item // index.block
        if sum(float(x[4][block]) for x in lists[:pivot + 1]) < low:
            # No item of this block gets there with these lists: on to the next
            # block, or to the next list's item if that comes first.
            target = (block + 1) * index.block
            if pivot + 1 < len(lists):
                target = min(target, lists[pivot + 1][1][lists[pivot + 1][0]])
            target = max(target, item + 1)
            moved = lists[:pivot + 1]
        elif lists[0][1][lists[0][0]] == item:
            score = 0.0
            for x in lists[:pivot + 1]:
                score += x[2][x[0]]
            if score >= low:
                found.append((item, score))
            target, moved = item + 1, lists[:pivot + 1]
        else:
            target, moved = item, [x for x in lists[:pivot] if x[1][x[0]] < item]
        for x in moved:
            k, postings = x[0], x[1]
            while k < len(postings) and postings[k] < target:
                k += 1
            x[0] = k
        lists = [x for x in lists if x[0] < len(x[1])]
    return found


def _grams(words: np.ndarray, n: int) -> np.ndarray:
    if not len(words):
        return words
    n = min(n, len(words))
    out = np.zeros(len(words) - n + 1, np.int64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = out * np.int64(6364136223846793005) + words[k:k + len(out)]
    return out


def covered(part: np.ndarray, region: np.ndarray) -> float:
    """Share of ``part``'s word trigrams that ``region`` holds; 1 for no words."""
    if not len(part):
        return 1.0
    n = min(GRAM, len(part))
    grams = _grams(part, n)
    return float(np.isin(grams, _grams(region, n)).mean()) if len(region) >= n else 0.0


def find_items(column: pa.Array | list, index: Shard, threshold: float = THRESHOLD, question: float = QUESTION,
               answer: float = ANSWER) -> list[dict[int, tuple[float, float, float]]]:
    """Per text the verified items: place in the shard -> (score, question, answer share).
    ``column`` are texts, or their words as a list from ``_words``."""
    out: list[dict[int, tuple[float, float, float]]] = []
    half = index.half
    for a, b, hashes, first in column if isinstance(column, list) else _words(column):
        got: list[dict] = [{} for _ in range(b - a)]
        out += got
        if not len(hashes):
            continue
        at = np.minimum(np.searchsorted(index.vocabulary, hashes), len(index.vocabulary) - 1)
        known = index.vocabulary[at] == hashes
        place = np.flatnonzero(known)
        if not len(place):
            continue
        # Half windows: numbered through the chunk, new ones at the start of each row.
        sizes = np.diff(first)
        halves = -(-sizes // half)
        row_half = np.concatenate([[0], np.cumsum(halves)])
        row = np.searchsorted(first, place, side="right") - 1
        number = row_half[row] + (place - first[row]) // half
        firsts = np.flatnonzero(np.diff(number, prepend=-1))
        reach = np.zeros((row_half[-1] + 1, index.peaks.shape[1]), np.float32)
        reach[number[firsts]] = np.add.reduceat(index.peaks[at[place]], firsts)
        follows = np.ones(len(reach) - 1, bool)
        follows[row_half[1:-1][row_half[1:-1] > 0] - 1] = False
        follows[-1] = False
        window = reach[:-1] + reach[1:] * follows[:, None]
        for w in np.flatnonzero((window >= threshold - 1e-3).any(axis=1)):
            r = int(np.searchsorted(row_half, w, side="right")) - 1
            lo = first[r] + (w - row_half[r]) * half
            hi = min(lo + 2 * half, first[r + 1])
            inside = np.unique(at[lo:hi][known[lo:hi]])
            if index.peaks[inside].sum(axis=0).max() < threshold - 1e-3:
                continue  # with each word taken once, no block gets there
            region = None
            for item, score in block_max_wand(index, inside, threshold):
                if item in got[r] and got[r][item][0] >= score:
                    continue
                if region is None:
                    region = hashes[max(first[r], lo - half):min(first[r + 1], hi + half)]
                words, n = index.words[item], index.question_words[item]
                shares = covered(words[:n], region), covered(words[n:], region)
                if shares[0] >= question and shares[1] >= answer:
                    got[r][item] = (score, *shares)
    return out


@dataclass
class Group:
    """The fields of the shards of one pass, as plain data."""
    parts: list[dict]


def groups(items: DataFrame, pass_shards: int = PASS_SHARDS) -> Iterator[Group]:
    """The index, a group of shards at a time.  A shard's rows are bounded by SHARD_ITEMS and
    SHARD_WORDS, so a group is too."""
    rows = materialise(posting_rows(item_words(items)), "postings")
    numbers = sorted(r["shard"] for r in rows.select("shard").distinct().toLocalIterator())
    for k in range(0, len(numbers), pass_shards):
        held: dict[int, list] = {}
        for r in rows.where(F.col("shard").isin(numbers[k:k + pass_shards])).collect():
            held.setdefault(r["shard"], []).append(r)
        yield Group([dict(vars(Shard.build(held[n]))) for n in sorted(held)])


def shards(items: DataFrame) -> list[Shard]:
    """The whole index, for a benchmark that is known to be small."""
    return [Shard(**p) for group in groups(items) for p in group.parts]


def _searcher(spark, group: Group, threshold: float):
    """A function of a text column: per text the verified matches as (item_id, score, question, answer share)."""
    get, made = shared(spark, group), []

    def search(column: pa.Array) -> list[list[tuple]]:
        if not made:
            made.extend(Shard(**p) for p in get().parts)
        words = list(_words(column))
        out: list[list[tuple]] = [[] for _ in range(len(column))]
        for index in made:
            for row, got in zip(out, find_items(words, index, threshold)):
                row += [(index.ids[k], *v) for k, v in got.items()]
        return out

    return search


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD,
                 pass_shards: int = PASS_SHARDS) -> DataFrame:
    """doc_id, item_id, score, question_share, answer_share of every verified match."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, item_id long, score double, question_share double, answer_share double"
    found = spark.createDataFrame([], schema)
    for group in groups(items, pass_shards):
        def run(batch: pa.RecordBatch, search=_searcher(spark, group, threshold)) -> pa.RecordBatch | None:
            rows = [(i, *match) for i, got in zip(batch.column(0).to_pylist(), search(batch.column(1))) for match in got]
            if not rows:
                return None
            cols = list(zip(*rows))
            return pa.record_batch([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                    *(pa.array(c, pa.float64()) for c in cols[2:])],
                                   names=["doc_id", "item_id", "score", "question_share", "answer_share"])

        found = found.unionByName(map_batches(texts, run, schema))
    return found.groupBy("doc_id", "item_id").agg(
        *[F.max(c).alias(c) for c in ("score", "question_share", "answer_share")])


def clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose text holds a test item."""
    spark = docs.sparkSession
    bounded_batches(spark)
    text_at = docs.columns.index("text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    for group in groups(items):
        def run(batch: pa.RecordBatch, search=_searcher(spark, group, threshold)) -> pa.RecordBatch:
            return batch.filter(pa.array([not got for got in search(batch.column(text_at))], pa.bool_()))

        docs = map_batches(docs, run, schema)
    return docs
