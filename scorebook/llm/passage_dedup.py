"""Substring dedup by super-k-mer partitioning.

A window is 20 consecutive words of one document; every word that lies in a window
whose words also start earlier (smaller doc_id, or the same document and an earlier
start) is taken out.  Windows are judged on the input.

1. The *minimiser* of a window is the leftmost of its 5-word groups with the smallest
   hash.  Consecutive windows that share it are one super-k-mer: on average eight windows,
   packed as one string of some 28 words instead of eight of 20.  Equal windows have equal
   minimisers.  One pass lists the super-k-mers by minimiser and place, without their words.
2. Minimisers are counted over all documents.  A window that is found twice has a
   minimiser that is found twice, so the super-k-mers of all others stay where they are.
3. The rest travel, as packed strings, to the bucket of their minimiser.  There they are
   sorted: of equal strings all but the first are repeats as a whole; the windows of
   different ones are cut out and sorted in turn, and all but the first of each are repeats.
4. What is covered goes back to its document, and the words are joined again.  The texts
   are shuffled once: both steps that need them read the same exchange.

Hot groups.  A phrase in a large share of all documents is the minimiser of ever new
strings.  Minimisers with more than ``HOT`` super-k-mers, and more than one in
``HOT_SHARE`` of all, are *hot*; there are fewer than ``HOT_SHARE`` of them, so the list of
their hashes is broadcast.  Their windows travel singly, to the bucket of the window itself, so
a hot phrase is dealt out over all buckets; nothing is dropped.  A passage with very many
copies is thinned before it travels: a task sends a string only if it has not sent
one of an earlier place, and all later ones are known to be repeats.

Strings are compared as a whole in the buckets, and by a 128-bit hash where a task
thins its own.

Defined results: a null text has no words; documents of fewer words than a window stay; a
null doc_id counts as the smallest; rows that share a doc_id are ordered by a hash of
their text, and rows that share both are one document and get the same result; words are
compared unchanged, white space between them not at all; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, byte_chunks, map_batches, materialise, mix64, remove_written, run_hashes, utf8_bytes
from .sketch import word_spans

WINDOW = 20
#: Words of a minimiser.
GROUP = 5
HOT = 1000
HOT_SHARE = 100_000
#: Strings a task remembers to have sent, of hot minimisers.
SENT = 100_000

_SMALLEST = -(1 << 63)
_ODD = mix64(np.arange(256, dtype=np.uint64), 61) | np.uint64(1)


def _group_hashes(hashes: np.ndarray, size: int, seed: int) -> np.ndarray:
    """A hash of each ``size`` consecutive word hashes."""
    n = len(hashes) - size + 1
    out = np.zeros(max(n, 0), np.uint64)
    if n > 0:
        with np.errstate(over="ignore"):
            for k in range(size):
                out += hashes[k:k + n] * _ODD[k]
    return mix64(out, seed)


def super_kmers(hashes: np.ndarray, first: np.ndarray, window: int = WINDOW,
                group: int = GROUP) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, first word (in the row), words and minimiser of each super-k-mer.

    ``hashes`` are the words of all rows, ``first`` the first word of each row and the end."""
    rows = len(first) - 1
    counts = np.maximum(np.diff(first) - window + 1, 0)
    n = int(counts.sum())
    if not n:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    row = np.repeat(np.arange(rows), counts)
    # The first word of every window, rows one after the other.
    at = np.arange(n) - np.repeat(np.cumsum(counts) - counts, counts) + first[row]
    groups = _group_hashes(hashes, group, 17)
    smallest, place = groups[at], at.copy()
    for k in range(1, window - group + 1):
        other = groups[at + k]
        less = other < smallest
        smallest[less] = other[less]
        place[less] = at[less] + k
    new = np.ones(n, bool)
    new[1:] = (place[1:] != place[:-1]) | (row[1:] != row[:-1])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], n) - 1
    return row[begin], at[begin] - first[row[begin]], at[end] - at[begin] + window, smallest[begin]


def _single_spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The words of all rows, each followed by one space; their starts and ends, and
    how many words lie before each row."""
    starts, ends, first = word_spans(data, offsets)
    sizes = ends - starts + 1
    out = np.full(int(sizes.sum()), 32, np.uint8)
    to = np.cumsum(sizes) - sizes
    inside = np.arange(len(out)) - np.repeat(to - starts, sizes)
    word = np.ones(len(out), bool)
    word[to + sizes - 1] = False
    out[word] = data[inside[word]]
    return out, to, to + sizes - 1, first


def _kmers_of(batch: pa.RecordBatch, column: int, window: int, group: int):
    """Per chunk of a batch: its first row, spaced words with starts and ends, word hashes, super-k-mers."""
    data, offsets = utf8_bytes(batch.column(column))
    for a, b in byte_chunks(offsets):
        part = offsets[a:b + 1] - offsets[a]
        text, starts, ends, first = _single_spaced(data[offsets[a]:offsets[b]], part)
        hashes = run_hashes(text, starts, ends)
        yield a, text, starts, ends, first, hashes, super_kmers(hashes, first, window, group)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def listed(texts: DataFrame, window: int, group: int) -> DataFrame:
    """mini, doc, version, start of every super-k-mer of ``texts`` (doc, version, text)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [(row + a, start, mini) for a, *_, (row, start, _, mini) in _kmers_of(batch, 2, window, group)]
        rows, start, mini = (np.concatenate(x) for x in zip(*found))
        rows = pa.array(rows)
        return pa.record_batch([_signed(mini), batch.column(0).take(rows), batch.column(1).take(rows),
                                pa.array(start, pa.int32())], names=["mini", "doc", "version", "start"])

    return map_batches(texts.select("doc", "version", "text"), run, "mini long, doc long, version long, start int")


def packed(texts: DataFrame, hot: np.ndarray, window: int, group: int) -> DataFrame:
    """bucket, words, doc, version, start, n of the super-k-mers named in ``starts`` of
    ``texts`` (doc, version, text, starts); words are null where the task knows a
    repeat, and such rows are dealt by chance.  ``hot`` is sorted."""
    held = texts.sparkSession.sparkContext.broadcast(hot)
    schema = "bucket long, words string, doc long, version long, start int, n int"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: dict[tuple[int, int], tuple[int, int, int]] = {}
        for batch in batches:
            doc = batch.column(0).to_numpy(zero_copy_only=False)
            version = batch.column(1).to_numpy(zero_copy_only=False)
            for a, text, starts, ends, first, hashes, (row, start, n, mini) in _kmers_of(batch, 2, window, group):
                # Super-k-mers of the chunk whose minimiser is shared, by row and place.
                wanted = batch.column(3).slice(a, len(first) - 1)
                named = np.repeat(np.arange(len(wanted)), pc.list_value_length(wanted).to_numpy(zero_copy_only=False))
                keep = np.isin(row << 32 | start, named << 32 | wanted.flatten().to_numpy(zero_copy_only=False))
                row, start, n, mini = row[keep], start[keep], n[keep], mini[keep]
                if not len(row):
                    continue
                is_hot = np.isin(mini, held.value)
                # Windows of hot minimisers travel singly, in the bucket of the window.
                times = np.where(is_hot, n - window + 1, 1)
                row, mini, single = np.repeat(row, times), np.repeat(mini, times), np.repeat(is_hot, times)
                start = np.repeat(start, times) + np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                n = np.where(single, window, np.repeat(n, times))
                at = first[row] + start
                bucket = mini.copy()
                if single.any():
                    bucket[single] = _group_hashes(hashes, window, 23)[at[single]]
                lo, hi = starts[at], ends[at + n - 1]
                own = run_hashes(text, lo, hi)
                docs, versions = doc[a + row], version[a + row]
                # Of equal strings in the chunk only the first travels.
                order = np.lexsort((start, versions, docs, own, bucket))
                opens = np.ones(len(order), bool)
                opens[1:] = (bucket[order[1:]] != bucket[order[:-1]]) | (own[order[1:]] != own[order[:-1]])
                head = order[np.maximum.accumulate(np.where(opens, np.arange(len(order)), 0))]
                later = np.empty(len(order), bool)
                later[order] = ((docs[order] != docs[head]) | (versions[order] != versions[head])
                                | (start[order] != start[head]))
                for k in np.flatnonzero(single & ~later).tolist():
                    key, place = (int(bucket[k]), int(own[k])), (int(docs[k]), int(versions[k]), int(start[k]))
                    before = sent.get(key)
                    if before is not None and before < place:
                        later[k] = True
                    elif before is not None or len(sent) < SENT:
                        sent[key] = place
                raw = text.tobytes()
                words = [None if x else raw[i:j].decode() for i, j, x in zip(lo.tolist(), hi.tolist(), later.tolist())]
                chance = mix64(docs.view(np.uint64) ^ mix64(start.astype(np.uint64), 5), 29)
                yield pa.record_batch(
                    [_signed(np.where(later, chance, bucket)), pa.array(words, pa.string()), pa.array(docs),
                     pa.array(versions), pa.array(start, pa.int32()), pa.array(n, pa.int32())],
                    names=["bucket", "words", "doc", "version", "start", "n"])

    return texts.select("doc", "version", "text", "starts", "doc_id").mapInArrow(run, schema)


def repeats(strings: DataFrame, window: int) -> DataFrame:
    """doc, version, start, n of the runs of words that also start earlier.

    All steps read the one exchange by bucket and sort within it."""
    dealt = strings.repartition("bucket")
    place = ["doc", "version", "start"]
    ranked = dealt.withColumns({
        "nth": F.rank().over(Window.partitionBy("bucket", "words").orderBy(*place)),
        "several": F.min("words").over(Window.partitionBy("bucket"))
        != F.max("words").over(Window.partitionBy("bucket"))})
    whole = F.array(F.struct(F.lit(None).cast("string").alias("w"), F.col("start").alias("s"), F.col("n").alias("k")))
    split = F.split("words", " ")
    each = F.transform(F.sequence(F.lit(0), F.col("n") - window), lambda j: F.struct(
        F.array_join(F.slice(F.col("split"), j + 1, window), " ").alias("w"), (F.col("start") + j).alias("s"),
        F.lit(window).alias("k")))
    windows = (ranked.where(F.col("words").isNull() | (F.col("nth") > 1) | F.col("several"))
               .withColumn("split", split)
               .select("bucket", "doc", "version", F.explode(F.when(
                   F.col("words").isNull() | (F.col("nth") > 1), whole).otherwise(each)).alias("x"))
               .select("bucket", "doc", "version", F.col("x.w").alias("w"), F.col("x.s").alias("start"), F.col("x.k").alias("n")))
    earlier = F.rank().over(Window.partitionBy("bucket", "w").orderBy(*place))
    return windows.withColumn("nth", earlier).where("w IS NULL OR nth > 1").select(*place, "n")


def without_repeats(texts: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, text of ``texts`` (doc_id, text, covered)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        total, gone, kept = [], [], []
        for text, covered in zip(batch.column(1), batch.column(2)):
            words = (text.as_py() or "").encode().split()
            total.append(len(words))
            if covered.is_valid:
                spans = covered.values.to_numpy()
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, spans >> 32, 1)
                np.add.at(edge, (spans >> 32) + (spans & 0xFFFFFFFF), -1)
                stay = np.cumsum(edge)[:-1] == 0
                words = [w for w, s in zip(words, stay.tolist()) if s]
            gone.append(total[-1] - len(words))
            kept.append(b" ".join(words))
        return pa.record_batch([batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                                pa.array(kept, pa.binary()).cast(pa.string())],
                               names=["doc_id", "n_words", "n_removed", "text"])

    return map_batches(texts.select("doc_id", "text", "covered"), run,
                       "doc_id long, n_words long, n_removed long, text string")


def dedup_passages(docs: DataFrame, window: int = WINDOW, group: int = GROUP, hot: int = HOT,
                   hot_share: int = HOT_SHARE) -> DataFrame:
    """doc_id, n_words, n_removed, text (what is left, words joined by one space) of every row of ``docs``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("version"), F.col("text"))
    texts = texts.withColumn("doc", F.coalesce("doc_id", F.lit(_SMALLEST)))
    runs = materialise(listed(texts, window, group), "super-kmers")
    shared = materialise(runs.groupBy("mini").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared-minimisers")
    total = shared.agg(F.sum("n")).first()[0] or 0
    # Fewer than ``hot_share`` rows, whatever the size of the input.
    crowded = shared.where(F.col("n") > max(hot, total // hot_share)).select("mini")
    hashes = np.sort(np.array([r.mini for r in crowded.collect()], np.int64).view(np.uint64))
    of_hot = runs.join(F.broadcast(crowded), "mini", "left_semi")
    of_rest = runs.join(F.broadcast(crowded), "mini", "left_anti").join(shared, "mini")
    starts = materialise(of_hot.select("doc", "version", "start").unionByName(of_rest.select("doc", "version", "start"))
                         .groupBy("doc", "version").agg(F.collect_set("start").alias("starts")), "shared-starts")
    for done in (runs, shared):
        remove_written(done)
    strings = packed(texts.join(starts, ["doc", "version"]), hashes, window, group)
    # A run of words as one number: start and length.
    span = F.shiftleft(F.col("start").cast("long"), 32).bitwiseOR(F.col("n").cast("long"))
    covered = repeats(strings, window).groupBy("doc", "version").agg(F.collect_set(span).alias("covered"))
    return without_repeats(texts.join(covered, ["doc", "version"], "left"))


def digest(docs: DataFrame) -> DataFrame:
    """The query over ``documents``: doc_id, n_words, n_removed, kept_sha256."""
    return dedup_passages(docs).select("doc_id", "n_words", "n_removed",
                                       F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM words WHERE len(w) >= 20)),
ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS nth FROM windows),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS pos FROM ranked WHERE nth > 1),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM words),
kept AS (
  SELECT e.doc_id, count(*) AS n, string_agg(e.word, ' ' ORDER BY e.pos) AS t
  FROM each e ANTI JOIN gone g ON g.doc_id = e.doc_id AND g.pos = e.pos GROUP BY e.doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON k.doc_id = w.doc_id
"""
