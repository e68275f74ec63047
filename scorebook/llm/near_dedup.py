"""Near-duplicate documents by fast similarity sketching, banding and exact checks.

Two documents are linked if the Jaccard similarity of their sets of distinct
5-word shingles is at least 0.75; ``component_id`` is the smallest doc_id that is
reached over links.

1. One pass over the texts gives each document its set size, a 128-bit hash of the set
   and a sketch of 128 coordinates (``sketch.fast_similarity_sketch``), kept
   as 32 bands of 4.  Two sets at the threshold share no band with a chance of
   5e-6; above it the chance falls fast (3e-8 at 0.8).
2. Documents with equal sets are one *class*, known by its smallest doc_id; a
   group of copies of any size is one row from here on.
3. Classes that share a band meet in a bucket.  In buckets of up to ``SMALL``
   classes all pairs are checked; in larger ones each class against the smallest.
4. Classes of large buckets that still lie in several components are joined
   exactly: by prefix filtering.  Shingles are ordered rarest first; two sets that
   reach the threshold share a shingle among the first quarter of one and the
   first seventh of the other, and the places of the first such shingle bound the
   overlap.  This finds every link between them, without pairs inside a group.
5. Each pair is checked on the full sets, and components are taken over the links.

No bucket is capped: step 4 is the exact way for those too large to pair up.
Shingles are compared by 64-bit hashes.

Defined results: a text that is null or without words has the empty set and is
linked with nothing; a shorter text than five words is one shingle; rows that share a
doc_id are one node, so both their sets lead to the same component; a null doc_id
takes part in no link, its component_id is null and it is not kept; ties cannot
occur; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, map_batches, materialise, utf8_bytes
from .components import components
from .sketch import BINS, WORDS, band_hashes, fast_similarity_sketch, set_hash, shingle_sets

BAND_ROWS = 4
SMALL = 8
#: The threshold as a fraction.
NUM, DEN = 75, 100


def sketch_rows(docs: DataFrame, words: int = WORDS, bins: int = BINS, rows: int = BAND_ROWS) -> DataFrame:
    """doc_id, n, h1, h2, bands of every row."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, one, two, bands = [], [], [], []
        for s in shingle_sets(*utf8_bytes(batch.column(1)), words):
            h = set_hash(s)
            n.append(len(s))
            one.append(h[0])
            two.append(h[1])
            bands.append(band_hashes(fast_similarity_sketch(s, bins), rows) if len(s) else None)
        return pa.record_batch([batch.column(0), pa.array(n, pa.int64()), pa.array(one, pa.int64()),
                                pa.array(two, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                               names=["doc_id", "n", "h1", "h2", "bands"])

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run,
                       "doc_id long, n long, h1 long, h2 long, bands array<long>")


def shingle_rows(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id and its shingle set."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [s.astype(np.int64) for s in shingle_sets(*utf8_bytes(batch.column(1)), words)]
        return pa.record_batch([batch.column(0), pa.array(sets, pa.list_(pa.int64()))],
                               names=["doc_id", "shingles"])

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run,
                       "doc_id long, shingles array<long>")


def _sizes_agree(x, y):
    return (DEN * x >= NUM * y) & (DEN * y >= NUM * x)


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` whose full sets reach the threshold."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(left, "a").join(right, "b")
            .where(DEN * both >= NUM * (F.size("sa") + F.size("sb") - both)).select("a", "b"))


def prefix_pairs(sets: DataFrame, labels: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) of different labels, none of the links among ``sets``
    left out.  ``labels`` has doc_id and label."""
    # Each distinct set of a doc_id once, known by ``own``; repeats would shorten prefixes and cancel in the maps.
    sets = sets.select("doc_id", F.sort_array("shingles").alias("shingles")).distinct()
    # A shingle's place in the common order: rarest first, then by hash.
    each = sets.select("doc_id", F.xxhash64("shingles").alias("own"), F.size("shingles").cast("long").alias("n"),
                       F.explode("shingles").alias("s"))
    seen = each.groupBy("s").agg(F.count(F.lit(1)).alias("f"))
    # Parity of the shingles that fall on each of 512 bits.
    word, bit = F.shiftright("s", 6).bitwiseAND(7), F.expr("shiftleft(1L, cast(s & 63 as int))")
    maps = [f"m{k}" for k in range(8)]
    ordered = (each.join(seen, "s").groupBy("doc_id", "own", "n")
               .agg(F.sort_array(F.collect_list(F.struct("f", "s"))).alias("order"),
                    *[F.bit_xor(F.when(word == k, bit).otherwise(F.lit(0))).alias(m) for k, m in enumerate(maps)])
               .join(labels, "doc_id"))
    probe = F.col("n") - F.ceil(F.col("n") * NUM / DEN - 1e-9) + 1
    index = F.col("n") - F.ceil(F.col("n") * 2 * NUM / (NUM + DEN) - 1e-9) + 1
    first = (ordered.select("doc_id", "n", "label", *maps, index.alias("index"),
                            F.posexplode(F.slice("order", F.lit(1), probe.cast("int"))))
             .select("doc_id", "n", "label", *maps, "index", "pos", F.col("col.s").alias("s")))
    first = materialise(first, "prefixes")
    short = first.where(F.col("pos") < F.col("index")).select(
        "s", *[F.col(c).alias(f"{c}1") for c in ("doc_id", "n", "label", "pos", *maps)])
    apart = sum((F.bit_count(F.col(f"{m}1").bitwiseXOR(F.col(m))) for m in maps), F.lit(0))
    both = F.col("n1") + F.col("n")
    room = F.least(F.col("n1") - F.col("pos1"), F.col("n") - F.col("pos"))
    return (short.join(first, "s")
            .where((F.col("label1") != F.col("label"))
                   & ((F.col("n1") < F.col("n")) | ((F.col("n1") == F.col("n")) & (F.col("doc_id1") < F.col("doc_id"))))
                   & (DEN * F.col("n1") >= NUM * F.col("n"))
                   & ((NUM + DEN) * room >= NUM * both) & ((NUM + DEN) * (both - apart) >= 2 * NUM * both))
            .select(F.least("doc_id1", "doc_id").alias("a"), F.greatest("doc_id1", "doc_id").alias("b")).distinct())


def _buckets(classes: DataFrame) -> DataFrame:
    """Members of the buckets with several classes: band, value, rep, n, cnt, hub, hub_n."""
    rows = classes.select("rep", "n", F.posexplode("bands").alias("band", "value"))
    held = (rows.groupBy("band", "value")
            .agg(F.count(F.lit(1)).alias("cnt"), F.min(F.struct("rep", "n")).alias("hub"))
            .where(F.col("cnt") > 1)
            .select("band", "value", "cnt", F.col("hub.rep").alias("hub"), F.col("hub.n").alias("hub_n")))
    return rows.join(held, ["band", "value"])


def _first_pairs(members: DataFrame, small: int) -> DataFrame:
    few = members.where(F.col("cnt") <= small)
    other = few.select("band", "value", F.col("rep").alias("b"), F.col("n").alias("nb"))
    near = (few.join(other, ["band", "value"])
            .where((F.col("rep") < F.col("b")) & _sizes_agree(F.col("n"), F.col("nb")))
            .select(F.col("rep").alias("a"), "b"))
    star = (members.where((F.col("cnt") > small) & (F.col("rep") != F.col("hub"))
                          & _sizes_agree(F.col("n"), F.col("hub_n")))
            .select(F.col("hub").alias("a"), F.col("rep").alias("b")))
    return near.unionByName(star).distinct()


def near_duplicates(docs: DataFrame, words: int = WORDS, bins: int = BINS, rows: int = BAND_ROWS,
                    small: int = SMALL) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs``."""
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    sketched = materialise(sketch_rows(texts, words, bins, rows), "sketches")
    linked = sketched.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    # The bands are a function of the set, so any row's do for its class.
    classes = materialise(linked.groupBy("h1", "h2").agg(
        F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands")), "classes")
    members = materialise(_buckets(classes), "buckets")
    pairs = materialise(_first_pairs(members, small), "pairs")
    crowded = members.where(F.col("cnt") > small)
    wanted = materialise(pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id")))
                         .unionByName(crowded.select(F.col("rep").alias("doc_id"))).distinct(), "wanted")
    # Rows that repeat are one row here, or each pair would meet once for every two copies.
    sets = materialise(shingle_rows(texts.join(wanted, "doc_id").distinct(), words), "sets")
    links = materialise(confirmed(pairs, sets), "confirmed")

    # What large buckets have left in several components, exactly.
    labels = components(links)
    crowded = (crowded.select("band", "value", F.col("rep").alias("node")).join(labels, "node", "left")
               .withColumn("label", F.coalesce("label", "node")))
    apart = (crowded.groupBy("band", "value").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
             .where(F.col("lo") != F.col("hi")).select("band", "value"))
    rest = materialise(crowded.join(apart, ["band", "value"])
                       .select(F.col("node").alias("doc_id"), "label").distinct(), "rest")
    more = confirmed(prefix_pairs(sets.join(rest.select("doc_id"), "doc_id"), rest), sets)

    # Rows that share a doc_id tie their classes together.
    placed = materialise(sketched.join(classes.select("h1", "h2", "rep"), ["h1", "h2"], "left")
                         .select("doc_id", "n", "rep"), "placed")
    torn = (placed.where(F.col("doc_id").isNotNull() & F.col("rep").isNotNull()).groupBy("doc_id")
            .agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where(F.col("a") != F.col("z")))
    ties = (placed.join(torn, "doc_id").where(F.col("rep") != F.col("a"))
            .select("a", F.col("rep").alias("b")).distinct())

    every = components(links.unionByName(more).unionByName(ties))
    out = placed.join(every.select(F.col("node").alias("rep"), "label"), "rep", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "rep", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"))


ORACLE_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
         ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
met AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM met JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * common >= 75 * (p.n + q.n - common)),
reach AS (
  SELECT doc_id AS node, doc_id AS other FROM documents
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, r.low AS component_id, r.low = d.doc_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT node, min(other) AS low FROM reach GROUP BY node) r ON r.node = d.doc_id
"""
