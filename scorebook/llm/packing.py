"""Packing of tokenised documents into fixed windows by best-fit decreasing.

A document is its token ids followed by one end id.  It is first cut into full
windows; what is left over, shorter than a window, is placed by best-fit
decreasing: pieces in falling length, each into the open window with the least
room that still holds it, found in a segment tree indexed by remaining capacity.

Scale.  A piece carries its length and checksum, never its ids, so only small rows
are shuffled.  A full window is a sequence by itself and is not shuffled at all: its id
follows from its place in the written pieces.  Left-over pieces are dealt by hash into
shards of about ``shard_pieces`` pieces; a shard is packed in one task, and the only loss
against one global packing is a few open windows a shard.  Sequence ids are
``shard * 2**32 + number in shard``, for full windows ``2**62 + place``, and so unique
without a count.

Tokens.  ``PieceTokenizer`` splits texts that hold no white space but single spaces
and line feeds between other characters into words; the byte-level pre-tokenizer
never joins across those places, so a word's ids do not depend on its neighbours
and are looked up in a bounded cache; other texts go to the tokenizer whole.  Either
way the ids are those of the whole text (tested against the tokenizer itself).  The
operator takes the tokenizer as loaded: a text that holds the literal of an added token
goes whole and gets that token's id.

Defined results: a null or empty text is the end id alone; a document whose length
is a multiple of the window gives full windows only; ties in length go by
doc_id and start; rows that share a doc_id are packed each for itself; a null
doc_id is kept; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import string
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, map_batches, materialise

WINDOW = 1024
END_ID = 0
TOKENIZER = "byte_bpe_50k.json"
#: Left-over pieces a shard holds on average.
SHARD_PIECES = 4096
#: Words a worker's cache holds at most; further words are encoded again.
CACHE_WORDS = 1_200_000


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers write for each byte: printable Latin-1
    stands for itself, the other bytes take the code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


class PieceTokenizer:
    """Ids of whole texts as packed little-endian unsigned 32-bit integers."""

    #: Texts that hold one of these, or start or end in white space, are encoded
    #: whole: white space that is not one space or line feed between other characters.
    _odd = ["  ", " \n", "\n ", "\n\n", *map(chr, [0, 9, 11, 12, 13, *range(0x1c, 0x20), 0x85, 0xa0, 0x1680,
            0x180e, *range(0x2000, 0x200c), 0x2028, 0x2029, 0x202f, 0x205f, 0x3000, 0xfeff])]
    _marks = string.punctuation

    def __init__(self, path: str, cache_words: int = CACHE_WORDS, plain_specials: bool = True):
        """``plain_specials``: the literal of a special token is text like any other."""
        from tokenizers import Tokenizer

        self._tok = Tokenizer.from_file(path)
        self._tok.encode_special_tokens = plain_specials
        self._odd = [*self._odd, *(t.content for t in self._tok.get_added_tokens_decoder().values())]
        self._tokenize = self._tok.model.tokenize
        self._letters = _byte_letters()
        self._cache: dict[str, bytes] = {}
        self._limit = cache_words

    def _whole(self, text: str) -> bytes:
        return np.array(self._tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        """Ids of a word that the cache does not hold.  A run of letters is one piece
        for the pre-tokenizer and goes straight to the merges, and so does a run of
        ASCII marks behind it; anything else takes the whole way."""
        core = word[1:] if word[:1] == " " else word
        letters = core.rstrip(self._marks)
        marks = core[len(letters):]
        if letters.isalpha() and (letters.isascii() or max(letters) < "\u0250") and marks[:1] != "'":
            if marks:
                return self._get(word[:-len(marks)]) + self._get(marks)
            return self._merged(word.encode().decode("latin-1").translate(self._letters))
        return self._merged(word) if word and word == marks and "'" not in marks else self._whole(word)

    def _merged(self, piece: str) -> bytes:
        got = self._tokenize(piece)
        return struct.pack(f"<{len(got)}I", *[t.id for t in got])

    def _get(self, word: str) -> bytes:
        ids = self._cache.get(word)
        if ids is None:
            known = len(self._cache)
            ids = self._word(word)
            # Letters with marks are kept once their letters are known: most are never seen again.
            if known == len(self._cache) < self._limit:
                self._cache[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a text, white space and all."""
        if text[:1].isspace() or text[-1:].isspace() or any(map(text.__contains__, self._odd)):
            return self._whole(text)
        # Words keep the space before them; a line feed is a word of its own.
        words = text.replace("\n", "\x00\n\x00").replace(" ", "\x00 ").split("\x00")
        found = list(map(self._cache.get, words))
        if None in found:
            found = [self._get(w) if ids is None else ids for w, ids in zip(words, found)]
        return b"".join(found)


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, window: int = WINDOW,
                     end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens."""
    bounded_batches(docs.sparkSession)
    end = np.array([end_id], "<u4").tobytes()
    held: list[PieceTokenizer] = []

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append(PieceTokenizer(tokenizer_path, plain_specials=False))
        rows = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            data = (held[0].encode(text) if text else b"") + end
            n = len(data) // 4
            for start in range(0, n, window):
                part = data[start * 4:(start + window) * 4]
                rows.append((doc, start, len(part) // 4, zlib.crc32(part), n))
        cols = list(zip(*rows))
        return pa.record_batch([pa.array(c, pa.int64()) for c in cols],
                               names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), cut,
                       "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


class RoomTree:
    """Open windows by remaining capacity: a segment tree over 0 .. window whose
    inner nodes hold how many open windows have a capacity in their range."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, room: int, by: int) -> None:
        node = room + self.size
        while node:
            self.count[node] += by
            node >>= 1

    def push(self, room: int, number: int) -> None:
        self.bins[room].append(number)
        self._add(room, 1)

    def tightest(self, need: int) -> int | None:
        """The least capacity of at least ``need`` that an open window has."""
        node = need + self.size
        if self.count[node]:
            return need
        while node > 1:
            if not node & 1 and self.count[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.size
            node >>= 1
        return None

    def pop(self, room: int) -> int:
        self._add(room, -1)
        return self.bins[room].pop()


def best_fit_decreasing(lengths, window: int = WINDOW) -> tuple[list[int], list[int]]:
    """(window number, offset) of each piece; ``lengths`` must fall."""
    tree, opened, where, offset = RoomTree(window), 0, [], []
    for need in lengths:
        room = tree.tightest(need)
        if room is None:
            number, room, opened = opened, window, opened + 1
        else:
            number = tree.pop(room)
        where.append(number)
        offset.append(window - room)
        if room > need:
            tree.push(room - need, number)
    return where, offset


def pack(pieces: DataFrame, window: int = WINDOW, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """``pieces`` with sequence_id and offset.  Pieces must fit the window."""
    columns = pieces.columns
    pieces = materialise(pieces.withColumn("place", F.monotonically_increasing_id()), "pieces")
    full = pieces.where(F.col("length") == window).select(
        *columns, (F.lit(1 << 62) + F.col("place")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest = pieces.where(F.col("length") < window).drop("place")
    shards = rest.count() // shard_pieces + 1
    dealt = rest.withColumn("shard", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(shards)))

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start"], ascending=[False, True, True],
                              kind="stable", na_position="first")
        where, offset = best_fit_decreasing(pdf["length"].tolist(), window)
        first = int(pdf["shard"].iloc[0]) << 32
        pdf["sequence_id"] = [first + w for w in where]
        pdf["offset"] = offset
        return pdf.drop(columns="shard")

    packed = dealt.groupBy("shard").applyInPandas(
        place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
               "sequence_id long, offset long")
    return full.unionByName(packed)


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = WINDOW) -> DataFrame:
    return pack(tokenized_pieces(docs, tokenizer_path, window), window)


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(TOKENIZER))


def iter_sequences(rows) -> Iterator[tuple[int, list]]:
    """Sequences of collected rows, in id order, their pieces by offset (for tests)."""
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append(r)
    for k in sorted(by):
        yield k, sorted(by[k], key=lambda r: r["offset"])
