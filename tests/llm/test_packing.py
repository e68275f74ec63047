"""Packing: exact ids, exact cover, best fit."""

import random

import numpy as np
import pytest

from scorebook.llm import packing

from .conftest import SF, crc, needs_data


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.default_tokenizer())
    t.encode_special_tokens = True
    return t


def check(rows, texts, tokenizer, window=packing.WINDOW):
    """rows against the ids of ``texts`` (doc_id -> list of texts)."""
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert set(by) == set(texts)
    for doc, own in texts.items():
        ids = [tokenizer.encode(t or "", add_special_tokens=False).ids + [0] for t in own]
        want = sorted((k, len(x[k:k + window]), crc(x[k:k + window]), len(x)) for x in ids for k in range(0, len(x), window))
        assert sorted((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in by[doc]) == want
    for _, pieces in packing.iter_sequences(rows):
        at = 0
        for r in pieces:
            assert r["offset"] == at
            at += r["length"]
        assert at <= window


def test_odd_rows(odd_docs, tokenizer):
    texts = {}
    for r in odd_docs.collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    check(packing.pack_documents(odd_docs, packing.default_tokenizer()).collect(), texts, tokenizer)


def test_empty_table(no_docs):
    assert packing.pack_documents(no_docs, packing.default_tokenizer()).count() == 0


@needs_data
def test_driver_documents(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = packing.pack_documents(docs, packing.default_tokenizer()).collect()
    check(rows, {r.doc_id: [r.text] for r in docs.collect()}, tokenizer)
    used = sum(r["length"] for r in rows)
    assert used / (packing.WINDOW * len({r["sequence_id"] for r in rows})) > 0.97


def test_word_cache_gives_the_tokenizers_ids(tokenizer):
    rng = random.Random(1)
    parts = list("ab1 \n\n.,'é日  \t!s-") + ["'s", "'ll", "<|endoftext|>", " the", "\x00", "a.b", "don't", "...", "(x)",
                                            " a!!", "ß", "İ", "\xa0", "ʰa", "é"]
    own = packing.PieceTokenizer(packing.default_tokenizer(), cache_words=200)
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 14)))
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == np.array(ids, "<u4").tobytes(), text


def test_added_tokens_are_those_of_the_tokenizer_as_loaded(spark):
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(packing.default_tokenizer())
    texts = {1: ["a <|endoftext|> b"], 2: ["<|endoftext|>"], 3: ["x<|endoftext|>y\nplain words"], 4: ["<|endoftext"]}
    df = spark.createDataFrame([(k, t) for k, own in texts.items() for t in own], "doc_id long, text string")
    check(packing.pack_documents(df, packing.default_tokenizer()).collect(), texts, loaded)


def test_best_fit_is_tightest():
    rng = random.Random(2)
    lengths = sorted((rng.randint(1, 50) for _ in range(400)), reverse=True)
    where, offset = packing.best_fit_decreasing(lengths, 50)
    rooms = []
    for need, w, o in zip(lengths, where, offset):
        fitting = [r for r in rooms if r >= need]
        if fitting:
            assert 50 - o == min(fitting) and rooms[w] == min(fitting)
        else:
            assert w == len(rooms) and o == 0
            rooms.append(50)
        rooms[w] -= need
