import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidebook.llm import packing
from tidebook.llm.packing import CAPACITY, WordEncoder, pack, pieces, split_words

PATH = public_tokenizers.path("word_bpe_49k.json")


WHOLE = Tokenizer.from_file(PATH)


def expected_ids(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids + [2]


def check(rows, texts):
    """Every document's ids once and in order; sequences without gaps; returns the padded share."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r.doc_id].append((r.start, np.frombuffer(r.ids, "<u4").tolist(), r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
        assert r.length == len(r.ids) // 4 > 0
    assert set(docs) == set(texts)
    for doc_id, text in texts.items():
        joined = []
        for start, ids, n in sorted(docs[doc_id]):
            assert start == len(joined)
            joined += ids
        assert joined == expected_ids(text) and n == len(joined)
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= CAPACITY
    return 1 - sum(r.length for r in rows) / (CAPACITY * len(sequences))


def test_whole_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = pack(docs, PATH).collect()
    assert check(rows, {r.doc_id: r.text for r in docs.collect()}) < 0.03


def test_edges(documents):
    texts = [None, "", " ", "a", "İstanbul ŞĞ <|endoftext|> <|ENDOFTEXT|>x <|startoftext|>y", "a\x1cb c\x85d", "don't we'll 12 é ́x", "word " * 30_000, "z" * 9000]
    docs = documents(texts).selectExpr("*", "1 AS start", "'x' AS ids")
    check(pack(docs, PATH).collect(), dict(enumerate(texts, 1)))
    assert pack(docs.limit(0), PATH).collect() == []


def test_repeated_rows(documents):
    rows = pack(documents(["a b", "a b", None], [1, 1, None]), PATH).collect()
    assert sorted((r.doc_id or 0, r.length) for r in rows) == [(0, 1), (1, 3), (1, 3)]


@pytest.mark.parametrize("n", [1, 2, 255, 256, 257, 2048, 4000, 4095, 4096, 4097, 100_000])
def test_pieces(n):
    cut = pieces(n)
    assert sum(cut) == n and max(cut) <= CAPACITY
    for length in cut:
        j = CAPACITY // length
        assert j >= 16 or j * length >= 0.97 * CAPACITY


ENCODER = WordEncoder(PATH)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=60) | st.text("aßé÷İ'st.,!? \nx1<|end>", max_size=40), max_size=4))
def test_words_are_encoded_as_in_whole_texts(texts):
    got = ENCODER.encode([t.encode() for t in texts])
    for text, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() + [2] == expected_ids(text)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40) | st.text("aBé.,!? \t\n\x0b\x1c1<|>", max_size=40), max_size=4))
def test_words_are_split_at_blanks_and_before_final_stops(texts):
    texts = [t.encode() for t in texts]
    words, first = split_words(texts)
    expected = [re.sub(rb"(?<=[A-Za-z])([.,;:!?])(?=\s|\Z)", rb" \1", t).split() for t in texts]
    assert [words[a:b].to_pylist() for a, b in zip(first, first[1:])] == expected
    assert len(first) == len(texts) + 1 and first[-1] == len(words)


def test_words_that_occur_again_are_not_learned_again(monkeypatch):
    """However full the memory is, it keeps the words of the last texts."""
    monkeypatch.setattr(packing, "CACHED_WORDS", 3)
    encoder, learned = WordEncoder(PATH), []
    for name in ("_learn", "_learn_plain"):
        method = getattr(encoder, name)
        monkeypatch.setattr(encoder, name, lambda words, method=method: (learned.extend(words), method(words)))
    for i in range(50):
        text = f"often Again, 12 new{i} " + " ".join("xyz"[: 1 + i % 3] + "ab" * j for j in range(3))
        assert np.frombuffer(encoder.encode([text.encode()])[0], "<u4").tolist() + [2] == expected_ids(text)
        assert len(encoder.known) + len(encoder.older) < 30
    assert [learned.count(w) for w in (b"often", b"again", b",", b"12")] == [1, 1, 1, 1]


def test_crc_matches_the_ids(spark, documents):
    from tidebook.llm.queries import piece_digests

    packed = pack(documents(["some text", None]), PATH)
    ids = {(r.doc_id, r.start): r.ids for r in packed.collect()}
    for r in piece_digests(packed).collect():
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id, r.start])
