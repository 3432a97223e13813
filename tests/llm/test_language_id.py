import math
import zlib

import numpy as np
import pyarrow as pa

from tidebook.llm import language_id as l


class BruteForce:
    """One language's context tree as dictionaries, one byte at a time."""

    def __init__(self, texts):
        self.counts = {}
        for text in texts:
            data = b"   " + text.encode().lower()
            for i in range(3, len(data)):
                for k in range(4):
                    after = self.counts.setdefault(data[i - k : i], {})
                    after[data[i]] = after.get(data[i], 0) + 1

    def bits(self, text):
        data, total = b"   " + text.encode().lower(), 0.0
        for i in range(3, len(data)):
            for k in (3, 2, 1, 0, -1):
                if k < 0:
                    total += 8
                    break
                after = self.counts.get(data[i - k : i])
                if after is None:
                    continue
                whole = sum(after.values()) + len(after)
                if data[i] in after:
                    total -= math.log2(after[data[i]] / whole)
                    break
                total -= math.log2(len(after) / whole)
        return total


def rows_of(docs):
    return [(r.doc_id, r.text, r.lang) for r in docs.collect()]


def test_code_lengths_against_brute_force(documents, monkeypatch):
    monkeypatch.setattr(l, "PIECE", 16)
    texts = ["the cat and the dog", "and then the end", "le chat et le chien", "et puis là fin", "Der Hund und die Katze"]
    docs = documents(texts, [2, 3, 4, 6, 7], ["en", "en", "fr", "fr", "de"])
    model = l.fit(docs)
    used = [(t, g) for i, t, g in rows_of(docs) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert model.languages == sorted({g for _, g in used})
    probes = ["the hund", "", "là", "\x00\x01zq", "THE " * 30, "x", "und et and " * 9]
    got = l.code_lengths(model, pa.array(probes))
    for j, lang in enumerate(model.languages):
        tree = BruteForce([t for t, g in used if g == lang])
        np.testing.assert_allclose(got[:, j], [tree.bits(p) for p in probes], rtol=1e-4)


def test_held_out_accuracy(spark, small_documents):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = l.predict(docs, l.fit(docs), ("doc_id", "lang")).collect()
    held_out = [r for r in found if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(held_out) > 200
    assert sum(r.lang == r.lang_pred for r in held_out) >= 0.98 * len(held_out)
    assert all(0 <= r.score <= 1 for r in found)


def test_held_out_documents_are_not_learned(documents):
    ids = [i for i in range(1, 40) if zlib.crc32(str(i).encode()) % 3 == 1][:3]
    model = l.fit(documents(["only held out"] * 3, ids, ["xx", "yy", "zz"]))
    assert model.languages == []


def test_edges(documents):
    ids = [i for i in range(1, 40) if zlib.crc32(str(i).encode()) % 3 != 1]
    texts = ["the cat the dog", "le chat là bas", None, "", "123 ...", "é", "Я", "the " * 60_000, "٣", "the cat the dog"]
    langs = ["en", "fr", None, "en", "en", None, None, None, None, None]
    docs = documents(texts, ids[: len(texts)], langs).selectExpr("*", "'c' AS lang_pred", "2 AS c0", "1 AS bits_per_byte")
    model = l.fit(docs)
    got = {r.doc_id: (r.lang_pred, r.score) for r in l.predict(docs, model).collect()}
    names = [got[i][0] for i in ids[: len(texts)]]
    assert names[:5] == ["en", "fr", "und", "und", "und"] and names[5] == "fr" and names[6] in ("en", "fr")
    assert names[7] == "en" and names[8] == "und" and got[ids[2]][1] == 0
    kept = l.in_a_language(docs, model)
    assert kept.columns == docs.columns
    rows = {r.doc_id: r.text for r in kept.collect()}
    assert set(rows) <= {i for i, n in zip(ids, names) if n != "und"} and rows[ids[0]] == texts[0]
    assert l.predict(docs.limit(0), model).collect() == []


def test_nothing_learned(documents):
    docs = documents(["a", None]).limit(0)
    model = l.fit(docs)
    assert [r.lang_pred for r in l.predict(documents(["abc"]), model).collect()] == ["und"]


def test_sample_is_bounded(documents, monkeypatch):
    monkeypatch.setattr(l, "SAMPLE_DOCUMENTS", 4)
    docs = documents(["a"] * 60 + ["a" * 10_000], None, ["en"] * 40 + ["fr"] * 21)
    assert sorted(r.lang for r in l.training_sample(docs).collect()) == ["en"] * 4 + ["fr"] * 4


def test_language_of_long_documents_only(documents):
    """Documents of any length are learned from, a piece of the long ones."""
    french, english = "le chat là bas et le chien à côté ", "the cat and the dog in the house "
    docs = documents([french * 400] * 30 + [english] * 30, None, ["fr"] * 30 + ["en"] * 30)
    model = l.fit(docs)
    assert model.languages == ["en", "fr"]
    assert [(r.doc_id <= 30) == (r.lang_pred == "fr") for r in l.predict(docs, model).collect()] == [True] * 60
    sample = l.training_sample(docs).collect()
    assert all(len(r.text) == min(l.SAMPLE_CHARACTERS, len(french if r.lang == "fr" else english) * (400 if r.lang == "fr" else 1)) for r in sample)
    pieces = {r.text for r in sample if r.lang == "fr"}
    assert len(pieces) > 5 and all(piece in french * 401 for piece in pieces)
