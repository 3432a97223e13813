import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidebook.llm import lm_scoring as m
from tidebook.llm.queries import op2_lm_scoring
from tidebook.llm.words import LOWER_WORDS, words_of


def tokens_of(text):
    lowered = re.sub("[A-Z]", lambda x: x[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered) + [None]


class BruteForce:
    """Exact counts, quantised like the filter's, in dictionaries."""

    def __init__(self, texts):
        self.single, self.pair = Counter(), Counter()
        for t in texts:
            tokens = tokens_of(t)
            self.single.update(tokens)
            self.pair.update(zip([None, *tokens], tokens))
        self.n, self.v = sum(self.single.values()), len(self.single)

    def base(self, text):
        return sum(math.log10((self.single[t] + 0.5) / (self.n + 0.5 * (self.v + 1))) for t in tokens_of(text))

    @staticmethod
    def bounds(count):
        """The least and the most count of the level that this count is in."""
        steps = sorted({2**k for k in range(40)} | {3 * 2**k for k in range(40)})
        return max((s for s in steps if s <= count), default=0), min(s for s in steps if s > count) - 1

    def share(self, before, t, probes):
        """The probability of a token after another."""
        alone = (self.bounds(self.single[t])[0] + 0.5) / (self.n + 0.5 * (self.v + 1))
        if not self.single[before]:
            return alone
        first = self.bounds(self.single[before])[1] + 1 + self.v * 2.0**-probes
        return 0.6 * self.bounds(self.pair[before, t])[0] / first + 0.4 * alone

    def score(self, text, probes):
        total, before = 0.0, None
        for t in tokens_of(text):
            total += math.log10(self.share(before, t, probes))
            before = t
        return total


@pytest.mark.parametrize("unit", [1, 1 << 24])
def test_whole_small_table(spark, small_documents, monkeypatch, unit):
    """Also with many small units."""
    monkeypatch.setattr(m, "UNIT_BYTES", unit)
    monkeypatch.setattr(m, "LEAST_PROBES", 20)
    rows = [(r.doc_id, r.text) for r in small_documents.collect()]
    held_out = {d for d, _ in rows if zlib.crc32(str(d).encode()) % 5 == 1}
    model = BruteForce([t for d, t in rows if d not in held_out])
    got = {r.doc_id: r for r in op2_lm_scoring(spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(rows)
    near = 0
    for doc_id, text in rows:
        r = got[doc_id]
        tokens = tokens_of(text)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (doc_id in held_out, len(tokens), model.n)
        assert r.n_known == sum(model.single[t] > 0 for t in tokens)
        assert r.base_score == pytest.approx(model.base(text), rel=1e-9)
        near += r.score == pytest.approx(model.score(text, 20), rel=1e-9)
    assert near >= 0.99 * len(rows)
    seen = [r.score / r.n_tokens for r in got.values() if not r.held_out]
    unseen = [r.score / r.n_tokens for r in got.values() if r.held_out]
    assert np.mean(seen) > np.mean(unseen)


def levels(model, words):
    """Levels of words in a model of one part that holds them."""
    hashes = words_of(pa.array([words]), LOWER_WORDS).hashes
    out = np.zeros(len(hashes), int)
    for r in model.parts.collect():
        edges = m._cuts(np.sort(hashes), model.buckets)
        inside = np.isin(hashes, np.sort(hashes)[edges[r.bucket] : edges[r.bucket + 1]])
        out[inside] = m.probed(hashes[inside], m._SINGLES, np.frombuffer(r.bits, np.uint8), r.size, model.probes)
    return out.tolist()


def test_levels_are_never_underrated(documents):
    texts = ["a " * 1000 + "b " * 100 + "c", "d e", None]
    model = m.fit(documents(texts))
    found = levels(model, "a b c d zzz")
    assert [m.THRESHOLDS[x - 1] if x else 0 for x in found] == [768, 96, 1, 1, 0]
    assert {r.n for r in model.vocabulary().collect()} == {1000, 100, 1, 3}
    full = np.full(8, 255, np.uint8)
    assert m.probed(np.arange(5, dtype=np.uint64), m._SINGLES, full, 64, 10).tolist() == [len(m.THRESHOLDS)] * 5


def test_shares_after_a_word_sum_to_one_at_most(documents):
    """For every word of a corpus, rare ones too: the shares of the whole vocabulary after it."""
    draw = np.random.default_rng(9)
    weights = 1 / np.arange(1, 301)
    texts = [" ".join(f"w{i}" for i in draw.choice(300, draw.integers(1, 40), p=weights / weights.sum())) for _ in range(400)]
    texts += [None, "", "w1 w1 w1 w2"]
    exact = BruteForce(texts)
    words = [t for t in exact.single if t is not None]
    vocabulary = [*words, None]
    model = m.fit(documents(texts))
    probes = [f"{a} {b}" for a in words for b in words]
    singles, pairs = m._tokens(words_of(pa.array(probes), LOWER_WORDS))
    parts = {r.bucket: r for r in model.parts.collect()}

    def of(grams, keys, kind):
        order = np.argsort(grams)
        cuts, out = m._cuts(grams[order], model.buckets), np.zeros(len(grams), int)
        for bucket, r in parts.items():
            at = order[cuts[bucket] : cuts[bucket + 1]]
            out[at] = m.probed(keys[at], kind, np.frombuffer(r.bits, np.uint8), r.size, model.probes)
        return out

    every = m._pairs(singles, pairs)
    level = of(singles, singles, m._SINGLES)
    pair = of(every, m._short(every, model.buckets), m._PAIRS)
    first, second = np.arange(0, len(singles), 3), np.arange(1, len(singles), 3)
    sizes = (model.n_tokens, model.n_distinct, model.probes)
    shares = m.token_shares(sizes, level[second], level[first], pair[second]).reshape(len(words), len(words))
    # Each text ends after its second word.
    ends = np.arange(2, len(singles), 3)[:: 1].reshape(len(words), len(words)).T
    after = pair[ends].T.diagonal()
    end = m.token_shares(sizes, np.full(len(words), level[2]), level[first][:: len(words)], after)
    sums = shares.sum(axis=1) + end
    assert len(vocabulary) == model.n_distinct and sums.max() <= 1
    assert np.mean(sums) > 0.5
    for i, a in enumerate(words):
        total = sum(exact.share(a, t, model.probes) for t in vocabulary)
        assert total <= 1
        assert sums[i] <= total + 0.31


def test_edges(spark, documents):
    texts = [None, "", "A a\ta", "é É", "x " * 100_000, "a a a"]
    docs = documents(texts, [1, 1, None, 4, 5, None]).selectExpr("*", "1 AS row", "2 AS score", "3 AS gram", "4 AS unit")
    model = m.fit(docs)
    exact = BruteForce(texts)
    got = sorted((r.n_tokens, r.n_known, round(r.base_score, 6)) for r in m.score(docs, model).collect())
    assert got == sorted((len(tokens_of(t)), len(tokens_of(t)), round(exact.base(t), 6)) for t in texts)
    assert m.score(docs.limit(0), model).collect() == []
    nothing = m.fit(docs.limit(0))
    rows = m.score(docs, nothing).collect()
    assert len(rows) == 6 and all(r.n_known == 0 and r.score == 0 for r in rows)
    assert all(math.isclose(r.base_score, r.n_tokens * math.log10(0.5 / 0.5)) for r in rows)


def test_filter_grows_with_the_corpus(spark, documents):
    """Its fill does not depend on the number of grams, and unknown words stay unknown."""
    sizes = []
    for n in (2_000, 200_000):
        texts = [" ".join(f"w{i}" for i in range(k, k + 1_000)) for k in range(0, n, 1_000)]
        model = m.fit(documents(texts))
        assert 0.45 < model.fill < 0.55
        sizes.append(model.parts.selectExpr("sum(size)").first()[0])
        assert sum(levels(model, " ".join(f"x{i}" for i in range(10_000)))) <= 40
    assert sizes[1] > 90 * sizes[0]


def test_blobs():
    draw = np.random.default_rng(3)
    for values in (np.zeros(0, np.uint64), draw.integers(0, 5, 9).astype(np.uint64), draw.integers(0, 1 << 63, 7).astype(np.uint64)):
        assert m._unpacked(m._packed(values)).tolist() == values.tolist()
        assert m._from_steps(m._steps(np.sort(values))).tolist() == sorted(values.tolist())
        assert m._unsqueezed(m._squeezed(values.tobytes())) == values.tobytes()
