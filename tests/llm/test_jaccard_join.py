import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidebook.llm import jaccard_join
from tidebook.llm.components import components
from tidebook.llm.jaccard_join import _Tree, _bitmap, _folded, jaccard_components, one_per_group
from tidebook.llm.words import LOWER_WORDS, words_of


def shingles(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def brute_force(rows):
    """(doc_id, n_shingles, component_id) of (doc_id, text) rows, all pairs compared."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    lowest = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            lowest[root(i)] = min(lowest.get(root(i), doc_id), doc_id)
    return sorted((d, len(sets[i]), lowest.get(root(i))) for i, (d, _) in enumerate(rows)) if all(
        d is not None for d, _ in rows
    ) else [(d, len(sets[i]), lowest.get(root(i))) for i, (d, _) in enumerate(rows)]


def found(docs):
    return sorted(tuple(r) for r in jaccard_components(docs).select("doc_id", "n_shingles", "component_id").collect())


def noisy(words, share, rng):
    return " ".join(w if rng.random() > share else f"x{rng.randrange(10**6)}" for w in words)


def test_words_match_the_pattern():
    texts = ["Ab  c\tab", None, "", "  x", "ab c", "é É z\x0b\x0cQ", "a" * 300_000 + " b", " ".join(map(str, range(90_000)))]
    words = words_of(pa.array(texts), LOWER_WORDS)
    seen = {}
    for i, t in enumerate(texts):
        expected = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        assert len(words.of(i)) == len(expected)
        for h, w in zip(words.of(i).tolist(), expected):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_whole_small_table(small_documents):
    rows = [(r.doc_id, r.text) for r in small_documents.collect()]
    assert found(small_documents) == brute_force(rows)


def test_edges(documents):
    texts = [None, "", " \t ", "one", "ONE", "one two", "a b c d e", "A b\tc d  e", "a b c d e f", "é è", "é è", "x " * 5000, "x " * 40]
    docs = documents(texts)
    assert found(docs) == brute_force(list(enumerate(texts, 1)))


def test_repeated_rows_and_null_ids(documents):
    texts = ["a b c d e f", "a b c d e f", "a b c d e f", "q", "z z"]
    got = jaccard_components(documents(texts, [7, 7, None, None, 3])).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == [(-1, -1), (-1, 7), (3, 3), (7, 7), (7, 7)]


def test_empty_table(documents, spark):
    assert found(documents(["a"]).limit(0)) == []


@pytest.mark.parametrize("seed", range(2))
def test_families_of_near_copies(documents, seed):
    """Copies with more and fewer changes, chains, one passage in every text."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(40)]
    texts = []
    for family in range(6):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([30, 120, 400]))]
        for _ in range(25):
            texts.append(noisy(base, rng.choice([0, 0.005, 0.01, 0.02, 0.03, 0.06]), rng) + " " + " ".join(passage))
        chain = list(base)
        for _ in range(10):
            at = rng.randrange(len(chain) - 3)
            chain[at : at + 3] = ["c" + str(rng.randrange(10**6))] * 3
            texts.append(" ".join(chain))
    texts += [f"only {i} " + " ".join(passage) for i in range(40)]
    rng.shuffle(texts)
    assert found(documents(texts)) == brute_force(list(enumerate(texts, 1)))


def test_large_blocks_are_cut(documents, monkeypatch):
    """Every block is large here: one passage is most of many sets, with and without a link."""
    monkeypatch.setattr(jaccard_join, "GROUP", 8)
    monkeypatch.setattr(jaccard_join, "SHARE", 16)
    opened = []
    whole = jaccard_join._open_blocks

    def watched(*args):
        rows = whole(*args)
        opened.append([r["count"] for r in rows.groupBy("cell").count().collect()])
        return rows

    monkeypatch.setattr(jaccard_join, "_open_blocks", watched)
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(95)]
    texts = []
    for own in [4, 8, 10, 11, 12, 13, 14, 18] * 20:
        texts.append(" ".join([f"o{rng.randrange(10**6)}" for _ in range(own)] + passage[: rng.choice([95, 95, 60])]))
    texts += [noisy(passage, rng.choice([0, 0.01, 0.03, 0.05]), rng) for _ in range(60)]
    assert found(documents(texts)) == brute_force(list(enumerate(texts, 1)))
    assert opened[0] and max(opened[0]) <= 8 * 8


def test_tree_keeps_every_link():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 300, dtype=np.uint64)
    sets = []
    for _ in range(150):
        change = rng.random(300) < rng.choice([0.02, 0.1, 0.3, 0.9])
        sets.append(np.unique(np.where(change, rng.integers(0, 2**63, 300, dtype=np.uint64), base)[: rng.integers(200, 300)]))
    sets.sort(key=len)
    sizes = np.array([len(s) for s in sets])
    parts = np.arange(len(sets))
    maps = _folded([_bitmap(s).tobytes() for s in sets])
    got = set(zip(*(x.tolist() for x in _Tree(sizes, parts, maps).pairs(80))))
    links = set()
    for i in range(len(sets)):
        for j in range(i + 1, len(sets)):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                links.add((i, j))
    assert links and links <= got
    assert len(got) < 150 * 149 / 2 / 2
    same = set(zip(*(x.tolist() for x in _Tree(sizes, parts * 0, maps).pairs(80))))
    assert not same


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (20, 20), (5, 4), (7, 9)] + [(100, 100 + i) for i in range(1, 50)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 1 for i in range(1, 6)}, **{i: 7 for i in (7, 8, 9)}, **{100 + i: 100 for i in range(50)}}
    path = [(i, i + 1) for i in range(300)]
    got = components(spark.createDataFrame(path, "u long, v long")).collect()
    assert {r.component for r in got} == {0} and len(got) == 301


def test_one_per_group(documents):
    docs = documents(["a b c d e f", "a b c d e f", "other text", None, "other text"], [5, 4, 9, 2, None])
    assert sorted((r.doc_id or -1, r.lang) for r in one_per_group(docs).collect()) == [(-1, "en"), (2, "en"), (4, "en"), (9, "en")]
    assert one_per_group(docs).columns == docs.columns


def test_one_per_group_tells_rows_of_one_id_apart(documents):
    texts = ["p q r s t u", "a b c d e f", "v w x y z", "a b c d e f", "g h i j k l", "g h i j k l", "g h i j k l", "", " "]
    docs = documents(texts, [1, 1, 2, 0, None, None, None, 3, 3]).withColumn("row_key", F.lit(5)).withColumn("key", F.lit(6))
    got = one_per_group(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.text) for r in got.collect()) == [
        (-1, "g h i j k l"), (0, "a b c d e f"), (1, "p q r s t u"), (2, "v w x y z"), (3, ""), (3, " ")
    ]
