import hashlib
import random
import re

from tidebook.llm import decontaminate as d
from tidebook.llm.queries import contamination_digests

ITEMS = "item_id long, text string"


def words_of(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_force(rows, items, window=10):
    patterns = {}
    for item_id, text in items:
        words = words_of(text)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            patterns.setdefault(tuple(words[i : i + window]), set()).add(item_id)
    sizes = {len(p) for p in patterns}
    out = []
    for doc_id, text in rows:
        words, hit, named = words_of(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                found = patterns.get(tuple(words[i : i + size]))
                if found:
                    hit.update(range(i, i + size))
                    named |= found
        listed = ",".join(sorted(str(i) for i in named if i is not None))
        n_items = len(named - {None})
        out.append((doc_id, len(words), len(hit), n_items, hashlib.sha256(listed.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def found(docs, benchmark):
    digests = contamination_digests(d.contamination(docs, benchmark))
    return sorted((tuple(r) for r in digests.collect()), key=repr)


def test_whole_small_table(spark, small_documents):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in small_documents.collect()]
    items = [(r.item_id, r.text) for r in benchmark.collect()]
    expected = brute_force(rows, items)
    assert found(small_documents, benchmark) == expected
    assert any(r[-1] for r in expected)


def fixture():
    rng = random.Random(2)
    vocabulary = ["the", "of", "a", *(f"w{i}" for i in range(60))]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 9, 10, 11, 30])))) for i in range(12)]
    items += [(3, "the of a"), (50, None), (51, ""), (52, "!!"), (53, "x x x x x x x x x x x"), (None, "only null item"), (54, items[0][1])]
    texts = [None, "", "...", "X-x,x x x x x x x x x x x x", "é the Of a", "only NULL, item here", "the of", "of a"]
    for _ in range(60):
        parts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(30)))]
        for _ in range(rng.randrange(3)):
            words = words_of(rng.choice(items)[1])
            a = rng.randrange(3)
            parts.append(", ".join(words[a : len(words) - rng.randrange(2)]).upper())
        texts.append(" ".join(parts))
    return texts, items


def test_against_brute_force(spark, documents):
    texts, items = fixture()
    got = found(documents(texts), spark.createDataFrame(items, ITEMS))
    assert got == brute_force(list(enumerate(texts, 1)), items)


def test_repeated_rows_null_ids_and_empty_tables(spark, documents):
    benchmark = spark.createDataFrame([(1, "b c d")], ITEMS)
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "b c d"), (None, None)]
    docs = documents([t for _, t in rows], [i for i, _ in rows])
    assert found(docs, benchmark) == brute_force(rows, [(1, "b c d")])
    assert found(docs.limit(0), benchmark) == []
    assert found(docs, benchmark.limit(0)) == brute_force(rows, [])


def test_clean_rows_keep_their_columns(spark, documents):
    benchmark = spark.createDataFrame([(1, "b c d")], ITEMS)
    docs = documents(["a b c d", "b c", None]).selectExpr("*", "'x' AS key2", "1 AS window")
    kept = d.clean_of(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_proximity(spark, documents):
    docs = d.with_key(documents(["zeta q q alpha", "zeta alpha", "zeta q q q q q alpha", "alpha zeta"]))
    windows = d.benchmark_windows(spark.createDataFrame([(1, "zeta alpha")], ITEMS))
    anchors = d._anchors(docs, windows)
    index = d.positional_index(docs, anchors)
    matches = d.phrase_matches(index, anchors, slack=2).join(index.select("key", "doc_id"), "key")
    assert {(r.doc_id, r.exact) for r in matches.collect()} == {(1, False), (2, True), (4, False)}
