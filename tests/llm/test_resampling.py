import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidebook.llm import resampling
from tidebook.llm.queries import op12_resampling

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall("" if text is None else re.sub("[A-Z]", lambda m: m[0].lower(), text))
    return words, [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def by_hand(docs, target, buckets=10000, least=20, percent=5):
    count = lambda texts: Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features(t)[1])
    s, t = count(x for _, x in docs), count(target)
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in s}
    rows = []
    for key, text in docs:
        words, found = features(text)
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in found)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([key, len(found), weight, score, None, len(words)])
    fit = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for i, r in enumerate(fit[: percent * len(fit) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()), key=repr)


def test_small_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    out = op12_resampling(spark, SMALL)
    assert dict(out.dtypes) == dict.fromkeys(["doc_id", "n_features", "weight", "score", "rank"], "bigint")
    assert found(out) == by_hand(docs, target)


TEXTS = [
    None, "", "  ,.  ", "One", "one TWO", "ÄÖ Straße\x00naïve 日本 x9_y", "a " * 60, "a " * 60, "x" * 500 + " y " + "z" * 63 + " w",
    " ".join(f"word{i % 7}" for i in range(40)), "q" * 62 + " " + "r" * 61 + " s", "the end of the long text " * 2000,
]


@pytest.mark.parametrize("buckets,percent", [(10000, 5), (97, 50), (1 << 20, 100)])
def test_edges_by_hand(spark, documents, buckets, percent):
    ids = [None, 2, 3, 4, 4, 6, 7, 7, 9, 10, 11, None]
    docs = documents(TEXTS, ids).selectExpr("*", "1 AS weight", "'x' AS buckets", "2 AS position", "3 AS n_words")
    target = spark.createDataFrame([(t, 5) for t in (None, "one two", "the long text of the end", "")], "text string, doc_id int")
    out = resampling.resample(docs, target, percent=percent, least_words=2, buckets=buckets)
    assert out.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    expected = by_hand(list(zip(ids, TEXTS)), [r[0] for r in target.collect()], buckets, 2, percent)
    assert found(out) == expected


def test_empty_tables(spark, documents):
    target = spark.createDataFrame([], "item_id string, text string")
    assert resampling.resample(documents(["a"]).limit(0), target).collect() == []
    (r,) = resampling.resample(documents(["b a"]), target).collect()
    assert (r.n_words, r.n_features, r["rank"]) == (2, 3, None)


def test_offsets_and_crcs():
    text = "Größe 12,\tNEW\x7fday É"
    assert [text[a:b].lower() for _, (a, b) in resampling.words_with_offsets(text)][:4] == ["größe", "12", "new", "day"]
    assert [w for w, _ in resampling.words_with_offsets(text)] == ["größe", "12", "new", "day", "É"]
    draw = np.random.default_rng(1)
    parts = [bytes(draw.integers(1, 256, draw.integers(1, 62), dtype=np.uint8)) for _ in range(300)]
    data, sizes = np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts])
    crcs = resampling.word_crcs(data, np.cumsum(sizes) - sizes, sizes)
    assert crcs.tolist() == [zlib.crc32(p) for p in parts]
    both = resampling.appended(crcs[:-1], sizes[1:], crcs[1:])
    assert both.tolist() == [zlib.crc32(a + b) for a, b in zip(parts, parts[1:])]


def test_target_like_documents_are_drawn(spark, documents):
    """A tenth of the documents is written like the target; nearly all of the drawn ones are."""
    draw = np.random.default_rng(2)
    say = lambda words: " ".join(draw.choice(words, 60))
    near, far = [f"near{i}" for i in range(50)], [f"far{i}" for i in range(200)]
    docs = documents([say(near) if i % 10 == 0 else say(far) for i in range(400)], list(range(400)))
    target = spark.createDataFrame([(say(near),) for _ in range(30)], "text string")
    drawn = [r.doc_id for r in resampling.resample(docs, target).collect() if r["rank"]]
    assert len(drawn) == 20 and sum(i % 10 == 0 for i in drawn) >= 19
