import zlib
from collections import Counter

import pytest

from tidebook.llm.sharding import SHARDS, SLOTS, lookup_table, place, write_shards


def by_hand(shards, slots):
    """Whole preference lists, then rounds."""
    lists = []
    for s in shards:
        offset, skip = zlib.crc32(f"offset {s}".encode()) % slots, zlib.crc32(f"skip {s}".encode()) % (slots - 1) + 1
        lists.append([(offset + j * skip) % slots for j in range(slots)])
    owner = {}
    while len(owner) < slots:
        for i, wanted in enumerate(lists):
            if len(owner) < slots:
                owner[next(x for x in wanted if x not in owner)] = i
    return [owner[i] for i in range(slots)]


@pytest.mark.parametrize("n,slots", [(1, 2), (3, 7), (5, 101), (7, 7)])
def test_table_by_hand(n, slots):
    names = [f"s{i}" for i in range(n)]
    assert lookup_table(names, slots) == by_hand(names, slots)


def test_balance_and_little_movement():
    full = lookup_table(SHARDS)
    counts = Counter(full)
    assert len(counts) == 64 and max(counts.values()) - min(counts.values()) <= 1
    fewer = lookup_table(SHARDS[:-1])
    moved = sum(a != b for a, b in zip(full, fewer) if a != 63)
    assert moved < 0.05 * SLOTS


@pytest.mark.parametrize("shards,slots", [([], 7), (["a", "a"], 7), (["a", "b", "c"], 2), (["a"], 8), (["a"], 1)])
def test_refused(shards, slots):
    with pytest.raises(ValueError):
        lookup_table(shards, slots)


def test_placement(spark, documents, tmp_path):
    docs = documents(["a", None, "c", "a"], [1, 2, None, 1]).selectExpr("*", "7 AS slot", "'old' AS shard", "0 AS at")
    table = lookup_table(SHARDS)
    placed = place(docs, "doc_id")
    assert placed.columns == ["doc_id", "text", "lang", "source", "n_chars", "at", "slot", "shard"]
    rows = placed.collect()
    assert len(rows) == 4
    for r in rows:
        key = b"" if r.doc_id is None else str(r.doc_id).encode()
        assert r.slot == zlib.crc32(key) % SLOTS and r.shard == SHARDS[table[r.slot]]
    assert place(docs.limit(0), "doc_id").collect() == []
    write_shards(placed, str(tmp_path / "out"), 2)
    assert sorted(spark.read.parquet(str(tmp_path / "out")).columns) == sorted(placed.columns)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_placement_stays_native(documents):
    plan = place(documents(["a"]), "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "BroadcastHashJoin" in plan
