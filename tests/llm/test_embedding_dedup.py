import numpy as np
import pytest

from tidebook.llm import embedding_dedup as dedup
from tidebook.llm.queries import op11_embedding_dedup

SCHEMA = "vec_id long, embedding array<float>, label int"


def good(v):
    return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def by_hand(rows, least=0.95):
    """n_links and component_id by comparing all pairs."""
    at = [i for i, (_, v) in enumerate(rows) if good(v)]
    near = np.zeros((len(rows), len(rows)), bool)
    for dims in {len(rows[i][1]) for i in at}:
        of = np.array([i for i in at if len(rows[i][1]) == dims])
        x = np.array([rows[i][1] for i in of], np.float32).astype(float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        near[np.ix_(of, of)] = x @ x.T >= least
    np.fill_diagonal(near, False)
    out, seen = {}, set()
    for i in range(len(rows)):
        if i in seen:
            continue
        reached, front = {i}, [i]
        while front:
            front = [int(k) for j in front for k in np.flatnonzero(near[j]) if int(k) not in reached and not reached.add(int(k))]
        seen |= reached
        named = [rows[j][0] for j in reached if rows[j][0] is not None]
        for j in reached:
            out[j] = min(named) if named else None
    return sorted(((k, int(near[i].sum()), out[i], k == out[i]) for i, (k, _) in enumerate(rows)), key=repr)


def found(df):
    assert df.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("sf", ["0.001", "0.1"])
def test_whole_table(spark, sf):
    """All links of the given tables are found."""
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"/root/testdata/sf{sf}/embeddings.parquet").collect()]
    assert found(op11_embedding_dedup(spark, f"/root/testdata/sf{sf}")) == by_hand(rows)


def test_recall_at_the_threshold(spark):
    """Pairs just above the threshold are the hardest; none below it are linked."""
    draw = np.random.default_rng(7)
    n = 3000
    a, b = draw.standard_normal((2, n, 32))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    cosine = np.where(np.arange(n) % 3 < 2, 0.951, 0.949)[:, None]
    c = cosine * a + np.sqrt(1 - cosine**2) * b
    rows = [(2 * i + j, [float(x) for x in v], None) for i in range(n) for j, v in enumerate((a[i], c[i]))]
    out = {r.vec_id: r.n_links for r in dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    linked = [out[2 * i] for i in range(n)]
    assert sum(linked[i] for i in range(n) if i % 3 < 2) >= 0.97 * (2 * n // 3)
    assert sum(linked[i] for i in range(n) if i % 3 == 2) == 0


def test_edges(spark):
    near = [1.0, 0.1, 0.0]
    rows = [
        (5, near), (3, near), (3, near), (None, [1.0, 0.0, 0.0]), (9, [2.0, 0.2, 0.0]), (2, [-1.0, -0.1, 0.0]),
        (1, None), (1, []), (4, [0.0, 0.0, 0.0]), (6, [1.0, None, 0.0]), (7, [float("nan"), 0.0, 1.0]), (None, None),
        (8, [float("inf"), 0.0, 0.0]), (None, [0.0, 0.0, 1.0]), (None, [0.0, 0.0, 1.0]), (10, [1.0, 0.1]), (11, [3e38, 3e38, 0.0]), (12, [3e38, 2.9e38, 0.0]),
    ]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).selectExpr("*", "1 AS node", "'a' AS h1", "2 AS size").repartition(4)
    assert found(dedup.near_duplicates(df)) == by_hand(rows)
    assert found(dedup.near_duplicates(df.limit(0))) == []
    doubled = df.selectExpr("vec_id", "cast(embedding AS array<double>) AS embedding")
    assert found(dedup.near_duplicates(doubled)) == by_hand(rows)


def test_crowded_bucket_in_blocks(spark, monkeypatch):
    """A large group of near vectors is compared in blocks of groups and counted once."""
    monkeypatch.setattr(dedup, "GROUP", 20)
    draw = np.random.default_rng(11)
    centre = draw.standard_normal(16)
    x = np.concatenate([centre + 0.08 * draw.standard_normal((150, 16)), draw.standard_normal((60, 16))])
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).repartition(4)
    assert found(dedup.near_duplicates(df, recall=1 - 1e-9)) == by_hand(rows)


def test_copies_meet_once(spark):
    """A third of all rows are one vector: they are one node, and no pair of them is made."""
    draw = np.random.default_rng(4)
    rows = [(i, [1.0, 2.0, 3.0, 4.0] if i % 3 == 0 else [float(c) for c in draw.standard_normal(4).astype(np.float32)]) for i in range(900)]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).repartition(4)
    assert dedup._classes(df, "vec_id", "embedding").count() == 601
    out = {r.vec_id: r for r in dedup.near_duplicates(df, recall=1 - 1e-9).collect()}
    expected = {r[0]: r for r in by_hand(rows)}
    assert {k: tuple(r) for k, r in out.items()} == expected


def test_sizes_follow_the_table():
    for n in (0, 1, 100, 10**6, 10**9):
        bits, tables = dedup.table_sizes(n)
        agree = (1 - np.arccos(0.95) / np.pi) ** bits
        assert 1 - (1 - agree) ** tables >= 0.99 and n / 2**bits <= 16 or n <= 16
