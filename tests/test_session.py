from types import SimpleNamespace

import pytest

from tidebook import session


def test_settings_grow_with_the_input():
    small, large = session.settings_for(10**9), session.settings_for(100 * 10**12)
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert small[key] == "200"
    assert int(large[key]) > 100_000
    assert large["spark.sql.files.maxPartitionBytes"] == "512m"
    assert key not in session.settings_for()


def fake(master, configured=None, set_by_call=None):
    """Stands in for a session: its master, ``spark.checkpoint.dir``, and a folder set in code."""
    settings = {"spark.checkpoint.dir": configured} if configured else {}
    context = SimpleNamespace(
        master=master, applicationId="app", getCheckpointDir=lambda: set_by_call
    )
    return SimpleNamespace(conf=settings, sparkContext=context)


def test_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_root(fake("yarn"))


def test_scratch_uses_the_configured_folder():
    assert session.scratch_root(fake("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert session.scratch_root(fake("local[8]", "/shared")) == "/shared"
    assert session.scratch_root(fake("yarn", set_by_call="hdfs:///set")) == "hdfs:///set"


def test_local_sessions_without_one_keep_a_folder(monkeypatch, tmp_path):
    monkeypatch.setattr(session.tempfile, "mkdtemp", lambda prefix: str(tmp_path))
    assert session.scratch_root(fake("local[8]")) == str(tmp_path)


def test_scratch_paths_are_unique(spark):
    first, second = (session.scratch_path(spark, "x") for _ in range(2))
    assert first != second and first.startswith(session.scratch_root(spark))


def test_materialize_keeps_rows_and_types(spark):
    df = spark.sql("SELECT 1 AS a, CAST(NULL AS date) AS b, 'x' AS c")
    kept = session.materialize(df, "t")
    assert kept.collect() == df.collect()
    assert [f.dataType for f in kept.schema] == [f.dataType for f in df.schema]
