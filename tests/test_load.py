import os
import uuid
from datetime import date, datetime
from decimal import Decimal

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidebook.plans.ingest import ingest
from tidebook.sources import csv_tables, warehouse

FILES = {
    "people": (
        "id,name,tax_id,active,hired,created,pay\n"
        "1,Ana,02428608000147,TRUE,2024-01-31,2024-01-31 10:00:00,10.50\n"
        "2, Rui,10771657000100,FALSE,,2024-02-01 00:00:00,7\n"
        '3,"Li, ""Jo""",11111111000100,TRUE,2024-02-29,,\n'
    ),
    "values": 'item,value\n1,""\n2,\n3,x\n',
}


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    for name, text in FILES.items():
        (folder / f"{name}.csv").write_text(text, encoding="utf-8")
    return str(folder)


def prepared(spark, source):
    paths = csv_tables.find_tables(spark, source)
    return paths, csv_tables.infer_schemas(spark, paths)


def test_find_tables(spark, source):
    parts = os.path.join(source, "parts")
    os.mkdir(parts)
    for k in range(2):
        with open(f"{parts}/part-{k}.csv", "w") as f:
            f.write(f"id\n{k}\n")
    found = csv_tables.find_tables(spark, source)
    assert sorted(found) == ["parts", "people", "values"]
    assert rows(csv_tables.read_text(spark, found["parts"])) == [("0",), ("1",)]
    assert csv_tables.find_tables(spark, f"file://{source}").keys() == found.keys()


def test_load_keeps_every_value(spark, source, tmp_path):
    paths, schemas = prepared(spark, source)
    assert schemas["people"].simpleString() == (
        "struct<id:bigint,name:string,tax_id:string,active:boolean,hired:date,created:timestamp_ntz,pay:decimal(4,2)>"
    )
    loaded = warehouse.load_all(spark, paths, schemas, str(tmp_path / "dest"))
    assert rows(loaded["people"]) == [
        (1, "Ana", "02428608000147", True, date(2024, 1, 31), datetime(2024, 1, 31, 10), Decimal("10.50")),
        (2, " Rui", "10771657000100", False, None, datetime(2024, 2, 1), Decimal("7.00")),
        (3, 'Li, "Jo"', "11111111000100", True, date(2024, 2, 29), None, None),
    ]
    # An empty field is null, a quoted empty field is an empty text.
    assert rows(loaded["values"]) == [(1, ""), (2, None), (3, "x")]
    again = warehouse.open_tables(spark, str(tmp_path / "dest"))
    assert rows(again["people"]) == rows(loaded["people"])


def test_second_load_is_refused(spark, source, tmp_path):
    dest = str(tmp_path / "dest")
    paths, schemas = prepared(spark, source)
    warehouse.load_all(spark, paths, schemas, dest)
    before = sorted(os.listdir(dest))
    with pytest.raises(warehouse.AlreadyLoaded):
        warehouse.load_all(spark, paths, schemas, dest)
    assert sorted(os.listdir(dest)) == before
    assert warehouse.open_tables(spark, dest)["people"].count() == 3


def test_failed_load_publishes_nothing(spark, source, tmp_path):
    """The second table fails after the first is written; a later load then works."""
    dest = str(tmp_path / "dest")
    paths, schemas = prepared(spark, source)
    with open(paths["values"], "a") as f:
        f.write("not a number,y\n")
    with pytest.raises(Exception, match="not a number|MALFORMED"):
        warehouse.load_all(spark, paths, schemas, dest)
    assert warehouse.published(spark, dest) == {}
    with pytest.raises(FileNotFoundError):
        warehouse.open_tables(spark, dest)
    paths, schemas = prepared(spark, source)
    assert warehouse.load_all(spark, paths, schemas, dest)["values"].count() == 4


def test_reordered_header_is_refused(spark, tmp_path):
    folder = tmp_path / "t"
    folder.mkdir()
    (folder / "a.csv").write_text("x,y\n1,2\n")
    schema = csv_tables.infer_schemas(spark, {"t": str(folder)})["t"]
    (folder / "b.csv").write_text("y,x\n3,4\n")
    with pytest.raises(Exception, match="(?i)header"):
        csv_tables.read_typed(spark, str(folder), schema).collect()


def test_line_breaks_inside_fields(spark, tmp_path):
    """Refused when files are split at line breaks, whole when they are not."""
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "notes.csv").write_text('id,note,n\n1,"two\nlines",7\n2,plain,8\n')
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        ingest(spark, str(folder), str(tmp_path / "a"))
    done = ingest(spark, str(folder), str(tmp_path / "b"), multiline=True)
    assert rows(done.tables["notes"]) == [(1, "two\nlines", 7), (2, "plain", 8)]
    assert rows(done.row_counts) == [("TOTAL", 2, 2, 0), ("notes", 2, 2, 0)]


def test_rows_with_missing_fields_are_refused(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "t.csv").write_text("id,a,b\n1,x,y\n2,x\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ"):
        ingest(spark, str(folder), str(tmp_path / "a"))


FIELD = st.text(st.characters(codec="utf-8", exclude_characters="\x00\r"), max_size=6)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(FIELD, st.none() | st.sampled_from(["01", " x", "1.5", "-", 'a"b', "a,b", "á\n"])), min_size=1, max_size=6))
def test_any_text_survives_export_and_load(spark, tmp_path, data):
    folder = str(tmp_path / uuid.uuid4().hex)
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(data)], "k bigint, a string, b string")
    csv_tables.write_text_table(df.coalesce(1), f"{folder}/raw/t")
    tables = ingest(spark, f"{folder}/raw", f"{folder}/w", ["a", "b"], multiline=True).tables
    assert rows(tables["t"]) == rows(df)


def test_two_loads_at_once_are_detected(spark, source, tmp_path):
    dest = str(tmp_path / "dest")
    paths, schemas = prepared(spark, source)
    warehouse.load_all(spark, paths, schemas, dest)
    other = spark.createDataFrame([("people", "run-x/people")], warehouse.PUBLISHED_SCHEMA)
    other.write.mode("append").json(f"{dest}/{warehouse.PUBLISHED}")
    with pytest.raises(warehouse.AlreadyLoaded):
        warehouse.open_tables(spark, dest)


def test_the_later_of_two_loads_leaves_nothing(spark, source, tmp_path, monkeypatch):
    """Both find the folder empty; the one that publishes second is refused and cleaned away."""
    dest = str(tmp_path / "dest")
    paths, schemas = prepared(spark, source)
    warehouse.load_all(spark, paths, schemas, dest)
    before = sorted(os.listdir(dest))
    monkeypatch.setattr(warehouse, "require_empty", lambda *_: None)
    with pytest.raises(warehouse.AlreadyLoaded, match="meanwhile"):
        warehouse.load_all(spark, paths, schemas, dest)
    assert sorted(os.listdir(dest)) == before
    assert warehouse.open_tables(spark, dest)["people"].count() == 3


def test_failed_publication_leaves_nothing(spark, source, tmp_path, monkeypatch):
    dest = str(tmp_path / "dest")
    paths, schemas = prepared(spark, source)

    def broken(*_):
        raise OSError("no space")

    with monkeypatch.context() as patched, pytest.raises(OSError):
        patched.setattr(warehouse, "create_file", broken)
        warehouse.load_all(spark, paths, schemas, dest)
    assert not [name for name in os.listdir(dest) if name.startswith("run-")]
    assert warehouse.load_all(spark, paths, schemas, dest)["people"].count() == 3


def test_reconcile(spark, source, tmp_path):
    paths, schemas = prepared(spark, source)
    loaded = warehouse.load_all(spark, paths, schemas, str(tmp_path / "dest"))
    source_counts = warehouse.count_rows(csv_tables.read_tables(spark, paths, schemas), "n_source")

    def against(tables):
        return rows(warehouse.reconcile(source_counts, warehouse.count_rows(tables, "n_loaded")))

    assert against(loaded) == [("TOTAL", 6, 6, 0), ("people", 3, 3, 0), ("values", 3, 3, 0)]
    assert against({"people": loaded["people"].limit(2), "extra": loaded["values"]}) == [
        ("TOTAL", 6, 5, 1),
        ("extra", 0, 3, -3),
        ("people", 3, 2, 1),
        ("values", 3, 0, 3),
    ]


def test_ingest(spark, source, tmp_path):
    with open(f"{source}/empty.csv", "w") as f:
        f.write("a,b\n")
    done = ingest(spark, source, str(tmp_path / "dest"), ["item"])
    assert rows(done.row_counts) == [("TOTAL", 6, 6, 0), ("empty", 0, 0, 0), ("people", 3, 3, 0), ("values", 3, 3, 0)]
    assert done.schemas["values"].simpleString() == "struct<item:string,value:string>"
    assert rows(done.tables["values"]) == [("1", ""), ("2", None), ("3", "x")]
    with pytest.raises(warehouse.AlreadyLoaded):
        ingest(spark, source, str(tmp_path / "dest"))


def test_views(spark, source, tmp_path):
    paths, schemas = prepared(spark, source)
    warehouse.register(warehouse.load_all(spark, paths, schemas, str(tmp_path / "dest")))
    assert spark.sql("SELECT sum(pay) FROM people WHERE active").first()[0] == Decimal("10.50")
