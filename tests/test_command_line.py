import glob

import pytest
from helpers import SMALL

from tidebook.__main__ import parser, run
from tidebook.sources import csv_tables, star
from tidebook.sources.warehouse import AlreadyLoaded


@pytest.fixture
def call(spark):
    return lambda *arguments: run(spark, parser().parse_args([str(a) for a in arguments]))


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "shop.csv").write_text("id,zip\n1,01310\n2,99999\n")
    return folder


def test_schema(call, raw, capsys):
    assert call("schema", raw, "--text", "id") == 0
    assert capsys.readouterr().out.strip() == "CREATE TABLE `shop` (\n  `id` string,\n  `zip` string\n);"


def test_load_twice(call, raw, tmp_path, capsys):
    assert call("load", raw, tmp_path / "w") == 0
    assert capsys.readouterr().out == "TOTAL: 2 read, 2 loaded\nshop: 2 read, 2 loaded\n"
    with pytest.raises(AlreadyLoaded):
        call("load", raw, tmp_path / "w")


def test_marts(call, tmp_path, capsys):
    out = tmp_path / "marts"
    options = ["--reference", 7, "--first", "2001-05", "--last", "2001-07", "--channel", "1-URGENT", "2-HIGH"]
    assert call("marts", SMALL, out, *options) == 0
    printed = capsys.readouterr().out.splitlines()
    assert len(printed) == 7 and "forecast: 3 rows" in printed and "weekdays: 7 rows" in printed
    assert len(glob.glob(f"{out}/run-*/*/*.csv")) == 7


def test_query(call, capsys):
    assert call("query", "worst_weekday", SMALL) == 0
    assert "average_sales" in capsys.readouterr().out


def test_marts_from_csv_equal_marts_from_parquet(spark, call, tmp_path):
    """Amounts are decimals after the load and doubles in the parquet tables."""
    for name in ("orders", "lineitem", "part", "customer"):
        exported = csv_tables.as_exported(star.table(spark, SMALL, name))
        csv_tables.write_text_table(exported, f"{tmp_path}/raw/{name}")
    assert call("load", tmp_path / "raw", tmp_path / "w") == 0
    options = ["--reference", 7, "--first", "2001-05", "--last", "2001-07", "--channel", "1-URGENT"]
    call("marts", SMALL, tmp_path / "a", *options)
    call("marts", "--loaded", tmp_path / "w", tmp_path / "b", *options)

    def files(folder):
        return {f.split("/")[-2]: open(f).read() for f in glob.glob(f"{tmp_path}/{folder}/run-*/*/*.csv")}

    assert files("a") == files("b") and len(files("a")) == 7
