"""Command line: infer a schema, load tables, publish the marts, run a query.

    python -m tidebook schema RAW_FOLDER
    python -m tidebook load RAW_FOLDER WAREHOUSE_FOLDER
    python -m tidebook marts TABLES_FOLDER OUT_FOLDER --reference 17 --first 2001-05 --last 2001-07
    python -m tidebook --input-gb 100000 marts --loaded WAREHOUSE_FOLDER OUT_FOLDER ...
    python -m tidebook query NAME TABLES_FOLDER
"""

from __future__ import annotations

import argparse
import sys
from dataclasses import replace
from datetime import date

from pyspark.sql import SparkSession

from tidebook.operators.schema import to_ddl
from tidebook.plans.ingest import ingest
from tidebook.plans.marts import build_marts
from tidebook.plans.registry import QUERIES
from tidebook.session import build_session
from tidebook.sources import csv_tables, star, warehouse
from tidebook.sources.mart_files import publish_marts, read_mart


def _month(text: str) -> date:
    return date.fromisoformat(f"{text}-01")


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(prog="tidebook")
    main.add_argument("--input-gb", type=int, help="size of the data, to size the shuffles")
    commands = main.add_subparsers(dest="command", required=True)

    schema = commands.add_parser("schema", help="print CREATE TABLE texts for a folder of CSV tables")
    schema.add_argument("raw")
    load = commands.add_parser("load", help="load a folder of CSV tables into an empty warehouse")
    load.add_argument("raw")
    load.add_argument("warehouse")
    for command in (schema, load):
        command.add_argument("--text", nargs="*", default=[], help="identifier columns to keep as text")
        command.add_argument("--multiline", action="store_true", help="fields may hold line breaks")

    marts = commands.add_parser("marts", help="compute, check and write the seven marts")
    marts.add_argument("tables")
    marts.add_argument("out")
    marts.add_argument("--loaded", action="store_true", help="TABLES is a warehouse made by load")
    marts.add_argument("--channel", nargs="*", default=None, help="channels of the weekday averages")
    marts.add_argument("--approved", help="folder of CSV marts, <name> or <name>.csv, that the rows must equal")
    marts.add_argument("--refresh", action="store_true", help="replace marts that OUT_FOLDER holds")
    marts.add_argument("--reference", type=int, required=True, help="product id")
    marts.add_argument("--first", type=_month, required=True, help="first test month, yyyy-mm")
    marts.add_argument("--last", type=_month, required=True, help="last test month, yyyy-mm")

    query = commands.add_parser("query", help="run a registered query")
    query.add_argument("name", choices=sorted(QUERIES))
    query.add_argument("tables")
    return main


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    if args.command == "schema":
        paths = csv_tables.find_tables(spark, args.raw)
        schemas = csv_tables.infer_schemas(spark, paths, args.text, args.multiline)
        for name, schema in schemas.items():
            print(to_ddl(name, schema) + ";\n")
        return 0
    if args.command == "load":
        counts = ingest(spark, args.raw, args.warehouse, args.text, args.multiline).row_counts
        rows = counts.orderBy("table_name").collect()  # one row per table
        for row in rows:
            print(f"{row['table_name']}: {row['n_source']} read, {row['n_loaded']} loaded")
        return int(any(row["diff"] for row in rows))
    if args.command == "marts":
        if args.loaded:
            sales = star.bind(warehouse.open_tables(spark, args.tables))
        else:
            sales = star.sales(spark, args.tables)
        marts = build_marts(sales, args.channel, args.reference, args.first, args.last)
        paths = csv_tables.find_tables(spark, args.approved) if args.approved else {}
        if unknown := set(paths) - set(marts):
            raise ValueError(f"approved rows for unknown marts: {sorted(unknown)}")
        for name, path in paths.items():
            marts[name] = replace(marts[name], approved=read_mart(spark, path, marts[name].rows.schema))
        for name, n in publish_marts(marts, args.out, args.refresh).items():
            print(f"{name}: {n} rows")
        return 0
    QUERIES[args.name](spark, args.tables).show(50, truncate=False)
    return 0


def main(arguments: list[str] | None = None) -> int:
    args = parser().parse_args(arguments)
    size = args.input_gb * 10**9 if args.input_gb else None
    return run(build_session(input_bytes=size), args)


if __name__ == "__main__":
    sys.exit(main())
