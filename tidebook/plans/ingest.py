"""From a folder of header CSV tables to a published typed load with matching row counts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidebook.operators.schema import infer_types, profile_tables, rows_profiled, schemas_of
from tidebook.session import materialize
from tidebook.sources import csv_tables, warehouse


@dataclass(frozen=True)
class Ingested:
    tables: dict[str, DataFrame]
    schemas: dict[str, T.StructType]
    row_counts: DataFrame


def ingest(
    spark: SparkSession,
    folder: str,
    dest: str,
    text_columns: list[str] | None = None,
    multiline: bool = False,
) -> Ingested:
    """Profile, infer, load, reconcile.

    The source is read twice: once to profile every row, once to load. The profile is written
    and serves both the types and the source row counts; the loaded rows are counted from the
    parquet footers.
    """
    warehouse.require_empty(spark, dest)
    paths = csv_tables.find_tables(spark, folder)
    texts = {name: csv_tables.read_text(spark, path, multiline) for name, path in paths.items()}
    profile = materialize(profile_tables(texts), "profile")
    columns = {name: df.columns for name, df in texts.items()}
    schemas = schemas_of(infer_types(profile, text_columns), columns)
    tables = warehouse.load_all(spark, paths, schemas, dest, multiline)
    counted = warehouse.reconcile(rows_profiled(profile), warehouse.count_rows(tables, "n_loaded"))
    return Ingested(tables, schemas, counted)
