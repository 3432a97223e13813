"""Typed load of many tables, published all together or not at all."""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.session import create_file, discard, holds_files, run_together
from tidebook.sources.csv_tables import read_tables

PUBLISHED = "_published"
MANIFEST = "manifest.json"
PUBLISHED_SCHEMA = "table_name string, path string"


class AlreadyLoaded(RuntimeError):
    """The destination holds data."""


def load_all(
    spark: SparkSession,
    paths: dict[str, str],
    schemas: dict[str, T.StructType],
    dest: str,
    multiline: bool = False,
) -> dict[str, DataFrame]:
    """Load every CSV table to parquet below ``dest`` and publish the set.

    Tables are written to a folder of this run that no reader looks at. The list of tables is
    written last, as one small file; only with it does the load exist. Of two loads at once, one
    creates that file and the other is refused. A failure up to then, that of the list included,
    leaves nothing behind. A destination that holds anything is refused, so that no row is loaded
    twice or mixed with other data.
    """
    require_empty(spark, dest)
    run = f"run-{uuid.uuid4().hex}"
    tables = read_tables(spark, paths, schemas, multiline)
    try:
        run_together(
            lambda name: tables[name].write.mode("errorifexists").parquet(f"{dest}/{run}/{name}"),
            tables,
        )
        listed = [json.dumps({"table_name": name, "path": f"{run}/{name}"}) for name in paths]
        if not create_file(spark, f"{dest}/{PUBLISHED}/{MANIFEST}", "\n".join(listed)):
            raise AlreadyLoaded(f"{dest} was loaded meanwhile; nothing of this load stays")
    except Exception:
        discard(spark, f"{dest}/{run}")
        raise
    return open_tables(spark, dest, schemas)


def require_empty(spark: SparkSession, dest: str) -> None:
    if holds_files(spark, dest):
        raise AlreadyLoaded(f"{dest} already holds data; nothing was written")


def published(spark: SparkSession, dest: str) -> dict[str, str]:
    """Table name to folder for a finished load; empty if there is none."""
    try:
        rows = spark.read.schema(PUBLISHED_SCHEMA).json(f"{dest}/{PUBLISHED}").collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    tables = {row["table_name"]: row["path"] for row in rows}
    if len(tables) != len(rows):
        raise AlreadyLoaded(f"{dest} was published by two loads at once; load into a new folder")
    return tables


def open_tables(
    spark: SparkSession, dest: str, schemas: dict[str, T.StructType] | None = None
) -> dict[str, DataFrame]:
    """The tables of a published load."""
    tables = published(spark, dest)
    if not tables:
        raise FileNotFoundError(f"no published load in {dest}")
    reader = {
        name: spark.read.schema(schemas[name]) if schemas else spark.read for name in tables
    }
    return {name: reader[name].parquet(f"{dest}/{path}") for name, path in tables.items()}


def register(tables: dict[str, DataFrame]) -> None:
    """Expose typed tables as views, the one base all SQL analyses read."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def count_rows(tables: dict[str, DataFrame], column: str) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        df.agg(F.count("*").alias(column)).select(F.lit(name).alias("table_name"), column)
        for name, df in tables.items()
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


def reconcile(source: DataFrame, loaded: DataFrame) -> DataFrame:
    """Rows per table on both sides, their difference, and a ``TOTAL`` row.

    Takes (table_name, n_source) and (table_name, n_loaded). A table that only one side knows is
    listed with 0 rows on the other.
    """
    filled = source.join(loaded, "table_name", "full_outer").select(
        "table_name",
        F.coalesce("n_source", F.lit(0)).alias("n_source"),
        F.coalesce("n_loaded", F.lit(0)).alias("n_loaded"),
    )
    return (
        filled.rollup("table_name")
        .agg(F.sum("n_source").alias("n_source"), F.sum("n_loaded").alias("n_loaded"))
        .select(
            F.coalesce("table_name", F.lit("TOTAL")).alias("table_name"),
            "n_source",
            "n_loaded",
            (F.col("n_source") - F.col("n_loaded")).alias("diff"),
        )
    )
