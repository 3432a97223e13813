"""Marts as header CSV files, written only after their checks pass."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidebook.functions.numbers import plain_text
from tidebook.session import create_file, discard, holds_files, materialize, run_together
from tidebook.sources.csv_tables import CSV_DIALECT, read_typed

PUBLISHED = "_published"
PUBLISHED_SCHEMA = "sequence bigint, mart string, path string"


class MartRejected(ValueError):
    """A mart differs from what was approved; nothing was written."""


class AlreadyPublished(RuntimeError):
    """The folder holds published marts, and a refresh was not asked for."""


@dataclass(frozen=True)
class Check:
    """An aggregate over the mart and the value it must have."""

    name: str
    measured: Column
    expected: Any
    tolerance: float = 0.0

    def fails(self, value: Any) -> bool:
        if value is None or self.expected is None:
            return value is not self.expected
        if self.tolerance:
            return abs(float(value) - float(self.expected)) > self.tolerance
        return value != self.expected


def validate(df: DataFrame, checks: Sequence[Check], approved: DataFrame | None = None) -> int:
    """Run all checks in one pass, compare with the approved rows if given, return the row count."""
    measured = df.agg(
        F.count("*").alias("rows"), *[c.measured.alias(f"c{i}") for i, c in enumerate(checks)]
    ).first()
    problems = [
        f"{check.name}: expected {check.expected!r}, found {measured[f'c{i}']!r}"
        for i, check in enumerate(checks)
        if check.fails(measured[f"c{i}"])
    ]
    if approved is not None:
        wanted = approved.select(*df.columns)
        missing, extra = wanted.exceptAll(df).count(), df.exceptAll(wanted).count()
        if missing or extra:
            problems.append(f"{missing} approved rows missing, {extra} rows not approved")
    if problems:
        raise MartRejected("; ".join(problems))
    return measured["rows"]


def write_mart(df: DataFrame, path: str, order: Sequence[str], single_file: bool) -> None:
    """Header CSV with the columns of ``df``, sorted, numbers without exponents."""
    ordered = df.orderBy(*order)
    printed = ordered.select(
        [
            plain_text(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in ordered.schema.fields
        ]
    )
    if single_file:
        printed = printed.coalesce(1)
    printed.write.mode("errorifexists").options(**CSV_DIALECT).csv(path)


@dataclass(frozen=True)
class Mart:
    """A mart to publish: its rows in file column order, the sort of the file, and its checks.

    A mart for people is one file; one of unlimited size should be several.
    """

    rows: DataFrame
    order: Sequence[str]
    checks: Sequence[Check] = ()
    approved: DataFrame | None = None
    single_file: bool = True


def publish_marts(marts: dict[str, Mart], folder: str, refresh: bool = False) -> dict[str, int]:
    """Compute every mart once, check them all, and only then publish all of them together.

    Returns the number of rows per mart. The files go to a folder of this run; the list of marts,
    one small file written last, makes them the published ones. A rejected mart or a failure
    leaves what was published before as it is. Existing marts are only replaced by a ``refresh``;
    their files stay for those who are reading them.
    """
    spark = next(iter(marts.values())).rows.sparkSession
    last, _ = _published(spark, folder)
    if last and not refresh:
        raise AlreadyPublished(f"{folder} already holds marts; nothing was written")
    written = run_together(lambda name: materialize(marts[name].rows, name), marts)
    staged = dict(zip(marts, written))
    counts, problems = {}, []
    for name, mart in marts.items():
        try:
            counts[name] = validate(staged[name], mart.checks, mart.approved)
        except MartRejected as error:
            problems.append(f"{name}: {error}")
    if problems:
        raise MartRejected(" | ".join(problems))
    run = f"run-{uuid.uuid4().hex}"
    try:
        run_together(
            lambda name: write_mart(staged[name], f"{folder}/{run}/{name}", marts[name].order, marts[name].single_file),
            marts,
        )
        entries = [{"sequence": last + 1, "mart": name, "path": f"{run}/{name}"} for name in marts]
        # Each publication has a number, and a number can be taken once.
        listed = "\n".join(json.dumps(entry) for entry in entries)
        if not create_file(spark, f"{folder}/{PUBLISHED}/{last + 1:010d}.json", listed):
            raise AlreadyPublished(f"{folder} was published by another run meanwhile")
    except Exception:
        discard(spark, f"{folder}/{run}")
        raise
    return counts


def _published(spark: SparkSession, folder: str) -> tuple[int, dict[str, str]]:
    """Number of the last publication, and its marts with their paths; (0, {}) if there is none."""
    if not holds_files(spark, f"{folder}/{PUBLISHED}"):
        return 0, {}
    rows = spark.read.schema(PUBLISHED_SCHEMA).json(f"{folder}/{PUBLISHED}").collect()
    last = max((r.sequence for r in rows), default=0)
    latest = {r.mart: f"{folder}/{r.path}" for r in rows if r.sequence == last}
    if len(latest) != sum(r.sequence == last for r in rows):
        raise AlreadyPublished(f"{folder} was published by two runs at once; refresh it")
    return last, latest


def mart_paths(spark: SparkSession, folder: str) -> dict[str, str]:
    """The published marts of a folder and where their files are."""
    return _published(spark, folder)[1]


def read_mart(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A written mart, typed again."""
    return read_typed(spark, path, schema)
