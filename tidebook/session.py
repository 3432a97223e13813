"""Session settings and the scratch folder used for written intermediate tables."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

MEGABYTE = 1024 * 1024
PARALLEL_JOBS = 8
LARGE_INPUT = 10 * MEGABYTE * MEGABYTE

_local_roots: dict[str, str] = {}


def settings_for(input_bytes: int | None = None) -> dict[str, str]:
    """Settings the plans are written for, given the size of the data a job will read.

    AQE only ever merges shuffle partitions, so the starting number has to be high enough for the
    data: the default of 200 would put 500 GB into each partition of a 100 TB shuffle. Large
    inputs also get larger scan and shuffle partitions, to keep the number of tasks in bounds.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
    }
    if input_bytes:
        megabytes = 512 if input_bytes >= LARGE_INPUT else 128
        partitions = max(200, -(-input_bytes // (megabytes * MEGABYTE)))
        settings |= {
            "spark.sql.files.maxPartitionBytes": f"{megabytes}m",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{megabytes // 2}m",
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        }
    return settings


def build_session(
    app: str = "tidebook",
    master: str | None = None,
    input_bytes: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Start (or get) a session with ``settings_for(input_bytes)`` and then ``conf``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (settings_for(input_bytes) | (conf or {})).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a session whose executors are threads of this process gets a folder of its own where the
    setting is missing, removed when the process ends; elsewhere such a folder would not be visible
    to the other executors, so an unset folder is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="tidebook-")
        atexit.register(shutil.rmtree, _local_roots[app], ignore_errors=True)
    return _local_roots[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the scratch folder that no other run uses."""
    return f"{scratch_root(spark)}/tidebook/{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back, so that several actions on it compute it once.

    The rows live in the scratch folder, not on executors, so losing an executor loses nothing.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def holds_files(spark: SparkSession, path: str) -> bool:
    """Whether there is anything in a folder, on any file system that Spark writes to."""
    system, place = _file_system(spark, path)
    return system.exists(place) and len(system.listStatus(place)) > 0


def discard(spark: SparkSession, path: str) -> None:
    """Remove what an own unfinished run has written."""
    system, place = _file_system(spark, path)
    system.delete(place, True)


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not exist yet; False, and nothing changed, if it does.

    Creating without overwriting is one step of the file system, so of two writers one wins.
    """
    system, place = _file_system(spark, path)
    try:
        stream = system.create(place, False)
    except Py4JJavaError:
        if system.exists(place):
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
        stream.close()
    except Py4JJavaError:
        system.delete(place, False)
        raise
    return True


def run_together(job: Callable[[Any], Any], inputs: Iterable[Any]) -> list[Any]:
    """Submit independent Spark jobs side by side, so that small ones do not leave a cluster idle.

    Waits for all of them; the first failure is raised afterwards.
    """
    with ThreadPoolExecutor(PARALLEL_JOBS) as pool:
        return list(pool.map(job, inputs))
