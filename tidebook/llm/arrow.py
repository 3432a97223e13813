"""Arrow batches through Python functions, and streams of groups within a sorted partition."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from functools import partial
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

Batches = Iterator[pa.RecordBatch]
OFFSET_BYTES = 1 << 31
# Bytes of rows that go to a Python worker at once, and how Spark says that nobody has set a limit.
BATCH_BYTES = 4 << 20
LIMIT, UNSET_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
_ROOT = str(Path(__file__).resolve().parents[2])


def map_batches(df: DataFrame, function: Callable[[Batches], Batches], schema: str) -> DataFrame:
    """``mapInArrow``, with this package importable in the Python workers of a local session.

    A session that has no limit of its own on the bytes of a batch gets one: 10,000 long texts at
    once are held by the executor, by Arrow and by Python. Workers give freed memory back when a
    task ends, as they are used again.
    """
    if df.sparkSession.conf.get(LIMIT) == UNSET_LIMIT:
        df.sparkSession.conf.set(LIMIT, str(BATCH_BYTES))
    environment = df.sparkSession.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(":") if p]
    if _ROOT not in paths:
        environment["PYTHONPATH"] = ":".join([*paths, _ROOT])
    return df.mapInArrow(partial(_freeing, function=function), schema)


def _freeing(batches: Batches, function: Callable[[Batches], Batches]) -> Batches:
    try:
        yield from function(batches)
    finally:
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def unused(name: str, columns: list[str]) -> str:
    """``name``, lengthened until no column has it in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def binaries(parts: list[np.ndarray]) -> pa.Array:
    """One binary value for each array."""
    return pa.array([p.tobytes() for p in parts], pa.binary())


def longs(values: np.ndarray) -> pa.Array:
    """64-bit values as Spark's long; hashes keep their bits."""
    values = np.ascontiguousarray(values)
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values.astype(np.int64))


def batch(**columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def whole_groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Batches cut between groups: rows of one key, sorted next to each other, stay in one batch."""
    held: list[pa.RecordBatch] = []
    for part in batches:
        if not part.num_rows:
            continue
        keys = part.column(key).to_numpy(zero_copy_only=False)
        changes = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        if held and held[-1].column(key)[-1].as_py() != keys[0]:
            yield _together(held)
            held = []
        if len(changes):
            yield _together([*held, part.slice(0, int(changes[-1]))])
            held = [part.slice(int(changes[-1]))]
        else:
            held.append(part)
    if held:
        yield _together(held)


def _together(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    """All rows in one batch. Columns of more bytes than 32-bit offsets reach get 64-bit ones, as
    Arrow would cut them into several chunks."""
    table = pa.Table.from_batches(parts)
    wide = {pa.binary(): pa.large_binary(), pa.string(): pa.large_string()}
    for i, column in enumerate(table.schema):
        if column.type in wide and table.column(i).nbytes >= OFFSET_BYTES:
            table = table.set_column(i, column.name, table.column(i).cast(wide[column.type]))
    whole = table.combine_chunks().to_batches()
    if len(whole) != 1:
        raise ValueError(f"{table.num_rows} rows of one group came back in {len(whole)} batches")
    return whole[0]


def run_starts(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
