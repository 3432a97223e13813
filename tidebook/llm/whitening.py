"""Embedding whitening from exact integer moments, by bit-sliced scatter.

Entries become whole numbers, ``floor(256 * c)``. Each dimension is shifted by its smallest value and
written as bit planes: the bits of 64 rows form one word. The cross-product of two dimensions is the
sum over pairs of planes of ``2**(a + b)`` times the bits that both planes share, counted word by
word, so the moments are exact whatever the order of rows, tasks or retries. They are centred as
integers, ``n * sum(x_i * x_j) - S_i * S_j``, and only then divided for the eigenvectors.

Equal vectors count once (the fit list). Each task holds one count for a pair of dimensions and a
power of two and sends one row for a pair of dimensions; nothing that grows with the rows reaches
the driver, which holds matrices of dimension by dimension.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidebook.llm.arrow import Batches, batch, longs, map_batches, unused
from tidebook.session import materialize

SCALE = 256
COMPONENTS = 4
# Rows whose planes are held at once: 64 words for every plane.
CHUNK = 4096
# An eigenvalue below this part of the trace is rounding only.
NOTHING = 1e-12
_SPLIT = 32


def usable(column: str | Column) -> Column:
    """Whether a vector is given and all its entries are finite numbers."""
    c = F.col(column) if isinstance(column, str) else column
    finite = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite, F.lit(False))


def whole(column: str) -> Column:
    """The vector in whole numbers. Entries beyond a long are cut to the largest or smallest long."""
    return F.transform(F.col(column), lambda c: F.floor(c.cast("double") * SCALE))


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of equal length as rows of a matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)


# Moments of the fit list


def _ranges(batches: Batches) -> Batches:
    low = high = None
    for rows in batches:
        if rows.num_rows:
            x = matrix(rows.column("x"))
            low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
            high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
    if low is not None:
        yield batch(dim=longs(np.arange(len(low))), low=longs(low), high=longs(high))


def planes(x: np.ndarray, low: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """The bit planes of all dimensions, one below the other: 64 rows of ``x`` in a word."""
    shifted = x.astype(np.uint64) - low.astype(np.uint64)
    of = np.repeat(np.arange(len(bits)), bits)
    place = np.arange(len(of)) - np.repeat(np.cumsum(bits) - bits, bits)
    flags = ((shifted[:, of] >> place.astype(np.uint64)) & np.uint64(1)).astype(np.uint8).T
    wide = np.zeros((len(of), -(-len(x) // 64) * 64), np.uint8)
    wide[:, : len(x)] = flags
    return np.packbits(wide, axis=1, bitorder="little").view(np.uint64)


def _shared_bits(sliced: np.ndarray, counts: np.ndarray) -> None:
    """Add to ``counts`` the bits that each pair of planes shares (upper triangle)."""
    for i in range(len(sliced)):
        counts[i, i:] += np.bitwise_count(sliced[i:] & sliced[i]).sum(axis=1, dtype=np.int64)


def _scatter(batches: Batches, low: np.ndarray, bits: np.ndarray) -> Batches:
    """One task's cross-products of shifted dimensions, as (i, j, high, low part), and with j = -1
    their sums. The sum of a dimension is found from its planes' shares with themselves."""
    counts, n = np.zeros((bits.sum(), bits.sum()), np.int64), 0
    for rows in batches:
        for start in range(0, rows.num_rows, CHUNK):
            part = matrix(rows.column("x").slice(start, CHUNK))
            _shared_bits(planes(part, low, bits), counts)
            n += len(part)
    if not n:
        return
    counts += np.triu(counts, 1).T
    edges = np.concatenate([[0], np.cumsum(bits)])
    out = []
    for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        out.append((i, -1, sum(int(counts[p, p]) << int(p - a) for p in range(a, b))))
        for j, (c, d) in enumerate(zip(edges[: i + 1], edges[1 : i + 2])):
            block = counts[a:b, c:d]
            # All pairs of planes with one power of two stand on one anti-diagonal.
            total = sum(int(np.trace(block[:, ::-1], (d - c - 1) - k)) << k for k in range(max(b - a + d - c - 1, 0)))
            out.append((i, j, total))
    yield batch(
        i=longs(np.array([o[0] for o in out])),
        j=longs(np.array([o[1] for o in out])),
        upper=pa.array([str(o[2] >> _SPLIT) for o in out], pa.string()).cast(pa.decimal128(38, 0)),
        lower=longs(np.array([o[2] & ((1 << _SPLIT) - 1) for o in out], np.int64)),
    )


@dataclass
class Whitening:
    """``n`` vectors of the fit list with sums ``sums``; eigenvalues by falling size, eigenvectors
    as columns, both for the components asked for; ``trace`` is the sum of all eigenvalues."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float | None = None

    @property
    def dims(self) -> int:
        return len(self.sums)

    def explained(self) -> list[float | None]:
        return [float(e) / self.trace if self.trace > 0 else None for e in self.values]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, from n * x - S where that fits in a long."""
        most = max(abs(int(x.min())), abs(int(x.max()))) if x.size else 0
        if self.n * most + max(map(abs, self.sums), default=0) < 1 << 63:
            return (self.n * x - np.array(self.sums, np.int64)) / self.n
        return x - np.array([s / self.n for s in self.sums])

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened components; a component without variance is NaN."""
        real = self.values > NOTHING * self.trace
        scale = np.sqrt(np.where(real, self.values, 1))
        return np.where(real, self.centred(x) @ self.vectors / scale, np.nan)

    def deviations(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums over dimensions of (n * x - S)**2, modulo 2**64, and which of them fit in a long."""
        mask = (1 << 64) - 1
        sums = np.array([s & mask for s in self.sums], np.uint64)
        apart = x.astype(np.uint64) * np.uint64(self.n & mask) - sums
        about = ((self.n * x.astype(float) - np.array([float(s) for s in self.sums])) ** 2).sum(axis=1)
        return (apart * apart).sum(axis=1, dtype=np.uint64).view(np.int64), about < 9.2e18


def _identity(batches: Batches, model: Whitening) -> Batches:
    """One task's sums of products of whitened components, and with j = -1 their sums."""
    k = len(model.values)
    products, sums, n = np.zeros((k, k)), np.zeros(k), 0
    for rows in batches:
        if rows.num_rows:
            w = model.project(matrix(rows.column("x")))
            products += w.T @ w
            sums += w.sum(axis=0)
            n += len(w)
    if n:
        i, j = np.triu_indices(k)
        yield batch(
            i=longs(np.concatenate([i, np.arange(k)])),
            j=longs(np.concatenate([j, np.full(k, -1)])),
            value=pa.array(np.concatenate([products[i, j], sums])),
        )


def _identity_error(listed: DataFrame, model: Whitening) -> float | None:
    """The largest entry, by size, of the whitened fit list's covariance minus the identity."""
    real = model.values > NOTHING * model.trace
    if not real.any():
        return None
    parts = map_batches(listed, partial(_identity, model=model), "i long, j long, value double")
    found = {(r.i, r.j): r.value for r in parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()}
    means = {i: v / model.n for (i, j), v in found.items() if j < 0}
    worst = [
        abs(v / model.n - means[i] * means[j] - (i == j)) for (i, j), v in found.items() if j >= 0 and real[i] and real[j]
    ]
    return float(max(worst))


def _usual_length(vectors: DataFrame) -> int:
    sizes = vectors.groupBy(F.size("x").alias("size")).count().filter("size > 0")
    first = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return first["size"] if first else 0


def fit(rows: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Moments, eigenvalues and eigenvectors of the distinct vectors of ``column`` in whole numbers.

    Vectors that are null, empty, or hold a null or non-finite entry are left out, and so are those
    that have not the commonest length (of two, the longer). None where nothing is left.
    """
    vectors = rows.filter(usable(column)).select(whole(column).alias("x"))
    dims = _usual_length(vectors)
    if not dims:
        return None
    listed = materialize(vectors.filter(F.size("x") == dims).distinct(), "fit_list")
    n = listed.count()
    ranges = map_batches(listed, _ranges, "dim long, low long, high long")
    ranges = ranges.groupBy("dim").agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()
    low, bits = np.zeros(dims, np.int64), np.zeros(dims, np.int64)
    for r in ranges:
        low[r.dim], bits[r.dim] = r.low, (r.high - r.low).bit_length()
    scatter = partial(_scatter, low=low, bits=bits)
    parts = map_batches(listed, scatter, "i long, j long, upper decimal(38,0), lower long")
    totals = parts.groupBy("i", "j").agg(F.sum("upper").alias("upper"), F.sum("lower").alias("lower")).collect()
    found = {(r.i, r.j): (int(r.upper) << _SPLIT) + r.lower for r in totals}
    shifted = [found[i, -1] for i in range(dims)]
    covariance = np.empty((dims, dims))
    for i in range(dims):
        for j in range(i + 1):
            covariance[i, j] = covariance[j, i] = (n * found[i, j] - shifted[i] * shifted[j]) / (n * n)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    vectors = vectors[:, order]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))] < 0, -1.0, 1.0)
    sums = [s + n * int(l) for s, l in zip(shifted, low)]
    model = Whitening(n, sums, np.maximum(values[order], 0), vectors, float(np.trace(covariance)))
    model.identity_error = _identity_error(listed, model)
    return model


def _whitened(batches: Batches, model: Whitening, names: list[str]) -> Batches:
    for rows in batches:
        x = matrix(rows.column(rows.num_columns - 1)) if rows.num_rows else np.empty((0, model.dims), np.int64)
        w = model.project(x).ravel()
        deviation, fits = model.deviations(x)
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(model.values)), pa.array(w, mask=np.isnan(w))
        )
        columns = [*rows.columns[:-1], pa.array(deviation, mask=~fits), lists]
        yield pa.RecordBatch.from_arrays(columns, names)


def whiten(rows: DataFrame, model: Whitening | None, column: str = "embedding") -> DataFrame:
    """``rows`` without ``column`` that the model covers, with ``deviation`` (sum over dimensions of
    (n * x - S)**2; null where that is beyond a long) and ``whitened`` (a list, by component; null
    for a component without variance). Rows that ``fit`` leaves out go. Input columns called
    ``deviation`` or ``whitened`` are replaced. Repeated rows and ids stay; without a model there
    are no rows."""
    kept = [c for c in rows.columns if c not in (column, "deviation", "whitened")]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema], "deviation bigint, whitened array<double>"])
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    x = unused("x", kept)
    vectors = rows.filter(usable(column)).select(*[F.col(f"`{c}`") for c in kept], whole(column).alias(x))
    vectors = vectors.filter(F.size(x) == model.dims)
    return map_batches(vectors, partial(_whitened, model=model, names=[*kept, "deviation", "whitened"]), schema)


def component_rows(whitened: DataFrame, model: Whitening | None, key: str = "vec_id") -> DataFrame:
    """One row for each row and component: key, component (from 1), n, deviation, whitened,
    explained (part of the trace; null if that is 0), identity_error."""
    explained = F.array(*[F.lit(e).cast("double") for e in (model.explained() if model else [])]).cast("array<double>")
    exploded = whitened.select(key, "deviation", F.posexplode("whitened").alias("at", "value"))
    return exploded.select(
        key,
        (F.col("at") + 1).alias("component"),
        F.lit(model.n if model else None).cast("long").alias("n"),
        "deviation",
        F.col("value").alias("whitened"),
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(model.identity_error if model else None).cast("double").alias("identity_error"),
    )
