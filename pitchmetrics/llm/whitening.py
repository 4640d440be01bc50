"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Entries become integers x = floor(scale * c) (an offset that all entries share would cancel
wherever x is centred, so none is added).  The fit list is each distinct x vector once.
Sums S and the number n of the fit list are exact integers; every pass over it centres first,
as (n * x - S) / n with an exact numerator, and multiplies then.

The leading eigenvectors of the covariance V are found without forming V.  A pass returns
V Q for a block Q of a few columns.  A few Lanczos steps bound the spectrum from below; then,
round by round, a Chebyshev polynomial of V that is small between that bound and the
smallest Ritz value of the block (three-term recurrence, one pass a degree) damps the
unwanted part, the block is made orthonormal by QR, and Rayleigh-Ritz gives eigenvalues,
vectors and residuals |V q - e q|.  It ends once all wanted residuals are certified under
``tolerance`` times the largest eigenvalue; what is broadcast and what comes back are
matrices of vector length x block.  Sums of a pass are aggregated by Spark, never collected
by task.

Defined cases: rows whose vector is null or holds null or non-finite entries are dropped, as
are empty vectors and vectors with entries of 2^31 or more in size, which do not fit the
integer arithmetic; vectors of different lengths are tables of their own, each with its n,
S and components; components whose eigenvalue is zero (up to 1e-12 of the largest) cannot be
whitened and have no rows, so a table of one distinct vector gives none; a deviation that
does not fit a long is null; repeated rows get the same values each; a null key is kept; an
empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

#: entries of a block of the fit list
BLOCK_ENTRIES = 1_000_000
_LIMIT = 2.0 ** 31


@dataclass
class Model:
    """The fit of the vectors of one length."""

    n: int
    sums: np.ndarray        # longs
    values: np.ndarray      # eigenvalues, falling
    vectors: np.ndarray     # a column each
    trace: float
    residual: float         # the largest certified |V q - e q| / the largest eigenvalue
    passes: int
    identity_error: float = 0.0

    @property
    def map(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def quantised(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(key, dim, width, x): the valid vectors as little-endian integers of ``width`` bytes,
    the least of 2, 4 and 8 that holds them, so that equal vectors are equal bytes."""
    rows = df.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"))
    schema = T.StructType([T.StructField("key", rows.schema["key"].dataType), T.StructField("dim", T.IntegerType()),
                           T.StructField("width", T.IntegerType()), T.StructField("x", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null entries: NaN
            end = np.cumsum(size)
            bad = np.concatenate([[0], np.cumsum(~(np.abs(flat) < _LIMIT))])
            good = np.flatnonzero((size > 0) & (bad[end] == bad[end - size]))
            most = np.zeros(len(size))
            x = np.floor(scale * np.where(np.abs(flat) < _LIMIT, flat, 0.0)).astype(np.int64)
            if len(good):
                most[size > 0] = np.maximum.reduceat(np.abs(x), (end - size)[size > 0])
            width = np.where(most < 2 ** 15, 2, np.where(most < 2 ** 31, 4, 8))
            for w in np.unique(width[good]):
                own = good[width[good] == w]
                raw = [x[e - s:e].astype(f"<i{w}").tobytes() for s, e in zip(size[own], end[own], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(own)), pa.array(size[own].astype(np.int32)),
                     pa.array(np.full(len(own), w, np.int32)), pa.array(raw, pa.binary())], schema.names)

    return rows.mapInArrow(run, schema)


def fit_list(rows: DataFrame) -> DataFrame:
    """(dim, width, n, data): each distinct vector of ``quantised`` rows once, in blocks."""
    schema = T.StructType([T.StructField("dim", T.IntegerType()), T.StructField("width", T.IntegerType()),
                           T.StructField("n", T.LongType()), T.StructField("data", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, widths = (batch.column(i).to_numpy() for i in (0, 1))
            out = []
            for dim, w in sorted(set(zip(dims.tolist(), widths.tolist(), strict=True))):
                own = np.flatnonzero((dims == dim) & (widths == w))
                per = max(1, BLOCK_ENTRIES // dim)
                for at in range(0, len(own), per):
                    part = batch.column(2).take(pa.array(own[at:at + per]))
                    out.append((dim, w, len(part), b"".join(part.to_pylist())))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in
                                              enumerate((pa.int32(), pa.int32(), pa.int64(), pa.binary()))], schema.names)

    return rows.select("dim", "width", "x").distinct().mapInArrow(run, schema)


def _summed(blocks: DataFrame, dim: int, value: Callable[[np.ndarray], np.ndarray], kind: type = float) -> np.ndarray:
    """The sum over the blocks of vectors of length ``dim`` of ``value`` of their integers, a
    small matrix: added up in each task, then cell by cell by Spark."""
    rows, columns = value(np.zeros((0, dim), np.int64)).shape
    arrow, spark = (pa.int64(), "bigint") if kind is int else (pa.float64(), "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for w, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                x = np.frombuffer(data.as_buffer(), f"<i{w}").reshape(-1, dim).astype(np.int64)
                total = value(x) if total is None else total + value(x)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(rows * columns, dtype=np.int32)), pa.array(np.ravel(total), arrow)], ["cell", "v"])

    parts = blocks.filter(F.col("dim") == dim).select("width", "data").mapInArrow(run, f"cell int, v {spark}")
    cells = parts.groupBy("cell").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(rows * columns, np.int64 if kind is int else np.float64)
    out[cells.column(0).to_numpy()] = cells.column(1).to_numpy()
    return out.reshape(rows, columns)


def _below(product: Callable[[np.ndarray], np.ndarray], dim: int, steps: int, rng: np.random.Generator) -> float:
    """A lower bound of the spectrum as ``steps`` of Lanczos see it: the least Ritz value
    less its residual."""
    q = rng.standard_normal(dim)
    basis, alpha, beta = [q / np.linalg.norm(q)], [], []
    for _ in range(steps):
        w = product(basis[-1][:, None])[:, 0]
        alpha.append(w @ basis[-1])
        for _ in range(2):
            b = np.array(basis).T
            w = w - b @ (b.T @ w)
        beta.append(np.linalg.norm(w))
        if beta[-1] <= 1e-12 * abs(alpha[0]):
            break
        basis.append(w / beta[-1])
    ritz, s = np.linalg.eigh(np.diag(alpha) + np.diag(beta[:len(alpha) - 1], 1) + np.diag(beta[:len(alpha) - 1], -1))
    return max(0.0, ritz[0] - abs(beta[-1] * s[-1, 0]))


def _filtered(product: Callable[[np.ndarray], np.ndarray], q: np.ndarray, low: float, high: float, top: float) -> np.ndarray:
    """A Chebyshev polynomial of V on ``q``, small on [low, high], scaled to 1 at ``top``;
    its degree keeps the growth up to ``top`` under e^18, so that no column drowns."""
    half, mid = (high - low) / 2, (high + low) / 2
    degree = int(np.clip(18 / np.arccosh(max((top - mid) / half, 1.0001)), 2, 20))
    first = sigma = half / (top - mid)
    before, y = q, (product(q) - mid * q) * (sigma / half)
    for _ in range(degree - 1):
        new = 1 / (2 / first - sigma)
        before, y = y, (product(y) - mid * y) * (2 * new / half) - (sigma * new) * before
        sigma = new
    return y


def fit(blocks: DataFrame, dim: int, components: int = 16, block: int | None = None, tolerance: float = 1e-14,
        lanczos: int = 12, rounds: int = 60, seed: int = 0) -> Model:
    """The leading ``components`` of the vectors of length ``dim``; the subspace has ``block``
    columns (three times the components).  Raises if ``rounds`` end without a certificate of
    at least 1e-9; in between, it ends where rounding lets residuals fall no further."""
    n = int(blocks.filter(F.col("dim") == dim).agg(F.sum("n")).first()[0])
    sums = _summed(blocks, dim, lambda x: x.sum(0)[:, None], int)[:, 0]

    def centred(x: np.ndarray) -> np.ndarray:
        return (n * x - sums) / n

    passes = 0

    def product(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1
        return _summed(blocks, dim, lambda x: (c := centred(x)).T @ (c @ q)) / n

    trace = float(_summed(blocks, dim, lambda x: np.array([[np.square(centred(x)).sum()]]))[0, 0]) / n
    wanted, width = min(components, dim), min(dim, block or 3 * components)
    if trace == 0:
        return Model(n, sums, np.zeros(0), np.zeros((dim, 0)), 0.0, 0.0, passes)
    rng = np.random.default_rng(seed)
    low = _below(product, dim, min(lanczos, dim), rng) if width < dim else 0.0
    q = np.linalg.qr(rng.standard_normal((dim, width)))[0]
    seen = [np.inf, np.inf]
    for _ in range(rounds):
        vq = product(q)
        h = q.T @ vq
        ritz, turn = np.linalg.eigh((h + h.T) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        residual = float(np.linalg.norm(vq - q * ritz, axis=0)[:wanted].max() / ritz[0])
        if residual <= tolerance or width == dim or (residual < 1e-11 and residual > 0.3 * seen[-2]):
            break
        seen.append(residual)
        if ritz[-1] <= low:  # what lies under the bound was let through: the bound was too high
            low = max(0.0, 0.5 * ritz[-1])
        y = _filtered(product, q, low, max(ritz[-1], low + 1e-9 * ritz[0]), ritz[0])
        q = np.linalg.qr(y / np.maximum(np.linalg.norm(y, axis=0), 1e-300))[0]
    if residual > 1e-9:
        raise RuntimeError(f"eigenvectors not certified: residual {residual}")
    there = np.flatnonzero(ritz[:wanted] > 1e-12 * ritz[0])
    model = Model(n, sums, ritz[there], q[:, there], trace, residual, passes)
    # the covariance of the whitened fit list, and its mean in the last row
    k, w = len(there), model.map
    z = _summed(blocks, dim, lambda x: np.vstack([(z := centred(x) @ w).T @ z, z.sum(0)[None, :]])) / n
    model.identity_error = float(np.abs(z[:k] - np.outer(z[k], z[k]) - np.eye(k)).max())
    return model


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 16, scale: int = 64,
           **settings) -> DataFrame:
    """Per valid row and component: key, component, n, deviation, whitened, explained,
    identity_error, eigenvalue and residual.  ``settings``: arguments of :func:`fit`."""
    rows = quantised(df, key, vector, scale)
    blocks = stored(fit_list(rows), "fit_list")
    models = {r.dim: fit(blocks, r.dim, components, **settings) for r in blocks.select("dim").distinct().collect()}
    schema = T.StructType([T.StructField(key, rows.schema["key"].dataType), T.StructField("component", T.IntegerType()),
                           T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
                           T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType()),
                           T.StructField("eigenvalue", T.DoubleType()), T.StructField("residual", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, widths = (batch.column(i).to_numpy() for i in (1, 2))
            for dim, w in sorted(set(zip(dims.tolist(), widths.tolist(), strict=True))):
                m, own = models[dim], np.flatnonzero((dims == dim) & (widths == w))
                k = len(m.values)
                x = np.frombuffer(b"".join(batch.column(3).take(pa.array(own)).to_pylist()), f"<i{w}").reshape(-1, dim).astype(np.int64)
                d = m.n * x - m.sums
                fits = np.square(d.astype(np.float64)).sum(1) < 2.0 ** 62.9
                deviation = np.square(d).sum(1)
                z = (d / m.n) @ m.map

                def each(v: np.ndarray) -> pa.Array:
                    return pa.array(np.tile(v, len(own)))

                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.repeat(own, k))), each(np.arange(1, k + 1, dtype=np.int32)),
                     pa.array(np.full(len(own) * k, m.n, np.int64)), pa.array(np.repeat(deviation, k), mask=np.repeat(~fits, k)),
                     pa.array(z.ravel()), each(m.values / m.trace), pa.array(np.full(len(own) * k, m.identity_error)),
                     each(m.values), pa.array(np.full(len(own) * k, m.residual))], schema.names)

    return rows.mapInArrow(run, schema)
