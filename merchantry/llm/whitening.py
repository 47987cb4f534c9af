"""Whitening of embeddings on their largest principal components.

Each entry c of a vector becomes the whole number x = floor(64 c) + 1000000. The fit list holds each distinct x vector once. Its size, sums and centred covariance are sums of partial sums of tasks: the number and the sums in
whole numbers, the products in double precision after centring. The covariance, of one row and column per dimension, is all that the driver gets. Its largest eigenpairs come from contour integration (:mod:`feast`).
A last pass over the fit list measures the covariance of the whitened values themselves.

Equal vectors meet by combining before the shuffle, so a vector that a third of all rows share is no hot key. Partial products are added up row by row of the matrix in as many tasks as it has rows, each holding sums only.

Defined cases: rows whose vector is null or empty or holds null or non-finite entries are left out; vectors of each length are a list of their own, with its own components; a null identity stays null; repeated rows are
returned each and count once in the fit; entries beyond 2**60 / 64 count as that; components whose eigenvalue isn't above 1e-11 of the largest one have no scale to divide by and are left out, so a list of one distinct vector gives
no rows; a deviation beyond a long is null; vectors of more than ``max_dim`` entries are refused; an empty table gives an empty result; other columns are left behind.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchantry.llm import feast
from merchantry.llm.common import discard, stored

LARGE = float(1 << 60)
FITS = 1 << 62


class Fit(NamedTuple):
    """Of one vector length: the number of distinct vectors, their sums, the eigenvalues and unit vectors, and the trace of the covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & fine


def whole(vector: Column) -> Column:
    """The vector's entries as whole numbers."""
    clipped = lambda c: F.greatest(F.least(c * 64.0, F.lit(LARGE)), F.lit(-LARGE))
    return F.transform(vector, lambda c: F.floor(clipped(c)).cast("long") + F.lit(1000000).cast("long"))


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """(length, rows, x as a matrix) of a batch with a column x."""
    sizes = np.diff(batch.column("x").offsets.to_numpy())
    for d in np.unique(sizes).tolist():
        mine = batch.filter(pa.array(sizes == d))
        yield d, mine, mine.column("x").flatten().to_numpy().reshape(-1, d)


def off_mean(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S exactly: as 64-bit numbers where they hold it, as Python's otherwise."""
    bound = int(np.abs(x).max(initial=0)) * n + max(map(abs, sums), default=0)
    if bound < FITS:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def deviations(off: np.ndarray) -> list[int | None]:
    """The exact sum of squares of each row; None beyond a long."""
    most = int(np.abs(off).max(initial=0))
    if most * most * off.shape[1] < FITS:
        return (off * off).sum(axis=1).tolist()
    exact = off.astype(object)
    return [v if v < 1 << 63 else None for v in (exact * exact).sum(axis=1).tolist()]


def counted(fit: DataFrame, max_dim: int) -> dict[int, tuple[int, list[int]]]:
    """Length -> number of vectors and their sums."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, _, x in by_length(batch):
                fits = int(np.abs(x).max(initial=0)) * len(x) < FITS
                sums = [Decimal(int(s)) for s in (x if fits else x.astype(object)).sum(axis=0)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d], pa.int32()), pa.array([len(x)], pa.int64()), pa.array([sums], pa.list_(pa.decimal128(38, 0)))], ["dim", "n", "s"]
                )

    parts = fit.mapInArrow(local, "dim int, n long, s array<decimal(38,0)>").select("dim", "n", F.posexplode("s").alias("at", "s"))
    out: dict[int, tuple[int, list[int]]] = {}
    for r in parts.groupBy("dim", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("dim", "at").toLocalIterator():
        if r["dim"] > max_dim:
            raise ValueError(f"vectors of {r['dim']} entries; {max_dim} is the most whose covariance the driver takes")
        out.setdefault(r["dim"], (r["n"], []))[1].append(int(r["s"]))
    return out


def product_sums(fit: DataFrame, ready: Callable[[int, np.ndarray], np.ndarray | None]) -> dict[int, np.ndarray]:
    """Length -> the sum of y'y over the fit list; ``ready`` gives the rows y of vectors of a length."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, _, x in by_length(batch):
                y = ready(d, x)
                if y is not None and y.shape[1]:
                    sums[d] = sums.get(d, 0) + y.T @ y
        for d, total in sums.items():
            yield rows(d, range(len(total)), list(total))

    def rows(d: int, at, values: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([d] * len(values), pa.int32()), pa.array(list(at), pa.int32()), pa.array([v.tolist() for v in values], pa.list_(pa.float64()))], ["dim", "at", "v"]
        )

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for d, at, v in zip(batch.column("dim").to_pylist(), batch.column("at").to_pylist(), batch.column("v"), strict=True):
                sums[d, at] = sums.get((d, at), 0) + v.values.to_numpy()
        for (d, at), v in sums.items():
            yield rows(d, [at], [v])

    kind = "dim int, at int, v array<double>"
    out: dict[int, dict[int, list[float]]] = {}
    for r in fit.mapInArrow(local, kind).repartition("dim", "at").mapInArrow(added, kind).toLocalIterator():
        out.setdefault(r["dim"], {})[r["at"]] = r["v"]
    return {d: np.array([m[i] for i in range(len(m))]) for d, m in out.items()}


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return off_mean(x, n, sums).astype(np.float64) / n


def fitted(fit: DataFrame, k: int, max_dim: int) -> dict[int, Fit]:
    """The fit of each length."""
    known = counted(fit, max_dim)
    covariances = product_sums(fit, lambda d, x: _centred(x, *known[d]))
    out = {}
    for d, (n, sums) in known.items():
        v = covariances[d] / n
        v = (v + v.T) / 2
        values, vectors = feast.largest(v, k)
        real = values > 1e-11 * values.max(initial=0)
        out[d] = Fit(n, sums, values[real], vectors[:, real], float(np.trace(v)))
    return out


def whitened(rows: DataFrame, *, identity: str = "vec_id", vector: str = "embedding", k: int = 16, max_dim: int = 2048) -> DataFrame:
    """(identity, component, n, deviation, whitened, explained, identity_error): a row for each usable vector and component."""
    v = F.col(vector).cast("array<double>")
    mine = rows.select(F.col(identity).alias("id"), v.alias("v")).filter(usable(F.col("v"))).select("id", whole(F.col("v")).alias("x"))
    fit = stored(mine.select("x").distinct(), "white-fit")
    fits = fitted(fit, k, max_dim)

    def projected(d: int, x: np.ndarray) -> np.ndarray:
        f = fits[d]
        return _centred(x, f.n, f.sums) @ f.vectors / np.sqrt(f.values)

    spread = product_sums(fit, projected)
    errors = {d: float(np.abs(spread[d] / fits[d].n - np.eye(len(spread[d]))).max()) for d in spread}
    discard(fit)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, part, x in by_length(batch):
                f = fits[d]
                m = len(f.values)
                if not m:
                    continue
                at = pa.array(np.repeat(np.arange(len(x)), m))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id").take(at), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(x))), pa.array(np.full(len(at), f.n)),
                        pa.array(deviations(off_mean(x, f.n, f.sums)), pa.int64()).take(at), pa.array(projected(d, x).reshape(-1)), pa.array(np.tile(f.values / f.trace, len(x))),
                        pa.array(np.full(len(at), errors[d])),
                    ],
                    [identity, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    kind = mine.schema["id"].dataType.simpleString()
    return mine.mapInArrow(local, f"`{identity}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
