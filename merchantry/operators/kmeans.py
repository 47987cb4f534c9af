"""k-means for many numbers of clusters and many starts at once.

All (K, start) runs advance together: one pass over the rows assigns each row to its nearest centre in every run and sums per centre, so an iteration costs one small aggregate however many runs there are. A run that has
settled drops out of later passes. The driver holds centres only, a few hundred short vectors.

Starting centres are the rows of the smallest hashes of (start, key), the same in every engine and after every retry. A centre without rows stays where it is. Ties go to the centre of the smaller number.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import md5
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Distances are compared after rounding to so many digits, so that ties are ties in every engine.
DIGITS = 9
#: Rows whose distances to a run's centres are held at once.
TOGETHER = 4096


class Run(NamedTuple):
    """One run: number of clusters, start, cost and centres."""

    k: int
    start: int
    cost: float
    centres: np.ndarray


def vectors(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One array column ``x``; rows with a null take no part."""
    x = F.array(*[F.col(c).cast("double") for c in columns])
    return rows.select(x.alias("x")).filter(F.forall("x", lambda v: v.isNotNull()))


def starting_rows(rows: DataFrame, columns: Sequence[str], key: str, k: int, starts: Sequence[int]) -> dict[int, np.ndarray]:
    """Start -> its first ``k`` rows by hash; each task sends ``k`` rows a start at most."""
    x = F.array(*[F.col(c).cast("double") for c in columns])
    named = rows.select(F.col(key).cast("string").alias("id"), x.alias("x")).filter(F.forall("x", lambda v: v.isNotNull()))
    starts = tuple(starts)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list] = {s: [] for s in starts}
        for batch in batches:
            ids = batch.column("id").to_pylist()
            for s in starts:
                digests = [md5((str(s) if i is None else f"{s}:{i}").encode()).digest() for i in ids]
                begin = np.frombuffer(b"".join(digests), ">u8")[::2]
                some = np.flatnonzero(begin <= np.partition(begin, k - 1)[k - 1]) if len(ids) > k else range(len(ids))
                kept[s] = sorted(kept[s] + [(digests[i].hex(), ids[i] or "", batch.column("x")[i].as_py()) for i in some])[:k]
        found = [(s, *r) for s in starts for r in kept[s]]
        yield pa.RecordBatch.from_pylist([dict(zip(("start", "hash", "id", "x"), r, strict=True)) for r in found], kind)

    kind = pa.schema([("start", pa.int32()), ("hash", pa.string()), ("id", pa.string()), ("x", pa.list_(pa.float64()))])
    out: dict[int, list] = {s: [] for s in starts}
    for r in sorted(named.mapInArrow(local, "start int, hash string, id string, x array<double>").collect()):
        if len(out[r["start"]]) < k:
            out[r["start"]].append(r["x"])
    return {s: np.array(v) for s, v in out.items()}


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's nearest centre and its squared distance."""
    d = np.zeros((len(x), len(centres)))
    for j in range(x.shape[1]):
        gap = x[:, j, None] - centres[None, :, j]
        d += gap * gap
    at = np.round(d, DIGITS).argmin(axis=1)
    return at, d[np.arange(len(x)), at]


class Places:
    """Rows side by side, to be met with the centres of many runs."""

    def __init__(self, x: np.ndarray) -> None:
        self.x = x
        self.columns = np.concatenate([x.T, np.ones((1, len(x)))])
        self.rows = np.ascontiguousarray(self.columns.T)
        self.squares = (x * x).sum(axis=1)

    def nearest(self, centres: np.ndarray) -> np.ndarray:
        """(centres, rows): whether a centre is the row's nearest, as ``nearest`` has it. One product of matrices; only rows with two centres about as near, which rounding may turn into a tie, are looked at by differences."""
        own = (centres * centres).sum(axis=1)
        d = np.column_stack([-2 * centres, own]) @ self.columns
        near = d <= d.min(axis=0) + (2 * 10.0**-DIGITS + 1e-14 * (self.squares + own.max()))
        if np.count_nonzero(near) > len(self.x):
            some = np.flatnonzero(near.sum(axis=0) > 1)
            near[:, some] = False
            near[nearest(self.x[some], centres)[0], some] = True
        return near


def numbered(rows: DataFrame, columns: Sequence[str], runs: Sequence[np.ndarray]) -> DataFrame:
    """The columns, and in ``c`` the number of the nearest centre of each run; 0 for a row with a null."""
    given = [r.copy() for r in runs]

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in columns], axis=1)
            there = np.flatnonzero(~np.isnan(x).any(axis=1))
            at = np.zeros((len(x), len(given)), np.int32)
            places = Places(x[there])
            for i, centres in enumerate(given if len(there) else ()):
                at[there, i] = places.nearest(centres).argmax(axis=0)
            c = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(given)), pa.array(at.reshape(-1)))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in columns), c], [*columns, "c"])

    return rows.select(*[F.col(n).cast("double").alias(n) for n in columns]).mapInArrow(local, ", ".join([*(f"`{n}` double" for n in columns), "c array<int>"]))


def pass_over(points: DataFrame, runs: Sequence[np.ndarray], priced: int = 0) -> tuple[list[np.ndarray], list[float]]:
    """For each run, the means of the rows nearest to its centres, and for the last ``priced`` runs the sum of squared distances to these centres (0 for the others)."""
    given = [r.copy() for r in runs]
    dim = given[0].shape[1]
    offsets = np.cumsum([0, *(len(r) for r in given)])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost, totals = np.zeros(offsets[-1]), np.zeros((offsets[-1], dim + 1))
        for batch in batches:
            every = batch.column("x").flatten().to_numpy().reshape(-1, dim)
            for x in (every[i : i + TOGETHER] for i in range(0, len(every), TOGETHER)):
                places = Places(x)
                for i, centres in enumerate(given):
                    near = places.nearest(centres)
                    part = slice(offsets[i], offsets[i + 1])
                    totals[part] += near.astype(float) @ places.rows
                    if i >= len(given) - priced:
                        at = near.argmax(axis=0)
                        cost[part] += np.bincount(at, ((x - centres[at]) ** 2).sum(axis=1), len(centres))
        n, sums = np.rint(totals[:, dim]).astype(np.int64), totals[:, :dim]
        some = np.flatnonzero(n)
        columns = [pa.array(some), pa.array(n[some]), pa.array(cost[some]), *(pa.array(sums[some, j]) for j in range(dim))]
        yield pa.RecordBatch.from_arrays(columns, ["slot", "n", "cost", *(f"s{j}" for j in range(dim))])

    kind = "slot long, n long, cost double, " + ", ".join(f"s{j} double" for j in range(dim))
    total = points.mapInArrow(local, kind).groupBy("slot").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), *[F.sum(f"s{j}").alias(f"s{j}") for j in range(dim)])
    after = np.concatenate(given)
    costs = np.zeros(len(after))
    for r in total.collect():
        after[r["slot"]] = [r[f"s{j}"] / r["n"] for j in range(dim)]
        costs[r["slot"]] = r["cost"]
    cut = range(len(given))
    return [after[offsets[i] : offsets[i + 1]] for i in cut], [float(costs[offsets[i] : offsets[i + 1]].sum()) for i in cut]


def fit(
    rows: DataFrame, columns: Sequence[str], ks: Sequence[int], *, key: str = "CustomerID", starts: Sequence[int] = tuple(range(42, 52)), max_iter: int = 300, settled: float = 1e-4
) -> list[Run]:
    """Every run of ``ks`` x ``starts``. A run is settled when its centres' moves, squared and summed, are ``settled`` at most (columns have unit variance); its cost is that of its last centres.

    A start with fewer rows than K takes the rows there are; without rows there are no runs.
    """
    first = starting_rows(rows, columns, key, max(ks), starts)
    points = vectors(rows, columns)
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if points.rdd.getNumPartitions() < cores:  # few rows, which every pass compares with every centre
        points = points.repartition(cores)
    points = points.persist()
    try:
        open_ = {(k, s): c[:k] for s, c in first.items() if len(c) for k in ks}
        done: dict[tuple[int, int], Run] = {}
        ended: dict[tuple[int, int], np.ndarray] = {}
        turn = 0
        while open_ or ended:
            names = [*open_, *ended]
            moved, costs = pass_over(points, [*open_.values(), *ended.values()], len(ended))
            turn += 1
            after, stopped = {}, {}
            for name, new, cost in zip(names, moved, costs, strict=True):
                if name in ended:
                    done[name] = Run(*name, cost, ended[name])
                elif ((new - open_[name]) ** 2).sum() <= settled or turn >= max_iter:
                    stopped[name] = new
                else:
                    after[name] = new
            open_, ended = after, stopped
    finally:
        points.unpersist()
    return [done[k, s] for k in ks for s in starts if (k, s) in done]


def best(runs: Sequence[Run]) -> dict[int, Run]:
    """For each K the run of the lowest cost, of equal ones that of the smallest start."""
    out: dict[int, Run] = {}
    for r in sorted(runs, key=lambda r: (r.k, round(r.cost, 6), r.start)):
        out.setdefault(r.k, r)
    return out
