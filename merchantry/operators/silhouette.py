"""Euclidean silhouettes of several clusterings of the same rows, from sums of distances over the nodes of a k-d tree.

The silhouette of a row compares its mean distance to its own cluster with that to the nearest other one, so it needs the sum of its distances to all rows of every cluster. Rows are dealt to the leaves of a k-d tree. For
a leaf of rows and a tree node away from it, a node's share of all these sums is an expansion in its moments (count, first to third moments about its middle, for every cluster of every clustering). The remainder of this third-order Taylor series of |x|
is at most r**4 / (8 d**3) for a node that reaches r from its middle and keeps a distance d. A node stands for its rows when that is at most ``error`` / 2 of d; otherwise its halves are looked at, and a leaf that is too
near is met by ``distances.Sums``, which halves both leaves further inside the task. So each mean is right to a share of ``error`` / 2 and each silhouette to about ``error``.

Leaves are large, about ``BLOCKS`` of them, because the rows of a leaf are sent to each leaf near to it: that is each row about 2 ``BLOCKS`` times at most, however many rows there are. A task reads them leaf by leaf in a stream and
holds two leaves at a time.

Equal rows are one row with a weight from the start, so no leaf grows beyond ``leaf`` rows. Pairs of leaves and nodes are found level by level with joins; nothing but means reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchantry.operators.distances import Sums

#: Leaves of rows, give or take a factor of two.
BLOCKS = 32
#: Rows of a leaf at least.
LEAST_LEAF = 2048

Store = Callable[[str, DataFrame], DataFrame]


def _box(dim: int) -> list[Column]:
    return [f(f"x{j}").alias(f"{n}{j}") for j in range(dim) for n, f in (("lo", F.min), ("hi", F.max))]


def tree(points: DataFrame, dim: int, leaf: int, store: Store) -> tuple[DataFrame, DataFrame]:
    """(points with their leaf ``node``, every node with its box, count and whether it is a leaf). Node n has the halves 2n and 2n + 1; the root is 1.

    A node is halved at about the median of its widest side, or at the middle of it where half of its rows or more lie at its upper end.
    """
    rows = points.withColumn("node", F.lit(1).cast("long"))
    nodes, level = None, 0
    while True:
        open_ = rows if nodes is None else rows.filter(F.col("node") >= 1 << level)
        mid = [F.percentile_approx(f"x{j}", 0.5, 1000).alias(f"m{j}") for j in range(dim)]
        found = open_.groupBy("node").agg(F.count("*").alias("n"), *_box(dim), *mid)
        widest = F.greatest(*[F.struct((F.col(f"hi{j}") - F.col(f"lo{j}")).alias("w"), F.lit(j).alias("j"), F.col(f"lo{j}").alias("lo"), F.col(f"hi{j}").alias("hi"), F.col(f"m{j}").alias("m")) for j in range(dim)])
        cut = F.when(F.col("s.m") < F.col("s.hi"), F.col("s.m")).otherwise((F.col("s.lo") + F.col("s.hi")) / 2)
        found = found.withColumn("s", widest).withColumn("leaf", (F.col("n") <= leaf) | (F.col("s.w") == 0) | (cut >= F.col("s.hi")))
        found = store(f"tree-{level}", found.select("node", "n", "leaf", *[f"{a}{j}" for j in range(dim) for a in ("lo", "hi")], F.col("s.j").alias("side"), cut.alias("cut")))
        nodes = found if nodes is None else nodes.unionByName(found)
        halves = found.filter("NOT leaf").select("node", "side", "cut")
        if halves.isEmpty():
            return rows, nodes.drop("side", "cut")
        at = F.element_at(F.array(*[F.col(f"x{j}") for j in range(dim)]), F.col("side") + 1)
        moved = rows.join(halves, "node", "left").withColumn("node", F.when(F.col("side").isNull(), F.col("node")).otherwise(2 * F.col("node") + (at > F.col("cut")).cast("long")))
        level += 1
        rows = store(f"tree-rows-{level}", moved.drop("side", "cut"))


def _powers(dim: int) -> list[tuple[int, ...]]:
    """Index lists of the moments up to the third."""
    each = range(dim)
    return [(), *((i,) for i in each), *((i, j) for i in each for j in each), *((i, j, k) for i in each for j in each for k in each)]


def _matrix(table: pa.Table, names: Sequence[str]) -> np.ndarray:
    return np.stack([table.column(n).to_numpy() for n in names], axis=1)


def _labels(table: pa.Table, offsets: np.ndarray) -> np.ndarray:
    """The clusters of each row in one numbering over all clusterings."""
    return table.column("c").combine_chunks().flatten().to_numpy().reshape(table.num_rows, len(offsets)) + offsets


def _kinds(labels: np.ndarray, offsets: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """(a row of 0 and 1 over all clusters for each kind of row, the kind of each row); rows of a kind are in the same clusters."""
    widths = np.diff([*offsets, total])
    if np.prod(widths.astype(float)) < 2.0**62:
        code = (labels - offsets) @ np.cumprod([1, *widths[:-1]])
        _, first, kind = np.unique(code, return_index=True, return_inverse=True)
    else:
        _, first, kind = np.unique(labels, axis=0, return_index=True, return_inverse=True)
    values = np.zeros((len(first), total))
    values[np.arange(len(first))[:, None], labels[first]] = 1
    return values, kind.reshape(-1)


def moments(rows: DataFrame, nodes: DataFrame, wanted: DataFrame, dim: int, groups: Sequence[int], leaf: int) -> DataFrame:
    """(node, middle, v) of the wanted nodes: sums over a node's rows of the products of ``_powers`` about the middle of its box, for every cluster of every clustering.

    ``groups``: clusters of each clustering. A large node is summed in shares of about ``leaf`` rows, and these are added up in streams.
    """
    offsets = np.cumsum([0, *groups])[:-1]
    powers, total = _powers(dim), sum(groups)
    xs, mids = [f"x{j}" for j in range(dim)], [f"mid{j}" for j in range(dim)]
    middle = [((F.col(f"lo{j}") + F.col(f"hi{j}")) / 2).alias(f"mid{j}") for j in range(dim)]
    some = nodes.join(wanted, "node", "left_semi").select("node", F.ceil(F.col("n") / leaf).cast("int").alias("shares"), *middle)
    # A node's rows are those of the leaves below it: its number is a leaf's without the last binary digits.
    above = F.transform(F.sequence(F.lit(0), F.floor(F.log2("node")).cast("int")), lambda k: F.call_function("shiftright", F.col("node"), k))
    near = rows.select(*xs, "c", "w", F.explode(above).alias("node")).join(some, "node")
    near = near.withColumn("share", F.pmod(F.xxhash64(*xs), F.col("shares")))

    def sums(table: pa.Table) -> pa.Table:
        x = _matrix(table, xs) - _matrix(table, mids)
        w = table.column("w").to_numpy()
        basis = np.stack([w * np.prod(x[:, list(p)], axis=1) for p in powers], axis=1)
        out = np.zeros((total, len(powers)))
        np.add.at(out, _labels(table, offsets), basis[:, None])
        first = table.slice(0, 1)
        return pa.table({"node": first.column("node"), "middle": pa.array(_matrix(first, mids).tolist()), "v": pa.array([out.reshape(-1).tolist()])})

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[int, tuple[list, np.ndarray]] = {}
        for batch in batches:
            for node, middle, v in zip(batch.column("node").to_pylist(), batch.column("middle").to_pylist(), batch.column("v"), strict=True):
                have[node] = (middle, have[node][1] + v.values.to_numpy() if node in have else v.values.to_numpy())
        for node, (middle, v) in have.items():
            yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([middle]), pa.array([v.tolist()])], ["node", "middle", "v"])

    kind = "node long, middle array<double>, v array<double>"
    return near.groupBy("node", "share").applyInArrow(sums, kind).repartition("node").mapInArrow(added, kind)


def _gap(dim: int) -> Column:
    """The smallest distance between the query leaf's box and the node's middle."""
    parts = []
    for j in range(dim):
        middle = (F.col(f"lo{j}") + F.col(f"hi{j}")) / 2
        away = F.greatest(F.col(f"qlo{j}") - middle, middle - F.col(f"qhi{j}"), F.lit(0.0))
        parts.append(away * away)
    return F.sqrt(sum(parts[1:], parts[0]))


def _reach(dim: int) -> Column:
    """Half the diagonal of the node's box."""
    parts = [(F.col(f"hi{j}") - F.col(f"lo{j}")) * (F.col(f"hi{j}") - F.col(f"lo{j}")) for j in range(dim)]
    return F.sqrt(sum(parts[1:], parts[0])) / 2


def meetings(nodes: DataFrame, dim: int, error: float, store: Store) -> tuple[DataFrame, DataFrame]:
    """(query, node) pairs that are far, where the node's moments do, and those that are near: leaves whose rows are met one by one. Each query leaf meets every row once."""
    box = [f"{a}{j}" for j in range(dim) for a in ("lo", "hi")]
    queries = nodes.filter("leaf").select(F.col("node").alias("query"), *[F.col(b).alias(f"q{b}") for b in box])
    frontier = store("silhouette-pairs-0", queries.select("query", F.lit(1).cast("long").alias("node")))
    far = near = None
    level = 0
    while not frontier.isEmpty():
        pairs = frontier.join(nodes.select("node", "leaf", *box), "node").join(queries, "query")
        d, r = _gap(dim) - _reach(dim), _reach(dim)
        # r**4 / (8 d**3) is at most error / 2 of d.
        fits = (r == 0) | ((d > 0) & (r * r * r * r <= 4 * error * d * d * d * d))
        judged = store(f"silhouette-judged-{level}", pairs.select("query", "node", "leaf", fits.alias("far")))
        here_far, here_near = judged.filter("far").select("query", "node"), judged.filter("NOT far AND leaf").select("query", "node")
        far = here_far if far is None else far.unionByName(here_far)
        near = here_near if near is None else near.unionByName(here_near)
        level += 1
        halves = F.explode(F.array(2 * F.col("node"), 2 * F.col("node") + 1)).alias("node")
        frontier = store(f"silhouette-pairs-{level}", judged.filter("NOT far AND NOT leaf").select("query", halves))
    return far, near


def silhouettes(rows: DataFrame, columns: Sequence[str], clusters: Column, groups: Sequence[int], *, error: float = 1e-6, leaf: int | None = None, store: Store) -> list[float]:
    """The mean silhouette of each clustering.

    ``clusters``: an array with the row's cluster in each clustering, numbered from 0 and below that clustering's entry of ``groups``. A row alone in its cluster counts 0, as do all rows of a clustering of one
    cluster. Rows with a null take no part; without rows there is nothing, so every mean is NaN.
    """
    dim = len(columns)
    xs = [f"x{j}" for j in range(dim)]
    points = rows.select(*[F.col(c).cast("double").alias(x) for c, x in zip(columns, xs, strict=True)], clusters.alias("c")).dropna(subset=xs)
    points = store("silhouette-points", points.groupBy(*xs, "c").agg(F.count("*").cast("double").alias("w")))
    offsets, total = np.cumsum([0, *groups])[:-1], sum(groups)
    sizes = np.zeros(total)
    counted = points.select(F.posexplode("c").alias("g", "cluster"), "w").groupBy("g", "cluster").agg(F.sum("w").alias("w"))
    for r in counted.collect():
        sizes[offsets[r["g"]] + r["cluster"]] = r["w"]
    if not sizes.any():
        return [float("nan")] * len(groups)
    leaf = leaf or max(LEAST_LEAF, -(-points.count() // BLOCKS))
    placed, nodes = tree(points, dim, leaf, store)
    nodes = store("tree-nodes", nodes)
    far, near = meetings(nodes, dim, error, store)
    far = store("silhouette-far", far)
    known = store("silhouette-moments", moments(placed, nodes, far.select("node").distinct(), dim, groups, leaf))
    # A leaf's own rows come first, then those of the leaves near to it.
    mine = placed.select(F.col("node").alias("query"), F.lit(-1).cast("long").alias("node"), *xs, "c", "w")
    met = near.join(placed.select("node", *xs, "c", "w"), "node").select("query", "node", *xs, "c", "w")
    seen = known.join(far, "node").select("query", "middle", "v")
    n_powers = len(_powers(dim))

    def near_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The leaves' rows with their sums over the leaves near to them."""
        rows: pa.Table | None = None
        sums: Sums | None = None
        for node, table in _runs(batches):
            x, w = _matrix(table, xs), table.column("w").to_numpy()
            if node < 0:
                if rows is not None:
                    yield from _with_sums(rows, sums)
                rows, sums = table, Sums(x, total, error / 2)
                continue
            sums.add(x, *_kinds(_labels(table, offsets), offsets, total), w)
        if rows is not None:
            yield from _with_sums(rows, sums)

    def expanded(key, left: pa.Table, right: pa.Table) -> pa.Table:
        sums = np.stack(left.column("sums").to_numpy())
        if right.num_rows:
            for i in range(0, right.num_rows, 64):
                part = right.slice(i, 64)
                v = np.stack(part.column("v").to_numpy()).reshape(part.num_rows, total, n_powers)
                off = _matrix(left, xs)[:, None] - np.stack(part.column("middle").to_numpy())[None]
                sums += np.einsum("qnp,ntp->qt", _basis(off), v, optimize=True)
        scores = _scores(sums, _labels(left, offsets), offsets, sizes)
        w = left.column("w").to_numpy()
        return pa.table({"g": pa.array(np.arange(len(groups))), "s": pa.array(w @ scores), "w": pa.array(np.full(len(groups), w.sum()))})

    kind = ", ".join(["query long", *[f"{x} double" for x in xs], "c array<int>", "w double", "sums array<double>"])
    # A stated number of partitions: these are few bytes and much work, so they aren't merged.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def dealt(df: DataFrame):
        return df.repartition(tasks, "query").groupBy("query")

    # Leaves are about equal work, so they are dealt out in turn; by hash some tasks get several.
    turn = F.dense_rank().over(Window.orderBy("query")) - 1
    turns = F.broadcast(nodes.filter("leaf").select(F.col("node").alias("query")).withColumn("turn", turn.cast("int")))
    each = mine.unionByName(met).join(turns, "query")
    stream = each.repartitionById(tasks, F.col("turn") % tasks).drop("turn").sortWithinPartitions("query", "node")
    direct = stream.mapInArrow(near_sums, kind)
    parts = dealt(direct).cogroup(dealt(seen)).applyInArrow(expanded, "g long, s double, w double")
    means = {r["g"]: r["s"] for r in parts.groupBy("g").agg((F.sum("s") / F.sum("w")).alias("s")).collect()}
    return [float(means[g]) for g in range(len(groups))]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """(node, its rows) for each run of rows equal in query and node."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = np.stack([batch.column(n).to_numpy() for n in ("query", "node")], axis=1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(keys)], strict=True):
            if start == end:
                continue
            if last is not None and tuple(keys[start]) != last:
                yield last[1], pa.Table.from_batches(held)
                held = []
            last = tuple(keys[start])
            held.append(batch.slice(start, end - start))
    if held:
        yield last[1], pa.Table.from_batches(held)


def _with_sums(rows: pa.Table, sums: Sums) -> Iterator[pa.RecordBatch]:
    found = sums.totals()
    flat = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]), pa.array(found.reshape(-1)))
    yield from rows.drop_columns(["node"]).append_column("sums", flat).to_batches(max_chunksize=2048)


def _basis(off: np.ndarray) -> np.ndarray:
    """The factors of a node's moments in the sum of distances from a row ``off`` away from its middle: (rows, nodes, moments)."""
    dim = off.shape[2]
    d = np.sqrt((off * off).sum(axis=2))
    with np.errstate(divide="ignore", invalid="ignore"):
        u = np.where(d[..., None] > 0, off / d[..., None], 0.0)
        inverse = np.where(d > 0, 1 / d, 0.0)
    out = [d, *(-u[..., i] for i in range(dim))]
    for i in range(dim):
        for j in range(dim):
            out.append(((i == j) - u[..., i] * u[..., j]) * inverse / 2)
    for i in range(dim):
        for j in range(dim):
            for k in range(dim):
                out.append(u[..., i] * ((j == k) - u[..., j] * u[..., k]) * inverse * inverse / 2)
    return np.stack(out, axis=2)


def _scores(sums: np.ndarray, own: np.ndarray, offsets: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The silhouette of each row in each clustering."""
    ends = [*offsets[1:], len(sizes)]
    out = np.zeros(own.shape)
    at = np.arange(len(sums))
    for g, (low, high) in enumerate(zip(offsets, ends, strict=True)):
        mine = own[:, g]
        a = sums[at, mine] / np.maximum(sizes[mine] - 1, 1)
        means = np.where(sizes[low:high] > 0, sums[:, low:high] / np.maximum(sizes[low:high], 1), np.inf)
        means[at, mine - low] = np.inf
        b = means.min(axis=1)
        most = np.maximum(a, b)
        with np.errstate(invalid="ignore", divide="ignore"):
            s = np.where(np.isfinite(b) & (most > 0) & (sizes[mine] > 1), (b - a) / most, 0.0)
        out[:, g] = s
    return out
