"""Global order without a one-task sort: running totals, exact quantiles and dense keys.

Running totals cut the values into ranges at approximate quantiles: the totals of the ranges (at most a thousand
rows) give each range its starting offset, and a window inside the range does the rest. Quantiles narrow the
interval around the wanted rank. Any cut points give exact results; good ones only balance the work.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from merchantry.functions.frames import literal_rows

# A range should hold about this many values; there are never more than MAX_RANGES of them.
RANGE_ROWS = 50_000
MAX_RANGES = 1024


#: Keys that grouped operators here may have: one row of figures per key goes through the driver.
MAX_KEYS = 1000


def few_rows(df: DataFrame) -> list:
    """The rows of a small table; more than MAX_KEYS are refused."""
    rows = df.limit(MAX_KEYS + 1).collect()
    if len(rows) > MAX_KEYS:
        raise ValueError(f"more than {MAX_KEYS} keys")
    return rows


def _survey(df: DataFrame, value: str, totals: Sequence[str], by: Sequence[str]) -> list:
    """Per key: number of rows, totals and approximate cut points. A few rows of numbers reach the driver, and
    because they become literals a recomputed task sees the very same ranges."""
    probs = [i / MAX_RANGES for i in range(1, MAX_RANGES)]
    return few_rows(
        df.groupBy(*by).agg(
            F.count("*").alias("_rows"),
            *[F.sum(t).alias(f"_sum_{t}") for t in totals],
            F.percentile_approx(F.col(value).cast("double"), probs, MAX_RANGES * 4).alias("_cuts"),
        )
    )


def _literal_rows(df: DataFrame, by: Sequence[str], rows: list, name: str, kind: str) -> DataFrame:
    fields = [(b, df.schema[b].dataType.simpleString()) for b in by] + [(name, kind)]
    return F.broadcast(literal_rows(df.sparkSession, fields, rows))


def _with_range(df: DataFrame, value: str, by: Sequence[str], survey: list, range_rows: int) -> DataFrame:
    """Add ``_range``; each key gets as many ranges as its number of values calls for."""
    rows = []
    for r in survey:
        wanted = min(MAX_RANGES, -(-r["_rows"] // range_rows))
        cuts = [r["_cuts"][i * MAX_RANGES // wanted - 1] for i in range(1, wanted)] if wanted > 1 else []
        rows.append(tuple(r[b] for b in by) + (sorted(set(cuts)),))
    x = F.col(value).cast("double")
    if by:
        cut = df.join(_literal_rows(df, by, rows, "_cuts", "array<double>"), list(by))
    else:
        cut = df.withColumn("_cuts", F.array(*[F.lit(c) for c in rows[0][0]]).cast("array<double>"))
    return cut.withColumn("_range", F.size(F.filter("_cuts", lambda e: e < x))).drop("_cuts")


def running_totals(
    df: DataFrame,
    value: str,
    totals: Sequence[str],
    by: Sequence[str] = (),
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Add ``before_<t>``, the sum of ``t`` over all smaller values, and ``all_<t>``, its sum per key.

    ``df`` has one row per (by, value), so group it first. ``by`` must have few distinct, non-null keys.
    """
    by = list(by)
    survey = _survey(df, value, totals, by)
    split = any(r["_rows"] > range_rows for r in survey)
    part = [*by, "_range"] if split else by
    inside = W.partitionBy(*part).orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    out = _with_range(df, value, by, survey, range_rows) if split else df
    if split:
        per_range = out.groupBy(*part).agg(*[F.sum(t).alias(t) for t in totals])
        earlier = W.partitionBy(*by).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
        offsets = per_range.select(
            *part, *[F.coalesce(F.sum(t).over(earlier), F.lit(0)).alias(f"_off_{t}") for t in totals]
        )
        # at most MAX_RANGES rows per key are broadcast
        out = out.join(F.broadcast(offsets), part)
    for t in totals:
        offset = F.col(f"_off_{t}") if split else F.lit(0)
        out = out.withColumn(f"before_{t}", offset + F.coalesce(F.sum(t).over(inside), F.lit(0)))
    for t in totals:
        if by and survey:
            rows = [tuple(r[b] for b in by) + (int(r[f"_sum_{t}"]),) for r in survey]
            out = out.join(_literal_rows(df, by, rows, f"all_{t}", "long"), by)
        else:
            out = out.withColumn(f"all_{t}", F.lit(survey[0][f"_sum_{t}"] if survey else None).cast("long"))
    return out.drop("_range", *[f"_off_{t}" for t in totals])


@dataclass
class _Place:
    """One wanted rank and the open value interval (lo, hi) that is known to hold it."""

    key: tuple
    column: str
    rank: int
    rows: int
    lo: float | None = None
    hi: float | None = None
    below: int = 0
    value: float | None = None

    def inside(self, by: Sequence[str]) -> Column:
        x = F.col(self.column).cast("double")
        cond = x.isNotNull()
        for name, v in zip(by, self.key, strict=True):
            cond &= F.col(name) == F.lit(v)
        if self.lo is not None:
            cond &= x > self.lo
        if self.hi is not None:
            cond &= x < self.hi
        return F.when(cond, x)

    def narrow(self, cuts: tuple[float, float], before: Sequence[int]) -> None:
        """``before``: rows of the interval < c1, <= c1, < c2, <= c2."""
        want = self.rank - self.below
        (c1, c2), (lt1, le1, lt2, le2) = cuts, before
        if want < lt1:
            self.hi, self.rows = c1, lt1
        elif want < le1:
            self.value = c1
        elif want < lt2:
            self.lo, self.hi, self.below, self.rows = c1, c2, self.below + le1, lt2 - le1
        elif want < le2:
            self.value = c2
        else:
            self.lo, self.below, self.rows = c2, self.below + le2, self.rows - le2


SELECT_ROWS = 200_000
MARGIN = 1 / 500


def _select(df: DataFrame, by: Sequence[str], places: list[_Place], select_rows: int) -> None:
    """Find the value at every wanted rank by narrowing.

    Each round scans the data twice and shuffles only sketches and counts: approximate quantiles just below and
    above the rank, then exact counts around them. The interval that holds the rank shrinks some 200-fold per
    round, and a value that fills a large part of the data is recognised by its counts. When at most
    ``select_rows`` rows are left, they are sorted.
    """
    while todo := [p for p in places if p.value is None and p.rows > select_rows]:
        sketches = []
        for p in todo:
            at = (p.rank - p.below) / (p.rows - 1)
            sketches.append(F.percentile_approx(p.inside(by), [max(at - MARGIN, 0.0), min(at + MARGIN, 1.0)], 5000))
        found = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(sketches)]).first()
        counts = []
        for i, p in enumerate(todo):
            x = p.inside(by)
            for j, c in enumerate(found[f"c{i}"]):
                counts.append(F.count(F.when(x < c, 1)).alias(f"lt{i}_{j}"))
                counts.append(F.count(F.when(x <= c, 1)).alias(f"le{i}_{j}"))
        row = df.agg(*counts).first()
        for i, p in enumerate(todo):
            before = [row[f"{op}{i}_{j}"] for j in (0, 1) for op in ("lt", "le")]
            p.narrow(tuple(found[f"c{i}"]), before)
    groups: dict[tuple, list[_Place]] = {}
    for p in places:
        if p.value is None:
            groups.setdefault((p.key, p.column, p.lo, p.hi), []).append(p)
    if groups:
        picks = []
        for i, members in enumerate(groups.values()):
            ordered = F.sort_array(F.collect_list(members[0].inside(by)))
            picks.append(F.transform(F.array(*[F.lit(p.rank - p.below) for p in members]), _at(ordered)).alias(f"v{i}"))
        row = df.agg(*picks).first()
        for i, members in enumerate(groups.values()):
            for p, v in zip(members, row[f"v{i}"], strict=True):
                p.value = v


def _at(values: Column):
    return lambda i: F.get(values, i)


def _quantile_values(
    df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str], select_rows: int
) -> list[tuple]:
    """(key..., column, [quantile per probability]) for every key and column that has values."""
    sizes = df.groupBy(*by).agg(*[F.count(F.col(c).cast("double")).alias(f"_n{i}") for i, c in enumerate(columns)])
    places: dict[tuple, _Place] = {}
    wanted = []
    for row in few_rows(sizes):
        key = tuple(row[b] for b in by)
        for i, c in enumerate(columns):
            n = row[f"_n{i}"]
            if n:
                spots = [(n - 1) * p for p in probs]
                wanted.append((key, c, spots))
                for rank in {f(s) for s in spots for f in (math.floor, math.ceil)}:
                    places[key, c, rank] = _Place(key, c, rank, n)
    _select(df, by, list(places.values()), select_rows)
    out = []
    for key, c, spots in wanted:
        values = []
        for s in spots:
            low, high = places[key, c, math.floor(s)].value, places[key, c, math.ceil(s)].value
            # the same weighting as Spark's own percentile
            values.append(low if low == high else (math.ceil(s) - s) * low + (s - math.floor(s)) * high)
        out.append((*key, c, values))
    return out


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    select_rows: int = SELECT_ROWS,
) -> DataFrame:
    """Exact linear-interpolated quantiles: rows (by, column, q0, q1, ...), nulls left out.
    ``by`` must have few distinct, non-null keys."""
    rows = _quantile_values(df, columns, probs, by, select_rows)
    fields = [(b, df.schema[b].dataType.simpleString()) for b in by] + [("column", "string")]
    fields += [(f"q{i}", "double") for i in range(len(probs))]
    flat = [(*r[:-1], *r[-1]) for r in rows]
    if not flat:
        return df.sparkSession.createDataFrame([], ", ".join(f"`{n}` {k}" for n, k in fields))
    return literal_rows(df.sparkSession, fields, flat)


def exact_quantiles(
    df: DataFrame, wanted: dict[str, tuple[str, float]], select_rows: int = SELECT_ROWS, digits: int | None = None
) -> dict:
    """{name: value} for ``wanted`` = {name: (column, probability)}, like ``DataFrame.approxQuantile`` but exact.
    The figures become literals in later plans. A column without values gives ``None``."""
    columns = sorted({c for c, _ in wanted.values()})
    probs = sorted({p for _, p in wanted.values()})
    found = dict(_quantile_values(df, columns, probs, (), select_rows))
    out = {name: found[c][probs.index(p)] if c in found else None for name, (c, p) in wanted.items()}
    return out if digits is None else {k: None if v is None else round(v, digits) for k, v in out.items()}


def dense_key(df: DataFrame, natural: str, name: str, digits: int = 3) -> DataFrame:
    """Number distinct rows 1..n by hash bucket, then natural key: no global sort and no skew, since the
    keys are distinct. ``digits`` hexadecimal digits give 16**digits buckets."""
    bucketed = df.withColumn("_bucket", F.substring(F.md5(F.col(natural).cast("string")), 1, digits))
    earlier = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy("_bucket")
        .agg(F.count("*").alias("_n"))
        .select("_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    )
    place = F.row_number().over(W.partitionBy("_bucket").orderBy(natural))
    # at most 16**digits rows are broadcast
    numbered = bucketed.join(F.broadcast(offsets), "_bucket")
    return numbered.withColumn(name, (F.col("_offset") + place).cast("long")).drop("_bucket", "_offset")
