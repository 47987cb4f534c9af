"""Descriptive statistics."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from merchantry.functions import columns as C
from merchantry.operators.ordered import quantiles


def _pairs(columns: Sequence[str]) -> Column:
    return F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])


def describe(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per numeric column."""
    stats = (
        df.select(F.inline(_pairs(columns)))
        .groupBy("column")
        .agg(
            F.count("value").alias("Count"),
            C.rounded(F.avg("value"), digits).alias("Mean"),
            C.rounded(F.stddev_samp("value"), digits).alias("Std"),
            F.min("value").alias("Min"),
            F.max("value").alias("Max"),
        )
    )
    q = quantiles(df, columns, [0.25, 0.5, 0.75])
    return stats.join(q, "column").select(
        F.col("column").alias("Column"),
        "Count",
        "Mean",
        "Std",
        "Min",
        C.rounded("q0", digits).alias("P25"),
        C.rounded("q1", digits).alias("P50"),
        C.rounded("q2", digits).alias("P75"),
        "Max",
    )


def value_counts(df: DataFrame, column: str, digits: int = 6) -> DataFrame:
    """Frequency and share of each non-null value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("Count"))
    return with_share(counts, "Count", "Percent", digits)


def with_share(df: DataFrame, column: str, name: str, digits: int = 6, total: Column | None = None) -> DataFrame:
    """Percentage of the column's total, which a scalar subquery supplies."""
    if total is None:
        total = df.agg(F.sum(column).alias("t")).scalar()
    return df.withColumn(name, C.rounded(C.ratio(F.col(column).cast("double") * 100, total), digits))


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between the minimum and the maximum; the last bin is closed. Empty bins are kept."""
    x = F.col(column).cast("double")
    ends = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi")).alias("e")).scalar()
    width = (ends["hi"] - ends["lo"]) / bins
    slot = F.when(width == 0, F.lit(0)).otherwise(F.least(F.floor((x - ends["lo"]) / width), F.lit(bins - 1)))
    counts = df.filter(x.isNotNull()).groupBy(slot.cast("int").alias("Bin")).agg(F.count("*").alias("Count"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("Bin"))
    return frame.join(F.broadcast(counts), "Bin", "left").select("Bin", F.coalesce("Count", F.lit(0)).alias("Count"))


def correlations(df: DataFrame, columns: Sequence[str], complete: bool = True, digits: int = 6) -> DataFrame:
    """Pearson correlation of every column pair below the diagonal, in one pass.
    ``complete`` drops rows with any null first; otherwise each pair uses its own complete rows."""
    numbers = df.select([F.col(c).cast("double").alias(c) for c in columns])
    if complete:
        numbers = numbers.dropna()
    entries = [
        F.struct(F.lit(b).alias("ColumnA"), F.lit(a).alias("ColumnB"), C.rounded(F.corr(a, b), digits).alias("R"))
        for a, b in combinations(columns, 2)
    ]
    return numbers.agg(F.array(*entries).alias("e")).select(F.inline("e"))


def cross_tab(df: DataFrame, row: str, column: str, values: Sequence, prefix: str) -> DataFrame:
    """Counts of row x column with missing cells as zero; the column values are given, so no extra pass runs."""
    cells = [F.sum((F.col(column) == v).cast("int")).alias(f"{prefix}{v}") for v in values]
    return df.filter(F.col(row).isNotNull() & F.col(column).isNotNull()).groupBy(row).agg(*cells).fillna(0)


def ranges(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct count, minimum and maximum as text per column, combined per column before the final merge."""
    entries = F.array(*[F.struct(F.lit(c).alias("Column"), F.col(c).cast("string").alias("value")) for c in columns])
    values = df.select(F.inline(entries)).groupBy("Column", "value").agg(F.lit(1).alias("one"))
    return values.groupBy("Column").agg(
        F.count("value").alias("DistinctValues"), F.min("value").alias("MinText"), F.max("value").alias("MaxText")
    )


def percent_change(df: DataFrame, order: str, column: str, name: str, digits: int = 6) -> DataFrame:
    """Change against the previous period in percent; the frame has one row per period."""
    before = F.lag(column).over(W.orderBy(order)).cast("double")
    change = (C.ratio(column, before) - 1) * 100
    return df.withColumn(name, C.rounded(change, digits))


def word_frequencies(df: DataFrame, column: str, stop_words: DataFrame | None = None, top: int = 150) -> DataFrame:
    """Most frequent words of whole texts. Counts combine inside each task before the shuffle."""
    words = df.select(F.explode(F.split(F.lower(column), r"[^\p{L}\p{N}_']+")).alias("Word")).filter(F.col("Word") != "")
    counts = words.groupBy("Word").agg(F.count("*").alias("Count"))
    if stop_words is not None:
        counts = counts.join(stop_words.select("Word").distinct(), "Word", "left_anti")
    return counts.orderBy(F.desc("Count"), "Word").limit(top)


def vector_class_mean(df: DataFrame, digits: int = 6) -> DataFrame:
    """Mean element value per class: element sums per row, then one small grouping."""
    total = F.aggregate("features", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return (
        df.select("label", total.alias("_sum"), F.size("features").alias("_size"))
        .groupBy("label")
        .agg(F.count("*").alias("Vectors"), C.rounded(C.ratio(F.sum("_sum"), F.sum("_size")), digits).alias("MeanValue"))
    )
