"""Churn data set: enrichment, derived features, selection, splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchantry import constants as K
from merchantry.functions import columns as C
from merchantry.operators.clean import clip_limits, winsorise
from merchantry.operators.ordered import exact_quantiles
from merchantry.operators.segment import standardise

WINSORISED = ("Monetary", "Frequency", "UniqueProducts", "AvgPricePerItem")


def enrich(customers: DataFrame, behaviour: DataFrame) -> DataFrame:
    """Customer data set with behavioural columns; missing behaviour counts as zero, unlabelled rows drop."""
    extra = [c for c in behaviour.columns if c != "CustomerID"]
    return customers.join(behaviour, "CustomerID", "left").fillna(0, subset=extra).dropna(subset=["ChurnLabel"])


DERIVE_LIMITS = {"m50": ("Monetary", 0.5), "m25": ("Monetary", 0.25), "f50": ("Frequency", 0.5)}


def derive(df: DataFrame, limits: dict | None = None) -> DataFrame:
    """Fifteen derived columns. The limits are quantiles of the values before any clipping."""
    limit = exact_quantiles(df, DERIVE_LIMITS) if limits is None else limits
    m, f = F.col("Monetary").cast("double"), F.col("Frequency").cast("double")
    u, days = F.col("UniqueProducts").cast("double"), F.col("CustomerLifespanDays").cast("double")
    flag = lambda c: c.cast("int")
    return df.withColumns(
        {
            "MonetaryPerProduct": m / (u + 1),
            "HighValue": flag(m > limit["m50"]),
            "IsOneTimeBuyer": flag(f == 1),
            "LowSpender": flag(m < limit["m25"]),
            "OrdersPerLifespan": f / (days + 1),
            "AvgDaysBetweenOrders": (days + 1) / (f + 1),
            "MonetaryPerLifespan": m / (days + 1),
            "LogLifespan": F.log1p(days),
            "LogMonetary": F.log1p(m),
            "LogFrequency": F.log1p(f),
            "MonetaryFrequencyRatio": m / (f + 1),
            "FrequencyPerProduct": f / (u + 1),
            "FrequencySquared": f * f,
            "HighFrequencyHighValue": flag((f > limit["f50"]) & (m > limit["m50"])),
            "SpendingConsistency": F.col("SpendingStdDev") / (m / (f + 1) + 1),
        }
    )


def churn_features(customers: DataFrame, behaviour: DataFrame, limit_digits: int | None = None) -> DataFrame:
    """Enriched, derived, then clipped to the 1st and 99th percentile. All quantiles come from one call;
    ``limit_digits`` rounds them."""
    rows = enrich(customers, behaviour)
    wanted = DERIVE_LIMITS | clip_limits(WINSORISED)
    limits = exact_quantiles(customers.dropna(subset=["ChurnLabel"]), wanted, digits=limit_digits)
    return winsorise(derive(rows, limits), WINSORISED, limits=limits)


def encode_labels(df: DataFrame, column: str, most: int = 1000) -> DataFrame:
    """Number the values of a text column in alphabetical order, null as 'Unknown'.

    The sorted list of values becomes a literal; a column with more than ``most`` of them is refused."""
    value = F.coalesce(column, F.lit("Unknown"))
    names = sorted(r["v"] for r in df.select(value.alias("v")).distinct().limit(most + 1).collect())
    if len(names) > most:
        raise ValueError(f"{column} has more than {most} values")
    return df.withColumn(column, (C.rank_in(value, names) - 1).cast("int"))


def feature_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in K.CHURN_EXCLUDED]


def model_table(features: DataFrame) -> tuple[DataFrame, list[str]]:
    """(CustomerID, label, numeric features) with the region encoded and gaps as zero."""
    encoded = encode_labels(features, "Region")
    names = [
        c for c in feature_columns(encoded) if isinstance(encoded.schema[c].dataType, (T.NumericType, T.BooleanType))
    ]
    table = encoded.select(
        "CustomerID",
        F.col("ChurnLabel").cast("double").alias("label"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in names],
    )
    return table, names


def with_split(df: DataFrame, key: str = "CustomerID", train: float = 0.68, validation: float = 0.12, seed: int = 42) -> DataFrame:
    """Repeatable train / validation / test split by hash of the key, so every class keeps its ratio in expectation
    and no shuffle is needed."""
    x = C.hash_fraction(key, seed)
    return df.withColumn(
        "split", F.when(x < train, "train").when(x < train + validation, "validation").otherwise("test")
    )


def with_fold(df: DataFrame, key: str = "CustomerID", folds: int = 5, seed: int = 7) -> DataFrame:
    return df.withColumn("fold", F.floor(C.hash_fraction(key, seed) * folds).cast("int"))


def class_weights(df: DataFrame, label: str = "label", name: str = "weight") -> DataFrame:
    """Balanced weights n / (classes x n_class)."""
    sizes = df.groupBy(label).agg(F.count("*").alias("_n"))
    total = sizes.agg(F.sum("_n").alias("t"), F.count("*").alias("c"))
    scale = total.select(C.ratio("t", "c").alias("s")).scalar()
    weighted = sizes.select(label, (scale / F.col("_n")).alias(name))
    # one row per class is broadcast
    return df.join(F.broadcast(weighted), label)


def scaled_splits(table: DataFrame, names: Sequence[str], seed: int = 42) -> DataFrame:
    """Splits with features scaled by the training part only."""
    cut = with_split(table, seed=seed)
    return standardise(cut, names, fit_on=cut.filter("split = 'train'"))


def split_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("split", "label").agg(F.count("*").alias("Rows"))
