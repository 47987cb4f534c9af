"""Cleaning of staged retail lines and reviews."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchantry import constants as K
from merchantry.functions import columns as C
from merchantry.operators.ordered import exact_quantiles, quantiles

BUSINESS_KEY = ("Invoice", "StockCode", "CustomerID", "Quantity", "Price")


def valid_sales(df: DataFrame) -> DataFrame:
    """Lines with a customer, a positive quantity and price, and no cancelled invoice."""
    return df.filter(
        F.col("Customer ID").isNotNull()
        & ~C.is_cancelled("Invoice")
        & (F.col("Quantity") > 0)
        & (F.col("Price") > 0)
    )


def dedupe_business_key(df: DataFrame) -> DataFrame:
    """One row per business key.

    Maxima of texts are aggregated by sorting. Lines are sent by their key first, so each is sorted once, in a partition's share, and not also before the shuffle in whatever share of a file a task reads.
    """
    return df.repartition(*BUSINESS_KEY).groupBy(*BUSINESS_KEY).agg(
        F.max(F.upper("Description")).alias("Description"),
        F.max("InvoiceDate").alias("InvoiceDate"),
        F.max("Country").alias("Country"),
    )


def add_calendar(df: DataFrame, ts: str = "InvoiceDate") -> DataFrame:
    t = F.col(ts)
    return df.withColumns(
        {
            "Year": F.year(t),
            "Month": F.month(t),
            "DayOfWeek": F.date_format(t, "EEEE"),
            "Hour": F.hour(t),
            "IsWeekend": C.is_weekend(t),
            "Quarter": F.quarter(t),
        }
    )


def clean_retail(
    staging: DataFrame,
    rules: Sequence[tuple[str, str]] = tuple(K.CATEGORY_RULES),
    money: str = "decimal(10,2)",
    dedupe: str = "business_key",
) -> DataFrame:
    """Filter, normalise keys, drop duplicates, then derive price, calendar and category columns."""
    lines = valid_sales(staging).select(
        C.normalise_key("Invoice").alias("Invoice"),
        C.normalise_key("StockCode").alias("StockCode"),
        "Description",
        "Quantity",
        "InvoiceDate",
        "Price",
        F.col("Customer ID").cast("long").alias("CustomerID"),
        "Country",
    )
    if dedupe not in ("business_key", "full_row"):
        raise ValueError(f"unknown way to drop duplicates: {dedupe}")
    lines = dedupe_business_key(lines) if dedupe == "business_key" else lines.dropDuplicates()
    lines = lines.withColumns(
        {
            "Description": F.coalesce(F.upper(F.trim("Description")), F.lit("UNKNOWN")),
            "TotalPrice": (F.col("Quantity") * F.col("Price")).cast(money),
            "InvoiceDay": F.to_date("InvoiceDate"),
        }
    )
    return add_calendar(lines).withColumn("ProductCategory", C.first_match("Description", rules, K.DEFAULT_CATEGORY))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """How many rows repeat an earlier row in full."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("Rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("DuplicateRows"),
    )


def cancellation_report(staging: DataFrame) -> DataFrame:
    flag = C.is_cancelled("Invoice").cast("int")
    return staging.agg(
        F.count("*").alias("TotalLines"),
        F.sum(flag).alias("CancelledLines"),
        C.rounded(C.ratio(F.sum(flag) * 100, F.count("*")), 6).alias("CancelledPercent"),
    )


def iqr_filter(df: DataFrame, column: str, factor: float = 1.5) -> DataFrame:
    """Keep rows within ``factor`` inter-quartile ranges of the quartiles, bounds included."""
    q = exact_quantiles(df, {"q1": (column, 0.25), "q3": (column, 0.75)})
    if q["q1"] is None:
        return df
    spread = (q["q3"] - q["q1"]) * factor
    return df.filter(F.col(column).cast("double").between(q["q1"] - spread, q["q3"] + spread))


def clip_limits(columns: Sequence[str], low: float = 0.01, high: float = 0.99) -> dict[str, tuple[str, float]]:
    """The quantiles that ``winsorise`` needs, by name."""
    return {f"{c}_lo": (c, low) for c in columns} | {f"{c}_hi": (c, high) for c in columns}


def winsorise(
    df: DataFrame, columns: Sequence[str], low: float = 0.01, high: float = 0.99, limits: dict | None = None
) -> DataFrame:
    """Clip each column to its own quantiles; ``limits`` may bring the figures of ``clip_limits``."""
    q = exact_quantiles(df, clip_limits(columns, low, high)) if limits is None else limits
    return df.withColumns({c: C.clip(F.col(c).cast("double"), q[f"{c}_lo"], q[f"{c}_hi"]) for c in columns})


def winsorised_counts(df: DataFrame, columns: Sequence[str], low: float = 0.01, high: float = 0.99) -> DataFrame:
    """Bounds and number of values outside them, one row per column."""
    q = quantiles(df, columns, [low, high])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    values = df.select(F.inline(pairs))
    outside = (F.col("value") < F.col("q0")) | (F.col("value") > F.col("q1"))
    # one row of bounds per column is broadcast
    return (
        values.join(F.broadcast(q), "column")
        .groupBy("column", "q0", "q1")
        .agg(F.sum(outside.cast("int")).alias("Outside"))
        .select("column", F.col("q0").alias("Lower"), F.col("q1").alias("Upper"), "Outside")
    )


def fill_with_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    q = exact_quantiles(df, {c: (c, 0.5) for c in columns})
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(q[c])) for c in columns})


def normalise_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().replace(" ", "_") for c in df.columns])


def drop_if_present(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def find_column(df: DataFrame, *patterns: str) -> str | None:
    """First column whose name holds every word of a pattern; patterns are tried in order."""
    for pattern in patterns:
        words = re.split(r"\s+", pattern.lower())
        for name in df.columns:
            if all(w in name.lower() for w in words):
                return name
    return None


def standard_review_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def clean_reviews(
    staging: DataFrame,
    classes: dict = K.IMAGE_CLASSES,
    length_mode: str = "spaces",
) -> DataFrame:
    """Reviews with text, defaults for missing labels, review length and image class."""
    df = drop_if_present(staging, "Unnamed: 0")
    df = df.filter(F.trim("ReviewText") != "").withColumn("ReviewText", F.lower(F.trim("ReviewText")))
    df = df.withColumns(
        {
            "Title": C.text_or("Title", "Unknown"),
            "DivisionName": F.coalesce("DivisionName", F.lit("Unknown")),
            "DepartmentName": F.coalesce("DepartmentName", F.lit("Unknown")),
            "ClassName": F.coalesce("ClassName", F.lit("Unknown")),
        }
    )
    return df.withColumns(
        {
            "ReviewLength": C.word_count("ReviewText", length_mode),
            "CNN_Matched_Class": C.lookup("ClassName", classes, K.DEFAULT_IMAGE_CLASS),
        }
    )


def fill_defaults(df: DataFrame, text: str = "Unknown") -> DataFrame:
    """Text nulls become ``text``, numeric nulls the column median."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    numbers = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    filled = df.fillna(text, subset=texts) if texts else df
    return fill_with_median(filled, numbers) if numbers else filled


def numeric(df: DataFrame, *names: str) -> DataFrame:
    """Coerce to numbers; what does not parse becomes null."""
    return df.withColumns({n: F.col(n).try_cast("double") for n in names})


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Up to ``n`` rows in a repeatable random order."""
    digest: Column = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    return df.orderBy(digest, key).limit(n)
