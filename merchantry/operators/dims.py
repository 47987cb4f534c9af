"""Dimension tables of the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from merchantry import constants as K
from merchantry.functions import columns as C
from merchantry.operators.ordered import dense_key


def dim_time(clean: DataFrame) -> DataFrame:
    """One row per sales day, numbered in date order. The window sees one row per calendar day."""
    days = clean.select(F.col("InvoiceDay").alias("FullDate")).distinct()
    d = F.col("FullDate")
    return days.select(
        F.row_number().over(W.orderBy("FullDate")).cast("long").alias("TimeID"),
        "FullDate",
        F.dayofmonth(d).alias("Day"),
        F.date_format(d, "EEEE").alias("DayOfWeek"),
        F.month(d).alias("Month"),
        F.date_format(d, "MMMM").alias("MonthName"),
        F.quarter(d).alias("Quarter"),
        F.year(d).alias("Year"),
        C.is_weekend(d).alias("IsWeekend"),
        F.lit(0).alias("IsHoliday"),
    )


def dim_location(clean: DataFrame, regions: DataFrame | None = None) -> DataFrame:
    """One row per country. Without a region table the fixed country lists apply."""
    countries = clean.select("Country").filter(F.col("Country").isNotNull()).distinct()
    if regions is None:
        located = countries.withColumn("Region", C.lookup("Country", K.REGION_COUNTRIES, K.DEFAULT_REGION))
    else:
        located = countries.join(regions.select("Country", "Region"), "Country", "left").withColumn(
            "Region", F.coalesce("Region", F.lit(K.DEFAULT_REGION))
        )
    return located.select(
        F.row_number().over(W.orderBy("Country")).cast("long").alias("LocationID"),
        "Country",
        "Region",
        F.lit("N/A").alias("City"),
    )


def dim_product(
    clean: DataFrame,
    edges: Sequence[float] = K.PRICE_EDGES,
    labels: Sequence[str] = K.PRICE_BANDS,
    round_to: int | None = 2,
) -> DataFrame:
    """One row per stock code. Products can be many, so the keys are numbered per hash bucket.

    A maximum of texts is aggregated by sorting, so lines are first summed in hash tables by code, text and category; only those sums are sorted.
    """
    texts = clean.groupBy("StockCode", "Description", "ProductCategory").agg(F.sum("Price").alias("_p"), F.count("Price").alias("_n"))
    products = texts.groupBy("StockCode").agg(
        F.max("Description").alias("ProductName"),
        F.max("ProductCategory").alias("Category"),
        C.ratio(F.sum("_p"), F.sum("_n")).alias("_avg"),
    )
    return dense_key(products, "StockCode", "ProductID").select(
        "ProductID",
        "StockCode",
        "ProductName",
        "Category",
        F.lit("N/A").alias("SubCategory"),
        C.rounded("_avg", round_to).alias("AvgPrice"),
        F.lit(0.0).alias("AvgRating"),
        F.lit(None).cast("string").alias("ImageCategory"),
        C.band("_avg", edges, labels).alias("PriceRange"),
    )
