"""Recency, frequency, monetary features per customer and the customer dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchantry.functions import columns as C
from merchantry.operators.ordered import quantiles


def reference_date(clean: DataFrame) -> Column:
    """The day after the last sale, as a scalar subquery."""
    return clean.agg(F.date_add(F.max("InvoiceDay"), 1).alias("d")).scalar()


def rfm_table(clean: DataFrame, rule: str = "tiered", round_to: int | None = 2) -> DataFrame:
    grouped = clean.groupBy("CustomerID").agg(
        F.max("InvoiceDay").alias("_last"),
        F.countDistinct("Invoice").alias("Frequency"),
        F.sum("TotalPrice").alias("Monetary"),
        F.min("InvoiceDay").alias("JoinDate"),
    )
    rfm = grouped.select(
        "CustomerID",
        F.datediff(reference_date(clean), "_last").alias("Recency"),
        "Frequency",
        "Monetary",
        "JoinDate",
        C.rounded(C.ratio("Monetary", "Frequency"), round_to).alias("AvgOrderValue"),
    )
    return rfm.withColumn("ChurnLabel", C.churn_label(rule))


def rfm_elapsed(clean: DataFrame) -> DataFrame:
    """Variant on time stamps: whole days between the last line and one day after the last sale."""
    last = clean.agg(F.max("InvoiceDate").alias("t")).scalar()
    grouped = clean.groupBy("CustomerID").agg(
        F.max("InvoiceDate").alias("_last"),
        F.countDistinct("Invoice").alias("Frequency"),
        F.sum("TotalPrice").alias("Monetary"),
    )
    seconds = F.unix_timestamp(last) + 86400 - F.unix_timestamp("_last")
    return grouped.select(
        "CustomerID", F.floor(seconds / 86400).cast("int").alias("Recency"), "Frequency", "Monetary"
    ).withColumn("ChurnLabel", C.churn_label("recency90"))


def churn_summary(rfm: DataFrame) -> DataFrame:
    return rfm.agg(
        F.sum("ChurnLabel").alias("Churned"),
        F.sum(1 - F.col("ChurnLabel")).alias("Active"),
        C.rounded(C.ratio(F.sum("ChurnLabel") * 100, F.count("*")), 6).alias("ChurnRatePercent"),
    )


def most_frequent(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Most frequent value per key, ties to the smallest value. Both steps combine before their shuffle."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v")))
    return counts.groupBy(key).agg(best.alias("_b")).select(key, F.col("_b.v").alias(name))


def modal_country(clean: DataFrame) -> DataFrame:
    return most_frequent(clean, "CustomerID", "Country", "Country")


def favourite_product(clean: DataFrame) -> DataFrame:
    return most_frequent(clean, "CustomerID", "Description", "FavoriteProduct")


def tenure_features(clean: DataFrame) -> DataFrame:
    """Two distinct counts in one grouping would send every line three times, so countries are counted from the distinct (customer, country) pairs, which combine before the shuffle."""
    dated = clean.groupBy("CustomerID").agg(
        F.min("InvoiceDay").alias("FirstPurchase"),
        F.max("InvoiceDay").alias("LastPurchase"),
        F.sum("Quantity").alias("TotalItems"),
        F.countDistinct("StockCode").alias("UniqueProducts"),
    )
    pairs = clean.select(F.col("CustomerID").alias("_c"), "Country").distinct()
    countries = pairs.groupBy("_c").agg(F.count("Country").alias("UniqueCountries"))
    # a null customer is a group like any other
    grouped = dated.join(countries, F.col("CustomerID").eqNullSafe(F.col("_c"))).drop("_c")
    return grouped.withColumns(
        {
            "DaysSinceFirstPurchase": F.datediff(reference_date(clean), "FirstPurchase"),
            "CustomerLifespan": F.datediff("LastPurchase", "FirstPurchase"),
        }
    )


def customer_features(clean: DataFrame, round_to: int | None = 2) -> DataFrame:
    """One row per customer: features, tenure, favourite product and country."""
    base = rfm_table(clean, rule="recency90", round_to=round_to).drop("JoinDate")
    tenure = tenure_features(clean).select(
        "CustomerID", "TotalItems", "UniqueProducts", "DaysSinceFirstPurchase", "CustomerLifespan"
    )
    return (
        base.join(tenure, "CustomerID")
        .join(favourite_product(clean), "CustomerID", "left")
        .join(modal_country(clean), "CustomerID", "left")
    )


def dim_customer(rfm: DataFrame, country: DataFrame) -> DataFrame:
    return rfm.join(country, "CustomerID", "left").select(
        "CustomerID",
        "Country",
        F.lit("Unknown").alias("AgeGroup"),
        "JoinDate",
        "Recency",
        "Frequency",
        "Monetary",
        "AvgOrderValue",
        F.lit(None).cast("string").alias("RFM_Segment"),
        "ChurnLabel",
    )


def rfm_by_churn(rfm: DataFrame, digits: int = 6) -> DataFrame:
    """Mean, minimum, median and maximum of each feature per churn class."""
    names = ["Recency", "Frequency", "Monetary"]
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in names])
    stats = (
        rfm.select("ChurnLabel", F.inline(pairs))
        .groupBy("ChurnLabel", "column")
        .agg(
            C.rounded(F.avg("value"), digits).alias("Mean"),
            F.min("value").alias("Min"),
            F.max("value").alias("Max"),
        )
    )
    medians = quantiles(rfm, names, [0.5], by=["ChurnLabel"]).withColumnRenamed("q0", "Median")
    return stats.join(medians, ["ChurnLabel", "column"]).select(
        "ChurnLabel", F.col("column").alias("Feature"), "Mean", "Min", C.rounded("Median", digits).alias("Median"), "Max"
    )
