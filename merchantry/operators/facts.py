"""Fact tables and the per-customer data sets built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchantry.functions import columns as C


def fact_orders(clean: DataFrame, products: DataFrame, days: DataFrame, locations: DataFrame) -> DataFrame:
    """Star load by three inner lookups.

    No join carries a hint. The dimensions are stored tables, so Spark knows their size: the calendar and the
    countries are broadcast, and products are too until they outgrow the threshold. Beyond it the join is
    sort-merge and adaptive execution splits a hot product.
    """
    return (
        clean.join(products.select("ProductID", "StockCode"), "StockCode")
        .join(days.select("TimeID", F.col("FullDate").alias("InvoiceDay")), "InvoiceDay")
        .join(locations.select("LocationID", "Country"), "Country")
        .select(
            C.row_key("Invoice", "StockCode", "CustomerID", "Quantity", "Price").alias("OrderID"),
            F.col("Invoice").alias("InvoiceNo"),
            "CustomerID",
            "ProductID",
            "TimeID",
            "LocationID",
            "Quantity",
            F.col("Price").alias("UnitPrice"),
            "TotalPrice",
            F.lit(0).cast("decimal(5,2)").alias("Discount"),
        )
    )


def fact_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.select(
        "ReviewID",
        "ClothingID",
        "Rating",
        "Title",
        "ReviewText",
        "ReviewLength",
        "Age",
        "DivisionName",
        "DepartmentName",
        "ClassName",
        "CNN_Matched_Class",
        "Recommended",
        "PositiveFeedback",
        F.lit(None).cast("double").alias("SentimentScore"),
    )


def customer_orders(orders: DataFrame, days: DataFrame, variant: str = "weighted", round_to: int | None = 2) -> DataFrame:
    """Order roll-up per customer. ``weighted``: items per order and quantity-weighted price.
    ``line``: plain averages over order lines.

    Two distinct counts in one grouping would send every line three times, so lines are summed per invoice first and products are counted from the distinct (customer, product) pairs.
    """
    dated = orders.join(days.select("TimeID", "FullDate"), "TimeID")
    per_order = dated.groupBy("CustomerID", "InvoiceNo").agg(
        F.sum("Quantity").alias("_q"),
        F.count("Quantity").alias("_nq"),
        F.sum(F.col("Quantity") * F.col("UnitPrice")).alias("_qp"),
        F.sum("UnitPrice").alias("_p"),
        F.count("UnitPrice").alias("_np"),
        F.min("FullDate").alias("_first"),
        F.max("FullDate").alias("_last"),
    )
    products = dated.select("CustomerID", "ProductID").distinct().groupBy("CustomerID").agg(F.count("ProductID").alias("UniqueProducts"))
    if variant == "weighted":
        quantity, price = C.ratio(F.sum("_q"), F.count("InvoiceNo")), C.ratio(F.sum("_qp"), F.sum("_q"))
    else:
        quantity, price = C.ratio(F.sum("_q"), F.sum("_nq")), C.ratio(F.sum("_p"), F.sum("_np"))
    totals = per_order.groupBy("CustomerID").agg(
        F.sum("_q").alias("TotalItems"),
        F.count("InvoiceNo").alias("TotalOrders"),
        F.min("_first").alias("FirstOrderDate"),
        F.max("_last").alias("LastOrderDate"),
        C.rounded(quantity, round_to).alias("AvgQuantityPerOrder"),
        C.rounded(price, round_to).alias("AvgPricePerItem"),
    )
    # a null customer is a group like any other
    return totals.withColumnRenamed("CustomerID", "_c").join(products, F.col("_c").eqNullSafe(F.col("CustomerID"))).select(
        "CustomerID", "TotalItems", "UniqueProducts", "TotalOrders", "FirstOrderDate", "LastOrderDate", "AvgQuantityPerOrder", "AvgPricePerItem"
    )


def final_customer_dataset(customers: DataFrame, rollup: DataFrame, locations: DataFrame) -> DataFrame:
    """Every customer with the order roll-up and region; missing roll-ups take defaults."""
    region = locations.select("Country", "Region")
    span = F.datediff("LastOrderDate", "FirstOrderDate")
    zero = F.lit(0)
    return (
        customers.join(rollup, "CustomerID", "left")
        .join(region, "Country", "left")
        .select(
            "CustomerID", "Country", "JoinDate", "Recency", "Frequency", "Monetary", "AvgOrderValue", "ChurnLabel",
            F.coalesce("TotalItems", zero).alias("TotalItems"),
            F.coalesce("UniqueProducts", zero).alias("UniqueProducts"),
            F.coalesce("TotalOrders", zero).alias("TotalOrders"),
            F.coalesce("FirstOrderDate", "JoinDate").alias("FirstOrderDate"),
            F.coalesce("LastOrderDate", "JoinDate").alias("LastOrderDate"),
            F.coalesce(span, zero).alias("CustomerLifespanDays"),
            "Region",
            F.coalesce("AvgQuantityPerOrder", F.lit(0.0)).alias("AvgQuantityPerOrder"),
            F.coalesce("AvgPricePerItem", F.lit(0.0)).alias("AvgPricePerItem"),
        )
    )


def behaviour_features(orders: DataFrame, products: DataFrame, days: DataFrame) -> DataFrame:
    """Category diversity, weekend and premium share of order lines, latest calendar month, spread of spend.

    Order keys are unique, so the distinct count of weekend orders is a plain sum.
    """
    lines = orders.join(products.select("ProductID", "Category", "PriceRange"), "ProductID").join(
        days.select("TimeID", "IsWeekend", "Month"), "TimeID"
    )
    return lines.groupBy("CustomerID").agg(
        F.countDistinct("Category").alias("CategoryDiversity"),
        C.ratio(F.sum("IsWeekend"), F.count("*")).alias("WeekendRatio"),
        C.ratio(F.sum((F.col("PriceRange") == "Premium").cast("int")), F.count("*")).alias("PremiumRatio"),
        F.max("Month").alias("LastPurchaseMonth"),
        F.stddev_pop(F.col("TotalPrice").cast("double")).alias("SpendingStdDev"),
    )
