"""The report catalogue: each function takes warehouse tables and returns one report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchantry import constants as K
from merchantry.functions import columns as C
from merchantry.functions.frames import literal_rows
from merchantry.operators import stats
from merchantry.plans.warehouse import Warehouse

DIGITS = 6


def _dated(w: Warehouse, *columns: str) -> DataFrame:
    """Order lines with calendar columns. The stored calendar's size lets Spark broadcast it without a hint."""
    return w["fact_orders"].join(w["dim_time"].select("TimeID", *columns), "TimeID")


def _located(w: Warehouse, *columns: str) -> DataFrame:
    return w["fact_orders"].join(w["dim_location"].select("LocationID", *columns), "LocationID")


def _per_product(w: Warehouse, *aggregates) -> DataFrame:
    """Order lines reduced per product before they meet the product table, so only one row per product moves."""
    return w["fact_orders"].groupBy("ProductID").agg(*aggregates)


def _revenue():
    return F.sum("TotalPrice").alias("Revenue")


def top_products(w: Warehouse, n: int = 10) -> DataFrame:
    sums = _per_product(
        w,
        F.sum("Quantity").alias("TotalUnitsSold"),
        F.sum("TotalPrice").alias("TotalRevenue"),
        F.count("*").alias("TimesOrdered"),
    )
    named = sums.join(w["dim_product"].select("ProductID", "ProductName", "Category"), "ProductID")
    columns = ["ProductID", "ProductName", "Category", "TotalUnitsSold", "TotalRevenue", "TimesOrdered"]
    return named.select(*columns).orderBy(F.desc("TotalUnitsSold"), "ProductID").limit(n)


def monthly_revenue(w: Warehouse) -> DataFrame:
    return (
        _dated(w, "Year", "Month", "MonthName")
        .groupBy("Year", "Month", "MonthName")
        .agg(
            _revenue(),
            F.countDistinct("InvoiceNo").alias("TotalOrders"),
            F.countDistinct("CustomerID").alias("UniqueCustomers"),
        )
        .orderBy("Year", "Month")
    )


def customer_ltv(w: Warehouse, customers: DataFrame | None = None, n: int = 20) -> DataFrame:
    """Top customers by lifetime value; the line average is part of the report."""
    customers = w["dim_customer"] if customers is None else customers
    sums = (
        w["fact_orders"]
        .groupBy("CustomerID")
        .agg(
            F.sum("TotalPrice").alias("LifetimeValue"),
            F.countDistinct("InvoiceNo").alias("TotalOrders"),
            C.rounded(C.ratio(F.sum("TotalPrice"), F.count("*")), DIGITS).alias("AvgOrderValue"),
        )
    )
    columns = ["CustomerID", "RFM_Segment", "Country", "Recency", "Frequency", "Monetary"]
    return (
        sums.join(customers.select(*columns), "CustomerID")
        .select(
            "CustomerID", "RFM_Segment", "Country", "LifetimeValue", "TotalOrders", "AvgOrderValue",
            "Recency", "Frequency", "Monetary",
        )
        .orderBy(F.desc("LifetimeValue"), "CustomerID")
        .limit(n)
    )


def churn_by_segment(customers: DataFrame) -> DataFrame:
    churned = F.sum("ChurnLabel")
    return (
        customers.filter(F.col("RFM_Segment").isNotNull())
        .groupBy("RFM_Segment")
        .agg(
            F.count("*").alias("TotalCustomers"),
            churned.alias("ChurnedCustomers"),
            C.rounded(C.ratio(churned * 100, F.count("*")), DIGITS).alias("ChurnRatePercent"),
        )
        .orderBy(F.desc("ChurnRatePercent"), "RFM_Segment")
    )


def segment_profile(customers: DataFrame) -> DataFrame:
    return (
        customers.filter(F.col("RFM_Segment").isNotNull())
        .groupBy("RFM_Segment")
        .agg(
            F.count("*").alias("CustomerCount"),
            C.rounded(F.avg("Recency"), DIGITS).alias("AvgRecency"),
            C.rounded(F.avg("Frequency"), DIGITS).alias("AvgFrequency"),
            C.rounded(C.ratio(F.sum("Monetary"), F.count("Monetary")), DIGITS).alias("AvgMonetary"),
            F.min("Monetary").alias("MinMonetary"),
            F.max("Monetary").alias("MaxMonetary"),
        )
        .orderBy(F.desc("AvgMonetary"))
    )


def sentiment_by_category(reviews: DataFrame, category: str = "CNN_Matched_Class") -> DataFrame:
    positive = (F.col("SentimentScore") > 0.05).cast("int")
    return (
        reviews.filter(F.col(category).isNotNull())
        .groupBy(F.col(category).alias("Category"))
        .agg(
            C.rounded(F.avg("SentimentScore"), DIGITS).alias("AvgSentiment"),
            C.rounded(F.avg("Rating"), DIGITS).alias("AvgRating"),
            F.count("*").alias("ReviewCount"),
            F.sum("Recommended").alias("RecommendedCount"),
            C.rounded(C.ratio(F.sum("Recommended") * 100, F.count("*")), DIGITS).alias("RecommendRatePercent"),
            C.rounded(F.avg(positive) * 100, DIGITS).alias("PositivePercent"),
        )
        .orderBy(F.desc("AvgSentiment"), "Category")
    )


def revenue_by_country(w: Warehouse, n: int = 10) -> DataFrame:
    return (
        _located(w, "Country")
        .groupBy("Country")
        .agg(
            F.sum("TotalPrice").alias("TotalRevenue"),
            F.countDistinct("CustomerID").alias("UniqueCustomers"),
            F.countDistinct("InvoiceNo").alias("TotalOrders"),
        )
        .orderBy(F.desc("TotalRevenue"), "Country")
        .limit(n)
    )


def sales_by_weekday(w: Warehouse, keep_missing: bool = True) -> DataFrame:
    """Monday first; days without sales stay as null rows when ``keep_missing`` is set."""
    sums = (
        _dated(w, "DayOfWeek")
        .groupBy("DayOfWeek")
        .agg(
            F.countDistinct("InvoiceNo").alias("TotalOrders"),
            F.sum("TotalPrice").alias("TotalRevenue"),
            C.rounded(C.ratio(F.sum("TotalPrice"), F.count("*")), DIGITS).alias("AvgOrderValue"),
        )
    )
    if keep_missing:
        days = literal_rows(w.spark, [("DayOfWeek", "string")], [(d,) for d in K.WEEKDAYS])
        sums = days.join(sums, "DayOfWeek", "left")
    return sums.orderBy(C.rank_in("DayOfWeek", K.WEEKDAYS))


def products_by_price_band(w: Warehouse) -> DataFrame:
    return (
        w["dim_product"]
        .groupBy("PriceRange")
        .agg(F.count("*").alias("ProductCount"), C.rounded(F.avg("AvgRating"), DIGITS).alias("AvgRating"))
        .orderBy(C.rank_in("PriceRange", K.PRICE_BANDS))
    )


def region_share(w: Warehouse) -> DataFrame:
    sums = _located(w, "Region").groupBy("Region").agg(_revenue(), F.count("*").alias("Orders"))
    return stats.with_share(sums, "Revenue", "Pct").orderBy(F.desc("Revenue"), "Region")


def daily_revenue(w: Warehouse) -> DataFrame:
    return (
        _dated(w, "FullDate").groupBy("FullDate").agg(_revenue(), F.count("*").alias("Orders")).orderBy("FullDate")
    )


def monthly_change(w: Warehouse) -> DataFrame:
    """Revenue per month present in the data, with the change against the month before it."""
    months = _dated(w, "FullDate").groupBy(F.date_format("FullDate", "yyyy-MM").alias("Month")).agg(_revenue())
    return stats.percent_change(months, "Month", "Revenue", "Change").orderBy("Month")


def quarterly_growth(w: Warehouse) -> DataFrame:
    label = F.concat(F.col("Year").cast("string"), F.lit("Q"), F.col("Quarter").cast("string"))
    quarters = _dated(w, "Year", "Quarter").groupBy(label.alias("Quarter")).agg(_revenue())
    return stats.percent_change(quarters, "Quarter", "Revenue", "GrowthRate").orderBy("Quarter")


def _by_product_column(w: Warehouse, column: str) -> DataFrame:
    sums = _per_product(
        w, _revenue(), F.sum("Quantity").alias("Quantity"), F.count("*").alias("Lines")
    )
    return (
        sums.join(w["dim_product"].select("ProductID", column), "ProductID")
        .groupBy(column)
        .agg(F.sum("Revenue").alias("Revenue"), F.sum("Quantity").alias("Quantity"), F.sum("Lines").alias("Lines"))
    )


def category_revenue(w: Warehouse, n: int = 8) -> DataFrame:
    top = _by_product_column(w, "Category").select("Category", "Revenue")
    top = top.orderBy(F.desc("Revenue"), "Category").limit(n)
    return stats.with_share(top, "Revenue", "Share").orderBy(F.desc("Revenue"), "Category")


def lines_by_price_band(w: Warehouse) -> DataFrame:
    return stats.with_share(_by_product_column(w, "PriceRange").select("PriceRange", "Lines"), "Lines", "Percent")


def weekend_split(w: Warehouse) -> DataFrame:
    label = F.when(F.col("IsWeekend") == 1, "Weekend").otherwise("Weekday")
    sums = _dated(w, "IsWeekend").groupBy(label.alias("Label")).agg(_revenue(), F.count("*").alias("Lines"))
    return stats.with_share(sums, "Revenue", "Percent")


def category_quantity(w: Warehouse, n: int = 10) -> DataFrame:
    sums = _by_product_column(w, "Category").select("Category", "Quantity")
    return stats.with_share(sums, "Quantity", "Percent").orderBy(F.desc("Quantity"), "Category").limit(n)


def purchase_frequency(w: Warehouse) -> DataFrame:
    """Customers per order-count bin; all bins are present and the share is of all customers."""
    bins = w["dim_customer"].select(C.interval_bin("Frequency", K.FREQUENCY_EDGES, K.FREQUENCY_LABELS).alias("FreqBin"))
    total = w["dim_customer"].agg(F.count("*").alias("n")).scalar()
    counts = bins.groupBy("FreqBin").agg(F.count("*").alias("Customers"))
    frame = literal_rows(w.spark, [("FreqBin", "string")], [(b,) for b in K.FREQUENCY_LABELS])
    full = frame.join(counts, "FreqBin", "left").select("FreqBin", F.coalesce("Customers", F.lit(0)).alias("Customers"))
    return stats.with_share(full, "Customers", "Percent", total=total).orderBy(C.rank_in("FreqBin", K.FREQUENCY_LABELS))


def rating_distribution(reviews: DataFrame) -> DataFrame:
    total = reviews.agg(F.count("*").alias("n")).scalar()
    counts = reviews.filter(F.col("Rating").isNotNull()).groupBy("Rating").agg(F.count("*").alias("Reviews"))
    return stats.with_share(counts, "Reviews", "Percent", total=total).orderBy("Rating")


def sentiment_by_department(reviews: DataFrame) -> DataFrame:
    return (
        reviews.filter(F.col("DepartmentName").isNotNull())
        .groupBy("DepartmentName")
        .agg(C.rounded(F.avg("SentimentScore"), DIGITS).alias("AvgSentiment"))
        .orderBy("AvgSentiment", "DepartmentName")
    )


def recommend_rate_by_class(reviews: DataFrame) -> DataFrame:
    return (
        reviews.filter(F.col("ClassName").isNotNull())
        .groupBy("ClassName")
        .agg(F.count("Recommended").alias("Total"), F.sum("Recommended").alias("Recommended"))
        .withColumn("Percent", C.rounded(C.ratio(F.col("Recommended") * 100, "Total"), DIGITS))
        .orderBy("Percent", "ClassName")
    )


def age_rating_matrix(reviews: DataFrame) -> DataFrame:
    binned = reviews.select(C.interval_bin("Age", K.AGE_EDGES, K.AGE_LABELS).alias("AgeGroup"), "Rating")
    return stats.cross_tab(binned, "AgeGroup", "Rating", [1, 2, 3, 4, 5], "Rating_").orderBy("AgeGroup")


def sentiment_by_rating(reviews: DataFrame) -> DataFrame:
    return (
        reviews.filter(F.col("Rating").isNotNull())
        .groupBy("Rating")
        .agg(
            C.rounded(F.avg("SentimentScore"), DIGITS).alias("Mean"),
            C.rounded(F.stddev_samp("SentimentScore"), DIGITS).alias("Std"),
        )
        .orderBy("Rating")
    )


def top_customers(w: Warehouse, n: int = 10) -> DataFrame:
    status = F.when(F.col("ChurnLabel") == 1, "Churned").otherwise("Active")
    return (
        w["dim_customer"]
        .select("CustomerID", "Country", "Recency", "Frequency", "Monetary", "AvgOrderValue", status.alias("Status"))
        .orderBy(F.desc("Monetary"), "CustomerID")
        .limit(n)
    )


def products_per_category(w: Warehouse) -> DataFrame:
    return stats.value_counts(w["dim_product"], "Category")


def category_distribution(w: Warehouse) -> DataFrame:
    counts = w["clean_retail"].groupBy("ProductCategory").agg(F.count("*").alias("TotalRows"))
    return stats.with_share(counts, "TotalRows", "Percentage").orderBy(F.desc("TotalRows"), "ProductCategory")


def kpi_summary(w: Warehouse) -> DataFrame:
    """Headline counts and revenue; each source is read once and only for its own column."""

    def count(name: str):
        return w[name].agg(F.count("*").alias("n")).scalar()

    orders = w["fact_orders"].agg(F.count("*").alias("OrderLines"), F.sum("TotalPrice").alias("Revenue"))
    return orders.select(
        count("dim_customer").alias("Customers"),
        count("dim_product").alias("Products"),
        "OrderLines",
        count("fact_reviews").alias("Reviews"),
        "Revenue",
    )


def warehouse_preview(w: Warehouse, n: int = 10) -> DataFrame:
    """First joined rows in a fixed order, for inspection."""
    lines = _dated(w, "FullDate").join(w["dim_location"].select("LocationID", "Country"), "LocationID")
    first = lines.orderBy("InvoiceNo", "OrderID").limit(n)
    return first.join(w["dim_product"].select("ProductID", "ProductName"), "ProductID").select(
        "InvoiceNo", "CustomerID", "ProductName", "FullDate", "Country", "Quantity", "TotalPrice"
    )


def display_customers(w: Warehouse, n: int = 10, width: int = 12) -> DataFrame:
    """Display columns: truncated label, money and percentage text, share label."""
    top = stats.with_share(top_customers(w, n).select("CustomerID", "Country", "Monetary"), "Monetary", "Pct")
    return top.select(
        "CustomerID",
        F.substring("Country", 1, width).alias("CountryLabel"),
        F.concat(F.lit("$"), F.format_number(F.col("Monetary").cast("decimal(20,0)"), 0)).alias("MonetaryText"),
        F.concat("Country", F.lit(" ("), F.format_string("%.1f", "Pct"), F.lit("%)")).alias("ShareLabel"),
    )
