"""Views of the given order, catalogue and document tables as staged retail lines and reviews."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CLASS_NAMES = (
    "Dresses", "Knits", "Fine gauge", "Blouses", "Sweaters", "Pants",
    "Jeans", "Skirts", "Jackets", "Outerwear", "Shorts", "Lounge",
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give a scan with fewer splits than cores (a single small file) one part per core, since the work behind it
    would otherwise run in one task. A large input has more splits than cores and is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def staging_retail(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line; no join hints, so the file sizes decide between broadcast and sort-merge.

    The given lines are clean. Lines chosen by their key are returned goods (negative quantity), free (price zero), entered with
    a wrong quantity (40 times as much) or entered twice, so that every cleaning step has work to do.
    """
    lines = spread(
        table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    )
    line = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    quantity = F.when(line % 97 == 0, -F.col("l_quantity")).when(line % 101 == 0, F.col("l_quantity") * 40).otherwise(F.col("l_quantity"))
    lines = lines.withColumns(
        {"l_quantity": quantity, "l_extendedprice": F.when(line % 89 == 0, 0.0).otherwise(F.col("l_extendedprice"))}
    ).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.when(line % 50 == 7, 2).otherwise(1))))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    part = table(spark, folder, "part").select("p_partkey", "p_name")
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    key = F.col("o_orderkey").cast("string")
    # Orders meet customers before the lines do: so lines are sent for two joins, not three. The names of the few countries come last.
    placed = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return (
        lines.join(placed.drop("c_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("C"), key)).otherwise(key).alias("Invoice"),
            F.col("l_partkey").cast("string").alias("StockCode"),
            F.concat(F.lit(" "), "p_name", F.lit(" ")).alias("Description"),
            F.col("l_quantity").cast("int").alias("Quantity"),
            F.col("o_orderdate").alias("InvoiceDate"),
            F.col("l_extendedprice").cast("decimal(10,2)").alias("Price"),
            F.when(F.col("o_custkey") % 50 != 0, F.col("o_custkey").cast("double")).alias("Customer ID"),
            F.col("n_name").alias("Country"),
        )
    )


def region_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Country -> region rows."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("Country"), F.col("r_name").alias("Region")
    )


def staging_reviews(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = spread(table(spark, folder, "documents")), table(spark, folder, "labels")
    doc = F.col("doc_id")
    classes = F.array(*[F.lit(c) for c in CLASS_NAMES])
    return docs.join(labels.select("doc_id", "quality"), "doc_id", "left").select(
        doc.alias("ReviewID"),
        (doc % 100).alias("ClothingID"),
        (F.lit(15) + doc % 60).cast("int").alias("Age"),
        F.when(doc % 7 == 0, F.lit(None)).when(doc % 11 == 0, F.lit(" ")).otherwise(F.col("source")).alias("Title"),
        F.when(doc % 37 != 0, F.col("text")).alias("ReviewText"),
        (F.lit(1) + doc % 5).cast("int").alias("Rating"),
        F.coalesce(F.col("quality"), F.lit(0)).cast("int").alias("Recommended"),
        (F.col("n_chars") % 20).cast("int").alias("PositiveFeedback"),
        F.col("lang").alias("DivisionName"),
        F.when(doc % 13 != 0, F.col("source")).alias("DepartmentName"),
        F.element_at(classes, (doc % 12 + 1).cast("int")).alias("ClassName"),
    )


def labelled_vectors(spark: SparkSession, folder: str, names: dict[int, str] | None = None) -> DataFrame:
    """Vector data set with label names; the name table has one row per class."""
    data = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("features"), "label")
    if names is None:
        return data.withColumn("label_name", F.concat(F.lit("class_"), F.col("label").cast("string")))
    rows = spark.createDataFrame(sorted(names.items()), "label int, label_name string")
    return data.join(F.broadcast(rows), "label", "left")
