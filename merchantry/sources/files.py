"""File readers and writers: staged CSV, yearly parts, image folders, exports, models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def union_parts(*parts: DataFrame) -> DataFrame:
    """One table from parts with the same columns (for example yearly sheets)."""
    return reduce(lambda a, b: a.unionByName(b), parts)


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """CSV with a header and a declared schema. ``multi_line`` allows line breaks inside quotes,
    at the price of reading each file in one task, so leave it off for large files without them."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )


def read_first_csv(spark: SparkSession, folder: str, patterns: list[str], schema: T.StructType) -> DataFrame:
    """The first file pattern that matches any file in the folder."""
    jvm = spark.sparkContext._jvm
    for pattern in patterns:
        path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{pattern}")
        found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
        if found:
            names = sorted(str(f.getPath().toString()) for f in found)
            return read_csv(spark, names[0], schema)
    raise FileNotFoundError(f"no file in {folder} matches {patterns}")


def stage_retail(raw: DataFrame) -> DataFrame:
    """Give text-typed raw lines the staged types; values that do not parse become null."""
    return raw.select(
        F.col("Invoice").cast("string").alias("Invoice"),
        F.col("StockCode").cast("string").alias("StockCode"),
        F.col("Description").cast("string").alias("Description"),
        F.col("Quantity").try_cast("int").alias("Quantity"),
        F.col("InvoiceDate").try_cast("timestamp").alias("InvoiceDate"),
        F.col("Price").try_cast("decimal(10,2)").alias("Price"),
        F.col("Customer ID").try_cast("double").alias("Customer ID"),
        F.col("Country").cast("string").alias("Country"),
    )


def read_labelled_images(spark: SparkSession, folder: str) -> DataFrame:
    """Image bytes with the parent folder as class."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return files.select("path", "content", F.element_at(F.split("path", "/"), -2).alias("label"))


def class_counts(images: DataFrame) -> DataFrame:
    return images.groupBy("label").agg(F.count("*").alias("files"))


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a stored table."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def insert_into(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Append rows to a stored table, cast to its schema."""
    df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]).write.mode("append").parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """One folder of CSV parts with headers, written by the executors."""
    exact = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}  # else the writer trims text
    df.write.mode("overwrite").option("header", True).option("escape", '"').options(**exact).csv(path)


def split_rejects(df: DataFrame, condition) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) rows; a null condition counts as kept."""
    bad = F.coalesce(condition, F.lit(False))
    return df.filter(~bad), df.filter(bad)


def write_back(target: DataFrame, updates: DataFrame, key: str, column: str) -> DataFrame:
    """Overwrite one column of the rows that ``updates`` names by key; write the result to a new path."""
    new = updates.select(key, F.col(column).alias("_new"))
    kind = target.schema[column].dataType
    joined = target.join(new, key, "left").withColumn(column, F.coalesce(F.col("_new"), F.col(column)).cast(kind))
    return joined.select(target.columns)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)
