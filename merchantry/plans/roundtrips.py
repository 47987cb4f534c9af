"""Queries that send given tables through the file readers and writers and report what comes back."""

from __future__ import annotations

import uuid

from pyspark.ml.feature import StandardScaler, StandardScalerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from merchantry.operators import clean, segment
from merchantry.plans.warehouse import Warehouse
from merchantry.schemas import STAGING_RETAIL
from merchantry.sources import files, tables
from merchantry.sources.versioned import VersionedTable

#: Staged lines as they stand in a text file.
RAW_RETAIL = T.StructType([T.StructField(f.name, T.StringType()) for f in STAGING_RETAIL])


def _place(w: Warehouse, name: str) -> str:
    return f"{w.store.root}/exports/{name}"


def csv_staging(w: Warehouse) -> DataFrame:
    """Lines of even and odd years are exported as text, read back as parts, united and typed; figures by country."""
    lines = w["staging_retail"]
    parts = []
    for name, odd in (("even", 0), ("odd", 1)):
        files.export_csv(lines.filter(F.year("InvoiceDate") % 2 == odd), _place(w, f"lines-{name}"))
        parts.append(files.read_csv(w.spark, _place(w, f"lines-{name}"), RAW_RETAIL))
    staged = files.stage_retail(files.union_parts(*parts))
    return staged.groupBy("Country").agg(
        F.count("*").alias("Lines"),
        F.sum("Quantity").alias("Quantity"),
        F.sum((F.col("Quantity") * F.col("Price")).cast("decimal(20,2)")).alias("Amount"),
        F.sum(F.col("Customer ID").isNull().cast("int")).alias("Unknown"),
        F.sum(F.length("Description")).alias("TextChars"),
        F.max("InvoiceDate").cast("string").alias("LastDate"),
    )


def rejected_lines(w: Warehouse) -> DataFrame:
    """Lines without a positive amount go to an output of their own; both outputs are read back and counted."""
    kept, rejected = files.split_rejects(w["staging_retail"], (F.col("Quantity") <= 0) | (F.col("Price") <= 0))
    counts = []
    for name, rows in (("kept", kept), ("rejected", rejected)):
        files.replace_table(rows, _place(w, f"lines-{name}"))
        back = w.spark.read.schema(rows.schema).parquet(_place(w, f"lines-{name}"))
        counts.append(back.agg(F.count("*").alias("Lines"), F.coalesce(F.sum("Quantity"), F.lit(0)).alias("Quantity")).select(F.lit(name).alias("Output"), "Lines", "Quantity"))
    return files.union_parts(*counts)


def replaced_table(w: Warehouse) -> DataFrame:
    """A table is written, replaced by other rows and appended to; what it holds by day of week."""
    days = w["dim_time"].select("FullDate", "DayOfWeek", "IsWeekend")
    path = _place(w, "days")
    files.replace_table(days.filter("DayOfWeek = 'Monday'"), path)
    files.replace_table(days.filter("IsWeekend = 1"), path)
    schema = T.StructType([days.schema["FullDate"], days.schema["DayOfWeek"], days.schema["IsWeekend"]])
    files.insert_into(days.filter("DayOfWeek = 'Friday'").withColumn("IsWeekend", F.col("IsWeekend").cast("string")), path, schema)
    return w.spark.read.schema(schema).parquet(path).groupBy("DayOfWeek").agg(F.count("*").alias("Days"), F.sum("IsWeekend").alias("Weekend"))


def first_csv(w: Warehouse) -> DataFrame:
    """Locations from the first file pattern that exists."""
    rows = w["dim_location"].select("Country", "Region")
    files.export_csv(rows.coalesce(1), _place(w, "locations"))
    return files.read_first_csv(w.spark, _place(w, "."), ["locations-*/part-*.csv", "locations/part-*.csv"], rows.schema)


def review_names(w: Warehouse) -> DataFrame:
    """Reviews under the names of a spreadsheet: the number column goes, names lose their blanks, columns are found by words, text becomes numbers."""
    sheet = w["staging_reviews"].select(
        F.col("ReviewID").alias("Unnamed: 0"),
        F.col("ReviewID").alias(" Review No "),
        F.col("Age").cast("string").alias("Customer Age"),
        F.col("DepartmentName").alias("Department Name"),
        F.concat(F.lit("0"), F.col("Rating").cast("string"), F.lit(".5")).alias("Star Rating"),
    )
    named = clean.normalise_names(clean.drop_if_present(sheet, "Unnamed: 0", "Not There"))
    age, stars = clean.find_column(named, "age of", "customer age"), clean.find_column(named, "rating")
    numbers = clean.numeric(named, age, stars, "Department_Name")
    return numbers.select(F.col("Review_No").alias("ReviewID"), F.col(age).alias("Age"), F.col(stars).alias("Stars"), F.col("Department_Name").alias("Department"))


def versioned_write_back(w: Warehouse) -> DataFrame:
    """Reviews are published as a table in versions; the scores of the newest tenth of identities are merged into the ranges that hold them, and the newest version is read."""
    reviews = w["fact_reviews"].select("ReviewID", "Rating", "SentimentScore")
    table = VersionedTable(w.spark, _place(w, f"reviews-{uuid.uuid4().hex[:8]}"), "ReviewID")
    table.replace(reviews)
    newest = reviews.agg((F.max("ReviewID") * 9 / 10).alias("m")).scalar()
    scores = w["sentiment_scores"].filter(F.col("ReviewID") >= newest).select("ReviewID", F.col("Ensemble_Score").alias("SentimentScore"))
    table.merge(scores)
    return table.read().select("ReviewID", "Rating", F.round("SentimentScore", 6).alias("SentimentScore"))


def image_folder_counts(w: Warehouse, folder: str) -> DataFrame:
    """Pages are written as files in a folder for each class, one file a page, and read back as labelled binary files; files and bytes by class."""
    pages = tables.table(w.spark, folder, "pages")
    label = F.concat(F.lit("class-"), F.pmod("page_id", F.lit(7)).cast("string"))
    path = _place(w, "images")
    rows = pages.select(F.coalesce("html", F.lit("")).alias("value"), label.alias("label"))
    rows.write.mode("overwrite").partitionBy("label").option("maxRecordsPerFile", 1).text(path)
    images = files.read_labelled_images(w.spark, path).withColumn("label", F.split("label", "=")[1])
    sizes = images.groupBy("label").agg(F.sum(F.length("content")).alias("Bytes"))
    return files.class_counts(images).join(sizes, "label").select(F.col("label").alias("Label"), F.col("files").alias("Files"), "Bytes")


def saved_scaler(w: Warehouse) -> DataFrame:
    """A scaler is fitted on recency, frequency and monetary value, saved, read again and applied."""
    rows = segment.as_vectors(w["rfm_table"].select("CustomerID", *[F.col(c).cast("double").alias(c) for c in segment.FEATURES]), segment.FEATURES)
    path = _place(w, "scaler")
    files.save_model(StandardScaler(inputCol="features", outputCol="z", withMean=True, withStd=True).fit(rows), path)
    scaled = StandardScalerModel.load(path).transform(rows).select("CustomerID", vector_to_array("z").alias("z"))
    return scaled.select("CustomerID", *[F.round(F.col("z")[i], 6).alias(c) for i, c in enumerate(segment.FEATURES)])
