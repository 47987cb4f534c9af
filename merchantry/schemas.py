"""Explicit schemas of the staged inputs."""

from pyspark.sql import types as T

STAGING_RETAIL = T.StructType(
    [
        T.StructField("Invoice", T.StringType()),
        T.StructField("StockCode", T.StringType()),
        T.StructField("Description", T.StringType()),
        T.StructField("Quantity", T.IntegerType()),
        T.StructField("InvoiceDate", T.TimestampType()),
        T.StructField("Price", T.DecimalType(10, 2)),
        T.StructField("Customer ID", T.DoubleType()),
        T.StructField("Country", T.StringType()),
    ]
)

STAGING_REVIEWS = T.StructType(
    [
        T.StructField("Unnamed: 0", T.LongType()),
        T.StructField("Clothing ID", T.LongType()),
        T.StructField("Age", T.IntegerType()),
        T.StructField("Title", T.StringType()),
        T.StructField("Review Text", T.StringType()),
        T.StructField("Rating", T.IntegerType()),
        T.StructField("Recommended IND", T.IntegerType()),
        T.StructField("Positive Feedback Count", T.IntegerType()),
        T.StructField("Division Name", T.StringType()),
        T.StructField("Department Name", T.StringType()),
        T.StructField("Class Name", T.StringType()),
    ]
)

# Source review column -> column used by the operators.
REVIEW_COLUMNS = {
    "Unnamed: 0": "ReviewID",
    "Clothing ID": "ClothingID",
    "Review Text": "ReviewText",
    "Recommended IND": "Recommended",
    "Positive Feedback Count": "PositiveFeedback",
    "Division Name": "DivisionName",
    "Department Name": "DepartmentName",
    "Class Name": "ClassName",
}
