"""Validation: reconciliation, null checks, row counts, referential integrity, profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchantry.functions import columns as C


def _count(df: DataFrame):
    return df.agg(F.count("*").alias("n")).scalar()


def _one_row(df: DataFrame) -> DataFrame:
    return df.sparkSession.range(1)


def reconciliation(stages: dict[str, tuple[DataFrame, DataFrame]], digits: int = 6) -> DataFrame:
    """Source rows, loaded rows, lost rows and load percentage per stage."""
    rows = []
    for name, (source, loaded) in stages.items():
        pair = _one_row(source).select(
            F.lit(name).alias("Stage"), _count(source).alias("SourceRows"), _count(loaded).alias("LoadedRows")
        )
        rows.append(
            pair.withColumn("RowsLost", F.col("SourceRows") - F.col("LoadedRows")).withColumn(
                "LoadPercent", C.rounded(C.ratio(F.col("LoadedRows") * 100, "SourceRows"), digits)
            )
        )
    return reduce(DataFrame.unionByName, rows)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count("*").alias("TotalRows")).select(F.lit(n).alias("TableName"), "TotalRows") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def cleaning_steps(staging: DataFrame, clean: DataFrame) -> DataFrame:
    """Rows left after each cleaning step; the filter steps are counted in one pass."""
    kept = ~C.is_cancelled("Invoice")
    known = kept & F.col("Customer ID").isNotNull()
    valid = known & (F.col("Quantity") > 0) & (F.col("Price") > 0)

    def rows(cond):
        return F.coalesce(F.sum(cond.cast("int")), F.lit(0)).cast("long")

    steps = F.array(
        F.struct(F.lit("1 raw").alias("Step"), F.count("*").alias("RowsLeft")),
        F.struct(F.lit("2 not cancelled").alias("Step"), rows(kept).alias("RowsLeft")),
        F.struct(F.lit("3 known customer").alias("Step"), rows(known).alias("RowsLeft")),
        F.struct(F.lit("4 positive amounts").alias("Step"), rows(valid).alias("RowsLeft")),
    )
    filters = staging.agg(steps.alias("s")).select(F.inline("s"))
    deduped = clean.agg(F.count("*").alias("RowsLeft")).select(F.lit("5 no duplicates").alias("Step"), "RowsLeft")
    return filters.unionByName(deduped)


def null_checks(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null counts per column in one pass, as rows."""
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("Column"), F.coalesce(F.sum(F.col(c).isNull().cast("int")), F.lit(0)).alias("Nulls")
            )
            for c in columns
        ]
    )
    return df.agg(entries.alias("e")).select(F.inline("e"))


def missing_table(df: DataFrame, digits: int = 6) -> DataFrame:
    """Columns that have missing values, with count and share."""
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("Column"),
                F.coalesce(F.sum(F.col(c).isNull().cast("int")), F.lit(0)).alias("Missing"),
                F.count("*").alias("_n"),
            )
            for c in df.columns
        ]
    )
    rows = df.agg(entries.alias("e")).select(F.inline("e")).filter(F.col("Missing") > 0)
    share = C.rounded(C.ratio(F.col("Missing") * 100, "_n"), digits)
    return rows.select("Column", "Missing", share.alias("Percent")).orderBy(F.desc("Missing"), "Column")


def row_integrity(expected: DataFrame, actual: DataFrame) -> DataFrame:
    pair = _one_row(expected).select(_count(expected).alias("Expected"), _count(actual).alias("Actual"))
    return pair.withColumn("Status", F.when(F.col("Expected") == F.col("Actual"), "PASS").otherwise("FAIL"))


def orphans(fact: DataFrame, parents: dict[str, DataFrame]) -> DataFrame:
    """Fact rows whose key is missing in the parent, per foreign key. Only distinct keys meet the parent."""
    parts = []
    for key, parent in parents.items():
        keys = fact.groupBy(key).agg(F.count("*").alias("_n"))
        lost = keys.join(parent.select(key), key, "left_anti")
        parts.append(lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("Orphans")).select(F.lit(key).alias("ForeignKey"), "Orphans"))
    return reduce(DataFrame.unionByName, parts)


def dataset_summary(datasets: dict[str, DataFrame], digits: int = 6) -> DataFrame:
    """Rows, columns, share of missing cells and text size per data set."""
    parts = []
    for name, df in datasets.items():
        width = len(df.columns)
        nulls = sum((F.col(c).isNull().cast("int") for c in df.columns), F.lit(0))
        size = sum((F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
        parts.append(
            df.agg(
                F.count("*").alias("Rows"), F.sum(nulls).alias("_nulls"), F.sum(size.cast("long")).alias("TextChars")
            ).select(
                F.lit(name).alias("Dataset"),
                "Rows",
                F.lit(width).alias("Columns"),
                C.rounded(C.ratio(F.col("_nulls") * 100, F.col("Rows") * width), digits).alias("MissingPercent"),
                "TextChars",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def column_profile(df: DataFrame, name: str) -> DataFrame:
    """Position, type, filled and empty cells, distinct values and text range of every column.

    One pass makes (column, value) groups that combine before the shuffle, so any number of columns needs no distinct aggregate.
    """
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("Position"), F.lit(f.name).alias("Column"), F.lit(f.dataType.simpleString()).alias("Type"),
                F.col(f"`{f.name}`").cast("string").alias("value"),
            )
            for i, f in enumerate(df.schema)
        ]
    )
    keys = [F.lit(name).alias("TableName"), "Position", "Column", "Type"]
    values = df.select(F.inline(entries)).groupBy("Position", "Column", "Type", "value").agg(F.count("*").alias("n"))
    filled = F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0))
    return (
        values.groupBy("Position", "Column", "Type")
        .agg(
            filled.alias("NonNull"),
            (F.sum("n") - filled).alias("Nulls"),
            F.count("value").alias("DistinctValues"),
            F.min("value").alias("MinText"),
            F.max("value").alias("MaxText"),
        )
        .select(*keys, "NonNull", "Nulls", "DistinctValues", "MinText", "MaxText")
    )


def schema_listing(tables: dict[str, DataFrame]) -> DataFrame:
    """Table, column and number of filled cells, in one pass per table."""
    parts = []
    for name, df in tables.items():
        entries = [
            F.struct(F.lit(name).alias("TableName"), F.lit(i).alias("Position"), F.lit(c).alias("Column"), F.count(F.col(c)).alias("NonNull"))
            for i, c in enumerate(df.columns)
        ]
        parts.append(df.agg(F.array(*entries).alias("e")).select(F.inline("e")))
    return reduce(DataFrame.unionByName, parts)
