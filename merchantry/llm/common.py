"""Shared pieces: intermediate tables, word handling, and exact weighted cuts of a huge ordering."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchantry.sources.store import shared_folder

#: The white space between words: space and the control characters tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet below the cluster's shared folder and return a reader of it.

    Later plans start from these files, so a lost executor costs its own tasks only, and their size is known to the planner. The writing job's
    shuffle files are deleted when it ends, as nothing reads them again; otherwise they would stay until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(table_: DataFrame) -> None:
    """Delete a table that :func:`stored` wrote and that no later step reads."""
    spark = table_.sparkSession
    folder = f"/llm/{spark.sparkContext.applicationId}/"
    for name in table_.inputFiles()[:1]:
        top, _, rest = name.partition(folder)
        if rest:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(top + folder + rest.split("/")[0])
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def words(text: Column) -> Column:
    """The words of a text, as an array; null gives none. Java splits by a single blank without a regular expression."""
    flat = F.translate(F.coalesce(text, F.lit("")), SPACES[1:], " " * (len(SPACES) - 1))
    return F.array_remove(F.split(flat, " "), "")


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def digest_bits(value: Column, bits: int = 60) -> Column:
    """The first ``bits`` (a multiple of 4, 60 at most) of the value's MD5 as a number; the same in every engine."""
    return F.conv(F.substring(F.md5(value), 1, bits // 4), 16, 10).cast("long")


def lookup(values: Mapping[int, int | float], key: Column, default: int | float) -> Column:
    """A small driver-side mapping as an expression."""
    if not values:
        return F.lit(default)
    entries = [F.lit(x) for pair in values.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*entries), key), F.lit(default))


def weighted_cuts(
    items: DataFrame, group: Column, key: Column, weight: Column, targets: Mapping[int, float], *, digit_bits: int = 12
) -> dict[int, tuple[int, int, int]]:
    """For each group, the first key at which the running weight in key order goes beyond the group's target.

    Keys are whole numbers from 0 to 2**60 - 1 and weights are not negative. Each round counts the weight by the next ``digit_bits`` bits of
    the keys that share the prefix found so far, so the driver only sees 2**digit_bits sums a group and no task sorts a group.

    Returns group -> (key, weight below the key, weight at the key); groups whose whole weight fits the target are left out.
    """
    state = {g: (0, float(t), 0) for g, t in targets.items()}
    found: dict[int, tuple[int, int, int]] = {}
    rows = items.select(group.cast("int").alias("g"), key.alias("k"), weight.cast("long").alias("w"))
    shift = 60
    while state and shift > 0:
        shift -= digit_bits
        prefix = lookup({g: p for g, (p, _, _) in state.items()}, F.col("g"), -1)
        sums = (
            rows.filter(F.shiftright("k", shift + digit_bits) == prefix)
            .groupBy("g", F.shiftright("k", shift).alias("p"))
            .agg(F.sum("w").alias("w"), F.min("k").alias("lo"), F.max("k").alias("hi"))
            .collect()
        )
        after: dict[int, tuple[int, float, int]] = {}
        for g, (_, left, below) in state.items():
            for r in sorted((r for r in sums if r["g"] == g), key=lambda r: r["p"]):
                if r["w"] > left:
                    if r["lo"] == r["hi"]:
                        found[g] = (r["lo"], below, r["w"])
                    else:
                        after[g] = (r["p"], left, below)
                    break
                left -= r["w"]
                below += r["w"]
        state = after
    return found
