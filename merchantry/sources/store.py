"""Where warehouse layers are written: the shared folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import hashlib
import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder. A temporary folder is only ever made for a local session without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="merchantry-")
        spark.conf.set("spark.checkpoint.dir", folder)
        return folder
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def keep_checkpoints(spark: SparkSession) -> None:
    """Have the session write checkpoints, to the shared folder unless it has a place. Without them a round of boosting carries the plans of all rounds before it."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_folder(spark)}/checkpoints")


class TableStore:
    """Parquet tables under one folder per application and input."""

    def __init__(self, spark: SparkSession, scope: str) -> None:
        digest = hashlib.sha1(scope.encode()).hexdigest()[:12]
        self.spark = spark
        self.root = f"{shared_folder(spark)}/merchantry/{spark.sparkContext.applicationId}/{digest}"

    def save(self, name: str, df: DataFrame) -> DataFrame:
        """Write the table and return a reader of it, so later plans start from the files."""
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
