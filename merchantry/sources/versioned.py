"""Tables in versions: written aside, audited, and published by one atomic step; keyed updates rewrite only the parts that hold their keys.

A table is a folder of parts and a folder of manifests. Parts are written first, under a name that no other write has. A manifest lists the parts of one version and is moved into place last, under the next number, in a
step that fails if the number is taken. Readers take the manifest of the highest number, so they see a whole version or the one before; what a lost driver left behind is in no manifest and is removed by :meth:`VersionedTable.vacuum`.

Parts are ranges of the key, with their lower bounds in the manifest. A merge looks up which ranges hold the updated keys, reads and rewrites those, and takes over the other parts as they are.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Audit = Callable[[DataFrame], None]
BUCKET = "_bucket"


class Folder:
    """Files below a path of any file system that Spark knows."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(self._conf)

    def _at(self, name: str):
        return self._path(f"{self.root}/{name}")

    def names(self, name: str) -> list[str]:
        at = self._at(name)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def publish(self, name: str, text: str) -> None:
        """A file that appears with its whole text at once, or an error if there is one of that name."""
        aside = f"{name}.{uuid.uuid4().hex}.tmp"
        stream = self._fs.create(self._at(aside), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        sc = self.spark.sparkContext
        options = sc._gateway.new_array(getattr(sc._jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
        # A rename without the option to overwrite fails where the target exists.
        context = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        context.rename(self._fs.makeQualified(self._at(aside)), self._fs.makeQualified(self._at(name)), options)


class VersionedTable:
    """One table in versions. ``key``: a column of whole numbers, unique; rows without one belong to the first range."""

    def __init__(self, spark: SparkSession, root: str, key: str) -> None:
        self.spark, self.key = spark, key
        self.folder = Folder(spark, root)
        self.root = self.folder.root

    def version(self) -> int:
        """The number of the newest version, 0 before the first."""
        numbers = [int(n[:-5]) for n in self.folder.names("manifests") if n.endswith(".json")]
        return max(numbers, default=0)

    def manifest(self, version: int | None = None) -> dict:
        number = self.version() if version is None else version
        if not number:
            raise LookupError(f"{self.root} has no version yet")
        return json.loads(self.folder.read(f"manifests/{number:012d}.json"))

    def read(self, version: int | None = None, parts: list[int] | None = None) -> DataFrame:
        """A whole version, or some of its ranges."""
        m = self.manifest(version)
        schema = T.StructType.fromJson(m["schema"])
        paths = [f"{self.root}/{p}" for i, p in sorted((int(i), p) for i, p in m["parts"].items()) if parts is None or i in parts]
        return self._parts(schema, paths)

    def _parts(self, schema: T.StructType, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _range(self, bounds: list[int]) -> Column:
        """The number of the range of a key: how many bounds are at or below it."""
        if not bounds:
            return F.lit(0)
        return F.size(F.filter(F.array(*[F.lit(b).cast("long") for b in bounds]), lambda b: F.coalesce(b <= F.col(self.key), F.lit(False))))

    def _write(self, rows: DataFrame, bounds: list[int]) -> dict[int, str]:
        """Write rows aside, a folder for each range; range -> folder."""
        name = f"data/{uuid.uuid4().hex}"
        dealt = rows.withColumn(BUCKET, self._range(bounds)).repartition(len(bounds) + 1, BUCKET)
        dealt.write.partitionBy(BUCKET).parquet(f"{self.root}/{name}")
        return {int(n.partition("=")[2]): f"{name}/{n}" for n in self.folder.names(name) if n.startswith(BUCKET)}

    def _publish(self, after: int, schema: T.StructType, bounds: list[int], parts: dict[int, str], audit: Audit | None) -> int:
        rows = self._parts(schema, [f"{self.root}/{p}" for p in parts.values()])
        twice = rows.filter(F.col(self.key).isNotNull()).groupBy(self.key).count().filter("count > 1").limit(1).collect()
        if twice:
            raise ValueError(f"{self.key} {twice[0][0]} stands on more than one row")
        if audit:
            audit(rows)
        text = {"schema": schema.jsonValue(), "bounds": bounds, "parts": {str(i): p for i, p in sorted(parts.items())}}
        self.folder.publish(f"manifests/{after + 1:012d}.json", json.dumps(text))
        return after + 1

    def replace(self, rows: DataFrame, *, ranges: int = 16, audit: Audit | None = None) -> int:
        """Publish ``rows`` as the next version; its number. Ranges hold about equally many rows. ``audit`` reads what was written and raises to keep it from being published."""
        before = self.version()
        steps = [i / ranges for i in range(1, ranges)]
        cuts = rows.agg(F.percentile_approx(F.col(self.key).cast("long"), steps, 10_000)).first()[0] if steps else None
        bounds = sorted(set(cuts or []))
        return self._publish(before, rows.schema, bounds, self._write(rows, bounds), audit)

    def merge(self, updates: DataFrame, *, audit: Audit | None = None) -> int:
        """Publish a version in which the columns of ``updates`` replace those of the rows of the same key, and rows of new keys are added; its number.

        A null in an update replaces too. Updates without a key are refused. Ranges without an updated key keep their files.
        """
        before = self.version()
        m = self.manifest(before)
        schema, bounds = T.StructType.fromJson(m["schema"]), m["bounds"]
        if not updates.filter(F.col(self.key).isNull()).isEmpty():
            raise ValueError(f"an update without {self.key}")
        # A row per range at most reaches the driver.
        touched = sorted(r[0] for r in updates.select(self._range(bounds).alias(BUCKET)).distinct().collect())
        if not touched:
            return before
        own = [c for c in updates.columns if c != self.key]
        new = updates.select(F.col(self.key).alias("_key"), F.lit(True).alias("_new"), *[F.col(c).alias(f"_u_{c}") for c in own])
        old = self.read(before, touched)
        both = old.join(new, old[self.key] == new["_key"], "full_outer")

        def mixed(f: T.StructField) -> Column:
            if f.name == self.key:
                out = F.coalesce(f.name, "_key")
            elif f.name in own:
                out = F.when(F.col("_new"), F.col(f"_u_{f.name}")).otherwise(F.col(f.name))
            else:
                out = F.col(f.name)
            return out.cast(f.dataType).alias(f.name)

        written = self._write(both.select(*[mixed(f) for f in schema]), bounds)
        parts = {int(i): p for i, p in m["parts"].items() if int(i) not in touched} | written
        return self._publish(before, schema, bounds, parts, audit)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete all manifests but the newest ``keep``, and parts that no manifest left names, such as those of writes that never ended; the part folders deleted. Not to be run while a write is under way."""
        numbers = [n for n in self.folder.names("manifests") if n.endswith(".json")]
        for n in self.folder.names("manifests"):
            if n not in numbers[-keep:]:
                self.folder.delete(f"manifests/{n}")
        used = {p for n in numbers[-keep:] for p in json.loads(self.folder.read(f"manifests/{n}"))["parts"].values()}
        gone = []
        for n in self.folder.names("data"):
            parts = [f"data/{n}/{part}" for part in self.folder.names(f"data/{n}") if part.startswith(BUCKET)]
            lost = [p for p in parts if p not in used]
            for p in lost:
                self.folder.delete(p)
            if len(lost) == len(parts):
                self.folder.delete(f"data/{n}")
            gone += lost
        return gone
