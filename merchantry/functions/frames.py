"""Small literal tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_rows(spark: SparkSession, fields: Sequence[tuple[str, str]], rows: Sequence[tuple]) -> DataFrame:
    """A table of a few literal rows (at least one), with ``fields`` = (name, SQL type). It is part of the plan, so
    no task has to fetch it from Python."""

    def value(v, kind: str, name: str):
        lit = F.array(*[F.lit(x) for x in v]) if isinstance(v, (list, tuple)) else F.lit(v)
        return lit.cast(kind).alias(name)

    structs = [F.struct(*[value(v, kind, name) for v, (name, kind) in zip(r, fields, strict=True)]) for r in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
