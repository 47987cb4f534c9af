"""From raw documents to training tokens: quality rules, near copies, personal data, source mix, token ids.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept; its result is written as Parquet and read again as the next one's input. All stages but the last return the
columns of ``documents``. A document that the mix takes twice is two rows from there on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchantry.llm import bpe, mixing, ngram_join, pii, quality
from merchantry.llm.common import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules go, and those of rejected hosts."""
    return quality.kept_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest doc_id stays."""
    return ngram_join.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind; ``n_chars`` is that of the new text."""
    out = pii.without_personal_data(docs)
    size = F.length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None
    return out if size is None else out.withColumn("n_chars", F.coalesce(size, "n_chars"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document of the mix: its token ids (32-bit little-endian, in base 64), and the digests of ids and decoded bytes."""
    codec = bpe.Codec(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = docs.select("doc_id", "source", codec.round_trip(F.col("text")).alias("both")).select("doc_id", "source", "both.ids", "both.decoded")
    return rows.select(
        "doc_id", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.base64("ids").alias("ids_base64"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_copies),
    ("personal data", personal_data),
    ("mixing sources", source_mix),
    ("byte-level BPE", token_ids),
]

#: The trained tagger, and merges of byte pairs, are beyond SQL; the tests hold the pipeline against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
