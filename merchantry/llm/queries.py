"""The thin queries over the operators of this package, with their contracts' columns and parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merchantry.llm import bpe, collocations, html, language, mixing, neighbours, ngram_join, pii, quality, sharding, substring, tokens, whitening
from merchantry.llm.common import table


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ngram_join.groups(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), F.col("component").alias("component_id"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.deduplicated(table(spark, sf_dir, "documents"), with_text=False)
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = html.with_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = tokens.with_token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    return out.select("doc_id", size.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    codec = bpe.Codec(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    out = docs.select("doc_id", codec.round_trip(F.col("text")).alias("both")).select("doc_id", "both.ids", "both.decoded")
    return out.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("row.doc_id", *quality.MEASURES, "base_failed", "kept")


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pii.with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))))

    def count(kind):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda x: x["base"])
    return docs.withColumn("base", base).select(
        "doc_id", *(count(k) for k in pii.KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )


def op9_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mixed(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op10_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.kd_shards(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return out.select(
        "row.doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_language_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language.with_language(docs).select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op12_feast_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.phrases(table(spark, sf_dir, "documents"))


QUERIES = (op1_ngram_join, op2_substring_dedup, op3_main_text, op4_cross_polytope, op5_token_counts, op6_byte_bpe, op7_host_quality, op8_personal_data, op9_fair_mix, op10_kd_shards, op11_language_net, op12_feast_whitening, op13_collocations)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}
