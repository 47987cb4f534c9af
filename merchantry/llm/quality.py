"""Quality rules on documents, with verdicts on whole hosts. DataFrame functions only.

Rules of one text
    ``n_words``, ``word_chars`` (code points in words), ``n_symbols`` (characters of ``#*$%&|<>``), ``n_dup_lines`` (lines with a word that
    equal an earlier line) and ``n_repeat_words`` (words inside three-word windows that occur twice or more in the text). A text fails when it
    has fewer than ``min_words`` words or ``100 * n_repeat_words > max_repeat * n_words``.

Verdict on hosts
    Failures are counted by host. The hosts' failure rates have an empirical beta prior, fitted by moments after taking off the part of their
    variance that binomial sampling explains; a host's rate is its posterior mean. A host whose rate is over ``max_host_rate`` is rejected with all
    its documents. A host with few documents stays near the prior, so it isn't rejected for one bad page.

Defined cases: a null or empty text has no words and fails; a null host is a host of its own; repeated rows are judged and counted each; an empty table
gives an empty result; other columns pass through, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchantry.llm.common import SPACES, stored, words

SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measured(rows: DataFrame, text: Column) -> DataFrame:
    """``rows`` with a struct ``_m`` of the five measures. All work stays in the row: nothing is exploded or shuffled."""
    body = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    out = rows.withColumn("_w", words(body)).withColumn("_lines", lines)
    gram = F.transform(
        F.sequence(F.lit(0), F.size("_w") - 3),
        lambda i: F.struct(F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)).alias("h"), i.alias("i")),
    )
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    out = out.withColumn("_g", F.sort_array(F.when(F.size("_w") >= 3, gram).otherwise(none)))
    same = F.filter(
        "_g",
        lambda x, j: F.coalesce(x["h"] == F.get("_g", j + 1)["h"], F.lit(False))
        | F.coalesce(x["h"] == F.get("_g", j - 1)["h"], F.lit(False)),
    )
    # Windows that repeat start at these places; each covers three words, less where the next one starts sooner.
    out = out.withColumn("_p", F.sort_array(F.transform(same, lambda x: x["i"])))
    gaps = F.transform("_p", lambda p, j: F.least(F.lit(3), F.coalesce(F.get("_p", j + 1) - p, F.lit(3))))
    measures = F.struct(
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.translate(body, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_repeat_words"),
    )
    return out.withColumn("_m", measures).drop("_w", "_lines", "_g", "_p")


def host_verdicts(judged: DataFrame, *, max_host_rate: float) -> DataFrame:
    """(host, n, failed, rate, host_rejected) from rows with ``_host`` and ``_failed``."""
    hosts = stored(judged.groupBy("_host").agg(F.count("*").alias("n"), F.sum(F.col("_failed").cast("long")).alias("failed")), "host-counts")
    share = F.col("failed") / F.col("n")
    prior = hosts.agg(F.avg(share).alias("m"), F.coalesce(F.var_pop(share), F.lit(0.0)).alias("v"), F.avg(1 / F.col("n")).alias("inv"))
    m, v, inv = prior.first()
    m = m or 0.0
    # What binomial sampling adds to the rates' variance isn't the prior's; the prior weighs as much as one document at least.
    spread = max((v or 0.0) - m * (1 - m) * (inv or 0.0), 1e-6)
    strength = max(m * (1 - m) / spread - 1, 1.0)
    rate = (F.col("failed") + m * strength) / (F.col("n") + strength)
    return hosts.select("_host", "n", "failed", rate.alias("rate"), (rate > max_host_rate).alias("_host_rejected"))


def _with_row(docs: DataFrame, text: str, host: str, carry: list[str] | None) -> DataFrame:
    kept = [F.col(c) for c in (docs.columns if carry is None else carry)]
    return docs.select(F.struct(*kept).alias("row"), F.col(text).alias("_text"), F.col(host).alias("_host"))


def _failed(min_words: int, max_repeat: int) -> Column:
    m = F.col("_m")
    return (m["n_words"] < min_words) | (100 * m["n_repeat_words"] > max_repeat * m["n_words"])


def judge(
    docs: DataFrame,
    *,
    text: str = "text",
    host: str = "source",
    carry: list[str] | None = None,
    min_words: int = 50,
    max_repeat: int = 50,
    max_host_rate: float = 0.9,
) -> DataFrame:
    """One row per document: ``row`` (a struct of the columns in ``carry``, all by default), the measures, ``base_failed`` and ``kept``.

    The measures are written once; the hosts' counts and the verdicts both read that table. The hosts' table is written too, so the planner knows its size:
    a small one is broadcast, a large one is joined by host with hot hosts split by adaptive execution.
    """
    rows = _with_row(docs, text, host, carry)
    judged = measured(rows, F.col("_text")).withColumn("_failed", _failed(min_words, max_repeat)).select("row", "_host", "_m", "_failed")
    judged = stored(judged, "quality")
    hosts = stored(host_verdicts(judged, max_host_rate=max_host_rate).select(F.col("_host").alias("_h"), "_host_rejected"), "hosts")
    out = judged.join(hosts, judged["_host"].eqNullSafe(hosts["_h"]), "left")
    return out.select(
        "row",
        *(F.col(f"_m.{c}").alias(c) for c in MEASURES),
        F.col("_failed").alias("base_failed"),
        (~F.col("_failed") & ~F.coalesce(F.col("_host_rejected"), F.lit(False))).alias("kept"),
    )


def kept_documents(
    docs: DataFrame, *, text: str = "text", host: str = "source", min_words: int = 50, max_repeat: int = 50, max_host_rate: float = 0.9
) -> DataFrame:
    """The documents that :func:`judge` keeps, with their own columns.

    Texts are measured twice, once for the hosts' counts and once to filter, so that no copy of them is written in between.
    """
    failed = _failed(min_words, max_repeat)
    counted = measured(docs.select(F.col(text).alias("_text"), F.col(host).alias("_host")), F.col("_text")).select("_host", failed.alias("_failed"))
    hosts = stored(host_verdicts(counted, max_host_rate=max_host_rate).select(F.col("_host").alias("_h"), "_host_rejected"), "hosts")
    # As a generator and not as a filter: the planner would push a filter down and repeat the measures inside it.
    passed = F.explode(F.when(~failed, F.array(F.struct("row", "_host")))).alias("p")
    rows = measured(_with_row(docs, text, host, None), F.col("_text")).select(passed).select("p.row", "p._host")
    out = rows.join(hosts, rows["_host"].eqNullSafe(hosts["_h"]), "left")
    return out.filter(~F.coalesce(F.col("_host_rejected"), F.lit(False))).select("row.*")
