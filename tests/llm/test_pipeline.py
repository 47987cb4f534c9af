"""The pipeline against a plain Python version of its stages on a small corpus."""

import base64
import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from merchantry.llm import pii, tagger
from tests.llm.test_pairs import WORD, brute_groups
from tests.llm.test_rows import filled, measures

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    r = random.Random(8)
    words = [a + b + c for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]
    rows = []
    for i in range(240):
        text = [r.choice(words) for _ in range(r.randrange(30, 200))]
        if i % 9 == 0:
            text[5] = "jo.1@mail2.example.com,"
        if i % 11 == 0:
            text[8] = "+1 (811) 555-3281"
        rows.append([i, " ".join(text), "en", f"s{i % 4}", 0])
    for i in range(240, 280):
        text = rows[i - 200][1].split(" ")
        text[-1] = "changed"
        rows.append([i, " ".join(text), "de", f"s{i % 3}", 0])
    rows += [[280, None, "en", "s0", None], [281, "", None, None, 0]]
    return [(i, t, lang, s, len(t or "")) for i, t, lang, s, _ in rows]


def plain_version(rows):
    """doc_id -> text after the first three stages."""
    kept = []
    for row in rows:
        m = measures(row[1])
        if m[0] >= 50 and 100 * m[4] <= 50 * m[0]:
            kept.append(row)
    first = {kept[i][0]: kept[c][0] for i, _, c in brute_groups([(k, row[1]) for k, row in enumerate(kept)])}
    kept = [row for row in kept if first[row[0]] == row[0]]
    model, out = tagger.trained(), {}
    for i, text, _, source, _ in kept:
        spans = pii.find([text], model, 48)[0]
        out[i] = (pii.redacted(text, [(s, e, pii.KINDS[k]) for s, k, e, _ in spans]), source)
    return out


def test_stages(spark, tmp_path):
    rows = corpus()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    want = plain_version(rows)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns
    got = {r["doc_id"]: (r["text"], r["source"]) for r in docs.collect()}
    assert got == want and 0 < len(got) < 240 and any("[EMAIL]" in t for t, _ in got.values())

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = entry.queries()["pipeline"](spark, str(tmp_path)).collect()
    size, taken, largest = Counter(), Counter(), Counter()
    for text, source in want.values():
        n = len(WORD.findall(text))
        size[source] += n
        largest[source] = max(largest[source], n)
    for r in out:
        text, source = want[r["doc_id"]]
        ids = library.encode_ordinary(text)
        raw = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (r["source"], r["n_tokens"], base64.b64decode(r["ids_base64"])) == (source, len(ids), raw)
        assert r["ids_sha256"] == hashlib.sha256(raw).hexdigest() and r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        taken[source] += len(WORD.findall(text))
    names = sorted(size)
    goals = filled([size[s] for s in names], [[3, 1, 2][i % 3] for i in range(len(names))], 1.5 * sum(size.values()), 2)
    assert all(abs(taken[s] - g) <= largest[s] for s, g in zip(names, goals, strict=True))
    assert max(Counter(r["doc_id"] for r in out).values()) <= 2


def test_an_empty_corpus_passes_through(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("number", range(1, 11))
def test_registered_queries_have_their_columns(spark, number):
    columns = {
        1: "doc_id n_shingles component_id", 2: "doc_id n_words n_removed kept_sha256", 3: "page_id url text n_chars",
        4: "query_id rank vec_id score", 5: "doc_id n_bytes n_tokens over_limit", 6: "doc_id n_tokens ids_sha256 decoded_sha256",
        7: "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
        8: "doc_id n_email n_ip n_card n_phone base_sha256 spans", 9: "doc_id size source_size target taken",
        10: "doc_id size text_crc32 law shard slot grown_shard",
    }
    name = next(n for n in entry.queries() if n.startswith(f"op{number}_"))
    out = entry.queries()[name](spark, "/root/testdata/sf0.001")
    assert out.columns == columns[number].split()
    table, key = ("pages", "page_id") if number == 3 else ("embeddings", "vec_id") if number == 4 else ("documents", "doc_id")
    rows = spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet")
    assert out.count() == (rows.filter(F.col(key) % 100 == 0).count() * 10 if number == 4 else rows.count())


def test_stages_take_one_python_worker_a_task(spark):
    """Idle workers are kept by Spark, so what a stage takes at once is in the executor's memory in the next ones too."""
    docs = spark.createDataFrame([(1, "jo.1@mail2.example.com, or +1 (811) 555-3281", "en", "s", 0), (2, None, None, None, None), (2, "", "en", "s", 0)], SCHEMA)
    for stage in (corpus_pipeline.personal_data, corpus_pipeline.token_ids):
        plan = stage(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1
    use = pii.Detector(spark)
    new = docs.withColumn("spans", use.spans(F.col("text"))).select(use.redact(F.col("text"), F.col("spans")).alias("a"), use.replaced(F.col("text")).alias("b"))
    assert sorted(map(str, {(r["a"], r["b"]) for r in new.collect()})) == ["('', '')", "('[EMAIL], or [PHONE]', '[EMAIL], or [PHONE]')", "(None, None)"]
