"""Token counts and byte-level BPE against the public libraries."""

import base64
import random
import struct

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as entry
from merchantry.llm import bpe, tokens

PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def texts():
    r = random.Random(0)
    odd = ["", " ", "  a  b", "a" * 3000, " " * 900, "\t\n" * 300, "日本語 x́ ①😀\n", "<s></s><|endoftext|>", "ab" * 900 + " cd" * 900, "▁ ▁" * 200]
    return odd + ["".join(r.choice("ab é日 \n😀'st1.,") for _ in range(n)) for n in (10, 500, 6000)] + [" ".join("wort" * r.randrange(1, 4) for _ in range(2000))]


@pytest.mark.parametrize("chunk,overlap", [(300, 8), (2000, 64), (32768, 512)])
def test_spliced_counts_are_those_of_the_whole(chunk, overlap):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    use = tokens.PieceCounter(PIECES, chunk, overlap)
    assert use.identity
    assert use.many(texts()) == [len(library.encode(t)) for t in texts()]


def test_counts_column(spark):
    df = spark.createDataFrame([(1, "two words", "x"), (2, None, "y"), (2, None, "y")], "doc_id long, text string, n_tokens string")
    out = tokens.with_token_counts(df, PIECES, chunk=64, overlap=4)
    assert out.columns == df.columns and sorted(r["n_tokens"] for r in out.collect()) == [0, 0, 2]
    json = tokens.with_token_counts(df, public_tokenizers.path("byte_bpe_50k.json"))
    assert max(r["n_tokens"] for r in json.collect()) == 2
    assert tokens.with_token_counts(df.limit(0), PIECES).count() == 0


def test_perfect_hash_is_minimal():
    keys = [f"key{i}".encode() for i in range(997)]
    use = bpe.PerfectHash(keys)
    assert sorted(use.slot(k) for k in keys) == list(range(997))
    assert bpe.PerfectHash([b"only"]).slot(b"only") == 0


def test_ids_are_those_of_the_library(spark):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = list(enumerate([*texts(), None, "twice", "twice"]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    codec = bpe.Codec(spark, RANKS, public_tokenizers.PATTERN, remember=50)
    out = df.select("doc_id", codec.encode(F.col("text")).alias("ids"))
    out = out.withColumn("decoded", codec.decode(F.col("ids"))).collect()
    for r in out:
        text = rows[r["doc_id"]][1] or ""
        assert list(struct.unpack(f"<{len(r['ids']) // 4}I", bytes(r["ids"]))) == library.encode_ordinary(text)
        assert bytes(r["decoded"]).decode() == text
    assert bpe.encoded(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_round_trip_is_one_python_step(spark, tmp_path):
    rows = list(enumerate([*texts(), None, "twice", "twice", *(f"w{i} x{i % 7}" for i in range(2 * bpe.AT_ONCE))]))
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    codec = bpe.Codec(spark, RANKS, public_tokenizers.PATTERN, remember=20)
    both = df.select("doc_id", codec.round_trip(F.col("text")).alias("both")).select("doc_id", "both.ids", "both.decoded")
    out = df.select("doc_id", codec.encode(F.col("text")).alias("ids"))
    out = out.withColumn("decoded", codec.decode(F.col("ids")))
    assert sorted(both.collect()) == sorted(out.collect())
    assert {r["doc_id"]: bytes(r["decoded"]).decode() for r in both.collect()} == {i: t or "" for i, t in rows}
    df.write.parquet(f"{tmp_path}/documents.parquet")
    plan = entry.queries()["op6_byte_bpe"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_results_are_handed_on_in_parts():
    taken = []

    def batches():
        for n in (300, 0, 5):
            taken.append(n)
            yield pa.array([str(i) for i in range(n)])

    parts = bpe.in_parts(batches(), 128)
    assert len(next(parts)) == 128 and taken == [300]
    assert [len(x) for x in parts] == [128, 44, 5]
