"""Quality rules, mixing and shards: brute force and defined cases."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from merchantry.llm import mixing, quality, sharding
from merchantry.llm.common import weighted_cuts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    w = WORD.findall(text)
    grams = Counter(zip(w, w[1:], w[2:]))
    hit = {p + k for p, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(hit))


def documents(n=300, seed=3):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        words = [r.choice(["a", "bé", "c#", "日", "e|e", "f"]) + (str(r.randrange(400)) if i % 3 else "") for _ in range(r.randrange(0, 160))]
        text = "".join(w + r.choice([" ", "\n", "  ", "\t", "\x0b"]) for w in words)
        rows.append((i, None if i % 37 == 0 else text, r.choice(["en", "de", None]), f"s{i % 6}" if i % 5 else "hot" if i % 10 else None))
    return rows + rows[:5]


SCHEMA = "doc_id long, text string, lang string, source string"


def test_measures_and_verdicts(spark):
    rows = documents()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = quality.judge(df).select("row.doc_id", *quality.MEASURES, "base_failed", "kept").collect()
    want = []
    for i, t, _, _ in rows:
        m = measures(t)
        want.append((i, *m, m[0] < 50 or 100 * m[4] > 50 * m[0]))
    assert sorted(tuple(r)[:-1] for r in got) == sorted(want)
    assert all(not (r["kept"] and r["base_failed"]) for r in got)
    kept = quality.kept_documents(df.withColumn("kept", F.lit(1)))
    assert kept.columns == [*df.columns, "kept"]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in got if r["kept"])


def test_a_bad_host_goes_with_its_good_pages(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(i, "spam", "en", "bad") for i in range(200)] + [(200, good, "en", "bad")]
    rows += [(300 + i, good, "en", f"ok{i % 7}") for i in range(70)] + [(400, "spam", "en", "one page")]
    out = {r["doc_id"]: r["kept"] for r in quality.judge(spark.createDataFrame(rows, SCHEMA)).select("row.doc_id", "kept").collect()}
    assert not out[200] and all(out[300 + i] for i in range(70)) and not out[400]


def test_rules_keep_clashing_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "x", "en", None, 5)], SCHEMA + ", kept int").withColumnRenamed("lang", "_m")
    out = quality.judge(df)
    assert out.select("row.*").columns == df.columns and out.count() == 1
    assert quality.judge(df.limit(0)).count() == 0


def filled(sizes, weights, budget, epochs):
    free, level = set(range(len(sizes))), 0.0
    while free:
        left = budget - sum(epochs * sizes[i] for i in range(len(sizes)) if i not in free)
        level = left / sum(weights[i] for i in free)
        over = {i for i in free if level * weights[i] > epochs * sizes[i]}
        if not over:
            break
        free -= over
    return [level * weights[i] if i in free else epochs * sizes[i] for i in range(len(sizes))]


def test_mix_meets_targets(spark):
    rows = documents(2000)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    out = [tuple(r) for r in mixing.mixed(df, range_rows=20).select("row.doc_id", "row.source", "size", "source_size", "target", "copies").collect()]
    size = Counter()
    for _, t, _, s in rows:
        size[s] += len(WORD.findall(t or ""))
    names = sorted((s for s in size if s is not None)) + [None]
    want = dict(zip(names, filled([size[s] for s in names], [[3, 1, 2][i % 3] for i in range(len(names))], 1.5 * sum(size.values()), 2), strict=True))
    taken, largest = Counter(), Counter()
    for _, s, n, whole, target, copies in out:
        assert whole == size[s] and target == pytest.approx(want[s]) and 0 <= copies <= 2
        taken[s] += n * copies
        largest[s] = max(largest[s], n)
    assert all(abs(taken[s] - want[s]) <= largest[s] for s in names) and sum(taken.values()) <= 1.5 * sum(size.values())
    again = mixing.mixed(df.repartition(2), range_rows=7).select("row.doc_id", "row.source", "size", "source_size", "target", "copies").collect()
    assert sorted(map(str, map(tuple, again))) == sorted(map(str, out))


def test_mix_rows_and_empty_input(spark):
    df = spark.createDataFrame([(1, "a b c", "en", "s", 1), (2, None, None, None, 2)], SCHEMA + ", copies int")
    out = mixing.mix(df)
    assert out.columns == df.columns and {r["doc_id"] for r in out.collect()} <= {1, 2}
    assert mixing.mix(df.limit(0)).count() == 0


@pytest.mark.parametrize("shards", [8, 5, 1])
def test_shards_have_equal_bytes(spark, shards):
    rows = documents(3000)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    out = sharding.kd_shards(df, shards=shards, carry=["doc_id", "text"]).collect()
    assert len(out) == len(rows)
    total, slots = Counter(), {}
    for r in out:
        raw = (r["row"]["text"] or "").encode()
        assert r["size"] == len(raw) + 1 and r["crc"] == zlib.crc32(raw)
        total[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert sorted(total) == list(range(shards))
    mean = sum(total.values()) / shards
    assert all(abs(v - mean) < 0.05 * mean for v in total.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_shards_of_copies_and_of_nothing(spark):
    one = spark.createDataFrame([(i, "same text", "en", "s") for i in range(80)], SCHEMA)
    out = Counter(r["shard"] for r in sharding.kd_shards(one, shards=4).collect())
    assert sorted(out.values()) == [20] * 4  # a group larger than a shard is cut
    assert sharding.kd_shards(one.limit(0)).count() == 0
    same = spark.createDataFrame([(None, None, None, None)] * 9, SCHEMA)
    assert sharding.kd_shards(same).count() == 9


def test_weighted_cuts(spark):
    r = random.Random(1)
    rows = [(r.randrange(2), r.choice([r.randrange(1 << 60), 5, (1 << 60) - 1]), r.randrange(50)) for _ in range(500)]
    df = spark.createDataFrame(rows, "g int, k long, w long")
    for goals in ({0: 3000.5, 1: 10}, {0: 0, 1: 1e9}):
        got = weighted_cuts(df, df["g"], df["k"], df["w"], goals)
        for g, goal in goals.items():
            below, want = 0, None
            for k in sorted({x[1] for x in rows if x[0] == g}):
                here = sum(x[2] for x in rows if x[0] == g and x[1] == k)
                if below + here > goal:
                    want = (k, below, here)
                    break
                below += here
            assert got.get(g) == want


def test_shards_of_one_row_many_times(spark):
    kind = "doc_id long, text string, source string, lang string"
    df = spark.createDataFrame([(7, "same words", "s", "en")] * 800 + [(None, "x", None, None)] * 80 + [(1, None, "t", "en")], kind)
    rows = sharding.kd_shards(df).collect()
    sizes = Counter()
    for r in rows:
        sizes[r["shard"]] += r["size"]
    assert len(rows) == 881 and set(sizes) == set(range(8))
    assert max(sizes.values()) - min(sizes.values()) <= 3 * 11
    for s in sizes:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
