"""Language ID, whitening and phrase mining: gradients, held-out accuracy, brute force, defined cases."""

import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from merchantry.llm import collocations, feast, language, langnet, whitening

GIVEN = "/root/testdata/sf0.01"


# Language ID


def test_convolution_is_the_sum_over_bytes():
    model = langnet.Network(3, size=2, filters=2, seed=1)
    x = langnet.windows(b"abcdefgh\xff\x00xyz", 13)
    top, _ = model.pooled(x)
    for i, width in enumerate(langnet.WIDTHS):
        for f in range(2):
            w = model.p["filters"][:, i * 2 + f].reshape(-1, 2)
            assert not w[width:].any()
            best = max(sum(float(model.p["byte"][x[0, t + k]] @ w[k]) for k in range(width)) for t in range(13 - model.reach + 1))
            assert top[0, i * 2 + f] == pytest.approx(max(best, 0), rel=1e-5, abs=1e-6)
    assert np.exp(model.log_chances(x)).sum() == pytest.approx(1, rel=1e-5)


def test_gradient_of_the_network():
    model = langnet.Network(3, size=2, filters=2, seed=1)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    r = np.random.Generator(np.random.PCG64(0))
    x, y = r.integers(97, 105, (5, 12)).astype(np.int16), r.integers(0, 3, 5)
    _, grad = model.loss_and_gradient(x, y)
    for name, g in grad.items():
        for _ in range(6):
            at = tuple(int(r.integers(0, n)) for n in g.shape)
            if name == "filters" and not model.mask[at]:
                continue
            was = model.p[name][at]
            model.p[name][at] = was + 1e-6
            up = model.loss_and_gradient(x, y)[0]
            model.p[name][at] = was - 1e-6
            down = model.loss_and_gradient(x, y)[0]
            model.p[name][at] = was
            assert g[at] == pytest.approx((up - down) / 2e-6, rel=1e-3, abs=1e-6)


def test_windows_cover_all_bytes():
    assert langnet.windows(b"", 4).tolist() == [[langnet.PAD] * 4]
    assert langnet.windows(b"abcde", 4).tolist() == [[97, 98, 99, 100], [101, langnet.PAD, langnet.PAD, langnet.PAD]]


@pytest.mark.skipif(not os.path.isdir(GIVEN), reason="needs the given tables")
def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{GIVEN}/documents.parquet").select("doc_id", "text", "lang")
    out = language.with_language(docs).withColumn("held_out", language.held_out(F.col("doc_id")))
    held = out.filter("held_out AND lang IS NOT NULL AND lang_pred <> 'und'").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert held[0] > 0.97 and held[1] > 200


def _spoken(spark):
    r = random.Random(5)
    talk = {"xx": "kala mota vasu pilo", "yy": "strng grumpf kvetch blorp"}
    rows = [(i, " ".join(r.choice(talk[lang].split()) for _ in range(30)), lang, "a") for i, lang in enumerate(["xx", "yy"] * 60)]
    rows += [(1000, None, "xx", "b"), (1000, None, "xx", "b"), (1001, "", "yy", "c"), (1002, "12 34 --", "xx", None), (None, "kala mota", None, "d"), (1003, "kala mota " * 60_000, None, "e"), (1004, "grumpf", "yy", "f")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")


def test_languages_of_defined_cases(spark):
    docs = _spoken(spark)
    out = language.with_language(docs, per_label=40)
    assert out.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in out.collect()}
    assert out.count() == docs.count()
    assert got[1000] == got[1001] == got[1002] == ("und", 0.0)
    assert got[None][0] == "xx" and got[1003][0] == "xx" and got[1004][0] == "yy"
    assert all(0 <= s <= 1 for _, s in got.values())
    assert all(got[i][0] == ("xx", "yy")[i % 2] for i in range(120))
    assert language.with_language(docs.limit(0)).count() == 0
    none = language.with_language(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {(r["lang_pred"], r["score"]) for r in none.collect()} == {("und", 0.0)}
    one = language.with_language(docs.filter("lang = 'xx' OR lang IS NULL"))
    assert {(r["lang_pred"], r["score"]) for r in one.collect()} == {("und", 0.0), ("xx", 1.0)}


def test_held_out_texts_are_never_learned(spark):
    docs = _spoken(spark)
    _, x, _ = language.sample(docs.withColumn("text", F.when(language.held_out(F.col("doc_id")), "secret").otherwise("known")), "text", "lang", "doc_id", per_label=100, cuts=2, length=8, max_labels=5)
    assert {bytes(int(b) for b in row if b < 256) for row in x} == {b"known"}
    with pytest.raises(ValueError, match="languages"):
        language.sample(docs, "text", "lang", "doc_id", per_label=1, cuts=2, length=8, max_labels=1)


# Whitening


def _matrix(values, seed):
    q, _ = np.linalg.qr(np.random.Generator(np.random.PCG64(seed)).normal(size=(len(values), len(values))))
    a = (q * np.array(values)) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("values", [[3.0], [2.0, -1.0], list(range(30)), [5.0] * 9 + [1.0] * 9 + [0.0] * 6, [2.0**-i for i in range(24)], [0.0] * 5, [-1.0, -2.0, -3.0, -4.0]])
def test_contour_integration_finds_every_pair(values):
    a = _matrix(values, 2)
    want = np.sort(np.linalg.eigvalsh(a))[::-1][:16]
    e, u = feast.largest(a, 16)
    assert e == pytest.approx(want, abs=1e-13 * max(1, np.abs(want).max()))
    assert np.abs(a @ u - u * e).max() < 1e-12 * max(1, np.abs(want).max())
    assert np.abs(u.T @ u - np.eye(u.shape[1])).max() < 1e-12


def test_inertia_counts():
    r = np.random.Generator(np.random.PCG64(4))
    for n in (1, 2, 3, 7, 20):
        a = r.normal(size=(n, n))
        a = a + a.T
        np.fill_diagonal(a, 0)  # needs pivots of two rows
        e = np.linalg.eigvalsh(a)
        for shift in (-3.0, -0.5, 0.1, 0.7, 2.0):
            assert feast.above(a, shift) == (e > shift).sum()


def _brute(vectors, k):
    x = np.floor(64 * np.array(vectors)).astype(np.int64) + 1000000
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(axis=0)
    y = (u * n - s) / n
    v = y.T @ y / n
    e, w = np.linalg.eigh(v)
    e, w = e[::-1][:k], w[:, ::-1][:, :k]
    real = e > 1e-11 * e.max()
    return n, ((x * n - s) ** 2).sum(axis=1), ((x * n - s) / n) @ w[:, real] / np.sqrt(e[real]), e[real] / np.trace(v)


def test_whitening_against_brute_force(spark):
    r = np.random.Generator(np.random.PCG64(6))
    base = (r.normal(size=(200, 24)) * np.linspace(0.2, 2, 24)).tolist()
    vectors = base + base[:50] + [base[0]] * 100  # the fit knows each of them once
    rows = [(i, v, i) for i, v in enumerate(vectors)] + [(9001, None, 0), (9002, [1.0, None] * 12, 0), (9003, [float("nan")] * 24, 0), (9004, [float("inf")] * 24, 0), (9005, [], 0), (7, vectors[7], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, component int")
    got = whitening.whitened(df).toPandas()
    n, dev, want, part = _brute(vectors, 16)
    assert len(got) == 16 * (len(vectors) + 1) and set(got.n) == {n}
    one = got.drop_duplicates(["vec_id", "component"]).sort_values(["vec_id", "component"])
    assert one.deviation.to_numpy().reshape(-1, 16)[:, 0].tolist() == dev.tolist()
    mine = one.whitened.to_numpy().reshape(-1, 16)
    for c in range(16):
        assert min(np.abs(mine[:, c] - want[:, c]).max(), np.abs(mine[:, c] + want[:, c]).max()) < 1e-9
    assert one.explained.to_numpy()[:16] == pytest.approx(part, rel=1e-10)
    assert got.identity_error.nunique() == 1 and got.identity_error[0] < 1e-10


def test_whitening_of_defined_cases(spark):
    kind = "vec_id long, embedding array<float>, n string"
    df = spark.createDataFrame([(None, [1.0, 2.0], "a"), (1, [0.5, 0.25], "b"), (2, [3.0, -1.0], "c"), (3, [1.0, 0.0, 2.0], "d"), (4, [2.0, 1.0, 1.0], "e"), (5, [1.0], "f"), (5, [1.0], "f")], kind)
    got = whitening.whitened(df).collect()
    assert Counter(r["vec_id"] for r in got) == {None: 2, 1: 2, 2: 2, 3: 1, 4: 1}  # two points have one direction, one point none
    assert all(abs(r["identity_error"]) < 1e-9 for r in got)
    assert whitening.whitened(df.limit(0)).count() == 0
    assert whitening.whitened(df.withColumn("embedding", F.lit(None).cast("array<float>"))).count() == 0
    large = spark.createDataFrame([(1, [1e200, 0.0]), (2, [-1e200, 1.0]), (3, [0.5, 2.0])], "vec_id long, embedding array<double>")
    far = whitening.whitened(large).collect()
    assert {r["vec_id"] for r in far} == {1, 2, 3} and all(r["deviation"] is None for r in far if r["vec_id"] < 3)
    with pytest.raises(ValueError, match="covariance"):
        whitening.whitened(df, max_dim=2)


def test_deviations_stay_exact():
    x = np.array([[10**15, 3], [10**15 + 1, 5]])
    sums = [2 * 10**15 + 1, 8]
    off = whitening.off_mean(x, 2, sums)
    assert whitening.deviations(off) == [1 + 4, 1 + 4]
    far = whitening.off_mean(np.array([[1 << 60, 0]]), 1 << 40, [0, 0])
    assert far[0][0] == 1 << 100 and whitening.deviations(far) == [None]


# Phrase mining


def _mined(rows, min_count, cover, top):
    n, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\n\x0b\x0c\r]", low):
            words = re.findall(r"[^ \t]+", piece)
            n[lang] += len(words)
            f.update((lang, tuple(words[i : i + k])) for k in range(1, 5) for i in range(len(words) - k + 1))
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= min_count}
    covered = set()
    for (lang, w), a in found.items():
        for k in range(2, len(w)):
            covered |= {(lang, w[i : i + k]) for i in range(len(w) - k + 1) if 100 * a >= cover * f[lang, w[i : i + k]]}
    out = {}
    for (lang, w), a in found.items():
        if (lang, w) not in covered:
            score, k = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    return {(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, all_ in out.items() for i, (s, a, p, left, right) in enumerate(sorted(all_)[:top])}


def _chatter(seed, n=400):
    r = random.Random(seed)
    vocabulary = ["a", "b", "c", "Élan", "D", "straße", "x-y", " q", "the", "of"]
    passage = "once upon a time there was a very long passage that many texts share"
    rows = []
    for _ in range(n):
        words = [r.choice(vocabulary[: r.randrange(2, len(vocabulary))]) for _ in range(r.randrange(0, 25))]
        text = "".join(w + r.choice([" ", " ", " ", "\t", ". ", ",", "\n", "  ", "!"]) for w in words)
        rows.append((text + (passage if r.random() < 0.2 else ""), r.choice(["en", "en", "en", None, "und", "fr"])))
    return rows + [(None, "en"), ("", None), (" \t", "fr"), ("...", "fr"), ("rare words alone", "zz")]


@pytest.mark.parametrize(("bits", "block", "part"), [(20, 1_000_000, 1 << 20), (3, 50, 1 << 20), (12, 300, 40)])
def test_phrases_against_brute_force(spark, monkeypatch, bits, block, part):
    monkeypatch.setattr(collocations, "PART", part)
    rows = _chatter(bits)
    df = spark.createDataFrame([(t, lang, 1, "x") for t, lang in rows], "text string, lang string, c int, gram string")
    got = {tuple(r) for r in collocations.phrases(df, min_count=6, bits=bits, block=block, top=60, salts=3).collect()}
    assert got == _mined(rows, 6, 80, 60) and len(got) > 100


def test_phrases_of_defined_cases(spark):
    kind = "text string, lang string"
    assert collocations.phrases(spark.createDataFrame([], kind)).count() == 0
    assert collocations.phrases(spark.createDataFrame([(None, None), ("a b", "en")] * 5, kind)).count() == 0
    long = [("so it goes on " * 200_000, "en")]
    got = {tuple(r) for r in collocations.phrases(spark.createDataFrame(long, kind)).collect()}
    assert got == _mined(long, 30, 80, 2000)


def test_paths_are_compacted(spark):
    edges = spark.createDataFrame([("en", g, f) for g, f in [("a b c d", 9), ("b c d e", 9), ("c d e f", 9), ("d e f g", 4), ("d e f h", 5), ("e f h i", 5)]], "lang string, phrase string, f long")
    nodes = spark.createDataFrame([("en", g, f) for g, f in [("a b c", 9), ("b c d", 9), ("c d e", 9), ("d e f", 9), ("e f g", 4), ("e f h", 5), ("f h i", 5)]], "lang string, phrase string, f long")
    links = collocations.compacted(edges, nodes)
    assert {(r["gram"], r["head"], r["place"]) for r in links.collect()} == {
        ("a b c d", "a b c d", 0), ("b c d e", "a b c d", 1), ("c d e f", "a b c d", 2), ("d e f g", "d e f g", 0), ("d e f h", "d e f h", 0), ("e f h i", "d e f h", 1)
    }
    assert {(r["words"], r["f"], r["n_edges"]) for r in collocations.paths(links).collect()} == {("a b c d e f", 9, 3), ("d e f g", 4, 1), ("d e f h i", 5, 2)}
