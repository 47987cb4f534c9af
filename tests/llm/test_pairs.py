"""N-gram Jaccard join and substring dedup against brute force."""

import hashlib
import random
import re

import pytest

from merchantry.llm import ngram_join, substring
from merchantry.llm.ngram_join import boundary_size, common, prefix_size, subset_sizes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def corpus(seed: int) -> list[tuple]:
    """Near copies, exact copies, tiny sets, a passage that many texts share, and odd texts."""
    r = random.Random(seed)
    words = [a + b for a in "abcdefgh" for b in "abcdefghijklmnop"]

    def edit(text, n):
        text = list(text)
        for _ in range(n):
            text[r.randrange(len(text))] = r.choice(words)
        return text

    base = [r.choice(words) for _ in range(120)]
    texts = [edit(base, r.randrange(0, 6)) for _ in range(40)]
    for n in range(1, 14):
        small = [r.choice(words) for _ in range(n)]
        texts += [edit(small, r.randrange(0, 2)) + [r.choice(words)] * r.randrange(0, 2) for _ in range(4)]
    passage = [r.choice(words) for _ in range(40)]
    texts += [[r.choice(words) for _ in range(r.randrange(0, 30))] + passage for _ in range(25)]
    texts += [passage * 3, ["x"] * 50]
    lines = [" ".join(t) for t in texts] + [None, "", " \t\n", "A b C d E f", "a B\tc\n\nd e F", " ".join(base)] + [" ".join(base)] * 3
    return list(enumerate(lines))


def shingle_set(text):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_groups(rows):
    sets, root = [shingle_set(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [(i, len(sets[i]), find(i)) for i in range(len(rows))]


@pytest.mark.parametrize("how", [{}, {"chunk": 200, "light": 1, "rounds": 1}])
def test_groups_are_those_of_brute_force(spark, how):
    rows = corpus(1)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted(map(tuple, ngram_join.groups(df, **how).collect())) == brute_groups(rows)


def test_small_sets_list_every_subset_a_partner_needs():
    for n in range(1, 13):
        for m in range(-(-75 * n // 100), min(12, 100 * n // 75) + 1):
            o = common(n, m, 75)
            assert 100 * o >= 75 * (n + m - o) > 100 * (o - 1) - 75
            if o <= min(n, m):
                assert o in subset_sizes(n, 12, 75) and o in subset_sizes(m, 12, 75)
    assert prefix_size(100, 75) == 26 and prefix_size(1, 75) == 1


def test_boundary_follows_cost():
    assert boundary_size({4: (100, 200), 5: (100, 200)}, 75) < boundary_size({4: (100, 20_000), 5: (100, 20_000)}, 75)


def test_one_of_each_keeps_columns_and_rows_without_identity(spark):
    text = "one two three four five six seven"
    rows = [(2, text, "a", 1), (1, text, "b", 2), (1, text, "b", 2), (3, "other words stand in this text", None, 3), (None, "x", "c", 4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component string, n int")
    out = ngram_join.one_of_each(df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted([rows[1], rows[3], rows[4]], key=str)
    assert ngram_join.one_of_each(df.limit(0)).count() == 0


def brute_removed(rows, window):
    first, out = {}, []
    for i, t in sorted(rows, key=lambda x: x[0]):
        w = WORD.findall(t or "")
        gone = set()
        for p in range(len(w) - window + 1):
            if first.setdefault(tuple(w[p : p + window]), (i, p)) != (i, p):
                gone.update(range(p, p + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("how", [{}, {"base": 5}, {"window": 8, "base": 8}])
def test_removed_words_are_those_of_brute_force(spark, how):
    rows = [(i * 7 % 1000, t) for i, t in corpus(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = substring.deduplicated(df, **how).select("id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == brute_removed(rows, how.get("window", 20))


def test_kept_text_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(1, text), (1, text), (2, "new " + text + " tail"), (None, text), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["id"], r["n_removed"], r["kept"]) for r in substring.deduplicated(df).collect()}
    assert got == {(1, 0, None), (2, 30, "new tail"), (None, 30, ""), (4, 0, None)}
    assert substring.deduplicated(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        substring.repeated(df, window=20, base=6)


def brute_removed_of_texts(rows, window=20):
    """(id, n, removed) of different texts, null last; the order within one identity is free here, as no passage is shared there."""
    first, out = {}, []
    for i, t in sorted(rows, key=lambda x: (x[0] is None, x[0] or 0)):
        w, gone = t.split(), set()
        for p in range(len(w) - window + 1):
            if first.setdefault(tuple(w[p : p + window]), (i, t, p)) != (i, t, p):
                gone.update(range(p, p + window))
        out.append((i, len(w), len(gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("shared", [None, 7])
def test_texts_of_one_identity_lose_their_own_words(spark, shared):
    passages = [[f"p{k}w{i}" for i in range(25)] for k in range(6)]
    rows = [(k, " ".join([f"a{k}", *p])) for k, p in enumerate(passages)]
    rows += [(shared, " ".join([*(f"b{k}x{i}" for i in range(k)), *p, f"c{k}"])) for k, p in enumerate(passages)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = substring.deduplicated(df).select("id", "n_words", "n_removed").collect()
    assert sorted(map(tuple, got), key=str) == brute_removed_of_texts(rows)


@pytest.mark.parametrize("how", [{}, {"light": 1, "rounds": 1}])
def test_a_document_without_identity_bridges_two_others(spark, how):
    words = [f"w{i}" for i in range(60)]
    left, right = ["x1", "x2", "x3", "x4", "x5", *words[5:]], [*words[:55], "y1", "y2", "y3", "y4", "y5"]
    assert 100 * len(shingle_set(" ".join(left)) & shingle_set(" ".join(right))) < 75 * len(shingle_set(" ".join(left)) | shingle_set(" ".join(right)))
    rows = [(1, " ".join(left)), (2, " ".join(right)), (None, " ".join(words)), (None, " ".join(words)), (None, "quite another text that stands alone here")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r["id"], r["component"]) for r in ngram_join.groups(df, **how).collect()), key=str)
    assert got == sorted([(1, 1), (2, 1), (None, 1), (None, 1), (None, None)], key=str)


def test_one_of_each_keeps_one_row_of_each_component(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    near = c.replace("c39", "e")
    rows = [(5, a, "s"), (5, b, "s"), (3, b, "t"), (None, c, "u"), (None, c, "u"), (None, c, "v"), (None, near, "u"), (9, d, "s"), (9, d, "t"), (None, None, "n"), (None, " ", "n"), (4, "", "n"), (4, "", "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = [tuple(r) for r in ngram_join.one_of_each(df.repartition(3)).collect()]
    again = [tuple(r) for r in ngram_join.one_of_each(df.repartition(2, "source")).collect()]
    assert sorted(map(str, out)) == sorted(map(str, again))
    assert (5, a, "s") in out and (3, b, "t") in out and (5, b, "s") not in out
    assert sum(r[0] is None and r[1] in (c, near) for r in out) == 1 and sum(r[0] == 9 for r in out) == 1
    assert sum(r[2] == "n" for r in out) == 3 and len(out) == 7
