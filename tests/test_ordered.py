import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from merchantry.operators import evaluate
from merchantry.operators.ordered import dense_key, exact_quantiles, quantiles, running_totals


@pytest.mark.parametrize("select_rows", [1, 50, 10**6])
def test_quantiles_equal_numpy_with_a_hot_value(spark, select_rows):
    rng = random.Random(3)
    values = [7.0] * 700 + [round(rng.uniform(-50, 50), 2) for _ in range(1300)]
    rng.shuffle(values)
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(values)], "g int, v double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.77, 0.99, 1.0]
    for row in quantiles(df, ["v"], probs, by=["g"], select_rows=select_rows).collect():
        group = [v for i, v in enumerate(values) if i % 2 == row["g"]]
        assert [row[f"q{i}"] for i in range(len(probs))] == pytest.approx(list(np.quantile(group, probs)), abs=1e-9)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=30), st.floats(0, 1))
def test_quantile_property(spark, values, p):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    got = exact_quantiles(df, {"q": ("v", p)}, select_rows=3)["q"]
    assert got == pytest.approx(float(np.quantile(values, p)), abs=1e-9)


def test_quantile_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert exact_quantiles(df, {"q": ("v", 0.5)}) == {"q": None}


@pytest.mark.parametrize("range_rows", [7, 10**6])
def test_running_totals(spark, range_rows):
    rng = random.Random(1)
    rows = [(g, float(v), rng.randint(1, 9)) for g in "ab" for v in rng.sample(range(500), 120)]
    df = spark.createDataFrame(rows, "g string, v double, n long")
    for r in running_totals(df, "v", ["n"], ["g"], range_rows).collect():
        mine = [x for x in rows if x[0] == r["g"]]
        assert r["before_n"] == sum(n for _, v, n in mine if v < r["v"]) and r["all_n"] == sum(n for _, _, n in mine)


def test_dense_key_is_dense(spark):
    df = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("k"))
    ids = [r["n"] for r in dense_key(df, "k", "n", digits=2).collect()]
    assert sorted(ids) == list(range(1, 3001))


def _scored(spark):
    rng = random.Random(5)
    rows = [(i, rng.randint(0, 1), round(rng.random(), 2)) for i in range(400)]
    return rows, spark.createDataFrame(rows, "id long, label int, score double")


def test_thresholds_match_brute_force(spark):
    rows, df = _scored(spark)
    grid = [i / 200 for i in range(60, 140)]
    right = {t: sum((s >= t) == bool(y) for _, y, s in rows) for t in grid}
    best = max(grid, key=lambda t: (right[t], -t))
    got = evaluate.tune_threshold(df).first()
    assert got["Threshold"] == pytest.approx(best) and got["Accuracy"] == pytest.approx(right[best] / len(rows))
    table = {r["step"]: r for r in evaluate.threshold_table(df).collect()}
    assert len(table) == 80
    assert all(table[round(t * 200)]["Predicted"] == sum(s >= t for _, _, s in rows) for t in grid)


def test_auc_and_roc(spark):
    rows, df = _scored(spark)
    pos = [s for _, y, s in rows if y]
    neg = [s for _, y, s in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert evaluate.auc(df).first()["AUC"] == pytest.approx(want)
    curve = evaluate.roc_curve(df).orderBy("Threshold").collect()
    assert (curve[0]["FPR"], curve[0]["TPR"]) == (1.0, 1.0)


def test_single_class_slice(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (2, 1, 0.2)], "id long, label int, score double")
    assert evaluate.auc(df).first()["AUC"] is None
    m = evaluate.classification_metrics(df).first()
    assert (m["Accuracy"], m["Precision"], m["Recall"]) == (0.5, 1.0, 0.5)


def test_vote_and_report(spark):
    rows = [(1, 1, "a", 0.9), (1, 1, "b", 0.1), (2, 0, "a", 0.2), (2, 0, "b", 0.3)]
    df = spark.createDataFrame(rows, "CustomerID long, label int, Model string, score double")
    votes = {r["CustomerID"]: r for r in evaluate.soft_vote(df, {"a": 3.0, "b": 1.0}).collect()}
    assert votes[1]["score"] == pytest.approx(0.7) and votes[1]["prediction"] == 1 and votes[2]["prediction"] == 0
    cells = evaluate.confusion_matrix(evaluate.soft_vote(df, {"a": 3.0, "b": 1.0})).collect()
    assert sum(r["Rows"] for r in cells) == 2
    assert all(r["F1"] == 1.0 for r in evaluate.class_report(evaluate.soft_vote(df, {"a": 3.0, "b": 1.0})).collect())
