"""Shapes of plans and tables that keep the work in proportion to the input, with results against plain Python."""

import itertools
import re
import threading
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from merchantry.operators import basket, churn, clean, dims, distances, facts, models, recommend, rfm, silhouette
from merchantry.plans import catalogue
from merchantry.plans.warehouse import Warehouse
from merchantry.sources import tables
from merchantry.sources.store import TableStore


def _plan(df):
    """The operators of the plan, the ones that run first last."""
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("rows", [1, 900, 6000])
def test_sums_of_distances_equal_brute_force(rows):
    r = np.random.Generator(np.random.PCG64(rows))
    x = np.stack([r.integers(0, 900, rows) / 90, r.integers(0, 9, rows) / 2.0, np.exp(r.normal(size=rows) * 2)], axis=1)
    other = np.concatenate([x[::2] + [30.0, 0, 5], x[:5], np.repeat(x[:1], 700, axis=0)])
    values = r.random((len(other), 3))
    sums = distances.Sums(x, 3, 5e-7)
    for part in (slice(0, 800), slice(800, None)):
        if len(other[part]):
            sums.add(other[part], values[part])
    assert rows < 6000 or sums.at_points  # some boxes met by points
    some = r.integers(0, rows, 40)
    want = np.sqrt(((x[some, None] - other[None]) ** 2).sum(axis=2)) @ values
    assert sums.totals()[some] == pytest.approx(want, rel=5e-7)


def test_rows_are_sent_to_few_leaves(spark, tmp_path):
    """The leaves, to each of which near rows are sent, don't become more with the rows."""
    kept = {}

    def save(name, df):
        path = f"{tmp_path}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        kept[name] = spark.read.schema(df.schema).parquet(path)
        return kept[name]

    r = np.random.Generator(np.random.PCG64(9))
    x = r.normal(size=(5000, 3)) * [1, 1, 5]
    labels = (x[:, 0] > 0).astype(int)
    df = spark.createDataFrame([(*map(float, v), [int(c)]) for v, c in zip(x, labels)], "a double, b double, c double, lab array<int>")
    got = silhouette.silhouettes(df, ["a", "b", "c"], F.col("lab"), [2], store=save)
    assert kept["tree-nodes"].filter("leaf").count() <= 4
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    own = np.stack([d[:, labels == g].sum(axis=1) for g in (0, 1)], axis=1)
    n = np.bincount(labels)
    a, b = own[np.arange(5000), labels] / (n[labels] - 1), own[np.arange(5000), 1 - labels] / n[1 - labels]
    assert got[0] == pytest.approx(((b - a) / np.maximum(a, b)).mean(), abs=1e-6)


@pytest.mark.parametrize("variant", ["weighted", "line"])
def test_customer_orders_without_expanded_lines(spark, variant):
    lines = [(1, "a", 1, 1, 2, 3.0), (1, "a", 1, 1, 2, 3.0), (1, "b", 2, 2, 5, 1.0), (1, None, None, 2, 1, 4.0), (None, "c", 3, 1, None, 2.0), (None, "c", 3, 2, 7, None)]
    orders = spark.createDataFrame(lines, "CustomerID long, InvoiceNo string, ProductID long, TimeID long, Quantity int, UnitPrice double")
    days = spark.createDataFrame([(1, "2020-01-01"), (2, "2020-01-05")], "TimeID long, FullDate string")
    df = facts.customer_orders(orders, days, variant)
    got = {r["CustomerID"]: tuple(r)[1:] for r in df.collect()}
    assert "Expand" not in _plan(df)
    span = ("2020-01-01", "2020-01-05")
    if variant == "weighted":
        assert got == {1: (10, 2, 2, *span, 5.0, 2.1), None: (7, 1, 1, *span, 7.0, None)}
    else:
        assert got == {1: (10, 2, 2, *span, 2.5, 2.75), None: (7, 1, 1, *span, 7.0, 2.0)}


def test_tenure_without_expanded_lines(spark):
    lines = [(1, "x", "A", 2), (1, "x", "B", 3), (1, "y", None, 1), (None, "x", "A", 1), (None, None, "A", 1)]
    df = spark.createDataFrame(lines, "CustomerID long, StockCode string, Country string, Quantity int").withColumn("InvoiceDay", F.lit("2020-02-01").cast("date"))
    out = rfm.tenure_features(df)
    got = {r["CustomerID"]: (r["TotalItems"], r["UniqueProducts"], r["UniqueCountries"], r["DaysSinceFirstPurchase"]) for r in out.collect()}
    assert got == {1: (6, 2, 2, 1), None: (2, 1, 1, 1)}
    assert "Expand" not in _plan(out)


def test_products_are_summed_before_texts_are_sorted(spark):
    lines = [("p", "new", "Toys", 1.0), ("p", "new", "Toys", 3.0), ("p", "old", "Games", 5.0), ("q", None, "Toys", None), (None, "x", "Toys", 2.0)]
    df = spark.createDataFrame(lines, "StockCode string, Description string, ProductCategory string, Price double")
    out = dims.dim_product(df, edges=(2.0, 4.0, 6.0))
    got = {r["StockCode"]: (r["ProductName"], r["Category"], r["AvgPrice"]) for r in out.collect()}
    assert got["p"] == ("old", "Toys", 3.0) and got["q"] == (None, "Toys", None)
    assert re.findall(r"(\w+Aggregate)\(", _plan(dims.dim_product(df)))[-1] == "HashAggregate"


def test_lines_are_sorted_after_they_are_sent(spark):
    key = ("i", "s", 1, 2, 3.0)
    df = spark.createDataFrame([(*key, "ab", "d1", "X"), (*key, "Zz", "d2", None), ("j", "s", 1, 2, 3.0, None, "d1", "Y")], "Invoice string, StockCode string, CustomerID long, Quantity int, Price double, Description string, InvoiceDate string, Country string")
    out = clean.dedupe_business_key(df)
    assert [tuple(r)[5:] for r in out.orderBy("Invoice").collect()] == [("ZZ", "d2", "X"), (None, "d1", "Y")]
    plan = _plan(out)
    assert plan.rindex("Exchange hashpartitioning") > plan.rindex("Sort [") > plan.rindex("SortAggregate(")


def test_lines_are_sent_for_two_joins(spark, tmp_path):
    """Orders meet customers before the lines do."""
    kinds = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in kinds}
    for k, v in kinds.items():
        spark.conf.set(k, v)
    try:
        plan = _plan(tables.staging_retail(spark, "/root/testdata/sf0.001"))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    joins = re.findall(r"SortMergeJoin \[(\w+)#", plan)
    assert joins[:3] == ["c_nationkey", "l_partkey", "l_orderkey"] and len(joins) == 4


def test_itemsets_equal_brute_force(spark):
    r = np.random.Generator(np.random.PCG64(5))
    names = [f"i{k:03d}" for k in range(80)]  # more than one word of bits
    held = {n: {names[k] for k in np.minimum(r.geometric(0.12, 6), 80) - 1} | ({names[70], names[79]} if n % 3 == 0 else set()) for n in range(300)}
    held[300], held[None] = set(names[:6]), {names[0], names[70]}
    rows = [(n, x) for n, items in held.items() for x in items] + [(5, None), (400, None), (0, names[70]), (0, names[70])]
    df = spark.createDataFrame(rows, "InvoiceNo long, Item string")
    got = {tuple(x["items"]): (x["freq"], x["n"], x["Support"], x["Length"]) for x in basket.frequent_itemsets(df, 0.02).collect()}
    want = {}
    for items in held.values():
        for size in range(1, len(items) + 1):
            for c in itertools.combinations(sorted(items), size):
                want[c] = want.get(c, 0) + 1
    want = {c: (n, 303, n / 303, len(c)) for c, n in want.items() if n >= 0.02 * 303}
    assert got == want and max(len(c) for c in want) >= 3
    assert basket.frequent_itemsets(df.limit(0), 0.02).count() == 0


def test_equal_baskets_are_counted_once(spark):
    rows = [(n, x) for n in range(500) for x in ("a", "b")] + [(900, "a")]
    weighted = basket._weighted_baskets(spark.createDataFrame(rows, "InvoiceNo long, Item string"), ["a", "b"])
    assert sorted(tuple(r) for r in weighted.collect()) == [(1, 1), (3, 500)]


def test_texts_are_scored_once(spark):
    w = catalogue.warehouse(spark, "/root/testdata/sf0.001")
    assert w["sentiment_scores"].count() == w["text_scores"].count()
    assert "ReviewText" not in _plan(catalogue.sentiment.ensemble(w["text_scores"]))


def test_baskets_are_sent_once_in_parts_that_follow_the_lines(spark, monkeypatch):
    r = np.random.Generator(np.random.PCG64(5))
    rows = [(f"i{a}" if a else None, int(b) if b else None, int(q) if q else None) for a, b, q in zip(r.integers(0, 60, 400), r.integers(0, 12, 400), r.integers(-2, 5, 400), strict=True)]
    orders = spark.createDataFrame(rows, "InvoiceNo string, ProductID long, Quantity int")
    products = spark.createDataFrame([(i, f"p{i % 7}") for i in range(1, 11)], "ProductID long, ProductName string")
    monkeypatch.setattr(basket, "PART_LINES", 20)
    df = basket.transactions(orders, products, top=5)
    several = {a for a, _, _ in rows if a and len({b for x, b, _ in rows if x == a and b}) > 1}
    lines = [(a, f"p{b % 7}") for a, b, q in rows if a in several and b and b < 11 and q and q > 0]
    best = sorted({i for _, i in lines}, key=lambda i: (-sum(x == i for _, x in lines), i))[:5]
    assert sorted(map(tuple, df.collect())) == sorted({x for x in lines if x[1] in best})
    known = sum(1 for a, b, _ in rows if a and b)
    sent = re.findall(r"Exchange hashpartitioning\(InvoiceNo#\d+, (\d+)\), REPARTITION_BY_NUM", _plan(df).split("Initial Plan")[0])
    assert sent and {int(x) for x in sent} == {-(-known // 20)}


def test_only_purchases_of_top_items_meet_their_products(spark, tmp_path):
    r = np.random.Generator(np.random.PCG64(8))
    rows = [(int(c), int(p) if p else None, int(q)) for c, p, q in zip(r.integers(1, 30, 500), r.integers(0, 40, 500), r.integers(-3, 9, 500), strict=True)]
    orders = spark.createDataFrame(rows, "CustomerID long, ProductID long, Quantity int")
    spark.createDataFrame([(i, f"s{i}", f"p{i % 9}", "c") for i in range(1, 39)], "ProductID long, StockCode string, ProductName string, Category string").write.parquet(f"{tmp_path}/p")
    orders.write.parquet(f"{tmp_path}/o")
    orders, products = spark.read.parquet(f"{tmp_path}/o"), spark.read.parquet(f"{tmp_path}/p")
    items = recommend.top_items(recommend.interactions(recommend.per_product(orders), products), 6)
    total = {}
    for c, p, q in rows:
        if p and p < 39 and q > 0:
            total[c, p] = total.get((c, p), 0) + q
    of = {p: sum(q for (_, x), q in total.items() if x == p) for _, p in total}
    best = sorted(of, key=lambda p: (-of[p], f"s{p}"))[:6]
    assert {x["StockCode"] for x in items.collect()} == {f"s{p}" for p in best}
    purchases = recommend.purchases_of(items, orders, products)
    assert sorted(map(tuple, purchases.collect())) == sorted((c, q, f"s{p}", f"p{p % 9}", "c") for (c, p), q in total.items() if p in best)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        plan = _plan(recommend.purchases_of(items, orders, products))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # what is sent by customer is summed from lines that have met the broadcast products
    sent = plan[plan.index("Exchange hashpartitioning(CustomerID") :]
    assert "partial_sum(Quantity" in sent and sent.index("BroadcastHashJoin") < sent.index("FileScan")
    assert plan.count("SortMergeJoin") == plan[plan.index("TakeOrdered") :].count("SortMergeJoin")


def test_models_are_fitted_side_by_side(spark, monkeypatch):
    data = spark.createDataFrame([(1, 0.0, "train"), (2, 1.0, "train"), (3, 1.0, "test")], "CustomerID long, label double, split string")
    together = threading.Barrier(models.FITS, timeout=60)
    waits = iter(range(models.FITS))

    def fitted(train, name, estimator):
        if next(waits, None) is not None:
            together.wait()
        return lambda df: df.withColumn("score", F.lit(0.5))

    monkeypatch.setattr(models, "fit", fitted)
    scores, found = models.base_scores(data, 2, catalogue.SIZES)
    assert list(found) == list(models.estimators(2, catalogue.SIZES))
    assert sorted(map(tuple, scores.collect())) == sorted((3, 1.0, "test", name, 0.5) for name in found)


def test_model_comparison_trains_the_full_sizes(spark, monkeypatch):
    """The comparison gets the study's sizes, search and stacking with them, and rows with as many Fourier features."""
    rows = [(i, i % 2, "Europe" if i % 3 else None, i % 7, float(i)) for i in range(40)]
    w = Warehouse(spark, None, None, store=TableStore(spark, "full-sizes"))
    w._tables["churn_features"] = spark.createDataFrame(rows, "CustomerID long, ChurnLabel int, Region string, Frequency long, Monetary double")
    catalogue._add_mining_layers(w)
    monkeypatch.setitem(catalogue._warehouses, (spark.sparkContext.applicationId, "full-sizes"), w)
    given = []

    def comparison(data, width, sizes, *args, **named):
        given.append((data, width, sizes, args, set(named)))
        return spark.range(1), None, {}

    monkeypatch.setattr(models, "churn_comparison", comparison)
    assert catalogue.queries()["model_comparison"](spark, "full-sizes").count() == 1
    [(data, width, sizes, args, named)] = given
    assert sizes == models.Sizes() and width == 3 and not args and named == {"store"}
    assert (sizes.forest_trees, sizes.boost_trees, sizes.gradient_trees, sizes.network_iter, sizes.search_draws, sizes.search_folds, sizes.stack_folds) == (300, 300, 500, 800, 30, 5, 5)
    assert data.count() == 40 and {len(r["fourier"]) for r in data.collect()} == {200}
    assert spark.sparkContext.getCheckpointDir()


def test_search_folds_are_even(spark, monkeypatch):
    """The folds of the full search don't follow the hash that chose the training rows, which would leave the last of them empty."""
    data = churn.with_split(spark.range(3000).select(F.col("id").alias("CustomerID"), F.lit(0.0).alias("label")))
    found = []

    class Search:
        bestModel, avgMetrics = type("Best", (), {"extractParamMap": lambda self: {}})(), [0.5]

        def __init__(self, **named):
            self.folds, self.draws = named["numFolds"], len(named["estimatorParamMaps"])

        def fit(self, folded):
            found.append((self.folds, self.draws, {r["fold"]: r["count"] for r in folded.groupBy("fold").count().collect()}))
            return self

    monkeypatch.setattr(models, "CrossValidator", Search)
    monkeypatch.setattr(models, "fit", lambda train, name, estimator: lambda df: df.withColumn("score", F.lit(0.5)))
    models.base_scores(data, 2, models.Sizes(), search=True)
    assert [(folds, draws) for folds, draws, _ in found] == [(5, 30)] * 2
    train = data.filter("split = 'train'").count()
    for _, _, rows in found:
        assert sorted(rows) == [0, 1, 2, 3, 4] and all(0.15 * train < n < 0.25 * train for n in rows.values())
