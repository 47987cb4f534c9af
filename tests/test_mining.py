import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from merchantry.operators import basket, churn, recommend, segment, sentiment
from merchantry.sources import files


def test_rules_split_three_item_sets(spark):
    baskets = [("a", "b", "c")] * 4 + [("a",)] * 2 + [("b", "c")] * 2 + [("d",)] * 2
    rows = [(i, x) for i, items in enumerate(baskets) for x in items]
    df = spark.createDataFrame(rows, "InvoiceNo long, Item string")
    sets = basket.frequent_itemsets(df, 0.2)
    rules = {(tuple(r[0]), tuple(r[1])): r for r in basket.association_rules(sets, 0.0).collect()}
    triples = [k for k in rules if len(k[0]) + len(k[1]) == 3]
    assert len(triples) == 6 and sum(len(k[1]) == 2 for k in triples) == 3
    r = rules[(("a",), ("b", "c"))]
    assert r["Support"] == pytest.approx(0.4) and r["Confidence"] == pytest.approx(4 / 6)
    assert r["Lift"] == pytest.approx((4 / 6) / 0.6)
    for (a, c), r in rules.items():
        assert r["Lift"] == pytest.approx(rules[(c, a)]["Lift"])


def test_transactions_need_two_products(spark):
    orders = spark.createDataFrame([(1, 1, 1), (1, 2, 1), (2, 1, 1), (3, 1, 1), (3, 1, 2)], "InvoiceNo long, ProductID long, Quantity int")
    products = spark.createDataFrame([(1, "x"), (2, "y")], "ProductID long, ProductName string")
    got = {tuple(r) for r in basket.transactions(orders, products).collect()}
    assert got == {(1, "x"), (1, "y")}


@pytest.mark.parametrize("seeds", [2, 40])
def test_top_pairs_equal_brute_force(spark, seeds):
    rng = random.Random(2)
    lines = [(inv, min(int(rng.expovariate(0.08)), 60)) for inv in range(300) for _ in range(rng.randint(1, 6))]
    lines += [(999, x) for x in range(200)]  # one huge invoice
    df = spark.createDataFrame(lines, "InvoiceNo long, Item long")
    counts = {}
    by_invoice = {}
    for inv, x in lines:
        by_invoice.setdefault(inv, []).append(x)
    for items in by_invoice.values():
        for a, b in itertools.combinations(sorted(items), 2):
            if a < b:
                counts[a, b] = counts.get((a, b), 0) + 1
    want = sorted(((-n, a, b) for (a, b), n in counts.items() if n > 5))[:20]
    invoices = basket.invoice_items(df, "Item")
    got = basket.top_pairs(invoices, 5, 20, seeds).collect()
    assert [(-r["CoOccurrence"], r["ItemA"], r["ItemB"]) for r in got] == want


def _purchases(spark, users=120, items=12, seed=4):
    rng = random.Random(seed)
    rows = []
    for u in range(users):
        for i in rng.sample(range(items), rng.choice([1, 1, 2, 3, 5])):
            rows.append((u, i, f"s{i:02d}", rng.choice([1, 1, 2, 9])))
    df = spark.createDataFrame(rows, "CustomerID long, Item int, StockCode string, TotalQty long")
    return rows, df.withColumn("Weight", F.log1p(F.col("TotalQty").cast("double")))


def _nearest(rows, k):
    vec = {}
    for u, i, _, q in rows:
        vec.setdefault(u, {})[i] = math.log1p(q)
    norm = {u: math.sqrt(sum(w * w for w in v.values())) for u, v in vec.items()}
    out = {}
    for u in vec:
        sims = []
        for v in vec:
            if v != u:
                s = round(sum(w * vec[v].get(i, 0.0) for i, w in vec[u].items()) / norm[u] / norm[v], 9)
                if s > 0:
                    sims.append((-s, v))
        out[u] = sorted(sims)[:k]
    return out


@pytest.mark.parametrize("head", [1, 3, 64])
def test_neighbours_equal_brute_force(spark, head):
    rows, df = _purchases(spark)
    want = _nearest(rows, 10)
    got = {}
    for r in recommend.neighbours(df, n_items=12, k=10, head=head).collect():
        got.setdefault(r["CustomerID"], []).append((-r["Similarity"], r["NeighbourID"]))
    for u, near in want.items():
        mine = sorted(got.get(u, []))
        assert [v for _, v in mine] == [v for _, v in near]
        assert [s for s, _ in mine] == pytest.approx([s for s, _ in near], abs=2e-9)


@pytest.mark.parametrize("head", [2, 64])
def test_neighbours_with_one_profile_holding_most_customers(spark, head):
    rows, _ = _purchases(spark, users=40, seed=9)
    rows += [(1000 - u, 3, "s03", u % 5 + 1) for u in range(80)]  # one item, any quantity: the same direction
    df = spark.createDataFrame(rows, "CustomerID long, Item int, StockCode string, TotalQty long")
    df = df.withColumn("Weight", F.log1p(F.col("TotalQty").cast("double")))
    want = _nearest(rows, 4)
    got = {}
    for r in recommend.neighbours(df, n_items=12, k=4, head=head).collect():
        got.setdefault(r["CustomerID"], []).append((r["Rank"], r["NeighbourID"]))
    assert {u: [v for _, v in sorted(n)] for u, n in got.items()} == {u: [v for _, v in n] for u, n in want.items() if n}


def test_clusters_are_saved_and_loaded(spark, tmp_path):
    from pyspark.ml.clustering import KMeansModel

    df = spark.createDataFrame([(i, float(i % 2), float(i % 2), 0.0) for i in range(20)], "CustomerID long, Recency double, Frequency double, Monetary double")
    scaled = segment.as_vectors(segment.standardise(df), segment.FEATURES)
    model = segment.best_kmeans(scaled, 2, seeds=(1, 2))
    files.save_model(model, str(tmp_path / "m"))
    again = KMeansModel.load(str(tmp_path / "m"))
    assert len(again.clusterCenters()) == 2
    assert segment.assign(df, again).groupBy("Cluster").count().count() == 2


def test_mean_similarity_without_pairs(spark):
    rows, df = _purchases(spark, users=40)
    near = _nearest(rows, 10**6)
    n = len(near)
    want = sum(-s for sims in near.values() for s, _ in sims) / (n * (n - 1))
    assert recommend.similarity_summary(df).first()["MeanSimilarity"] == pytest.approx(want, abs=2e-6)


def test_collaborative_skips_own_items_and_pads(spark):
    rows, df = _purchases(spark, users=30)
    items = df.select("Item", "StockCode", F.col("StockCode").alias("ProductName")).distinct()
    near = recommend.neighbours(df, n_items=12, k=10)
    bought = {(u, s) for u, _, s, _ in rows}
    got = recommend.collaborative(df, items, near).collect()
    assert got and all((r["CustomerID"], r["StockCode"]) not in bought for r in got)
    padded = recommend.collaborative(df, items, near, n=5, pad_zero=True).collect()
    assert len(padded) == 5 * 30 and all((r["CustomerID"], r["StockCode"]) not in bought for r in padded)


def _reviews(spark):
    rows = [
        (1, "Gaun", "Dresses", 5, 0.5, 1, 3), (2, "Gaun", "Dresses", 3, 0.1, 0, 1),
        (3, "Kaos", "Knits", 4, 0.2, 1, 0), (4, "Kaos", "Fine gauge", 2, -0.3, 0, 2),
    ]
    return spark.createDataFrame(
        rows,
        "ReviewID long, CNN_Matched_Class string, ClassName string, Rating int, SentimentScore double, "
        "Recommended int, PositiveFeedback int",
    )


def test_hybrid_single_item_class_and_unknown_customer(spark):
    rows, df = _purchases(spark, users=20)
    items = df.select("Item", "StockCode", F.lit("same name").alias("ProductName")).distinct()
    near = recommend.neighbours(df, n_items=12, k=10)
    asked = spark.createDataFrame([(0, "Gaun"), (1, None), (10**6, "Kaos"), (10**6 + 1, "None such")], "CustomerID long, CNN_Matched_Class string")
    got = recommend.hybrid(asked, df, items, near, _reviews(spark)).collect()
    by = {}
    for r in got:
        by.setdefault(r["CustomerID"], []).append(r)
    content = [r for r in by[0] if r["Source"].startswith("Content")]
    assert [(r["Product"], r["Hybrid_Score"]) for r in content] == [("Dresses (Gaun)", 0.0)]
    assert sum(r["Product"] == "same name" for r in by[0]) == 1  # duplicate names keep one row
    assert {r["Source"] for r in by[1]} == {"Collaborative"}
    assert [round(r["Hybrid_Score"], 6) for r in by[10**6]] == [0.4, 0.0] and 10**6 + 1 not in by


def test_category_profile_all_equal_gives_null(spark):
    one = _reviews(spark).filter("CNN_Matched_Class = 'Gaun'")
    assert recommend.category_profile(one).first()["Content_Score_Normalized"] is None


def test_imputation_only_when_mostly_missing(spark):
    df = _reviews(spark)
    assert {r[0] for r in recommend.impute_sentiment(df).select("SentimentScore").collect()} == {0.5, 0.1, 0.2, -0.3}
    bare = df.withColumn("SentimentScore", F.lit(None).cast("double"))
    assert {r[0] for r in recommend.impute_sentiment(bare).select("SentimentScore").collect()} == {1.0, 0.0, 0.5, -0.5}


def test_lexicon_scores_and_negation(spark):
    lexicon = spark.createDataFrame([("good", 2.0, 0.7, 0.6), ("bad", -2.0, -0.7, 0.6)], "Word string, Valence double, Polarity double, Subjectivity double")
    df = spark.createDataFrame([(1, "Good, good!"), (2, "not good"), (3, "plain"), (4, "<p>bad</p> -- 'good'")], "ReviewID long, ReviewText string")
    got = {r["ReviewID"]: r for r in sentiment.score_texts(df, lexicon).collect()}
    assert got[1]["VADER_Score"] == pytest.approx(4 / math.sqrt(31)) and got[1]["TextBlob_Score"] == pytest.approx(0.7)
    assert got[2]["VADER_Score"] == pytest.approx(-1.48 / math.sqrt(1.48**2 + 15))
    assert (got[3]["VADER_Score"], got[3]["TextBlob_Subjectivity"]) == (0.0, 0.0)
    assert got[4]["VADER_Score"] == 0.0
    even = spark.createDataFrame([(1, 0.2, 0.3), (2, 0.2, 0.3)], "ReviewID long, VADER_Score double, TextBlob_Score double")
    assert all(r["Ensemble_Score"] is None for r in sentiment.ensemble(even).collect())


def test_segment_suffixes(spark):
    rows = [(0, 10.0, 9.0, 90.0), (1, 11.0, 8.0, 80.0), (2, 50.0, 2.0, 5.0), (3, 60.0, 1.0, 5.0), (4, 90.0, 1.0, 5.0)]
    df = spark.createDataFrame(rows, "Cluster int, Recency double, Frequency double, Monetary double")
    got = {r["Cluster"]: r["RFM_Segment"] for r in segment.segment_labels(df).collect()}
    assert got == {0: "Champions", 1: "Champions 2", 2: "At Risk", 3: "At Risk 2", 4: "Lost"}


def test_splits_are_disjoint_and_repeatable(spark):
    df = spark.range(5000).withColumnRenamed("id", "CustomerID")
    a = {r[0]: r[1] for r in churn.with_split(df).collect()}
    b = {r[0]: r[1] for r in churn.with_split(df.repartition(5)).collect()}
    assert a == b
    assert abs(sum(v == "train" for v in a.values()) / 5000 - 0.68) < 0.03


def test_sources_round_trip(spark, tmp_path):
    from merchantry.schemas import STAGING_RETAIL

    raw = spark.createDataFrame(
        [("1", "A", 'say "hi", ok', "3", "2011-01-01 10:00:00", "2.50", "17850.0", "France"), ("2", "B", None, "x", "bad", "1", None, "USA")],
        "Invoice string, StockCode string, Description string, Quantity string, InvoiceDate string, Price string, `Customer ID` string, Country string",
    )
    staged = files.stage_retail(raw)
    assert [f.dataType for f in staged.schema] == [f.dataType for f in STAGING_RETAIL]
    assert staged.filter("Quantity IS NULL AND InvoiceDate IS NULL").count() == 1
    part = str(tmp_path / "part1.csv")
    files.export_csv(staged, part)
    both = files.union_parts(files.read_csv(spark, part, STAGING_RETAIL), staged)
    assert both.count() == 4
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "b.csv").write_text("x,y\n1,2\n")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("x", T.IntegerType()), T.StructField("y", T.IntegerType())])
    assert files.read_first_csv(spark, str(tmp_path / "in"), ["a*.csv", "b*.csv"], schema).first() == (1, 2)
    kept, bad = files.split_rejects(staged, F.col("Quantity").isNull())
    assert kept.count() == bad.count() == 1
    target = str(tmp_path / "t")
    files.replace_table(staged, target)
    files.insert_into(staged, target, STAGING_RETAIL)
    assert spark.read.parquet(target).count() == 4


def test_images_and_write_back(spark, tmp_path):
    for label, n in (("shirt", 2), ("shoe", 1)):
        (tmp_path / label).mkdir()
        for i in range(n):
            (tmp_path / label / f"{i}.png").write_bytes(b"x")
    images = files.read_labelled_images(spark, str(tmp_path))
    assert {r["label"]: r["files"] for r in files.class_counts(images).collect()} == {"shirt": 2, "shoe": 1}
    base = spark.createDataFrame([(1, None), (2, 0.5)], "ReviewID long, SentimentScore double")
    new = spark.createDataFrame([(1, 0.9)], "ReviewID long, SentimentScore double")
    assert {tuple(r) for r in files.write_back(base, new, "ReviewID", "SentimentScore").collect()} == {(1, 0.9), (2, 0.5)}
