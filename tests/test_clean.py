import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from merchantry import constants as K
from merchantry.functions import columns as C
from merchantry.operators import clean, dims, facts, quality, rfm
from merchantry.plans.warehouse import Warehouse
from merchantry.schemas import REVIEW_COLUMNS, STAGING_RETAIL
from merchantry.sources.store import TableStore

T1, T2 = dt.datetime(2011, 1, 1, 9, 5), dt.datetime(2011, 1, 1, 9, 7)  # a Saturday
ROWS = [
    ("536365", "85123a", "  white mug ", 6, T1, D("2.55"), 17850.0, "United Kingdom"),
    ("536365", "85123A", "  white mug ", 6, T2, D("2.55"), 17850.0, "United Kingdom"),  # same key, later time
    ("536365", "85123A", "  white mug ", 6, T2, D("2.55"), 17850.0, "United Kingdom"),  # exact copy
    ("C536366", "85123A", "WHITE MUG", 6, T1, D("2.55"), 17850.0, "United Kingdom"),
    ("c536367", "85123A", "WHITE MUG", 6, T1, D("2.55"), 17850.0, "United Kingdom"),
    ("536368", "85123A", "WHITE MUG", 0, T1, D("2.55"), 17850.0, "United Kingdom"),
    ("536368", "85123A", "WHITE MUG", -1, T1, D("2.55"), 17850.0, "United Kingdom"),
    ("536368", "85123A", "WHITE MUG", 1, T1, D("0.00"), 17850.0, "United Kingdom"),
    ("536368", "85123A", "WHITE MUG", 1, T1, D("2.55"), None, "United Kingdom"),
    ("536369", "22111", None, 2, dt.datetime(2011, 1, 3, 10, 0), D("20.00"), 12583.0, "France"),
    ("536370", "22112", "HAT BOX", 1, dt.datetime(2011, 1, 4, 10, 0), D("1.00"), 12583.0, "Utopia"),
]


@pytest.fixture(scope="module")
def staging(spark):
    return spark.createDataFrame(ROWS, STAGING_RETAIL)


@pytest.fixture(scope="module")
def cleaned(staging):
    return clean.clean_retail(staging)


def test_clean_retail_filters_and_dedupes(cleaned):
    rows = {r["Invoice"]: r for r in cleaned.collect()}
    assert set(rows) == {"536365", "536369", "536370"}
    mug = rows["536365"]
    assert (mug["StockCode"], mug["Description"], mug["InvoiceDate"]) == ("85123A", "WHITE MUG", T2)
    assert mug["TotalPrice"] == D("15.30") and mug["DayOfWeek"] == "Saturday" and mug["IsWeekend"] == 1
    assert (mug["Hour"], mug["Quarter"], mug["Year"], mug["CustomerID"]) == (9, 1, 2011, 17850)
    assert rows["536369"]["Description"] == "UNKNOWN" and rows["536369"]["ProductCategory"] == "General"
    assert rows["536370"]["ProductCategory"] == "Fashion & Clothing"


def test_cancellations_and_duplicates(staging):
    r = clean.cancellation_report(staging).first()
    assert (r["TotalLines"], r["CancelledLines"]) == (11, 2)
    d = clean.duplicate_rows(staging).first()
    assert (d["Rows"], d["DuplicateRows"]) == (11, 1)


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("GLASS BOWL", "Kitchen & Dining"),
        ("PENCIL CASE", "Stationery & Cards"),
        ("that thing", "Fashion & Clothing"),
        ("RIBBON BOW", "Gifts & Seasonal"),
        ("XYZ", "General"),
    ],
)
def test_first_matching_rule_wins(spark, text, want):
    df = spark.createDataFrame([(text,)], "d string")
    assert df.select(C.first_match("d", K.CATEGORY_RULES, K.DEFAULT_CATEGORY)).first()[0] == want


def test_dimensions_and_facts(spark, cleaned):
    days, places, products = dims.dim_time(cleaned), dims.dim_location(cleaned), dims.dim_product(cleaned)
    assert [r["TimeID"] for r in days.orderBy("FullDate").collect()] == [1, 2, 3]
    regions = {r["Country"]: r["Region"] for r in places.collect()}
    assert regions == {"United Kingdom": "Europe", "France": "Europe", "Utopia": "Other"}
    bands = {r["StockCode"]: r["PriceRange"] for r in products.collect()}
    assert bands == {"85123A": "Medium", "22111": "Premium", "22112": "Low"}
    assert sorted(r["ProductID"] for r in products.collect()) == [1, 2, 3]
    orders = facts.fact_orders(cleaned, products, days, places)
    assert orders.count() == 3 and orders.select("OrderID").distinct().count() == 3
    lost = quality.orphans(orders, {"ProductID": products, "TimeID": days}).collect()
    assert all(r["Orphans"] == 0 for r in lost)
    assert quality.orphans(orders, {"ProductID": products.limit(0)}).first()["Orphans"] == 3
    total = orders.agg(F.sum("TotalPrice")).first()[0]
    assert total == cleaned.agg(F.sum("TotalPrice")).first()[0]


def test_warehouse_writes_each_layer_once(spark, staging):
    reviews = spark.createDataFrame(
        [(1, 2, 30, "t", "Good  dress", 5, 1, 0, "g", "d", "Dresses")],
        "ReviewID long, ClothingID long, Age int, Title string, ReviewText string, Rating int, Recommended int, "
        "PositiveFeedback int, DivisionName string, DepartmentName string, ClassName string",
    )
    w = Warehouse(spark, staging, reviews, store=TableStore(spark, "unit"))
    final = w["final_customer_dataset"]
    assert quality.row_integrity(w["dim_customer"], final).first()["Status"] == "PASS"
    assert w["fact_orders"] is w["fact_orders"]
    assert {r["Region"] for r in final.collect()} == {"Europe"}
    assert final.columns[:3] == ["CustomerID", "Country", "JoinDate"] and len(final.columns) == 17


def test_modes_prefer_the_smallest_value(spark):
    df = spark.createDataFrame([(1, "B"), (1, "A"), (2, "Z"), (2, "Z"), (2, "A")], "CustomerID long, Country string")
    assert {r[0]: r[1] for r in rfm.modal_country(df).collect()} == {1: "A", 2: "Z"}


@pytest.mark.parametrize(
    ("r", "f", "m", "want"),
    [
        (181, 9, 900.0, 1), (180, 9, 900.0, 0), (91, 2, 900.0, 1), (91, 3, 900.0, 0), (90, 2, 900.0, 0),
        (61, 1, 99.99, 1), (61, 1, 100.0, 0), (60, 1, 50.0, 0), (61, 2, 50.0, 0),
    ],
)
def test_churn_tiers(spark, r, f, m, want):
    df = spark.createDataFrame([(r, f, m)], "Recency int, Frequency long, Monetary double")
    assert df.select(C.churn_label()).first()[0] == want
    assert df.select(C.churn_label("recency90")).first()[0] == int(r > 90)


def test_reviews(spark):
    raw = spark.createDataFrame(
        [
            (0, 1, 20, None, " A  Fine DRESS ", 5, 1, 0, None, None, "Dresses"),
            (1, 1, 20, " ", None, 5, 1, 0, "x", "y", "Knits"),
            (2, 1, 20, "ok", "  ", 5, 1, 0, "x", "y", "Knits"),
            (3, 1, 20, "ok", "b", 5, 1, 0, "x", "y", None),
        ],
        "`Unnamed: 0` long, `Clothing ID` long, Age int, Title string, `Review Text` string, Rating int, "
        "`Recommended IND` int, `Positive Feedback Count` int, `Division Name` string, `Department Name` string, "
        "`Class Name` string",
    )
    assert clean.find_column(raw, "review text", "review") == "Review Text"
    assert "Review_Text" in clean.normalise_names(raw).columns
    rows = clean.clean_reviews(clean.standard_review_columns(raw, REVIEW_COLUMNS)).orderBy("ReviewID").collect()
    assert [r["ReviewID"] for r in rows] == [0, 3]
    assert rows[0]["Title"] == "Unknown" and rows[0]["ReviewText"] == "a  fine dress"
    assert rows[0]["ReviewLength"] == 4 and rows[0]["CNN_Matched_Class"] == "Gaun"
    assert rows[1]["ClassName"] == "Unknown" and rows[1]["CNN_Matched_Class"] == "Lainnya"
    assert raw.select(C.word_count(F.lit("a  b c "), "tokens")).first()[0] == 3


def test_text_cleaning(spark):
    text = "<b>Très</b> bon! see http://x.y/z?a=1 or www.q.com — it's   50% *ok*"
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(C.clean_text("t")).first()[0] == "Très bon! see or it's 50 ok"


def test_bins_and_bands(spark):
    df = spark.createDataFrame([(a,) for a in (17, 18, 25, 26, 100, 101)], "Age int")
    got = [r[0] for r in df.select(C.interval_bin("Age", K.AGE_EDGES, K.AGE_LABELS)).collect()]
    assert got == [None, "18-25", "18-25", "26-35", "56+", None]
    df = spark.createDataFrame([(a,) for a in (2.0, 2.01, 15.0, 15.01)], "p double")
    assert [r[0] for r in df.select(C.band("p", K.PRICE_EDGES, K.PRICE_BANDS)).collect()] == ["Low", "Medium", "High", "Premium"]


def test_polarity_edges(spark):
    df = spark.createDataFrame([(0.05,), (-0.05,), (0.0,)], "s double")
    assert [r[0] for r in df.select(C.polarity("s")).collect()] == ["Positive", "Negative", "Neutral"]
    assert [r[0] for r in df.select(C.polarity("s", strict=True)).collect()] == ["Neutral"] * 3


def test_iqr_is_sequential_and_medians_fill(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 2, 3, 4, 100])], "id int, v double")
    assert sorted(r["v"] for r in clean.iqr_filter(df, "v").collect()) == [1, 2, 3, 4]
    gap = spark.createDataFrame([(1.0, "a"), (3.0, None), (None, "b")], "v double, t string")
    assert {tuple(r) for r in clean.fill_defaults(gap).collect()} == {(1.0, "a"), (3.0, "Unknown"), (2.0, "b")}


def test_sample_is_repeatable(spark):
    df = spark.range(100)
    a = [r[0] for r in clean.sample_rows(df, "id", 10).collect()]
    b = [r[0] for r in clean.sample_rows(df.repartition(3), "id", 10).collect()]
    assert a == b and len(set(a)) == 10
