import __spark_entry__ as entry
from merchantry.plans import catalogue

ROWS_ONLY = {
    "feature_importance", "model_comparison", "random_search", "vector_classifier_report",
}
TEXT_PREFIXES = ("op", "pipeline")


def test_every_deterministic_query_has_sql():
    open_ = {n for n in set(entry.queries()) - set(entry.oracle_sql()) if not n.startswith(TEXT_PREFIXES)}
    assert open_ == ROWS_ONLY


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["ProductID", "ProductName"] and df.count() == 10


def test_warehouse_is_shared(spark):
    folder = "/root/testdata/sf0.001"
    assert catalogue.warehouse(spark, folder) is catalogue.warehouse(spark, folder)


def test_model_flow(spark):
    w = catalogue.warehouse(spark, "/root/testdata/sf0.001")
    rows = catalogue.queries()["model_comparison"](spark, "/root/testdata/sf0.001").collect()
    assert {r["Model"] for r in rows} >= {"Voting Ensemble", "Stacking Ensemble", "SVM", "XGBoost"}
    assert all(0 <= r["AUC"] <= 1 for r in rows if r["AUC"] is not None)
    assert w["churn_training"].select("split").distinct().count() == 3
