"""Classifiers for churn and for labelled vectors, trained by Spark ML and scored as (key, label, Model, score) rows."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import partial, reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from merchantry import constants as K
from merchantry.functions import columns as C
from merchantry.operators import evaluate
from merchantry.operators.churn import class_weights, scaled_splits, with_fold
from merchantry.operators.segment import as_vectors


@dataclass(frozen=True)
class Sizes:
    """Model sizes. The defaults follow the published study; small values suit a quick run."""

    forest_trees: int = 300
    forest_depth: int = 16
    boost_trees: int = 300
    boost_depth: int = 6
    gradient_trees: int = 500
    gradient_depth: int = 4
    gradient_rate: float = 0.03
    hidden: Sequence[int] = (256, 128, 64)
    network_iter: int = 800
    linear_iter: int = 1000
    fourier: int = 200
    search_draws: int = 30
    search_folds: int = 5
    stack_folds: int = 5
    #: Of the search's folds; not the seed of the splits, by whose hash the training rows are chosen: the last folds would be empty.
    fold_seed: int = 7
    forest_grid: dict = field(
        default_factory=lambda: {
            "numTrees": [100, 200, 300, 500],
            "maxDepth": [8, 12, 16, 20, 25, 30],
            "minInstancesPerNode": [1, 2, 3],
            "featureSubsetStrategy": ["sqrt", "log2", "0.5", "0.7"],
        }
    )
    boost_grid: dict = field(
        default_factory=lambda: {
            "maxIter": [100, 200, 300, 500],
            "maxDepth": [4, 6, 8, 10],
            "stepSize": [0.01, 0.03, 0.05, 0.1],
            "subsamplingRate": [0.7, 0.8, 0.9],
            "featureSubsetStrategy": ["0.6", "0.7", "0.8", "0.9"],
        }
    )


#: The inverse strengths C of the linear models' penalties; the penalty per row is 1 / (C rows).
LOGISTIC_C, SVM_C = 1.0, 2.0


def estimators(width: int, sizes: Sizes, seed: int = 42, rows: int | None = None) -> dict[str, Estimator]:
    """The six base models. The SVM works on random Fourier features of the same rows. ``rows``: the number of training rows."""
    per_row = 1.0 / rows if rows else 0.001
    return {
        "Logistic Regression": LogisticRegression(maxIter=sizes.linear_iter, regParam=per_row / LOGISTIC_C, weightCol="weight"),
        "Random Forest": RandomForestClassifier(
            numTrees=sizes.forest_trees, maxDepth=sizes.forest_depth, weightCol="weight", seed=seed
        ),
        "XGBoost": GBTClassifier(
            maxIter=sizes.boost_trees, maxDepth=sizes.boost_depth, stepSize=0.05, subsamplingRate=0.8,
            featureSubsetStrategy="0.8", seed=seed,
        ),
        "Gradient Boosting": GBTClassifier(
            maxIter=sizes.gradient_trees, maxDepth=sizes.gradient_depth, stepSize=sizes.gradient_rate,
            subsamplingRate=0.8, minInstancesPerNode=5, seed=seed,
        ),
        "SVM": LinearSVC(featuresCol="fourier", maxIter=sizes.linear_iter, regParam=per_row / SVM_C, weightCol="weight"),
        "MLP Neural Network": MultilayerPerceptronClassifier(
            layers=[width, *sizes.hidden, 2], maxIter=sizes.network_iter, seed=seed
        ),
    }


def fourier_features(df: DataFrame, width: int, count: int, seed: int = 42, gamma: float | None = None) -> DataFrame:
    """Random Fourier features of an RBF kernel; the projection is a small matrix sent with the tasks."""
    rng = np.random.default_rng(seed)
    gamma = 1.0 / width if gamma is None else gamma
    matrix = rng.normal(0.0, np.sqrt(2.0 * gamma), size=(width, count))
    phase = rng.uniform(0.0, 2.0 * np.pi, size=count)

    @F.pandas_udf("array<double>")
    def project(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            rows = np.stack(batch.to_numpy()) if len(batch) else np.zeros((0, width))
            yield pd.Series(list(np.sqrt(2.0 / count) * np.cos(rows @ matrix + phase)))

    return df.withColumn("fourier", array_to_vector(project(vector_to_array("features"))))


def prepare(table: DataFrame, names: Sequence[str], sizes: Sizes, seed: int = 42) -> DataFrame:
    """Scaled splits with feature vectors, class weights and Fourier features."""
    cut = class_weights(scaled_splits(table, names, seed), "label")
    vectors = as_vectors(cut, names).select("CustomerID", "label", "weight", "split", "features")
    return fourier_features(vectors, len(names), sizes.fourier, seed)


def random_draws(estimator: Estimator, grid: dict[str, list], draws: int, seed: int = 42) -> list[dict]:
    """Distinct random parameter maps."""
    rng = np.random.default_rng(seed)
    seen: dict[tuple, dict] = {}
    total = int(np.prod([len(v) for v in grid.values()]))
    while len(seen) < min(draws, total):
        pick = tuple(int(rng.integers(len(v))) for v in grid.values())
        seen[pick] = {estimator.getParam(k): v[i] for (k, v), i in zip(grid.items(), pick, strict=True)}
    return list(seen.values())


def random_search(
    train: DataFrame,
    estimator: Estimator,
    grid: dict[str, list],
    draws: int = 30,
    folds: int = 5,
    parallelism: int = 4,
    seed: int = 42,
    fold_seed: int | None = None,
) -> tuple[Model, float]:
    """Best of ``draws`` parameter maps by cross-validated accuracy; folds are fixed by key hash, of ``seed`` where ``fold_seed`` isn't given."""
    maps = random_draws(estimator, grid, draws, seed) or ParamGridBuilder().build()
    folded = with_fold(train, folds=folds, seed=seed if fold_seed is None else fold_seed)
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=maps,
        evaluator=MulticlassClassificationEvaluator(metricName="accuracy"),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
    ).fit(folded)
    return search.bestModel, float(max(search.avgMetrics))


def calibrate(train: DataFrame, model: Model) -> Model:
    """Logistic map from SVM margin to probability, fitted on the training rows."""
    margins = _margin(model.transform(train))
    return LogisticRegression(featuresCol="margin", probabilityCol="p", rawPredictionCol="r", predictionCol="q").fit(margins)


def _margin(df: DataFrame) -> DataFrame:
    return df.withColumn("margin", array_to_vector(F.array(F.element_at(vector_to_array("rawPrediction"), 2))))


def fit(train: DataFrame, name: str, estimator: Estimator):
    """A scorer: function from rows to rows with a ``score`` column."""
    model = estimator.fit(train)
    if name == "SVM":
        calibrator = calibrate(train, model)

        def score(df: DataFrame) -> DataFrame:
            rows = calibrator.transform(_margin(model.transform(df)))
            return rows.withColumn("score", F.element_at(vector_to_array("p"), 2))
    else:

        def score(df: DataFrame) -> DataFrame:
            return model.transform(df).withColumn("score", F.element_at(vector_to_array("probability"), 2))

    score.model = model
    return score


#: Models that are fitted at the same time, as many as ``random_search`` tries at the same time.
FITS = 4


def _side_by_side(spark: SparkSession, tasks: Sequence[Callable]) -> list:
    """The results of the tasks in their order. A fit is many short jobs that leave cores idle between them, so several run at once."""
    with ThreadPool(max(1, min(FITS, len(tasks)))) as pool:
        return pool.map(lambda run: run(), map(inheritable_thread_target(spark), tasks), chunksize=1)


def base_scores(data: DataFrame, width: int, sizes: Sizes, seed: int = 42, search: bool = False) -> tuple[DataFrame, dict]:
    """Scores of every base model on validation and test rows, and the fitted scorers with their times, which are those of models fitted side by side."""
    train = data.filter("split = 'train'")
    rest = data.filter("split <> 'train'")
    known = estimators(width, sizes, seed, train.count())

    def trained(name: str, estimator: Estimator) -> tuple:
        start = time.time()
        grid = {"Random Forest": sizes.forest_grid, "XGBoost": sizes.boost_grid}.get(name)
        if search and grid:
            best, _ = random_search(train, estimator, grid, sizes.search_draws, sizes.search_folds, seed=seed, fold_seed=sizes.fold_seed)
            estimator = estimator.copy({p: v for p, v in best.extractParamMap().items() if estimator.hasParam(p.name)})
        return fit(train, name, estimator), time.time() - start, estimator

    found = _side_by_side(data.sparkSession, [partial(trained, name, estimator) for name, estimator in known.items()])
    fitted = dict(zip(known, found, strict=True))
    parts = [
        scorer(rest).select("CustomerID", "label", "split", F.lit(name).alias("Model"), "score")
        for name, (scorer, _, _) in fitted.items()
    ]
    return reduce(DataFrame.unionByName, parts), fitted


def stack(data: DataFrame, fitted: dict, folds: int = 5, seed: int = 7) -> DataFrame:
    """Stacking: out-of-fold scores of five base models feed a logistic model.

    The fold of a row is a hash of its key, so a row is never scored by a model that saw it."""
    base = [n for n in fitted if n != "Logistic Regression"]
    train = with_fold(data.filter("split = 'train'"), folds=folds, seed=seed)

    def scored(f: int, name: str) -> DataFrame:
        inner, held = train.filter(F.col("fold") != f), train.filter(F.col("fold") == f)
        scorer = fit(inner, name, fitted[name][2])
        return scorer(held).select("CustomerID", "label", F.lit(name).alias("Model"), "score")

    outside = _side_by_side(data.sparkSession, [partial(scored, f, name) for f in range(folds) for name in base])
    meta = LogisticRegression(maxIter=1000, featuresCol="stacked").fit(
        _stacked(reduce(DataFrame.unionByName, outside), base)
    )
    rest = data.filter("split <> 'train'")
    scores = [
        fitted[n][0](rest).select("CustomerID", "label", "split", F.lit(n).alias("Model"), "score") for n in base
    ]
    rows = meta.transform(_stacked(reduce(DataFrame.unionByName, scores), base, "split"))
    return rows.select(
        "CustomerID",
        "label",
        "split",
        F.lit("Stacking Ensemble").alias("Model"),
        F.element_at(vector_to_array("probability"), 2).alias("score"),
    )


def _stacked(scores: DataFrame, base: Sequence[str], *keep: str) -> DataFrame:
    """One vector of model scores per row; one grouping, no join per model."""
    columns: list[Column] = [
        F.max(F.when(F.col("Model") == n, F.col("score"))).alias(f"m{i}") for i, n in enumerate(base)
    ]
    wide = scores.groupBy("CustomerID", "label", *keep).agg(*columns)
    return as_vectors(wide, [f"m{i}" for i in range(len(base))], "stacked")


def compare(scores: DataFrame, times: dict[str, float] | None = None) -> DataFrame:
    """Metrics of every model at its own threshold (tuned on validation rows), with the AUC of the raw scores."""
    validation = scores.filter("split = 'validation'")
    test = scores.filter("split = 'test'")
    tuned = evaluate.tune_threshold(validation, by=("Model",)).select("Model", "Threshold")
    # one row per model is broadcast
    metrics = evaluate.classification_metrics(
        test.join(F.broadcast(tuned), "Model"), F.col("Threshold"), by=("Model", "Threshold")
    )
    table = metrics.join(evaluate.auc(test, by=("Model",)), "Model")
    seconds = F.lit(None).cast("double")
    for name, value in (times or {}).items():
        seconds = F.when(F.col("Model") == name, F.lit(float(value))).otherwise(seconds)
    return table.withColumn("Training_Time_Seconds", seconds)


def churn_comparison(
    data: DataFrame,
    width: int,
    sizes: Sizes,
    seed: int = 42,
    search: bool = True,
    stacking: bool = True,
    store: Callable[[str, DataFrame], DataFrame] = lambda name, df: df,
) -> tuple[DataFrame, DataFrame, dict]:
    """(comparison, scores, fitted) of the base models, two of them tuned by random search, and both ensembles.

    ``data`` is the output of ``prepare``. Every model passes over it many times, so store it as a table first. ``store`` writes the scores, which
    thresholds, metrics and AUC then read instead of running all models again."""
    scores, fitted = base_scores(data, width, sizes, seed, search)
    scores = store("base_scores", scores)
    vote = evaluate.soft_vote(scores, K.VOTING_WEIGHTS, ("CustomerID", "split")).select(
        "CustomerID", "label", "split", F.lit("Voting Ensemble").alias("Model"), "score"
    )
    parts = [scores, vote]
    if stacking:
        parts.append(stack(data, fitted, sizes.stack_folds))
    every = store("trained_scores", reduce(DataFrame.unionByName, parts))
    return compare(every, {n: f[1] for n, f in fitted.items()}), every, fitted


def feature_importance(model: Model, names: Sequence[str], spark, top: int = 10) -> DataFrame:
    """Largest importances of a tree model; the vector has one entry per feature."""
    pairs = sorted(zip(names, model.featureImportances.toArray().tolist(), strict=True), key=lambda p: (-p[1], p[0]))
    return spark.createDataFrame(pairs[:top], "Feature string, Importance double")


def vector_classifier(
    data: DataFrame, width: int, classes: int, hidden: Sequence[int] = (128,), max_iter: int = 200, seed: int = 42
) -> DataFrame:
    """Multi-class network on labelled vectors with a 70/15/15 split; predictions of the test part."""
    x = C.hash_fraction("vec_id", seed)
    part = F.when(x < 0.7, "train").when(x < 0.85, "validation").otherwise("test")
    rows = data.select(
        "vec_id",
        F.col("label").cast("double").alias("label"),
        array_to_vector(F.transform("features", lambda v: v.cast("double"))).alias("features"),
        part.alias("split"),
    )
    model = MultilayerPerceptronClassifier(layers=[width, *hidden, classes], maxIter=max_iter, seed=seed).fit(
        rows.filter("split = 'train'")
    )
    return model.transform(rows.filter("split = 'test'")).select("vec_id", "label", "prediction")
