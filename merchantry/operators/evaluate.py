"""Evaluation of scored rows (id, label 0/1, score)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from merchantry.functions import columns as C
from merchantry.operators.ordered import running_totals

# Thresholds 0.300, 0.305, ... 0.695, as multiples of 1/200.
FIRST_STEP, LAST_STEP, STEPS_PER_UNIT = 60, 139, 200


def _step(score: Column) -> Column:
    """Number of the highest threshold the score reaches; corrected by comparison, so no rounding slips in."""
    guess = F.floor(score * STEPS_PER_UNIT)
    up = F.when(score >= (guess + 1) / F.lit(float(STEPS_PER_UNIT)), guess + 1)
    down = F.when(score < guess / F.lit(float(STEPS_PER_UNIT)), guess - 1)
    return F.least(F.greatest(F.coalesce(up, down, guess), F.lit(FIRST_STEP - 1)), F.lit(LAST_STEP)).cast("int")


def threshold_table(scored: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """True and false positives at every threshold. Rows are first counted per threshold step, so the data is
    read once instead of once per threshold, and the running sum works on at most 81 rows per key."""
    counts = scored.groupBy(*by, _step(F.col("score")).alias("step")).agg(
        F.sum(F.col("label").cast("long")).alias("pos"), F.count("*").alias("n")
    )
    frame = scored.sparkSession.range(FIRST_STEP - 1, LAST_STEP + 1).select(F.col("id").cast("int").alias("step"))
    keys = counts.select(*by).distinct() if by else None
    if keys is not None:
        grid = keys.withColumn("step", F.explode(F.sequence(F.lit(FIRST_STEP - 1), F.lit(LAST_STEP))))
    else:
        grid = frame
    full = grid.join(counts, [*by, "step"], "left").fillna(0, subset=["pos", "n"])
    above = W.partitionBy(*by).orderBy(F.desc("step")).rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy(*by)
    return (
        full.select(
            *by,
            "step",
            F.sum("pos").over(above).alias("TP"),
            F.sum("n").over(above).alias("Predicted"),
            F.sum("pos").over(whole).alias("Positives"),
            F.sum("n").over(whole).alias("Rows"),
        )
        .filter(F.col("step") >= FIRST_STEP)
        .withColumn("Threshold", F.col("step") / F.lit(float(STEPS_PER_UNIT)))
    )


def _metrics(df: DataFrame, *keep: str) -> DataFrame:
    tp, predicted, positives, n = F.col("TP"), F.col("Predicted"), F.col("Positives"), F.col("Rows")
    return df.select(
        *keep,
        C.ratio(n - positives - predicted + tp + tp, n).alias("Accuracy"),
        C.ratio(tp, predicted).alias("Precision"),
        C.ratio(tp, positives).alias("Recall"),
        C.ratio(tp * 2, predicted + positives).alias("F1_Score"),
    )


def tune_threshold(scored: DataFrame, metric: str = "Accuracy", by: tuple[str, ...] = ()) -> DataFrame:
    """Best threshold by the metric; the lowest threshold wins ties."""
    table = _metrics(threshold_table(scored, by), *by, "Threshold")
    best = F.struct(F.col(metric).alias("v"), (-F.col("Threshold")).alias("t"))
    return table.groupBy(*by).agg(F.max(best).alias("b")).select(
        *by, (-F.col("b.t")).alias("Threshold"), F.col("b.v").alias(metric)
    )


def classification_metrics(scored: DataFrame, threshold: float | Column = 0.5, by: tuple[str, ...] = ()) -> DataFrame:
    threshold = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    hit = (F.col("score") >= threshold).cast("int")
    label = F.col("label").cast("int")
    counts = scored.groupBy(*by).agg(
        F.sum(hit * label).alias("TP"),
        F.sum(hit).alias("Predicted"),
        F.sum(label).alias("Positives"),
        F.count("*").alias("Rows"),
    )
    return _metrics(counts, *by)


def auc(scored: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Tie-aware area under the ROC curve from per-score counts: the rank-sum statistic over running totals."""
    counts = scored.groupBy(*by, "score").agg(
        F.sum(F.col("label").cast("long")).alias("pos"), F.count("*").alias("n")
    )
    counts = counts.withColumn("neg", F.col("n") - F.col("pos"))
    ranked = running_totals(counts, "score", ["neg"], by)
    wins = F.col("pos") * (F.col("before_neg") + F.col("neg") / 2)
    sums = ranked.groupBy(*by).agg(F.sum(wins).alias("_w"), F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    return sums.select(*by, C.ratio("_w", F.col("_p").cast("double") * F.col("_n")).alias("AUC"))


def roc_curve(scored: DataFrame, bins: int = 1000, by: tuple[str, ...] = ()) -> DataFrame:
    """ROC points per score bin; only binned counts are ordered."""
    slot = F.least(F.floor(F.col("score") * bins), F.lit(bins - 1)).cast("int")
    counts = scored.groupBy(*by, slot.alias("bin")).agg(
        F.sum(F.col("label").cast("long")).alias("pos"), F.count("*").alias("n")
    )
    above = W.partitionBy(*by).orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy(*by)
    neg = F.col("n") - F.col("pos")
    return counts.select(
        *by,
        (F.col("bin") / F.lit(float(bins))).alias("Threshold"),
        C.ratio(F.sum(neg).over(above), F.sum(neg).over(whole)).alias("FPR"),
        C.ratio(F.sum("pos").over(above), F.sum("pos").over(whole)).alias("TPR"),
    )


def confusion_matrix(predicted: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return predicted.groupBy(
        F.col(label).cast("int").alias("Actual"), F.col(prediction).cast("int").alias("Predicted")
    ).agg(F.count("*").alias("Rows"))


def class_report(predicted: DataFrame, label: str = "label", prediction: str = "prediction", digits: int = 6) -> DataFrame:
    """Precision, recall, F1 and support per class, from the confusion counts."""
    cells = confusion_matrix(predicted, label, prediction)
    sides = F.array(
        F.struct(F.col("Actual").alias("Class"), F.lit("a").alias("side"), "Rows", F.col("Predicted").alias("other")),
        F.struct(F.col("Predicted").alias("Class"), F.lit("p").alias("side"), "Rows", F.col("Actual").alias("other")),
    )
    rows = cells.select(F.inline(sides))
    actual = F.sum(F.when(F.col("side") == "a", F.col("Rows")).otherwise(0))
    guessed = F.sum(F.when(F.col("side") == "p", F.col("Rows")).otherwise(0))
    right = F.sum(F.when((F.col("side") == "a") & (F.col("Class") == F.col("other")), F.col("Rows")).otherwise(0))
    sums = rows.groupBy("Class").agg(actual.alias("Support"), guessed.alias("_p"), right.alias("_t"))
    return sums.select(
        "Class",
        C.rounded(F.coalesce(C.ratio("_t", "_p"), F.lit(0.0)), digits).alias("Precision"),
        C.rounded(F.coalesce(C.ratio("_t", "Support"), F.lit(0.0)), digits).alias("Recall"),
        C.rounded(F.coalesce(C.ratio(F.col("_t") * 2, F.col("_p") + F.col("Support")), F.lit(0.0)), digits).alias("F1"),
        "Support",
    )


def soft_vote(scores: DataFrame, weights: dict[str, float], keys: tuple[str, ...] = ("CustomerID",)) -> DataFrame:
    """Weighted mean of the model scores in (keys, label, Model, score) rows; one grouping, no join per model."""
    weight = F.create_map(*[F.lit(x) for kv in weights.items() for x in kv])
    used = scores.filter(F.col("Model").isin(list(weights)))
    w = F.element_at(weight, F.col("Model"))
    voted = used.groupBy(*keys, "label").agg(C.ratio(F.sum(F.col("score") * w), F.sum(w)).alias("score"))
    return voted.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


def best_model(comparison: DataFrame, metric: str = "F1_Score") -> DataFrame:
    """The row of the best model, ties to the smaller name."""
    columns = comparison.columns
    best = comparison.orderBy(F.desc(metric), "Model").limit(1)
    return best.select(*columns)
