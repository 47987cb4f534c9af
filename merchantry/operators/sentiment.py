"""Lexicon sentiment of review texts, as a join of tokens with a lexicon table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchantry import constants as K
from merchantry.functions import columns as C

# Words that turn the meaning of the next word.
NEGATORS = ("not", "no", "never", "none", "nor", "cannot", "without", "isn't", "wasn't", "don't", "didn't", "won't")


def tokens(c: str | Column) -> Column:
    """Lower-case words of a cleaned text, punctuation trimmed off their ends."""
    edges = F.regexp_replace(F.lower(C.col(c)), r"^[.,!?'-]+|[.,!?'-]+$", "")
    return F.array_remove(F.split(edges, r"[.,!?'-]*\s+[.,!?'-]*"), "")


def score_texts(
    reviews: DataFrame,
    lexicon: DataFrame,
    key: str = "ReviewID",
    text: str = "ReviewText",
    negators: Sequence[str] = NEGATORS,
) -> DataFrame:
    """(key, VADER_Score, TextBlob_Score, TextBlob_Subjectivity) for every text.

    ``lexicon`` has the columns Word, Valence, Polarity, Subjectivity. Each word is paired with the one before
    it inside the row, so negation needs no ordering of exploded tokens. The sums per text combine inside the
    task that exploded it, so one small row per text is shuffled however long the text is. The lexicon join
    carries no hint: its size decides how it runs.
    """
    words = reviews.select(key, tokens(C.clean_text(text)).alias("_w"))
    before = F.concat(F.array(F.lit("")), F.col("_w"))
    pairs = words.select(key, F.explode(F.arrays_zip(F.col("_w").alias("word"), before.alias("prev"))).alias("t"))
    hits = pairs.select(key, F.col("t.word").alias("Word"), F.col("t.prev").alias("prev")).join(lexicon, "Word")
    sign = F.when(F.col("prev").isin(list(negators)), F.lit(K.NEGATION_FACTOR)).otherwise(F.lit(1.0))
    sums = hits.groupBy(key).agg(
        F.sum(F.col("Valence") * sign).alias("_v"),
        F.avg(F.col("Polarity") * sign).alias("_p"),
        F.avg("Subjectivity").alias("_s"),
    )
    total = F.coalesce("_v", F.lit(0.0))
    return (
        reviews.select(key)
        .join(sums, key, "left")
        .select(
            key,
            (total / F.sqrt(total * total + F.lit(K.COMPOUND_ALPHA))).alias("VADER_Score"),
            F.coalesce("_p", F.lit(0.0)).alias("TextBlob_Score"),
            F.coalesce("_s", F.lit(0.0)).alias("TextBlob_Subjectivity"),
        )
    )


def score_with(reviews: DataFrame, scorer: Column, name: str) -> DataFrame:
    """Plug in another scorer, for example a pandas UDF from text to double."""
    return reviews.withColumn(name, scorer)


def ensemble(scored: DataFrame) -> DataFrame:
    """Standardise both scores (sample deviation), average, squash with tanh and label."""
    stats = scored.agg(
        F.struct(
            F.avg("VADER_Score").alias("vm"),
            F.stddev_samp("VADER_Score").alias("vs"),
            F.avg("TextBlob_Score").alias("tm"),
            F.stddev_samp("TextBlob_Score").alias("ts"),
        ).alias("s")
    ).scalar()
    v = C.ratio(F.col("VADER_Score") - stats["vm"], stats["vs"])
    t = C.ratio(F.col("TextBlob_Score") - stats["tm"], stats["ts"])
    out = scored.withColumn("Ensemble_Score", F.tanh((v + t) / 2))
    return out.withColumns(
        {
            "VADER_Label": C.polarity("VADER_Score"),
            "TextBlob_Label": C.polarity("TextBlob_Score"),
            "Final_Sentiment": C.polarity("Ensemble_Score", strict=True),
        }
    )


def sentiment_results(reviews: DataFrame, scored: DataFrame) -> DataFrame:
    """Export layout: review attributes with all scores."""
    return reviews.select("ReviewID", "Rating", "ClassName", "CNN_Matched_Class").join(
        scored.select(
            "ReviewID", "VADER_Score", "TextBlob_Score", "Ensemble_Score", "Final_Sentiment", "TextBlob_Subjectivity"
        ),
        "ReviewID",
    )


def sentiment_by_class(results: DataFrame, digits: int = 6) -> DataFrame:
    positive = (F.col("Final_Sentiment") == "Positive").cast("int")
    return (
        results.filter(F.col("CNN_Matched_Class").isNotNull())
        .groupBy("CNN_Matched_Class")
        .agg(
            C.rounded(F.avg("Ensemble_Score"), digits).alias("Avg_Sentiment"),
            C.rounded(F.avg("Rating"), digits).alias("Avg_Rating"),
            F.count("ReviewID").alias("Total_Reviews"),
            C.rounded(F.avg(positive) * 100, digits).alias("Positive_Pct"),
        )
        .orderBy(F.desc("Avg_Sentiment"), "CNN_Matched_Class")
    )


def label_shares(scored: DataFrame, digits: int = 6) -> DataFrame:
    """Counts and shares of the three labels for each scorer, in one pass over the scores."""
    names = ["VADER_Label", "TextBlob_Label", "Final_Sentiment"]
    pairs = F.array(*[F.struct(F.lit(n).alias("Scorer"), F.col(n).alias("Label")) for n in names])
    total = scored.agg(F.count("*").alias("n")).scalar()
    counts = scored.select(F.inline(pairs)).groupBy("Scorer", "Label").agg(F.count("*").alias("Reviews"))
    return counts.withColumn("Percent", C.rounded(C.ratio(F.col("Reviews") * 100, total), digits))


def sentiment_summary(results: DataFrame, digits: int = 6) -> DataFrame:
    """Averages and the two correlations of the closing summary."""
    return results.agg(
        F.count("*").alias("Reviews"),
        C.rounded(F.avg("VADER_Score"), digits).alias("AvgVader"),
        C.rounded(F.avg("TextBlob_Score"), digits).alias("AvgTextBlob"),
        C.rounded(F.avg("Ensemble_Score"), digits).alias("AvgEnsemble"),
        C.rounded(F.corr("VADER_Score", "TextBlob_Score"), digits).alias("CorrScorers"),
        C.rounded(F.corr("Ensemble_Score", "Rating"), digits).alias("CorrRating"),
    )
