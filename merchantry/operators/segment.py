"""Customer segmentation: scaling, clustering, cluster quality and business labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from merchantry.functions import columns as C
from merchantry.operators import kmeans, silhouette

FEATURES = ("Recency", "Frequency", "Monetary")


def scaling(df: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """One row with mean and population deviation per column."""
    return df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"{c}_mean") for c in columns],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"{c}_std") for c in columns],
    )


def standardise(df: DataFrame, columns: Sequence[str] = FEATURES, fit_on: DataFrame | None = None) -> DataFrame:
    """Replace columns by z-scores with the statistics of ``fit_on`` (default: the data itself).
    Two figures per column are fetched and become literals; a constant column is only centred."""
    row = scaling(df if fit_on is None else fit_on, columns).first()

    def z(c: str) -> Column:
        x = F.col(c).cast("double") - F.lit(row[f"{c}_mean"])
        return x / F.lit(row[f"{c}_std"]) if row[f"{c}_std"] else x

    return df.withColumns({c: z(c) for c in columns})


def as_vectors(df: DataFrame, columns: Sequence[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(columns), outputCol=name).transform(df)


def best_kmeans(data: DataFrame, k: int, seeds: Sequence[int] = tuple(range(42, 52)), max_iter: int = 300) -> KMeansModel:
    """Lowest-cost model over several starts, as a Spark ML model that can be saved."""
    models = [KMeans(k=k, seed=s, maxIter=max_iter, initSteps=2).fit(data) for s in seeds]
    return min(models, key=lambda m: m.summary.trainingCost)


def assign(rfm: DataFrame, model: KMeansModel, key: str = "CustomerID") -> DataFrame:
    scaled = as_vectors(standardise(rfm.select(key, *FEATURES)), FEATURES)
    found = model.transform(scaled).select(key, F.col("prediction").alias("Cluster"))
    return rfm.join(found, key)


def k_sweep(
    rfm: DataFrame, ks: Sequence[int] = tuple(range(2, 11)), starts: Sequence[int] = tuple(range(42, 52)), key: str = "CustomerID", *, store: silhouette.Store, error: float = 1e-6
) -> DataFrame:
    """Cost, Euclidean silhouette (right to ``error``) and Davies-Bouldin index of the best of all starts, per number of clusters. All runs advance together; only centres and these figures reach the driver."""
    scaled = store("scaled_rfm", standardise(rfm.select(key, *FEATURES)))
    best = kmeans.best(kmeans.fit(scaled, FEATURES, ks, key=key, starts=starts))
    found = store("sweep_clusters", kmeans.numbered(scaled, FEATURES, [r.centres for r in best.values()]))
    quality = silhouette.silhouettes(found, FEATURES, F.col("c"), list(best), error=error, store=store)
    rows = [(k, best[k].cost, quality[i], i) for i, k in enumerate(best)]
    sweep = rfm.sparkSession.createDataFrame(rows, "K int, WCSS double, Silhouette double, place int")
    index = davies_bouldin(found.select(*FEATURES, F.posexplode("c").alias("place", "Cluster")), by=("place",))
    return sweep.join(index, "place", "left").drop("place")


def best_k(sweep: DataFrame) -> int:
    return sweep.agg(F.max_by("K", F.struct("Silhouette", -F.col("K")))).first()[0]


def fitted_centres(rfm: DataFrame, k: int, starts: Sequence[int] = tuple(range(42, 52)), key: str = "CustomerID") -> Sequence[Sequence[float]]:
    """Centres of the best start, in standardised units; clusters are numbered by their centres in ascending order, so their numbers don't depend on the start."""
    runs = kmeans.fit(standardise(rfm.select(key, *FEATURES)), FEATURES, [k], key=key, starts=starts)
    return sorted(tuple(c) for c in kmeans.best(runs)[k].centres.tolist()) if runs else []


def nearest_centre(centres: Sequence[Sequence[float]], columns: Sequence[str] = FEATURES) -> Column:
    """Number of the nearest of some given centres, ties to the smaller one; the centres are a short literal list."""
    def distance(centre: Sequence[float]) -> Column:
        return sum(((F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v))) for c, v in zip(columns, centre, strict=True)), F.lit(0.0))

    options = [F.struct(F.round(distance(c), 9).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centres)]
    return (F.least(*options) if len(options) > 1 else options[0])["i"]


def assign_to_centres(scaled: DataFrame, centres: Sequence[Sequence[float]], columns: Sequence[str] = FEATURES) -> DataFrame:
    """Nearest given centre per row."""
    return scaled.withColumn("Cluster", nearest_centre(centres, columns))


def davies_bouldin(assigned: DataFrame, columns: Sequence[str] = FEATURES, digits: int | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Mean over clusters of the worst (spread_i + spread_j) / distance_ij; with ``by``, for each of several clusterings.

    Rows meet only their own centre. The comparison of clusters works on one array of K entries.
    """
    centres = assigned.groupBy(*by, "Cluster").agg(*[F.avg(c).alias(f"{c}_m") for c in columns])
    gap = sum(((F.col(c) - F.col(f"{c}_m")) ** 2 for c in columns), F.lit(0.0))
    # one row per cluster is broadcast
    spread = (
        assigned.join(F.broadcast(centres), [*by, "Cluster"])
        .groupBy(*by, "Cluster", *[f"{c}_m" for c in columns])
        .agg(F.avg(F.sqrt(gap)).alias("s"))
    )
    one = spread.groupBy(*by).agg(
        F.sort_array(F.collect_list(F.struct("Cluster", "s", *[f"{c}_m" for c in columns]))).alias("all")
    )
    worst = F.transform(
        "all",
        lambda a: F.array_max(
            F.transform(
                F.filter(F.col("all"), lambda b: b["Cluster"] != a["Cluster"]),
                lambda b: F.try_divide(
                    a["s"] + b["s"],
                    F.sqrt(sum(((a[f"{c}_m"] - b[f"{c}_m"]) * (a[f"{c}_m"] - b[f"{c}_m"]) for c in columns), F.lit(0.0))),
                ),
            )
        ),
    )
    mean = F.try_divide(F.aggregate(worst, F.lit(0.0), lambda x, y: x + y), F.size("all"))
    return one.select(*by, C.rounded(mean, digits).alias("DaviesBouldin"))


def centres_of(assigned: DataFrame, columns: Sequence[str] = FEATURES) -> DataFrame:
    """Cluster centres in original units."""
    return assigned.groupBy("Cluster").agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns])


def segment_labels(centres: DataFrame) -> DataFrame:
    """Business label per centre; the medians and the quartile are taken over the K centres, and a repeated
    label gets a running number."""
    limits = centres.agg(
        F.struct(
            F.median("Recency").alias("r"),
            F.median("Frequency").alias("f"),
            F.median("Monetary").alias("m"),
            F.percentile("Recency", 0.75).alias("r75"),
        ).alias("l")
    ).scalar()
    recent = F.col("Recency") < limits["r"]
    often = F.col("Frequency") > limits["f"]
    rich = F.col("Monetary") > limits["m"]
    label = (
        F.when(recent & often & rich, "Champions")
        .when(recent & often, "Loyal")
        .when(recent, "New Customers")
        .when(F.col("Recency") > limits["r75"], "Lost")
        .otherwise("At Risk")
    )
    place = F.row_number().over(W.partitionBy("_label").orderBy("Cluster"))
    named = centres.withColumn("_label", label).withColumn("_n", place)
    suffix = F.when(F.col("_n") == 1, F.lit("")).otherwise(F.concat(F.lit(" "), F.col("_n").cast("string")))
    return named.select("Cluster", *FEATURES, F.concat("_label", suffix).alias("RFM_Segment"))


def label_customers(assigned: DataFrame) -> DataFrame:
    """Assigned customers with their segment name; one row per cluster is broadcast."""
    labels = segment_labels(centres_of(assigned)).select("Cluster", "RFM_Segment")
    return assigned.drop("RFM_Segment").join(F.broadcast(labels), "Cluster")


def segment_shares(customers: DataFrame, digits: int = 6) -> DataFrame:
    """Means per segment and the share of customers."""
    total = customers.agg(F.count("*").alias("n")).scalar()
    means = customers.groupBy("RFM_Segment").agg(
        F.count("*").alias("Customers"),
        *[C.rounded(F.avg(F.col(c).cast("double")), digits).alias(f"Avg{c}") for c in FEATURES],
    )
    return means.withColumn("Percent", C.rounded(C.ratio(F.col("Customers") * 100, total), digits))
