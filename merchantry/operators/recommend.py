"""Collaborative, content-based and hybrid recommendations for all customers at once.

Nearest customers are found exactly, without pairing everybody who bought the same item:

1. Customers with the same direction of purchase vector form one *profile*. A profile needs to carry only its
   ``k + 1`` smallest customer numbers, because ties go to the smaller number.
2. For every item the ``head`` profiles with the largest weight are kept (at most items x head rows, broadcast).
   Each profile is compared with them inside its own task, which gives a lower bound ``t`` on the similarity of
   its k-th neighbour.
3. A profile outside the heads whose weights on all of u's items stay below ``t / sum(u)`` has a dot product below
   ``t``. Only tail entries above that level are joined, by item and weight level, and scored. Nothing is cut off.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from merchantry import constants as K
from merchantry.functions import columns as C

SIM_DIGITS = 9
LEVELS = 64


# --- purchase vectors -----------------------------------------------------------------------------------------


def quantities(orders: DataFrame) -> DataFrame:
    """(CustomerID, ProductID, TotalQty): the lines summed."""
    return orders.filter(F.col("Quantity") > 0).groupBy("CustomerID", "ProductID").agg(F.sum("Quantity").alias("TotalQty"))


def per_product(orders: DataFrame) -> DataFrame:
    """(ProductID, TotalQty): the sums of ``quantities`` over all customers, straight from the lines."""
    return orders.filter(F.col("Quantity") > 0).groupBy("ProductID").agg(F.sum("Quantity").alias("TotalQty"))


def interactions(sums: DataFrame, products: DataFrame) -> DataFrame:
    """``quantities``, or sums ``per_product``, with StockCode, ProductName and Category instead of the product's number."""
    return sums.join(products, "ProductID").select(*(c for c in sums.columns if c != "ProductID"), "StockCode", "ProductName", "Category")


def purchases_of(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """The ``interactions`` of a bounded top list. A stock code is one product, so its products are as few and are broadcast: of the lines, only theirs are sent."""
    few = F.broadcast(products.join(F.broadcast(items.select("StockCode")), "StockCode", "left_semi"))
    return interactions(quantities(orders.join(few.select("ProductID"), "ProductID", "left_semi")), few)


def top_items(actions: DataFrame, n: int = 200) -> DataFrame:
    """The ``n`` items of largest total quantity, numbered in stock-code order."""
    best = (
        actions.groupBy("StockCode")
        .agg(F.sum("TotalQty").alias("q"), F.max("ProductName").alias("ProductName"))
        .orderBy(F.desc("q"), "StockCode")
        .limit(n)
    )
    place = F.row_number().over(W.orderBy("StockCode")) - 1
    return best.select(place.cast("int").alias("Item"), "StockCode", "ProductName")


def weights(actions: DataFrame, items: DataFrame) -> DataFrame:
    """(CustomerID, Item, TotalQty, Weight) with Weight = log(1 + quantity); ``items`` is a bounded top list."""
    return actions.join(F.broadcast(items.select("StockCode", "Item")), "StockCode").select(
        "CustomerID", "Item", "StockCode", "TotalQty", F.log1p(F.col("TotalQty").cast("double")).alias("Weight")
    )


def matrix_summary(triples: DataFrame, digits: int = 6) -> DataFrame:
    sizes = triples.agg(
        F.countDistinct("CustomerID").alias("Users"),
        F.countDistinct("StockCode").alias("Items"),
        F.count("*").alias("NonZero"),
    )
    filled = C.ratio(F.col("NonZero") * 100, F.col("Users") * F.col("Items"))
    return sizes.withColumn("SparsityPercent", C.rounded(F.lit(100.0) - filled, digits))


def vectors(triples: DataFrame) -> DataFrame:
    """(CustomerID, vec = [(i, u)]) with unit length; a vector has at most one entry per top item."""
    entries = F.sort_array(F.collect_list(F.struct(F.col("Item").alias("i"), F.col("Weight").alias("w"))))
    raw = triples.groupBy("CustomerID").agg(entries.alias("_e"))
    norm = F.sqrt(F.aggregate("_e", F.lit(0.0), lambda a, x: a + x["w"] * x["w"]))
    unit = F.transform("_e", lambda x: F.struct(x["i"].alias("i"), (x["w"] / F.col("_n")).alias("u")))
    return raw.withColumn("_n", norm).select("CustomerID", unit.alias("vec"))


def similarity_summary(triples: DataFrame, digits: int = 6) -> DataFrame:
    """Mean cosine over all unordered customer pairs, zero pairs included, without any pair:
    the squared length of the summed unit vectors holds every pair's dot product twice."""
    users = vectors(triples)
    sums = users.select(F.inline("vec")).groupBy("i").agg(F.sum("u").alias("s"))
    n = users.agg(F.count("*").alias("n")).scalar()
    square = sums.agg(F.sum(F.col("s") * F.col("s")).alias("q"))
    return square.select(
        n.alias("Users"),
        C.rounded(C.ratio(F.col("q") - n, n.cast("double") * (n - 1)), digits).alias("MeanSimilarity"),
    )


# --- nearest customers ----------------------------------------------------------------------------------------


def _profiles(users: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(CustomerID -> pid) and one row per profile: pid, vec, its k+1 smallest customers."""
    shape = F.transform("vec", lambda x: F.struct(x["i"].alias("i"), F.round(x["u"], 12).alias("u")))
    keyed = users.withColumn("_shape", F.md5(F.to_json(shape)))
    place = F.row_number().over(W.partitionBy("_shape").orderBy("CustomerID"))
    few = keyed.withColumn("_rn", place).filter(F.col("_rn") <= k + 1)
    profiles = few.groupBy("_shape").agg(
        F.min("CustomerID").alias("pid"),
        F.min_by("vec", "CustomerID").alias("vec"),
        F.sort_array(F.collect_list("CustomerID")).alias("members"),
    )
    membership = keyed.select("CustomerID", "_shape").join(profiles.select("_shape", "pid"), "_shape")
    return membership.select("CustomerID", "pid"), profiles.select("pid", "vec", "members")


def _sparse(df: DataFrame, *keep: str) -> DataFrame:
    """Vectors as two plain arrays, which reach Python as numpy arrays."""
    return df.select(
        *keep, F.transform("vec", lambda x: x["i"]).alias("ix"), F.transform("vec", lambda x: x["u"]).alias("ux")
    )


def _dense(part: pd.DataFrame, width: int) -> np.ndarray:
    out = np.zeros((len(part), width))
    if len(part):
        rows = np.repeat(np.arange(len(part)), part["ix"].str.len().to_numpy(dtype="int64"))
        out[rows, np.concatenate(part["ix"].to_numpy())] = np.concatenate(part["ux"].to_numpy())
    return out


def _best_heads(profiles: DataFrame, heads: pd.DataFrame, width: int, k: int) -> DataFrame:
    """Compare every profile with the head profiles: best (pid, sim) list, itself included, and the bound t."""
    shared = profiles.sparkSession.sparkContext.broadcast(
        (heads["pid"].to_numpy(dtype="int64"), _dense(heads, width), heads["n"].to_numpy(dtype="int64"))
    )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, matrix, sizes = shared.value
        count = len(ids)
        take = min(k + 1, count)
        for batch in batches:
            found = {"pid": [], "near": [], "t": []}
            for start in range(0, len(batch), 256):
                part = batch.iloc[start : start + 256]
                sims = np.round(_dense(part, width) @ matrix.T, SIM_DIGITS)
                # heads are in customer order: among equal similarities the earlier column ranks first
                order = np.rint(sims * 10.0**SIM_DIGITS) * count + (count - 1 - np.arange(count))
                top = np.argpartition(-order, take - 1, axis=1)[:, :take]
                for r, (pid, n) in enumerate(zip(part["pid"], part["n"], strict=True)):
                    near = [(-1.0, int(pid), int(n))]
                    near += [
                        (-float(sims[r, c]), int(ids[c]), int(sizes[c])) for c in top[r] if sims[r, c] > 0 and ids[c] != pid
                    ]
                    near.sort()
                    reached = np.cumsum([size for _, _, size in near]) >= k + 1
                    found["pid"].append(pid)
                    found["near"].append([{"pid": p, "sim": -s} for s, p, _ in near])
                    found["t"].append(-near[int(np.argmax(reached))][0] if reached.any() else 0.0)
            yield pd.DataFrame(found)

    return _sparse(profiles, "pid", F.size("members").alias("n")).mapInPandas(
        compare, "pid long, near array<struct<pid: long, sim: double>>, t double"
    )


def _level(c: Column) -> Column:
    return F.floor(c * LEVELS).cast("int")


#: The largest table of head customers that is sent to every task.
HEAD_BYTES = 256 << 20


def neighbours(triples: DataFrame, n_items: int = 200, k: int = 10, head: int = 64) -> DataFrame:
    """Exact ``k`` most similar customers (CustomerID, NeighbourID, Similarity, Rank); ties to the smaller number.

    Customers without any shared item do not become neighbours.
    """
    users = vectors(triples)
    membership, profiles = _profiles(users, k)
    postings = profiles.select("pid", F.inline("vec"))
    rank = F.row_number().over(W.partitionBy("i").orderBy(F.desc("u"), "pid"))
    head_rows = postings.withColumn("_rn", rank).filter(F.col("_rn") <= head)
    # bounded by n_items * head profiles: collected once, then broadcast to the tasks
    head_ids = head_rows.select("pid").distinct()
    chosen = (
        _sparse(profiles.join(F.broadcast(head_ids), "pid", "left_semi"), "pid", F.size("members").alias("n"))
        .orderBy("pid")
        .toPandas()
    )
    if len(chosen) * n_items * 8 > HEAD_BYTES:
        raise ValueError("the table of head customers is too large to broadcast: lower head or n_items")
    edge_rows = head_rows.groupBy("i").agg(F.count("*").alias("c"), F.min("u").alias("edge")).collect()
    if chosen.empty:
        empty = "CustomerID long, NeighbourID long, Similarity double, Rank int"
        return triples.sparkSession.createDataFrame([], empty)
    near = _best_heads(profiles, chosen, n_items, k)

    # Items whose head is full may have a tail; its entries weigh no more than the edge of the head.
    edges = {r["i"]: r["edge"] for r in edge_rows if r["c"] >= head}
    candidates = near.select("pid", F.inline("near").alias("other", "sim"))
    if edges:
        candidates = candidates.unionByName(_tail_pairs(profiles, near, chosen, edges, k))
    best = F.sort_array(F.collect_list(F.struct((-F.col("sim")).alias("s"), F.col("other").alias("p"))))
    # both sources give at most k+2 rows per profile, so the lists are short
    lists = candidates.groupBy("pid").agg(F.slice(best, 1, k + 1).alias("near"))
    members = profiles.select(F.col("pid").alias("other"), "members")
    ranked = (
        lists.select("pid", F.inline("near").alias("s", "other"))
        .join(members, "other")
        .select("pid", "s", F.explode("members").alias("id"))
        .groupBy("pid")
        .agg(F.slice(F.sort_array(F.collect_list(F.struct("s", "id"))), 1, k + 1).alias("list"))
    )
    joined = membership.join(ranked, "pid")
    others = F.slice(F.filter("list", lambda x: x["id"] != F.col("CustomerID")), 1, k)
    return joined.select("CustomerID", F.posexplode(others).alias("pos", "n")).select(
        "CustomerID",
        F.col("n.id").alias("NeighbourID"),
        (-F.col("n.s")).alias("Similarity"),
        (F.col("pos") + 1).cast("int").alias("Rank"),
    )


def _tail_pairs(profiles: DataFrame, near: DataFrame, chosen: pd.DataFrame, edges: dict, k: int) -> DataFrame:
    """Profiles outside the heads that can still reach the bound: the best k+1 per profile."""
    spark = profiles.sparkSession
    # both tables are bounded by the number of top items (times the head length)
    edge = spark.createDataFrame([(int(i), float(u)) for i, u in edges.items()], "i int, edge double")
    heads = spark.createDataFrame([(int(p),) for p in chosen["pid"]], "pid long")
    tail = (
        profiles.join(F.broadcast(heads), "pid", "left_anti")
        .select(F.col("pid").alias("other"), F.col("vec").alias("other_vec"), F.inline("vec"))
        .select("other", "other_vec", "i", _level(F.col("u")).alias("level"))
    )
    total = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x["u"])
    levels = F.sequence(_level(F.col("_floor")), _level(F.col("edge")))
    probes = (
        profiles.select("pid", "vec")
        .join(near.select("pid", "t"), "pid")
        .withColumn("_floor", F.greatest(F.lit(0.0), (F.col("t") - 1e-8) / total))
        .select("pid", "vec", "t", "_floor", F.inline("vec"))
        .join(F.broadcast(edge), "i")
        .filter(F.col("edge") >= F.col("_floor"))
        .select("pid", "vec", "t", "i", F.explode(levels).alias("level"))
    )
    pairs = probes.join(tail, ["i", "level"]).filter(F.col("pid") != F.col("other"))
    dot = F.aggregate(
        "vec", F.lit(0.0), lambda a, x: a + x["u"] * F.coalesce(F.try_element_at(F.col("_m"), x["i"]), F.lit(0.0))
    )
    scored = (
        pairs.withColumn("_m", F.map_from_entries("other_vec"))
        .select("pid", "other", "t", F.round(dot, SIM_DIGITS).alias("sim"))
        .filter((F.col("sim") > 0) & (F.col("sim") >= F.col("t") - 1e-8))
        .groupBy("pid", "other")
        .agg(F.max("sim").alias("sim"))
    )
    place = F.row_number().over(W.partitionBy("pid").orderBy(F.desc("sim"), "other"))
    return scored.withColumn("_rn", place).filter(F.col("_rn") <= k + 1).select("pid", "other", "sim")


# --- collaborative ---------------------------------------------------------------------------------------------


def collaborative(
    triples: DataFrame, items: DataFrame, near: DataFrame, n: int = 5, pad_zero: bool = False
) -> DataFrame:
    """Best ``n`` items the customer has not bought: sum of neighbour similarity x weight.

    Scores and own purchases meet in one grouping, so no anti join is needed. ``pad_zero`` fills short lists with
    unscored items in stock-code order.
    """
    packed = triples.groupBy("CustomerID").agg(F.collect_list(F.struct("Item", "Weight")).alias("basket"))
    offered = (
        near.join(packed.select(F.col("CustomerID").alias("NeighbourID"), "basket"), "NeighbourID")
        .select("CustomerID", "Similarity", F.inline("basket"))
        .select("CustomerID", "Item", (F.col("Similarity") * F.col("Weight")).alias("score"), F.lit(0).alias("own"))
    )
    own = triples.select("CustomerID", "Item", F.lit(None).cast("double").alias("score"), F.lit(1).alias("own"))
    scored = (
        offered.unionByName(own)
        .groupBy("CustomerID", "Item")
        .agg(F.round(F.sum("score"), SIM_DIGITS).alias("score"), F.max("own").alias("own"))
        .filter((F.col("own") == 0) & (F.col("score") > 0))
    )
    if pad_zero:
        every = items.agg(F.sort_array(F.collect_list("Item")).alias("a")).scalar()
        bought = triples.groupBy("CustomerID").agg(F.collect_list("Item").alias("b"))
        spare = bought.select("CustomerID", F.explode(F.array_except(every, "b")).alias("Item"))
        zero = spare.select("CustomerID", "Item", F.lit(0.0).alias("score"))
        scored = (
            scored.select("CustomerID", "Item", "score")
            .unionByName(zero)
            .groupBy("CustomerID", "Item")
            .agg(F.max("score").alias("score"))
        )
    place = F.row_number().over(W.partitionBy("CustomerID").orderBy(F.desc("score"), "Item"))
    best = scored.withColumn("Rank", place).filter(F.col("Rank") <= n)
    return best.join(F.broadcast(items), "Item").select(
        "CustomerID", "StockCode", "ProductName", F.col("score").alias("Collaborative_Score"), "Rank"
    )


# --- content ---------------------------------------------------------------------------------------------------


def impute_sentiment(reviews: DataFrame, threshold: float = 0.9, noise_sd: float = 0.0, seed: int = 42) -> DataFrame:
    """Where more than ``threshold`` of the scores are missing, derive all of them from the rating."""
    missing = reviews.agg(C.ratio(F.sum(F.col("SentimentScore").isNull().cast("int")), F.count("*")).alias("m")).scalar()
    noise = F.randn(seed) * noise_sd if noise_sd else F.lit(0.0)
    derived = C.clip((F.col("Rating").try_cast("double") - 3) / 2 + noise, -1.0, 1.0)
    return reviews.withColumn("SentimentScore", F.when(missing > threshold, derived).otherwise(F.col("SentimentScore")))


def category_profile(reviews: DataFrame) -> DataFrame:
    """Content score per image class with its min-max normalisation; one row per class remains after grouping."""
    rows = (
        reviews.filter(F.col("CNN_Matched_Class").isNotNull())
        .groupBy("CNN_Matched_Class")
        .agg(
            F.avg("SentimentScore").alias("Avg_Sentiment"),
            F.avg("Rating").alias("Avg_Rating"),
            F.avg("Recommended").alias("Recommend_Rate"),
            F.avg("PositiveFeedback").alias("Avg_Feedback"),
            F.count("ReviewID").alias("Total_Reviews"),
        )
    )
    everywhere = W.partitionBy()
    score = (
        F.coalesce("Avg_Sentiment", F.lit(0.0)) * 0.3
        + F.col("Avg_Rating") / 5.0 * 0.3
        + F.coalesce("Recommend_Rate", F.lit(0.0)) * 0.2
        + C.ratio("Avg_Feedback", F.max("Avg_Feedback").over(everywhere)) * 0.2
    )
    low, high = F.min("Content_Score").over(everywhere), F.max("Content_Score").over(everywhere)
    return rows.withColumn("Content_Score", score).withColumn(
        "Content_Score_Normalized", C.ratio(F.col("Content_Score") - low, high - low)
    )


def content_items(reviews: DataFrame, n: int = 5) -> DataFrame:
    """Best review classes per image class by item score."""
    rows = (
        reviews.filter(F.col("CNN_Matched_Class").isNotNull() & F.col("ClassName").isNotNull())
        .groupBy("CNN_Matched_Class", "ClassName")
        .agg(
            F.avg("SentimentScore").alias("_s"),
            F.avg("Rating").alias("Avg_Rating"),
            F.avg("Recommended").alias("_r"),
            F.count("ReviewID").alias("Review_Count"),
        )
    )
    score = (
        F.coalesce("_s", F.lit(0.0)) * 0.4 + F.col("Avg_Rating") / 5.0 * 0.3 + F.coalesce("_r", F.lit(0.0)) * 0.3
    )
    scored = rows.withColumn("Item_Score", F.round(score, SIM_DIGITS))
    place = F.row_number().over(W.partitionBy("CNN_Matched_Class").orderBy(F.desc("Item_Score"), "ClassName"))
    return (
        scored.withColumn("Rank", place)
        .filter(F.col("Rank") <= n)
        .select("CNN_Matched_Class", "ClassName", "Avg_Rating", "Review_Count", "Item_Score", "Rank")
    )


# --- hybrid ----------------------------------------------------------------------------------------------------


def hybrid(
    requests: DataFrame,
    triples: DataFrame,
    items: DataFrame,
    near: DataFrame,
    reviews: DataFrame,
    n: int = 5,
) -> DataFrame:
    """Recommendations for a table of requests (CustomerID, CNN_Matched_Class, the class may be null).

    Collaborative candidates (2n) are scaled by the sum of the neighbour similarities, content candidates (the
    best 3 of the class) by min-max. A product name that occurs twice keeps its last, lowest score.
    """
    mass = near.groupBy("CustomerID").agg(F.sum("Similarity").alias("_mass"))
    by_rank = collaborative(triples, items, near, 2 * n)
    by_name = by_rank.groupBy("CustomerID", "ProductName").agg(
        F.max_by("Collaborative_Score", "Rank").alias("Collaborative_Score")
    )
    scaled = C.clip(F.coalesce(C.ratio("Collaborative_Score", "_mass"), F.lit(0.0)), 0.0, 1.0)
    collab = (
        requests.select("CustomerID", "CNN_Matched_Class")
        .join(by_name, "CustomerID")
        .join(mass, "CustomerID", "left")
        .select(
            "CustomerID",
            "CNN_Matched_Class",
            F.col("ProductName").alias("Product"),
            (scaled * K.COLLABORATIVE_WEIGHT).alias("Collaborative"),
            F.lit(0.0).alias("Content"),
            F.lit("Collaborative").alias("Source"),
        )
    )
    top = content_items(reviews, 3)
    per_class = W.partitionBy("CNN_Matched_Class")
    low, high = F.min("Item_Score").over(per_class), F.max("Item_Score").over(per_class)
    spread = F.when(high == low, F.lit(1.0)).otherwise(high - low)
    scored = top.withColumn("_c", (F.col("Item_Score") - low) / spread)
    # at most three rows per image class are broadcast
    content = requests.join(F.broadcast(scored.select("CNN_Matched_Class", "ClassName", "_c")), "CNN_Matched_Class").select(
        "CustomerID",
        "CNN_Matched_Class",
        F.concat("ClassName", F.lit(" ("), "CNN_Matched_Class", F.lit(")")).alias("Product"),
        F.lit(0.0).alias("Collaborative"),
        (F.col("_c") * K.CONTENT_WEIGHT).alias("Content"),
        F.lit("Content-Based (CNN)").alias("Source"),
    )
    both = collab.unionByName(content).withColumn(
        "Hybrid_Score", F.round(F.col("Collaborative") + F.col("Content"), SIM_DIGITS)
    )
    order = W.partitionBy("CustomerID", "CNN_Matched_Class").orderBy(F.desc("Hybrid_Score"), "Product")
    return both.withColumn("Rank", F.row_number().over(order)).filter(F.col("Rank") <= n)
