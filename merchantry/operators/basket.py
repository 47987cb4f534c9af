"""Market baskets: transactions, frequent itemsets, association rules, pair counts."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchantry.functions import columns as C


#: Lines of a part that a task groups and sorts by invoice.
PART_LINES = 500_000


def by_invoice(lines: DataFrame) -> DataFrame:
    """The lines dealt by invoice to parts whose number follows theirs, at least the session's number of shuffle partitions. Adaptive execution
    doesn't merge parts of a given number, so it can't make as few and as large ones as there are cores."""
    least = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return lines.repartition(max(least, math.ceil(lines.count() / PART_LINES)), "InvoiceNo")


def transactions(orders: DataFrame, products: DataFrame, item: str = "ProductName", top: int = 100) -> DataFrame:
    """Distinct (InvoiceNo, item) rows of invoices with two or more products, for the ``top`` items by line count.

    Two products in an invoice means its smallest and largest product differ, so the test needs no distinct
    aggregate. The top items are at most ``top`` rows and are broadcast. Lines are sent by invoice once: the test and the join read the same parts. So
    that both ask for the same rows and columns, the test looks at the largest quantity too, and lines without a positive one go after they are
    summed. Lines are summed per product before they meet the product table.
    """
    known = orders.select("InvoiceNo", "ProductID", "Quantity").filter(F.col("InvoiceNo").isNotNull() & F.col("ProductID").isNotNull())
    lines = by_invoice(known)
    several = (
        lines.groupBy("InvoiceNo")
        .agg(F.min("ProductID").alias("lo"), F.max("ProductID").alias("hi"), F.max("Quantity").alias("most"))
        .filter((F.col("lo") < F.col("hi")) & (F.col("most") > 0))
        .select("InvoiceNo")
    )
    # An invoice is one row of the test, so this keeps lines as they are; a semi join would be moved below the sending of lines.
    sold = lines.join(several, "InvoiceNo")
    named = products.select("ProductID", F.col(item).alias("Item"))
    sums = sold.groupBy("ProductID").agg(F.count_if(F.col("Quantity") > 0).alias("n")).filter(F.col("n") > 0).join(named, "ProductID")
    best = sums.groupBy("Item").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "Item").limit(top).select("Item")
    of_best = named.join(F.broadcast(best), "Item", "left_semi")
    return sold.join(of_best, "ProductID").groupBy("InvoiceNo", "Item").agg(F.max("Quantity").alias("q")).filter(F.col("q") > 0).select("InvoiceNo", "Item")


def baskets(rows: DataFrame) -> DataFrame:
    """One sorted item array per invoice. Its length is bounded by the number of top items."""
    return rows.groupBy("InvoiceNo").agg(F.sort_array(F.collect_set("Item")).alias("items"))


#: Items that share a word of a basket's bits; the sign bit is left out.
WORD = 63
#: Baskets that a task counts at once.
BASKET_BATCH = 4096


def frequent_itemsets(rows: DataFrame, min_support: float = 0.03) -> DataFrame:
    """(items, freq, n, Support, Length); the support is relative to the invoices that hold any top item.

    A basket is the bits of its frequent items, and equal baskets are one row with a weight. Sets are counted size by size: a set of k + 1 items is looked at when all its subsets of k are frequent, as in
    the Apriori method. A pass adds up small partial counts of the tasks; only itemsets and their counts, which are the result, reach the driver.
    """
    total = rows.select("InvoiceNo").distinct().count()
    least = math.ceil(min_support * total)
    # An item's lines are at least its invoices, so no frequent item is lost here.
    found = rows.filter(F.col("Item").isNotNull()).groupBy("Item").agg(F.count("*").alias("c")).filter(F.col("c") >= least).orderBy("Item")
    names = [r["Item"] for r in found.select("Item").collect()]
    kind = f"items array<{rows.schema['Item'].dataType.simpleString()}>, freq long"
    sets: list[tuple[list, int]] = []
    if names:
        baskets_ = _weighted_baskets(rows, names).persist()
        try:
            level = [(i,) for i in range(len(names))]
            while level:
                counts = _count_sets(baskets_, level, len(names))
                frequent = [(c, n) for c, n in zip(level, counts, strict=True) if n >= least and n > 0]
                sets += [([names[i] for i in c], n) for c, n in frequent]
                level = _next_level([c for c, _ in frequent])
        finally:
            baskets_.unpersist()
    return rows.sparkSession.createDataFrame(sets, kind).select(
        F.sort_array("items").alias("items"),
        "freq",
        F.lit(total).cast("long").alias("n"),
        C.ratio("freq", F.lit(total)).alias("Support"),
        F.size("items").alias("Length"),
    )


def _weighted_baskets(rows: DataFrame, names: Sequence) -> DataFrame:
    """(m0, m1, ..., w): the bits of the given items, which are few, and the number of invoices that hold just these."""
    session = rows.sparkSession
    places = session.createDataFrame([(x, i // WORD, i % WORD) for i, x in enumerate(names)], f"Item {rows.schema['Item'].dataType.simpleString()}, word int, bit int")
    words = [f"m{k}" for k in range(-(-len(names) // WORD))]
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
    bits = [F.bit_or(F.when(F.col("word") == k, bit).otherwise(F.lit(0).cast("long"))).alias(m) for k, m in enumerate(words)]
    per_invoice = rows.join(F.broadcast(places), "Item").groupBy("InvoiceNo").agg(*bits)
    return per_invoice.groupBy(*words).agg(F.count("*").alias("w"))


def _count_sets(weighted: DataFrame, level: Sequence[tuple[int, ...]], width: int) -> list[int]:
    """How many invoices hold each set of a level. Sets that differ in their last item only are counted together."""
    groups = [(list(head), at, [level[i][-1] for i in at]) for head, at in _by_head(level)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(len(level), np.int64)
        for batch in batches:
            for start in range(0, batch.num_rows, BASKET_BATCH):
                part = batch.slice(start, BASKET_BATCH)
                weights = part.column("w").to_numpy()
                holds = np.stack([part.column(f"m{i // WORD}").to_numpy() >> (i % WORD) & 1 for i in range(width)], axis=1)
                for head, at, last in groups:
                    has = np.flatnonzero(holds[:, head].all(axis=1)) if head else slice(None)
                    out[at] += weights[has] @ holds[has][:, last]
        some = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(out[some])], ["at", "n"])

    counts = [0] * len(level)
    for r in weighted.mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        counts[r["at"]] = r["n"]
    return counts


def _by_head(level: Sequence[tuple[int, ...]]) -> Iterator[tuple[tuple[int, ...], list[int]]]:
    for head, at in itertools.groupby(range(len(level)), lambda i: level[i][:-1]):
        yield head, list(at)


def _next_level(frequent: Sequence[tuple[int, ...]]) -> list[tuple[int, ...]]:
    """Sets of one more item whose every subset is frequent, in order."""
    known = set(frequent)
    out = []
    for head, at in _by_head(frequent):
        for x, y in itertools.combinations([frequent[i][-1] for i in at], 2):
            longer = (*head, x, y)
            if all(longer[:j] + longer[j + 1 :] in known for j in range(len(head))):
                out.append(longer)
    return out


def _with_mask(inside: bool) -> Column:
    """Items whose bit in the mask is set, or those whose bit is not."""
    wanted = 1 if inside else 0
    return F.expr(f"filter(items, (x, i) -> (shiftright(_mask, i) & 1) = {wanted})")


#: Itemsets of more items are refused: a set of n items has 2**n - 2 splits.
MAX_SPLIT = 24


def association_rules(itemsets: DataFrame, min_confidence: float = 0.3) -> DataFrame:
    """Every split of every frequent itemset into antecedent and consequent.

    Each itemset yields one row per non-trivial bit mask; subsets of frequent itemsets are frequent, so the
    two look-ups by item array always find their support.
    """
    spread = (
        itemsets.filter(F.col("Length") >= 2)
        .withColumn("Length", F.when(F.col("Length") <= MAX_SPLIT, F.col("Length")).otherwise(F.raise_error(F.lit("itemset too long to split"))))
        .withColumn("_mask", F.explode(F.expr("sequence(1L, shiftleft(1L, Length) - 2L)")))
        .select(
            _with_mask(True).alias("antecedent"),
            _with_mask(False).alias("consequent"),
            F.col("freq").alias("both"),
            "n",
            "Support",
        )
    )
    single = itemsets.select("items", "freq")
    joined = spread.join(
        single.select(F.col("items").alias("antecedent"), F.col("freq").alias("freq_a")), "antecedent"
    ).join(single.select(F.col("items").alias("consequent"), F.col("freq").alias("freq_c")), "consequent")
    confidence = C.ratio("both", "freq_a")
    lift = C.ratio(confidence, C.ratio("freq_c", "n"))
    return joined.select(
        "antecedent", "consequent", "Support", confidence.alias("Confidence"), lift.alias("Lift")
    ).filter(F.col("Confidence") >= min_confidence)


def export_rules(rules: DataFrame) -> DataFrame:
    """Rules with items as text, strongest lift first."""
    return rules.select(
        F.array_join("antecedent", ", ").alias("Antecedent"),
        F.array_join("consequent", ", ").alias("Consequent"),
        "Support",
        "Confidence",
        "Lift",
    ).orderBy(F.desc("Lift"), "Antecedent", "Consequent")


def strong_rules(exported: DataFrame, min_confidence: float = 0.5, min_lift: float = 3.0) -> DataFrame:
    return exported.filter((F.col("Confidence") >= min_confidence) & (F.col("Lift") >= min_lift))


def rule_labels(exported: DataFrame, n: int = 10, width: int = 25) -> DataFrame:
    """Short display labels of the strongest rules."""
    label = F.concat(F.substring("Antecedent", 1, width), F.lit(" → "), F.substring("Consequent", 1, width))
    return exported.orderBy(F.desc("Lift"), "Antecedent", "Consequent").limit(n).select(label.alias("RuleLabel"), "Lift")


def itemset_summary(itemsets: DataFrame) -> DataFrame:
    """Counts per size and the range of supports; the frame holds itemsets, not data rows."""
    return itemsets.agg(
        F.count("*").alias("Itemsets"),
        F.sum((F.col("Length") == 1).cast("int")).alias("Singles"),
        F.sum((F.col("Length") == 2).cast("int")).alias("Pairs"),
        F.sum((F.col("Length") >= 3).cast("int")).alias("TriplesOrMore"),
        F.min("Support").alias("MinSupport"),
        F.max("Support").alias("MaxSupport"),
        F.median("Support").alias("MedianSupport"),
    )


def rule_summary(exported: DataFrame, confident: float = 0.5, lifted: float = 3.0) -> DataFrame:
    """Totals and the strongest rule."""
    order = F.struct("Lift", "Confidence", "Antecedent", "Consequent")
    best = F.max(order)
    return exported.agg(
        F.count("*").alias("Rules"),
        F.sum((F.col("Confidence") >= confident).cast("int")).alias("HighConfidence"),
        F.sum((F.col("Lift") >= lifted).cast("int")).alias("StrongLift"),
        F.round(F.avg("Confidence"), 6).alias("AvgConfidence"),
        F.round(F.max("Lift"), 6).alias("MaxLift"),
        best.alias("_b"),
    ).select(
        "Rules", "HighConfidence", "StrongLift", "AvgConfidence", "MaxLift",
        F.concat("_b.Antecedent", F.lit(" -> "), "_b.Consequent").alias("StrongestRule"),
    )


#: Items of an invoice that share a block.
PAIR_BLOCK = 256


def _pair_counts(per_invoice: DataFrame) -> DataFrame:
    """Line pairs per item pair from (InvoiceNo, Item, n) rows."""
    # An invoice's items are dealt to blocks, and pairs of blocks are what is joined: a huge invoice is many keys of bounded size.
    blocks = F.ceil(F.col("d") / PAIR_BLOCK).cast("int")
    at = F.pmod(F.xxhash64("Item"), blocks)
    rows = per_invoice.withColumns({"at": at, "other": F.sequence(F.lit(0).cast("long"), blocks.cast("long") - 1)})
    left = rows.select("InvoiceNo", "at", F.explode("other").alias("to"), F.col("Item").alias("ItemA"), F.col("n").alias("nA"))
    right = rows.select("InvoiceNo", F.explode("other").alias("at"), F.col("at").alias("to"), F.col("Item").alias("ItemB"), F.col("n").alias("nB"))
    return (
        left.join(right, ["InvoiceNo", "at", "to"])
        .filter(F.col("ItemA") < F.col("ItemB"))
        .groupBy("ItemA", "ItemB")
        .agg(F.sum(F.col("nA") * F.col("nB")).alias("CoOccurrence"))
    )


def invoice_items(lines: DataFrame, item: str) -> DataFrame:
    """(InvoiceNo, Item, n, m, d): line count of each item, the largest one and the number of items in the invoice, for invoices with two
    or more items. ``top_pairs`` passes over it several times, so store it as a table first."""
    counts = (
        lines.select("InvoiceNo", F.col(item).alias("Item")).groupBy("InvoiceNo", "Item").agg(F.count("*").alias("n"))
    )
    widest = counts.groupBy("InvoiceNo").agg(F.max("n").alias("m"), F.count("*").alias("d")).filter("d > 1")
    return counts.join(widest, "InvoiceNo")


def top_pairs(invoices: DataFrame, min_count: int = 5, top: int = 20, seeds: int = 40) -> DataFrame:
    """The ``top`` item pairs by number of line pairs in the same invoice, above ``min_count``.

    Pairing whole invoices would explode on a huge one, so items are pruned first, without changing the result:
    an item's pairs can count no more than ``bound``, the sum of n x m over its invoices. The pairs among the
    ``seeds`` items of largest bound are counted first. Their ``top``-th count is a floor for the answer, and an
    item whose bound lies below it cannot be in the answer. A huge invoice keeps only items that are frequent
    across many invoices.
    """
    bounds = invoices.groupBy("Item").agg(F.sum(F.col("n") * F.col("m")).alias("bound"))
    seed = bounds.orderBy(F.desc("bound"), "Item").limit(seeds).select("Item")
    # at most ``seeds`` rows are broadcast, and an invoice holds at most ``seeds`` items here
    first = _pair_counts(invoices.join(F.broadcast(seed), "Item", "left_semi"))
    counts = [r["CoOccurrence"] for r in first.orderBy(F.desc("CoOccurrence")).limit(top).collect()]
    floor = max(counts[-1] if len(counts) == top else 0, min_count + 1)
    kept = bounds.filter(F.col("bound") >= floor).select("Item")
    return (
        _pair_counts(invoices.join(kept, "Item", "left_semi"))
        .filter(F.col("CoOccurrence") > min_count)
        .orderBy(F.desc("CoOccurrence"), "ItemA", "ItemB")
        .limit(top)
    )


def product_pairs(invoices: DataFrame, products: DataFrame, min_count: int = 5, top: int = 20) -> DataFrame:
    """Pairs by product with both names; only the resulting rows meet the product table."""
    pairs = top_pairs(invoices, min_count, top)
    names = products.select("ProductID", "ProductName")
    a = names.select(F.col("ProductID").alias("Product_A"), F.col("ProductName").alias("ProductName_A"))
    b = names.select(F.col("ProductID").alias("Product_B"), F.col("ProductName").alias("ProductName_B"))
    # at most ``top`` pairs are broadcast against the product table
    small = F.broadcast(pairs.withColumnsRenamed({"ItemA": "Product_A", "ItemB": "Product_B"}))
    with_a = F.broadcast(a.join(small, "Product_A"))
    return (
        b.join(with_a, "Product_B")
        .select("Product_A", "ProductName_A", "Product_B", "ProductName_B", "CoOccurrence")
        .orderBy(F.desc("CoOccurrence"), "Product_A", "Product_B")
    )
