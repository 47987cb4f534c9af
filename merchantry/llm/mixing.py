"""Mixing sources to target weights by weighted fair queueing.

Sources are ordered by code point, null last, and get ``weights`` in turn. Together they share ``budget`` times the size of the whole input; a source's target stops at
``max_epochs`` times its own size, and what it leaves goes to the others by weight until none is above (filling up to a common level, solved in
closed form on the table of sources).

Each source's documents stand in an order drawn from a digest of identity and text, epoch after epoch. A document's virtual finish time is the source's size up
to and with it, divided by the source's target. All documents are put in order of that time, and the order is cut where the budget is used up. Every
document that finishes by time 1 fits, so a source's taken size is off its target by less than one of its documents.

Inside a source the order is one of digests, so what it gives is fully described by its last digest in each epoch: the texts never move, only a table with a row per
source is joined to them. Running sums use digest ranges with offsets, so a source that holds a third of all rows is spread over many tasks.

Defined cases: null text has size 0; documents of size 0 take 0; rows equal in source, identity and text go in or stay out together; a null
source is a source of its own; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchantry.llm.common import digest_bits, stored, weighted_cuts, word_count

TIME_BITS = 44


def targets(sources: DataFrame, weights: tuple[int, ...], budget: float, max_epochs: int) -> DataFrame:
    """(source, source_size) -> with ``target``. One row per source; the window over them holds as many rows as there are sources."""
    every = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.pmod(F.row_number().over(every) - 1, F.lit(len(weights)))
    w = F.get(F.array(*(F.lit(float(x)) for x in weights)), cycle)
    cap = F.col("source_size") * float(max_epochs)
    by_level = Window.orderBy("level", "source")
    whole = Window.partitionBy(F.lit(1))
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        sources.withColumn("w", w)
        .withColumn("cap", cap)
        .withColumn("level", F.col("cap") / F.col("w"))
        .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("left_w", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
        .withColumn("total", F.sum("source_size").over(whole))
    )
    fill = (F.col("total") * budget - F.col("capped")) / F.col("left_w")
    # The common level is the first one, in order of caps, that the source itself isn't capped below; those after it only fall. Without one, every source is capped.
    ranked = ranked.withColumn("fill", F.when(fill <= F.col("level"), fill)).withColumn("fill", F.max("fill").over(whole))
    return ranked.select("source", "source_size", F.least("cap", F.coalesce(F.col("fill") * F.col("w"), F.col("cap"))).alias("target"))


def order_key(identity: Column, text: Column) -> Column:
    return digest_bits(F.concat_ws("|", F.coalesce(identity.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))))


def shares(
    items: DataFrame, *, weights: tuple[int, ...] = (3, 1, 2), budget: float = 1.5, max_epochs: int = 2, range_rows: int = 5000
) -> DataFrame:
    """From (source, size, h): one row per source with source_size, target and the last digest it gives in each epoch (``last``, an array).

    ``range_rows`` bounds the rows of a source that share a digest range, and so the rows a running sum sorts in one task.
    """
    sources = items.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sources = stored(sources, "mix-sources")
    most, budget_size = sources.agg(F.max("n"), F.sum("source_size") * budget).first()
    bits = max(8, ((most or 1) // range_rows).bit_length())
    goal = stored(targets(sources.select("source", "source_size"), weights, budget, max_epochs), "mix-targets")
    part = F.shiftright("h", 60 - bits)
    items = items.withColumn("part", part)
    sums = items.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("part_size").over(before), F.lit(0))).drop("part_size")
    sums = sums.join(goal, sums["source"].eqNullSafe(goal["source"])).drop(goal["source"])
    inside = Window.partitionBy("source", "part").orderBy("h").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    run = items.withColumn("inside", F.sum("size").over(inside))
    run = run.join(
        sums.withColumnsRenamed({"source": "s", "part": "p"}), run["source"].eqNullSafe(F.col("s")) & (run["part"] == F.col("p"))
    )
    cum = F.col("before") + F.col("inside")
    epochs = F.posexplode(F.transform(F.sequence(F.lit(0), F.lit(max_epochs - 1)), lambda e: cum + e * F.col("source_size")))
    run = run.select("source", "size", "h", "target", epochs.alias("epoch", "cum"))
    time = F.least(F.col("cum") / F.col("target"), F.lit(float(1 << 15)))
    run = stored(run.filter("target > 0").select("source", "size", "h", "epoch", F.floor(time * float(1 << TIME_BITS)).alias("time")), "mix-times")
    cut = weighted_cuts(run, F.lit(0), F.col("time"), F.col("size"), {0: float(budget_size or 0)})
    fits = run.filter(F.col("time") < cut[0][0]) if cut else run
    last = fits.groupBy("source", "epoch").agg(F.max("h").alias("h")).groupBy("source").agg(
        F.map_from_entries(F.collect_list(F.struct("epoch", "h"))).alias("m")
    )
    out = goal.join(last.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left")
    ends = F.array(*(F.coalesce(F.try_element_at("m", F.lit(e)), F.lit(-1).cast("long")) for e in range(max_epochs)))
    return out.select("source", "source_size", "target", ends.alias("last"))


def mixed(docs: DataFrame, *, identity: str = "doc_id", text: str = "text", source: str = "source", carry: list[str] | None = None, **how) -> DataFrame:
    """One row per document: ``row`` (struct of the columns in ``carry``, all by default), size, source_size, target, ``copies`` the mix takes."""
    kept = [F.col(c) for c in (docs.columns if carry is None else carry)]
    rows = docs.select(
        F.struct(*kept).alias("row"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        order_key(F.col(identity), F.col(text)).alias("h"),
    )
    small = set(carry or docs.columns) <= {identity, source}
    rows = stored(rows, "mix-items") if small else rows
    items = rows.select("source", "size", "h")
    per_source = stored(shares(items if small else stored(items, "mix-items"), **how), "mix-shares").withColumnRenamed("source", "s")
    out = rows.join(per_source, F.col("source").eqNullSafe(F.col("s")), "left")
    copies = F.aggregate(F.transform("last", lambda x: (F.col("h") <= x).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    return out.select("row", "size", "source_size", "target", copies.alias("copies"))


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mixed rows themselves: each document as often as the mix takes it, with its own columns."""
    out = mixed(docs, **how)
    return out.select("row", F.explode(F.expr("array_repeat(1, cast(copies as int))"))).select("row.*")
