"""Shards of near equal bytes by a k-d tree over document metadata. DataFrame functions only.

A node that still stands for several shards is split along its widest dimension (the dimensions are scaled to the whole input, so widths compare), at the weighted
median: the place in that dimension's order where the bytes to the left reach the left side's part of the node. Splitting goes on until a node stands for one
shard, whose bytes are then the target. Medians are exact: they come from rounds of sums by key digits (:func:`common.weighted_cuts`), a
bounded number of sums per node, so no task sorts a node and hot values of a dimension don't matter.

Dimensions are ties broken by a digest of the text, so equal texts stand together. A group of equal texts at a cut goes whole to the nearer side where that
misses the node's target by no more than ``slack`` of a shard, otherwise it is cut too, by a digest of the row's identity. Rows equal in identity and text are told apart by the place they were written at, so any number of
them can be cut; which of them goes where makes no difference.

Dimensions of a row are taken from the first copy of its text (smallest identity), so all copies share them.

Defined cases: null text has no bytes (size 1) and counts as the empty text; null source or language is a value of its own; rows equal in identity and text are cut like others, so a table
of one row many times over has even shards too; texts of any length are read for their size and digest only; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchantry.llm.common import digest_bits, lookup, stored, weighted_cuts

SCALE = 20
SLOT_ROWS = 5000
#: Low bits of a tie, which order rows equal in identity and text.
COPY_BITS = 20


def _name_place(value: Column) -> Column:
    return F.shiftright(F.crc32(F.coalesce(value, F.lit("\0"))), 32 - SCALE)


def items(docs: DataFrame, *, identity: str, text: str, carry: list[str]) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.struct(*(F.col(c) for c in carry)).alias("row"),
        F.coalesce(F.col(identity).cast("long"), F.lit(0)).alias("id"),
        F.col("source"),
        F.col("lang"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("crc"),
        F.md5(body).alias("digest"),
        F.monotonically_increasing_id().alias("nr"),  # tells rows equal in identity and text apart; fixed once these rows are written
    )


def keyed(rows: DataFrame) -> DataFrame:
    """Adds ``keys``, an array with a 60-bit order key per dimension, and ``tie``, the order inside a group of equal texts."""
    first = rows.groupBy("digest").agg(F.min(F.struct("id", "source", "lang")).alias("first"))
    rows = rows.join(first.withColumnRenamed("digest", "d"), F.col("digest") == F.col("d")).drop("d")
    low, high, top = rows.agg(F.min("id"), F.max("id"), F.max("size")).first()
    low, span, top = low or 0, max(1, (high or 0) - (low or 0)), max(2, top or 2)
    most = (1 << SCALE) - 1
    places = [
        F.floor(F.log2(F.col("size").cast("double")) * (most / top.bit_length())).cast("long"),
        _name_place(F.col("first.source")),
        _name_place(F.col("first.lang")),
        F.floor((F.col("first.id") - low).cast("double") * (most / span)).cast("long"),
    ]
    group = digest_bits(F.col("digest"), 40)
    keys = F.array(*(F.shiftleft(F.least(p, F.lit(most).cast("long")), 40).bitwiseOR(group) for p in places))
    of_row = digest_bits(F.concat_ws("|", F.col("id").cast("string"), F.col("digest")), 60 - COPY_BITS)
    tie = F.shiftleft(of_row, COPY_BITS).bitwiseOR(F.pmod(F.xxhash64("nr"), F.lit(1 << COPY_BITS)))
    return rows.withColumn("keys", keys).withColumn("tie", tie).drop("first", "nr")


def assign(rows: DataFrame, shards: int, slack: float) -> Column:
    """The shard of each row, as an expression of ``keys`` and ``tie``, one level of the tree after the other."""
    node = F.lit(0)
    stands = {0: (0, shards)}  # node -> (first shard, number of shards)
    leaf = (rows.agg(F.sum("size")).first()[0] or 0) / shards
    dims = 4
    while any(n > 1 for _, n in stands.values()):
        at = rows.withColumn("node", node)
        facts = {
            r["node"]: r
            for r in at.groupBy("node")
            .agg(
                F.sum("size").alias("size"),
                *(F.min(F.shiftright(F.get("keys", F.lit(d)), 40)).alias(f"lo{d}") for d in range(dims)),
                *(F.max(F.shiftright(F.get("keys", F.lit(d)), 40)).alias(f"hi{d}") for d in range(dims)),
            )
            .collect()
        }
        widest, goal = {}, {}
        for v, (_, n) in stands.items():
            if n > 1 and v in facts:
                r = facts[v]
                widest[v] = max(range(dims), key=lambda d: (r[f"hi{d}"] - r[f"lo{d}"], -d))
                goal[v] = r["size"] * (n // 2) / n
        key = F.get("keys", lookup(widest, F.col("node"), 0))
        cuts = weighted_cuts(at.filter(F.col("node").isin(list(widest))), F.col("node"), key, F.col("size"), goal)
        bound, whole_left, inner = {}, {}, {}
        for v, (k, below, weight) in cuts.items():
            bound[v] = k
            left_off, right_off = below + weight - goal[v], goal[v] - below
            if min(left_off, right_off) <= slack * leaf:
                whole_left[v] = int(left_off < right_off)
            else:
                inner[v] = right_off
        ties = {}
        if inner:
            same = at.filter(F.col("node").isin(list(inner)) & (key == lookup(bound, F.col("node"), -1)))
            for v, (t, below, weight) in weighted_cuts(same, F.col("node"), F.col("tie"), F.col("size"), inner).items():
                ties[v] = t + int(below + weight - inner[v] < inner[v] - below)
        far = 1 << 61
        here = node
        key = F.get("keys", lookup(widest, here, 0))
        cut = lookup({v: bound.get(v, far) for v in widest}, here, -1)
        left = (key < cut) | (
            (key == cut) & ((lookup(whole_left, here, 0) == 1) | (F.col("tie") < lookup(ties, here, 0)))
        )
        low_of, high_of, after = {}, {}, {}
        for v, (first, n) in stands.items():
            low_of[v], high_of[v] = first, first + n // 2 if n > 1 else first
            after[first] = (first, n // 2 if n > 1 else 1)
            if n > 1:
                after[first + n // 2] = (first + n // 2, n - n // 2)
        node = F.when(left, lookup(low_of, here, 0)).otherwise(lookup(high_of, here, 0))
        # The level's nodes are written down, else the expression doubles with each level.
        rows = stored(rows.withColumn("_next", node), "kd-level") if "_next" not in rows.columns else stored(
            rows.withColumn("_then", node).drop("_next").withColumnRenamed("_then", "_next"), "kd-level"
        )
        node = F.col("_next")
        stands = after
    return rows.withColumn("shard", node.cast("int")).drop("_next")


def slots(rows: DataFrame, bits: int) -> DataFrame:
    """A gapless number from 0 in each shard: shares of its rows, dealt by a hash of the tie, are counted, and a row's number is its share's offset plus its place in the share."""
    rows = rows.withColumn("part", F.pmod(F.xxhash64("tie"), F.lit(1 << bits)))
    counts = rows.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("shard").alias("s"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("tie", "id", "size")) - 1
    rows = rows.withColumn("inside", inside)
    rows = rows.join(counts, (F.col("shard") == F.col("s")) & (F.col("part") == F.col("p")))
    return rows.withColumn("slot", (F.col("before") + F.col("inside")).cast("long")).drop("s", "p", "before", "inside", "part")


def kd_shards(docs: DataFrame, *, shards: int = 8, identity: str = "doc_id", text: str = "text", carry: list[str] | None = None, slack: float = 0.01) -> DataFrame:
    """One row per document: ``row`` (struct of ``carry``, by default the identity alone), size, crc, shard, slot.

    Needs the columns ``source`` and ``lang``. Texts are read once; everything later works on a narrow stored table.
    """
    rows = stored(items(docs, identity=identity, text=text, carry=carry or [identity]), "kd-items")
    rows = stored(keyed(rows), "kd-keys")
    count = rows.count()
    placed = assign(rows, shards, slack)
    bits = max(5, (count // shards // SLOT_ROWS).bit_length())
    return slots(placed, bits).select("row", "size", "crc", "shard", "slot")
