"""Phrases whose words stand together more often than they would by chance, mined from a weighted de Bruijn graph.

Graph
    Nodes are three-word sequences, edges the four-word sequences between overlapping nodes, weighted by how often they occur inside pieces (texts are cut at punctuation and line ends). Every word occurrence starts
    one gram: the edge of four words, or the shorter rest of its piece. Only these longest grams are counted and shuffled.
Shorter counts
    The count of three words is the weight that flows out of their node, plus the pieces that end there; counts of two words and one word follow the same way from the level above. All levels are sums that combine
    before their shuffle, so a passage that stands in a third of all documents is no hot key.
Unary paths
    A node with one frequent edge in and one out, both of the node's own weight, is inside a path that nothing leaves or enters. Such edges are compacted into one path by pointer doubling (:func:`compacted`). A node inside a
    path is as frequent as the edges around it, so it is covered and needs no further look; the edges of a path stay candidates.
Rare pairs
    A phrase of ``min_count`` occurrences holds no rarer word pair, so pieces may be cut at rare pairs without changing the count of any candidate. Pairs are counted in 2**``bits`` hashed cells; only the map of cells
    that reach ``min_count`` is broadcast, 2**``bits`` / 8 bytes whatever the corpus is. Cells are shared, so a rare pair may look frequent, never the other way round: a full map cuts less and changes no result.

Inside a task, texts are read in blocks of about ``block`` words with numbers for the block's own words; grams are told apart by these numbers, not by fingerprints, so counts are exact. A long text is read in parts, and its
parts are put together as numbers before grams are taken.

Defined cases: a null text is empty, a text without words gives nothing; a null language is ``und``; repeated rows count each; ties in the score go to the more frequent phrase, then to the smaller one in byte order; an empty
table gives an empty result; other columns of the table aren't read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchantry.llm.common import discard, stored

#: Characters between pieces.
BREAKS = b".,;:!?\n\x0b\x0c\r"
#: Stands for the end of a piece; no byte of UTF-8.
END = b"\xff"
_TO_END = bytes.maketrans(BREAKS + b"\t", END * len(BREAKS) + b" ")
PART = 1 << 20
LONGEST = 4


class Numbers(dict):
    """Numbers of the words of a block in order of appearance; the end of a piece is 0."""

    def __init__(self) -> None:
        super().__init__()
        self[END] = 0

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def parts(raw: bytes) -> Iterator[bytes]:
    """Parts of about a megabyte, cut at blanks; a longer word stays whole."""
    at = 0
    while len(raw) - at > PART:
        cut = raw.find(b" ", at + PART)
        if cut < 0:
            break
        yield raw[at:cut]
        at = cut
    yield raw[at:]


def numbered(text: str, numbers: Numbers) -> list[np.ndarray]:
    """The text's words as numbers, with a 0 between pieces and behind the last."""
    flat = text.encode().lower().translate(_TO_END)  # lower() of bytes maps A-Z only
    out = [np.fromiter(map(numbers.__getitem__, p.replace(END, b" \xff ").split()), np.int64) for p in parts(flat)]
    return [*out, np.zeros(1, np.int64)]


def blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """(language, words by number, numbers) of blocks of about ``size`` words of one language."""
    open_: dict[str, tuple[Numbers, list[np.ndarray]]] = {}
    held = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
            numbers, found = open_.setdefault(lang, (Numbers(), []))
            new = numbered(text.as_py(), numbers)
            found += new
            held += sum(map(len, new))
            if held >= size:
                for key, (known, rows) in open_.items():
                    yield key, list(known), np.concatenate(rows)
                open_, held = {}, 0
    for key, (known, rows) in open_.items():
        yield key, list(known), np.concatenate(rows)


def cells(lang: str, words: list[bytes], first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    """The hashed cell of each pair of words of a language."""
    seed = xxhash.xxh64_intdigest(lang.encode())
    prints = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))
    h = prints[first] * np.uint64(0x9E3779B97F4A7C15) + prints[second]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def pairs(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of words that have a neighbour in their piece, the distinct pairs as ``first * width + second``, and each place's pair."""
    at = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
    width = int(ids.max(initial=0)) + 1
    distinct, which = np.unique(ids[at] * width + ids[at + 1], return_inverse=True)
    return at, distinct, which


def pair_cells(rows: DataFrame, block: int, bits: int) -> DataFrame:
    """(cell, c): how many pairs of a block fall into a cell."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, ids in blocks(batches, block):
            _, distinct, which = pairs(ids)
            width = int(ids.max(initial=0)) + 1
            where = cells(lang, words, distinct // width, distinct % width, bits)
            yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(np.bincount(which, minlength=len(distinct)))], ["cell", "c"])

    return rows.mapInArrow(local, "cell long, c long")


def frequent_map(rows: DataFrame, min_count: int, block: int, bits: int) -> np.ndarray:
    """A bit for each cell whose pairs occur ``min_count`` times or more. Executors pack bits; the driver gets the map's bytes."""
    low = min(bits, 15)
    full = pair_cells(rows, block, bits).groupBy("cell").agg(F.sum("c").alias("c")).filter(F.col("c") >= min_count)

    def pack(group: pa.Table) -> pa.Table:
        cell = group.column("cell").to_numpy()
        bit = np.zeros(1 << low, np.uint8)
        bit[cell & ((1 << low) - 1)] = 1
        return pa.table({"part": pa.array([int(cell[0]) >> low]), "bits": pa.array([np.packbits(bit, bitorder="little").tobytes()], pa.binary())})

    packed = full.groupBy(F.shiftright("cell", low).alias("part")).applyInArrow(pack, "part long, bits binary")
    out = np.zeros(1 << bits >> 3 or 1, np.uint8)
    for r in packed.toLocalIterator():
        out[r["part"] << low >> 3 :][: len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
    return out


def grams(lang: str, words: list[bytes], ids: np.ndarray, bitmap: np.ndarray, bits: int) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """(length, texts, counts) of the grams that start at each word of a block, cut at ends of pieces and at rare pairs."""
    at, distinct, which = pairs(ids)
    width = int(ids.max(initial=0)) + 1
    where = cells(lang, words, distinct // width, distinct % width, bits)
    frequent = (bitmap[where >> 3] >> (where & 7).astype(np.uint8) & 1).astype(bool)
    goes_on = np.zeros(len(ids) + LONGEST, bool)
    goes_on[at] = frequent[which]
    length = (ids > 0).astype(np.int64)
    further = ids > 0
    for k in range(LONGEST - 1):
        further = further & goes_on[k : k + len(ids)]
        length += further
    number = np.zeros(len(ids) + LONGEST, np.int64)
    number[at] = which
    for n in range(1, LONGEST + 1):
        here = np.flatnonzero(length == n)
        if n == 1:
            key = ids[here]
        elif n == 2:
            key = number[here]
        else:  # two pairs, overlapping or not, as one number
            key = number[here] * (len(distinct) + 1) + number[here + n - 2]
        _, first, counts = np.unique(key, return_index=True, return_counts=True)
        spans = ids[here[first][:, None] + np.arange(n)]
        yield n, [b" ".join(map(words.__getitem__, s)) for s in spans.tolist()], counts


def edges(rows: DataFrame, bitmap: np.ndarray, block: int, bits: int) -> DataFrame:
    """(lang, gram, size, c): edges of four words, and shorter rests of pieces, with their weights."""
    shared = rows.sparkSession.sparkContext.broadcast(bitmap.tobytes())

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.frombuffer(shared.value, np.uint8)
        for lang, words, ids in blocks(batches, block):
            for n, texts, counts in grams(lang, words, ids, seen, bits):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(texts), pa.string()), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(np.full(len(texts), n, np.int32)), pa.array(counts)],
                    ["lang", "gram", "size", "c"],
                )

    local_counts = rows.mapInArrow(local, "lang string, gram string, size int, c long")
    return local_counts.groupBy("lang", "gram", "size").agg(F.sum("c").alias("c"))


def _first(gram: Column | str, n: int) -> Column:
    return F.substring_index(gram, " ", n)


def _rest(gram: Column | str, n: int) -> Column:
    """The last ``n`` words."""
    return F.substring_index(gram, " ", -n)


def flows(graph: DataFrame, min_count: int) -> dict[int, DataFrame]:
    """Length -> (lang, phrase, f) of phrases with ``min_count`` occurrences or more, shorter ones from the flow out of their nodes and the pieces that end there."""
    level = graph.filter(F.col("size") == LONGEST).select("lang", "gram", "c")
    out = {LONGEST: stored(level.filter(F.col("c") >= min_count).select("lang", F.col("gram").alias("phrase"), F.col("c").alias("f")), "phrases-edges")}
    before = None
    for n in range(LONGEST - 1, 0, -1):
        through = level.select("lang", _first("gram", n).alias("gram"), "c")
        ends = graph.filter(F.col("size") == n).select("lang", "gram", "c")
        level = stored(through.unionByName(ends).groupBy("lang", "gram").agg(F.sum("c").alias("c")), f"phrases-{n}")
        if before is not None:
            discard(before)
        before = level
        out[n] = stored(level.filter(F.col("c") >= min_count).select("lang", F.col("gram").alias("phrase"), F.col("c").alias("f")), f"phrases-frequent-{n}")
    if before is not None:
        discard(before)
    return out


def compacted(edge_table: DataFrame, node_table: DataFrame) -> DataFrame:
    """(lang, gram, f, head, place): for each frequent edge the first edge of its unary path and its place in it; an edge outside longer paths is a path of one.

    A node joins two edges when it is as frequent as the only edge in and the only edge out. Heads are found by pointer doubling, so a path of n edges takes log n rounds.
    There are no rings: pieces end, and where one ends the node is more frequent than its edge out.
    """
    link = edge_table.select("lang", F.col("phrase").alias("gram"), "f", _first("phrase", LONGEST - 1).alias("source"), _rest("phrase", LONGEST - 1).alias("goal"))
    nodes = node_table.select("lang", F.col("phrase").alias("node"), F.col("f").alias("flow"))
    # An edge of the node's whole weight is its only one on that side.
    inward = link.join(nodes, (link["goal"] == nodes["node"]) & (link["f"] == nodes["flow"]) & (link["lang"] == nodes["lang"]), "left_semi")
    step = inward.select("lang", F.col("goal").alias("source"), "f", F.col("gram").alias("before"))
    state = link.join(step, ["lang", "source", "f"], "left")
    done = F.col("before").isNull()
    state = stored(state.select("lang", "gram", "f", F.coalesce("before", "gram").alias("head"), F.when(done, 0).otherwise(1).cast("long").alias("place"), done.alias("done")), "phrases-links")
    while not state.filter("NOT done").isEmpty():
        far = state.select("lang", F.col("gram").alias("head"), F.col("head").alias("far"), F.col("place").alias("more"), F.col("done").alias("ended"))
        new = state.join(far, ["lang", "head"]).select(
            "lang", "gram", "f", F.when(F.col("done"), F.col("head")).otherwise(F.col("far")).alias("head"), F.when(F.col("done"), F.col("place")).otherwise(F.col("place") + F.col("more")).alias("place"),
            (F.col("done") | F.col("ended")).alias("done"),
        )
        before, state = state, stored(new, "phrases-links")
        discard(before)
    return state.drop("done")


def paths(links: DataFrame) -> DataFrame:
    """(lang, words, f, n_edges): the compacted paths as text. A path is no longer than the longest piece."""
    steps = F.sort_array(F.collect_list(F.struct("place", _rest("gram", 1).alias("w"))))
    out = links.groupBy("lang", "head").agg(F.first("f").alias("f"), F.count("*").alias("n_edges"), steps.alias("steps"))
    return out.select("lang", F.concat_ws(" ", _first("head", LONGEST - 1), F.array_join("steps.w", " ")).alias("words"), "f", "n_edges")


def candidates(counts: dict[int, DataFrame], links: DataFrame, cover: int) -> DataFrame:
    """(lang, phrase, a, size): phrases of two words and more that no longer one covers: has ``cover`` percent of their occurrences or more."""
    inside = links.filter("place > 0").select("lang", _first("gram", LONGEST - 1).alias("phrase"))
    out = counts[LONGEST].select("lang", "phrase", F.col("f").alias("a"), F.lit(LONGEST).alias("size"))
    for n in range(LONGEST - 1, 1, -1):
        # One word more is enough: what lies between a phrase and a longer one that covers it is as frequent as the longer one at least.
        longer = counts[n + 1]
        around = longer.select("lang", _first("phrase", n).alias("phrase"), "f").unionByName(longer.select("lang", _rest("phrase", n).alias("phrase"), "f"))
        most = around.groupBy("lang", "phrase").agg(F.max("f").alias("most"))
        mine = counts[n]
        if n == LONGEST - 1:  # covered by the edges beside them in their path
            mine = mine.join(inside, ["lang", "phrase"], "left_anti")
        free = mine.join(most, ["lang", "phrase"], "left").filter(F.expr(f"most IS NULL OR CAST(100 AS DECIMAL(38,0)) * most < CAST({int(cover)} AS DECIMAL(38,0)) * f"))
        out = out.unionByName(free.select("lang", "phrase", F.col("f").alias("a"), F.lit(n).alias("size")))
    return out


def scored(found: DataFrame, counts: dict[int, DataFrame]) -> DataFrame:
    """(lang, phrase, a, l, r, score): the lowest score of all cuts, the earliest one of equals."""
    shorter = None
    for n in range(1, LONGEST):
        shorter = counts[n] if shorter is None else shorter.unionByName(counts[n])
    cut = found.select("lang", "phrase", "a", "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", F.expr("substring_index(phrase, ' ', k)").alias("head"), F.expr("substring_index(phrase, ' ', k - size)").alias("tail"))
    left = shorter.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    right = shorter.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    both = cut.join(left, ["lang", "head"]).join(right, ["lang", "tail"])
    # Whole numbers only: the quotient of decimals is rounded, the difference to the remainder isn't.
    both = both.withColumn("over", F.expr("CAST(2000000 AS DECIMAL(8,0)) * CAST(a AS DECIMAL(19,0))")).withColumn("under", F.expr("CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0))"))
    both = both.withColumn("score", F.expr("over div under").cast("long"))
    return both.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("s")).select("lang", "phrase", "a", "s.l", "s.r", "s.score")


def phrases(
    docs: DataFrame, *, text: str = "text", lang: str = "lang", min_count: int = 30, cover: int = 80, top: int = 2000, bits: int = 26, block: int = 400_000, salts: int = 64
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    bitmap = frequent_map(rows, min_count, block, bits)
    graph = stored(edges(rows, bitmap, block, bits), "phrases-graph")
    counts = flows(graph, min_count)
    total = stored(graph.groupBy("lang").agg(F.sum("c").alias("n")), "phrases-words")  # every word starts one gram
    discard(graph)
    found = scored(candidates(counts, compacted(counts[LONGEST], counts[LONGEST - 1]), cover), counts)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The best of a language by shares first, so that no task orders all phrases of one language.
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(salts))).orderBy(*order)
    some = found.withColumn("_at", F.row_number().over(share)).filter(F.col("_at") <= top).drop("_at")
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return best.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
