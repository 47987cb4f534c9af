"""N-gram Jaccard join: groups of documents that links of high shingle similarity hold together.

A document's set is that of its distinct word shingles. Equal sets are one class, and classes are what is joined. Two classes link when their sets' intersection is at least ``percent`` hundredths
of the union.

Size-aware heavy-light join
    A pair of sizes n and m needs a common part of o(n, m) shingles. A *small* set lists all its subsets of each size o(n, m) that a small partner can ask for;
    two small sets that link share one of them. A *large* set has no such list, it would be too long: it is found by scanning inverted lists. In a global order
    of shingles, sets that link share one of their first n - ceil(percent n / 100) + 1, so only these are listed. Small sets near the boundary stand in the lists too, for their large
    partners. The boundary is the size at which the rows of both ways together are fewest, from the numbers of small sets by size and the lengths of the lists they stand in.

Order of shingles
    Rarest first, by a count over all documents. Sets are dealt to chunks; a chunk sends each distinct shingle once to the bucket that counts it, as 32 bits, and gets a byte back. Shingles of one set
    alone come first and are in no list, so texts that share a passage of less than ``percent`` hundredths don't meet at all. Any order is right that all sets have in common, so counts may be rounded and keys may coincide.

Long lists without all pairs
    Lists of up to ``light`` classes give all their pairs. In a longer one, every class is first compared with a few pivots of the list, those most central in it (see :func:`central`), in
    several rounds with pivots of other components; classes that links already join need no comparison. Pairs from different components that are left at the end are all compared.
    A group of g near copies so costs about g comparisons a round, and no link between components is lost.

Every pair that its signatures leave possible is checked with the whole sets. 64-bit fingerprints stand for shingles.

Defined cases: a null or empty text, or one of blanks, has an empty set, links with nothing and is its own component; shorter texts are one shingle; repeated rows are one class;
a null identity takes part and can't be a component's name unless the whole component has none; an empty table gives an empty result; other columns pass through. A very long text is a chunk of its own, cut by bucket; its set is held in one task.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from merchantry.llm.common import SPACES, discard, stored
from merchantry.llm.components import components
from merchantry.llm.windows import all_windows, mix, shingles

#: Sets of up to this size carry all their shingles along, so that they can be small sets.
MOST_SMALL = 12
#: Classes that a task remembers.
REMEMBER = 200_000
#: Shingles of a chunk, about, and of a bucket at most in usual texts.
CHUNK = 1_000_000
#: Sets of a chunk at most; their places take 16 bits.
MOST_IN_CHUNK = 1 << 16
#: Bits of a set's signature.
SIGNATURE = 2048
#: Pivots of a long list in a round.
PIVOTS = 4


def common(n: int, m: int, percent: int) -> int:
    """The fewest common shingles at which sets of n and m link: 100 o >= percent (n + m - o)."""
    return -(-percent * (n + m) // (100 + percent))


def subset_sizes(n: int, boundary: int, percent: int) -> list[int]:
    partners = range(-(-percent * n // 100), min(boundary, 100 * n // percent) + 1)
    return sorted({o for m in partners if (o := common(n, m, percent)) <= min(n, m)})


def prefix_size(n: int | np.ndarray, percent: int) -> int | np.ndarray:
    return n - -(-percent * n // 100) + 1


def boundary_size(histogram: dict[int, tuple[int, int]], percent: int) -> int:
    """The boundary of fewest rows. ``histogram`` has, for each size up to MOST_SMALL, the classes and the rows that their lists meet (list lengths, summed over the places of a class);
    larger sizes cost the same for all boundaries."""
    def rows(x: int) -> int:
        small = sum(c * sum(math.comb(n, o) for o in subset_sizes(n, x, percent)) for n, (c, _) in histogram.items() if n <= x)
        return small + sum(met for n, (_, met) in histogram.items() if 100 * n >= percent * (x + 1))

    return min(range(MOST_SMALL + 1), key=rows)


def _packed(values: list[np.ndarray]) -> pa.Array:
    return pa.array([None if v is None else v.tobytes() for v in values], pa.binary())


def signature(s: np.ndarray) -> np.ndarray:
    """A bit map of a set: each shingle sets one of SIGNATURE bits."""
    bits = np.zeros(SIGNATURE, np.uint8)
    bits[(s % np.uint64(SIGNATURE)).astype(np.int64)] = 1
    return np.packbits(bits)


PARTS = "id long, x long, c long, n int, few array<long>, bits binary, chunk long, bucket int, keys binary, owners binary"


def parts(docs: DataFrame, size: int, buckets: int, chunk_size: int) -> DataFrame:
    """Rows of three kinds, from one pass over the texts.

    A document's row has id, x, its class ``c`` and its set's size ``n``; where a task meets a class first, also the set's ``bits`` and, if it is small, the set itself (``few``).
    The sets of classes met first are dealt to chunks of about ``chunk_size`` shingles. A chunk's row of bucket -1 has its classes (``keys``) and their sizes (``owners``); its other rows have, for a bucket
    of shingles, the keys of the chunk's shingles there in order, once for each class, and the places of these classes in the chunk. A key is 32 bits of the shingle: what shares bucket and key shares a list.
    """
    names = [f.split()[0] for f in PARTS.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]

    def rows(count: int, /, **columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns.get(x, pa.nulls(count, kind)) for x, kind in zip(names, kinds, strict=True)], names)

    def dealt(chunk: int, members: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        lengths = [len(s) for _, s in members]
        flat = np.concatenate([s for _, s in members])
        owner = np.repeat(np.arange(len(members), dtype=np.uint16), lengths)
        bucket = (flat >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
        place = bucket << np.uint64(32) | flat & np.uint64(0xFFFFFFFF)
        order = np.argsort(place, kind="stable")
        place, owner = place[order], owner[order]
        used = np.unique(bucket)
        ends = np.searchsorted(place, (used + np.uint64(1)) << np.uint64(32))
        keys = [np.array([c for c, _ in members], np.int64), *np.split(place.astype(np.uint32), ends[:-1])]
        owners = [np.array(lengths, np.int32), *np.split(owner, ends[:-1])]
        return rows(
            len(keys), chunk=pa.array([chunk] * len(keys), pa.int64()), bucket=pa.array([-1, *used.tolist()], pa.int32()), keys=_packed(keys), owners=_packed(owners)
        )

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, waiting, held = TaskContext.get().partitionId() << 32, [], 0
        met: set[int] = set()
        for batch in batches:
            cs, ns, few, bits = [], [], [], []
            for t in batch.column("text").to_pylist():
                s = shingles(t, size)
                c = class_print(s)
                first = len(s) > 0 and c not in met
                cs.append(c)
                ns.append(len(s))
                few.append(s.view(np.int64).tolist() if first and len(s) <= MOST_SMALL else None)
                bits.append(signature(s) if first else None)
                if not first:
                    continue
                if len(met) < REMEMBER:
                    met.add(c)
                waiting.append((c, s))
                held += len(s)
                if held >= chunk_size or len(waiting) == MOST_IN_CHUNK:
                    yield dealt(chunk, waiting)
                    chunk, waiting, held = chunk + 1, [], 0
            yield rows(
                len(cs), id=batch.column("id"), x=batch.column("x"), c=pa.array(cs, pa.int64()), n=pa.array(ns, pa.int32()),
                few=pa.array(few, pa.list_(pa.int64())), bits=_packed(bits),
            )
        if waiting:
            yield dealt(chunk, waiting)

    return docs.mapInArrow(local, PARTS)


def counted(keys: DataFrame) -> DataFrame:
    """(chunk, bucket, keys) -> (chunk, bucket, ranks): how common each distinct key is in all chunks, as a byte: 0 for one class, and never falling with the count.

    A chunk sends a key once, with its count, so what very many classes share is no hot spot.
    """

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [np.unique(np.frombuffer(k, np.uint32), return_counts=True) for k in batch.column("keys").to_pylist()]
            columns = [batch.column("chunk"), batch.column("bucket"), _packed([k for k, _ in both]), _packed([n.astype(np.uint32) for _, n in both])]
            yield pa.RecordBatch.from_arrays(columns, ["chunk", "bucket", "keys", "counts"])

    def ranked(rows: pa.Table) -> pa.Table:
        keys = [np.frombuffer(k, np.uint32) for k in rows.column("keys").to_pylist()]
        counts = np.concatenate([np.frombuffer(n, np.uint32) for n in rows.column("counts").to_pylist()])
        _, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, weights=counts)
        # Exact up to 128, then eight steps a doubling.
        rank = np.where(total <= 128, total - 1, np.minimum(127 + np.floor(8 * np.log2(np.maximum(total, 128) / 128)), 255)).astype(np.uint8)
        split = np.split(rank[at], np.cumsum([len(k) for k in keys])[:-1])
        return pa.table({"chunk": rows.column("chunk"), "bucket": rows.column("bucket"), "ranks": _packed(split)})

    sent = keys.select("chunk", "bucket", "keys").mapInArrow(combined, "chunk long, bucket int, keys binary, counts binary")
    return sent.groupBy("bucket").applyInArrow(ranked, "chunk long, bucket int, ranks binary")


def inverted_lists(dealt: DataFrame, percent: int) -> DataFrame:
    """(t, c, n, i): the inverted lists of first shingles. ``t`` is bucket and key of a shingle, ``i`` its place in the set's order, rarest first. What stands in one set alone is in no list."""
    ranks = stored(counted(dealt.filter("bucket >= 0")), "ngram-ranks")
    both = dealt.select("chunk", "bucket", "keys", "owners").withColumn("ranks", F.lit(None).cast("binary"))
    both = both.unionByName(ranks.select("chunk", "bucket", F.lit(None).cast("binary").alias("keys"), F.lit(None).cast("binary").alias("owners"), "ranks"))

    def listed(rows: pa.Table) -> pa.Table:
        ranks, own, classes, sizes = {}, [], None, None
        for bucket, keys, owners, rank in zip(*(rows.column(x).to_pylist() for x in ("bucket", "keys", "owners", "ranks")), strict=True):
            if rank is not None:
                ranks[bucket] = np.frombuffer(rank, np.uint8)
            elif bucket < 0:
                classes, sizes = np.frombuffer(keys, np.int64), np.frombuffer(owners, np.int32).astype(np.int64)
            else:
                own.append((bucket, np.frombuffer(keys, np.uint32), np.frombuffer(owners, np.uint16)))
        ts, owners, by = [], [], []
        for bucket, keys, owner in own:
            rank = ranks[bucket][np.cumsum(np.concatenate(([0], keys[1:] != keys[:-1])))]
            shared = rank > 0
            ts.append(keys[shared].astype(np.int64) | bucket << 32)
            owners.append(owner[shared].astype(np.int64))
            by.append(rank[shared])
        t, owner, rank = np.concatenate(ts), np.concatenate(owners), np.concatenate(by)
        order = np.lexsort((t, rank, owner))
        t, owner = t[order], owner[order]
        many = np.bincount(owner, minlength=len(classes))
        alone = sizes - many
        i = np.arange(len(t)) - (np.cumsum(many) - many)[owner] + alone[owner]
        n = sizes[owner]
        first = i < prefix_size(n, percent)
        return pa.table({"t": t[first], "c": classes[owner[first]], "n": n[first].astype(np.int32), "i": i[first].astype(np.int32)})

    return both.groupBy("chunk").applyInArrow(listed, "t long, c long, n int, i int")


def class_print(s: np.ndarray) -> int:
    """A fingerprint of a whole set."""
    total = s.sum(keepdims=True) + mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(keepdims=True) * np.uint64(0x9E3779B97F4A7C15)
    return int(mix(total + np.uint64(len(s))).view(np.int64)[0])


def subset_lists(classes: DataFrame, boundary: int, percent: int) -> DataFrame:
    """(t, c, n, i): lists of the subsets of small sets, from (c, n, few). Subsets have no order, their ``i`` is 0."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ts, cs, ns = [], [], []
            for c, n, tokens in zip(*(batch.column(x).to_pylist() for x in ("c", "n", "few")), strict=True):
                tokens = sorted(tokens)
                for o in subset_sizes(n, boundary, percent):
                    for sub in itertools.combinations(tokens, o):
                        ts.append(class_print(np.array((o, *sub), np.int64).view(np.uint64)))
                        cs.append(c)
                        ns.append(n)
            yield pa.RecordBatch.from_arrays([pa.array(ts, pa.int64()), pa.array(cs, pa.int64()), pa.array(ns, pa.int32())], ["t", "c", "n"])

    small = classes.filter((F.col("n") > 0) & (F.col("n") <= boundary)).select("c", "n", "few")
    return small.mapInArrow(local, "t long, c long, n int").withColumn("i", F.lit(0))


def candidates(met: DataFrame, percent: int) -> DataFrame:
    """The distinct pairs (a, b) of classes c and d, sizes n and m, that meet in a list at places i and j and may link.

    Two sets that link do so in the list of their first common shingle too, where what is common can't be more than it and all that follows.
    """
    need = F.ceil(percent * (F.col("n") + F.col("m")) / (100 + percent))
    may = (100 * F.least("n", "m") >= percent * F.greatest("n", "m")) & (F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j")) >= need)
    pairs = met.filter((F.col("c") != F.col("d")) & may)
    return pairs.select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b")).distinct()


def may_link(pairs: DataFrame, firsts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that their signatures leave possible. ``firsts`` has (c, n, bits), one row per class.

    A bit that only one set has stands for at least one shingle that the other lacks, which bounds what is common. No pair that links is lost, and few others are fetched as whole sets.
    """
    both = pairs.join(firsts.withColumnsRenamed({"c": "a", "bits": "left"}), "a").join(firsts.withColumnsRenamed({"c": "b", "n": "m", "bits": "right"}), "b")

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(x).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for x in ("left", "right"))
            n, m = (batch.column(x).to_numpy().astype(np.int64) for x in ("n", "m"))
            most = np.minimum(n - np.bitwise_count(left & ~right).sum(axis=1), m - np.bitwise_count(right & ~left).sum(axis=1))
            mask = pa.array((100 + percent) * most >= percent * (n + m))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])

    return both.select("a", "b", "n", "m", "left", "right").mapInArrow(local, "a long, b long")


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets link. ``sets`` has (c, tokens), tokens sorted fingerprints as bytes."""
    left = sets.withColumnsRenamed({"c": "a", "tokens": "left"})
    right = sets.withColumnsRenamed({"c": "b", "tokens": "right"})
    both = pairs.join(left, "a").join(right, "b")

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left"), batch.column("right"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(p) > len(q):
                    p, q = q, p
                o = int((q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p).sum())
                keep.append(100 * o >= percent * (len(p) + len(q) - o))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])

    return both.select("a", "b", "left", "right").mapInArrow(local, "a long, b long")


def whole_sets(docs: DataFrame, size: int) -> DataFrame:
    """(c, text) -> (c, tokens) where the text's set is of the class."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [(c, s) for c, t in zip(batch.column("c").to_pylist(), batch.column("text").to_pylist(), strict=True) if class_print(s := shingles(t, size)) == c]
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in sets], pa.int64()), pa.array([s.tobytes() for _, s in sets], pa.binary())], ["c", "tokens"])

    return docs.select("c", "text").mapInArrow(local, "c long, tokens binary")


def central(dealt: str, turn: int, part: int) -> Column:
    """An order of a list's classes whose first one is the pivot (c, n, i) of a part of them: those of most weight, the total length of the long lists that a class stands in.

    What was edited least has the most common shingles, so it stands in the most and longest lists and links with the most others. Classes are dealt to parts by the column ``dealt``, anew each turn.
    """
    mine = F.pmod(F.xxhash64(dealt, F.lit(turn)), F.lit(PIVOTS)) == part
    return F.struct((~mine).alias("other"), (-F.col("weight")).alias("w"), F.xxhash64("c").alias("o"), F.struct("c", "n", "i").alias("p"))


def row_key(docs: DataFrame) -> Column:
    """A fingerprint of a whole row; null has its own. Maps can't be hashed and are left out."""
    columns = [docs[f"`{c}`"] for c, kind in docs.dtypes if "map<" not in kind]
    return F.xxhash64(*columns, *(c.isNull() for c in columns))


def groups(docs: DataFrame, *, identity: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """(id, n, component): one row per document with the size of its set and its component's smallest identity."""
    docs = docs.select(F.col(identity).cast("long").alias("id"), F.col(text).alias("text"))
    named = labelled(docs.withColumn("x", F.xxhash64("text")), **how)
    least = named.filter("n > 0").groupBy("comp").agg(F.min("id").alias("least"))
    named = named.join(least, "comp", "left")
    return named.select("id", "n", F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id")).alias("component"))


def labelled(docs: DataFrame, *, size: int = 5, percent: int = 75, light: int = 8, rounds: int = 2, chunk: int = CHUNK) -> DataFrame:
    """(id, text, x) -> (id, x, n, comp): the size of each document's set and its component's smallest class; rows of one ``id`` and ``x`` must have one text."""
    # Texts rarely have more than a word in four bytes; where they do, buckets are larger.
    length = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    pieces = stored(parts(docs, size, max(1, length // (4 * chunk)), chunk), "ngram-parts")
    documents = stored(pieces.filter("chunk is null").select("id", "x", "c", "n", "few", "bits"), "ngram-classes")
    listed = documents.filter("bits is not null")
    lists = inverted_lists(pieces.filter("chunk is not null"), percent).distinct()
    whole_lists = stored(lists, "ngram-places")
    discard(pieces)

    counts = whole_lists.groupBy("t").agg(F.count("*").alias("k"))
    sizes = listed.filter(F.col("n") <= MOST_SMALL).groupBy("n").agg(F.countDistinct("c").alias("c")).collect()
    met = whole_lists.filter(F.col("n") <= MOST_SMALL).join(counts, "t").groupBy("n").agg(F.sum("k").alias("k")).collect()
    meets = {r["n"]: r["k"] for r in met}
    boundary = boundary_size({r["n"]: (r["c"], meets.get(r["n"], 0)) for r in sizes}, percent)

    lists = whole_lists.filter(100 * F.col("n") >= percent * (boundary + 1))
    if boundary:
        lists = lists.union(subset_lists(listed, boundary, percent).distinct())
    lists = lists.join(lists.groupBy("t").agg(F.count("*").alias("k")).filter("k > 1"), "t")
    lists = stored(lists, "ngram-lists")
    discard(whole_lists)
    other = F.col("c").alias("d"), F.col("n").alias("m"), F.col("i").alias("j"), F.col("t")
    few, many = lists.filter(F.col("k") <= light), lists.filter(F.col("k") > light)
    many = stored(many.join(many.groupBy("c").agg(F.sum("k").alias("weight")), "c"), "ngram-many")
    tried = stored(candidates(few.join(few.select(*other), "t").filter("c < d"), percent), "ngram-few")

    def in_pairs(pairs: DataFrame) -> DataFrame:
        return stored(pairs.select(F.col("a").alias("c")).union(pairs.select("b")).union(many.select("c")).distinct(), "ngram-members")

    firsts = listed.join(in_pairs(tried), "c", "left_semi").dropDuplicates(["c"]).select("c", "n", "bits")
    firsts = stored(firsts, "ngram-firsts")
    slim = stored(documents.select("id", "x", "c", "n"), "ngram-slim")
    discard(documents)
    documents = slim
    tried = stored(may_link(tried, firsts, percent), "ngram-few")
    members = in_pairs(tried)
    # One row stands for a class. It is found by its key too, as many texts may have one identity; where only rows without identity have the class, by its key alone.
    row = F.struct(F.col("id").isNull().alias("none"), "id", "x")
    one = documents.join(members, "c", "left_semi").groupBy("c").agg(F.min(row).alias("one")).select("c", "one.id", "one.x")
    found = docs.join(one, ["id", "x"]).dropDuplicates(["id", "x", "c"]).select("c", "text")
    nameless = docs.filter("id is null").groupBy("x").agg(F.min("text").alias("text"))
    found = found.union(nameless.join(one.filter("id is null").select("c", "x"), "x").select("c", "text"))
    sets = stored(whole_sets(found, size), "ngram-sets")

    links = None
    for turn in range(rounds):
        pivots = many.groupBy("t").agg(*(F.min(central("comp" if turn else "c", turn, k)).alias(f"p{k}") for k in range(PIVOTS)))
        pivots = pivots.select("t", F.explode(F.array_distinct(F.array(*(f"p{k}.p" for k in range(PIVOTS))))).alias("p"))
        with_pivot = many.join(pivots, "t").withColumn("d", F.col("p.c")).withColumn("m", F.col("p.n")).withColumn("j", F.col("p.i"))
        if "comp" in many.columns:
            with_pivot = with_pivot.join(comp.select(F.col("node").alias("d"), F.col("label").alias("far")), "d", "left")
            with_pivot = with_pivot.filter(F.col("comp") != F.coalesce("far", "d"))
        now = may_link(stored(candidates(with_pivot, percent), "ngram-met"), firsts, percent)
        now = now.union(tried).distinct() if turn == 0 else now
        new = linked(stored(now, "ngram-pairs"), sets, percent)
        links = stored(new if links is None else links.union(new), "ngram-links")
        comp = components(links)
        labelled = many.drop("comp").join(comp.withColumnRenamed("node", "c"), "c", "left").withColumn("comp", F.coalesce("label", "c")).drop("label")
        mixed = labelled.groupBy("t").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y").select("t")
        many = stored(labelled.join(mixed, "t", "left_semi"), "ngram-open")
        if many.isEmpty():
            break
    else:
        rest = many.join(many.select(*other, F.col("comp").alias("far")), "t").filter("c < d and comp <> far")
        rest = may_link(stored(candidates(rest, percent), "ngram-met"), firsts, percent)
        new = linked(stored(rest, "ngram-pairs"), sets, percent)
        links = stored(links.union(new), "ngram-links")
        comp = components(links)

    named = documents.join(comp.withColumnRenamed("node", "c"), "c", "left")
    return named.select("id", "x", "n", F.coalesce("label", "c").alias("comp"))


def one_of_each(docs: DataFrame, *, identity: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``docs`` without the near copies: of each component one row stays, that of the smallest identity, null last, and of the smallest key of the whole row among those.

    Documents without words are components of their own: one row an identity stays, and every row without one.
    """
    rows = docs.withColumn("_stay_row", row_key(docs))
    key = F.col(identity).cast("long")
    named = labelled(rows.select(key.alias("id"), F.col(text).alias("text"), F.col("_stay_row").alias("x")), **how)
    named = stored(named, "ngram-named")
    row = F.struct(F.col("id").isNull().alias("none"), "id", "x")
    stay = named.filter("n > 0").groupBy("comp").agg(F.min(row).alias("one"))
    stay = stay.unionByName(named.filter("n = 0 and id is not null").groupBy(F.col("id").alias("comp")).agg(F.min(row).alias("one")))
    stay = stored(stay.select(F.col("one.id").alias("_stay_id"), F.col("one.x").alias("_stay_x")), "ngram-stay")
    kept = rows.join(stay, key.eqNullSafe(F.col("_stay_id")) & (F.col("_stay_row") == F.col("_stay_x"))).dropDuplicates(["_stay_id", "_stay_x"])
    wordless = F.translate(F.coalesce(F.col(text), F.lit("")), SPACES, "") == ""
    return kept.select(docs.columns).unionByName(docs.filter(F.col(identity).isNull() & wordless))
