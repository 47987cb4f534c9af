"""Substring dedup: words inside windows that stand earlier in the corpus are removed.

A window is ``window`` consecutive words of one document. A word goes when a window over it has the same words as a window that starts earlier: in a document of smaller identity, or in
the same document at an earlier word. Windows are judged on the input, not on what is left.

Levels of doubling
    The first level looks at short windows of ``base`` words, the next ones at twice the length, up to ``window``. A long window is a candidate at a level only while the shorter windows in it were
    repeated at every level before; at the last level the window itself is looked at. A level needn't look at all short windows of a candidate: the one with the smallest fingerprint stands for
    it, and equal long windows have the same one at the same place. So about 2 / (window - base + 2) of the short windows are ever shuffled, and levels after the first only read
    documents with candidates. Doubling ends when no candidates are left or at the window's own length.

Copies of whole documents are told by a fingerprint of all words: the first copy is judged, the others hold nothing new. Counting looks for a smallest and a largest place of a fingerprint, which
combines before the shuffle, so a passage in a third of all documents is no hot spot.

Defined cases: null text has no words; a text shorter than a window keeps all; white space between kept words becomes one blank; a null identity comes last; rows equal in identity and words are one
document, both rows get its result; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from merchantry.llm.common import discard, stored
from merchantry.llm.windows import sequence_print, window_prints, word_prints

LAST = (1 << 63) - 1
REMEMBER = 200_000


def _smallest(short: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` neighbours, the place of the smallest one, the leftmost of equals."""
    if len(short) < width:
        return np.empty(0, np.int64)
    return np.arange(len(short) - width + 1) + np.lib.stride_tricks.sliding_window_view(short, width).argmin(axis=1)


def _sequence(words: np.ndarray) -> int:
    return int(sequence_print(words).view(np.int64)[0])


def _longs(parts: list[np.ndarray]) -> pa.Array:
    return pa.array(np.concatenate(parts).astype(np.int64, copy=False) if parts else np.empty(0, np.int64))


def sequences(docs: DataFrame, base: int, window: int) -> DataFrame:
    """(id, x, seq, n, sha, hs, places) in one reading of the texts: their given key ``x``, the fingerprint and number of a document's words, the digest of all of them joined by blanks, and the fingerprints and places of
    the short windows that stand for its windows. Of copies within a task only the first comes with windows."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            seqs, ns, shas, hs, places, ends = [], [], [], [], [], [0]
            for t in batch.column("text").to_pylist():
                words = word_prints(t)
                seq = _sequence(words)
                seqs.append(seq)
                ns.append(len(words))
                shas.append(hashlib.sha256(b" ".join(t.encode().split())).hexdigest())
                if len(words) >= window and seq not in seen:
                    if len(seen) >= REMEMBER:
                        seen.clear()
                    seen.add(seq)
                    short = window_prints(words, base)
                    at = np.unique(_smallest(short, window - base + 1))
                    hs.append(short[at].view(np.int64))
                    places.append(at)
                    ends.append(ends[-1] + len(at))
                else:
                    ends.append(ends[-1])
            offsets = pa.array(np.array(ends, np.int32))
            lists = [pa.ListArray.from_arrays(offsets, _longs(x)) for x in (hs, places)]
            cols = [batch.column("id"), batch.column("x"), pa.array(seqs, pa.int64()), pa.array(ns, pa.int64()), pa.array(shas, pa.string()), *lists]
            yield pa.RecordBatch.from_arrays(cols, ["id", "x", "seq", "n", "sha", "hs", "places"])

    return docs.mapInArrow(local, "id long, x long, seq long, n long, sha string, hs array<long>, places array<long>")


def next_anchors(open_: DataFrame, length: int, shorter: int, window: int) -> DataFrame:
    """(h, id, seq, pos) at the next level: the windows of ``length`` that stand for the candidates, whose ``shorter`` windows are at ``places``; ``seq`` tells apart texts of one identity."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hs, ids, seqs, places = [], [], [], []
            for i, seq, t, was in zip(*(batch.column(x).to_pylist() for x in ("id", "seq", "text", "places")), strict=True):
                words = word_prints(t)
                if _sequence(words) != seq:
                    continue
                alive = np.isin(_smallest(window_prints(words, shorter), window - shorter + 1), np.array(was, np.int64))
                long = window_prints(words, length)
                at = np.unique(_smallest(long, window - length + 1)[alive])
                hs.append(long[at].view(np.int64))
                ids.append(np.full(len(at), i, np.int64))
                seqs.append(np.full(len(at), seq, np.int64))
                places.append(at)
            yield pa.RecordBatch.from_arrays([_longs(hs), _longs(ids), _longs(seqs), _longs(places)], ["h", "id", "seq", "pos"])

    return open_.select("id", "seq", "text", "places").mapInArrow(local, "h long, id long, seq long, pos long")


def cut_out(open_: DataFrame, window: int) -> DataFrame:
    """(id, seq, n_removed, sha, kept) from texts and the starts of their repeated windows."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for i, seq, t, was in zip(*(batch.column(x).to_pylist() for x in ("id", "seq", "text", "places")), strict=True):
                words = t.encode().split()
                edge = np.zeros(len(words) + 1, np.int64)
                at = np.array(was, np.int64)
                edge[at] += 1  # starts differ from each other
                edge[at + window] -= 1
                stay = np.cumsum(edge[:-1]) == 0
                kept = b" ".join(w for w, s in zip(words, stay.tolist(), strict=True) if s)
                out.append((i, seq, int((~stay).sum()), hashlib.sha256(kept).hexdigest(), kept.decode()))
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            names = ["id", "seq", "n_removed", "sha", "kept"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, types, strict=True)], names)

    return open_.select("id", "seq", "text", "places").mapInArrow(local, "id long, seq long, n_removed long, sha string, kept string")


def repeated(docs: DataFrame, *, identity: str = "doc_id", text: str = "text", window: int = 20, base: int = 10) -> tuple[DataFrame, DataFrame]:
    """Two tables: (id, seq, n, sha, first) of all documents, ``first`` the identity of the first copy of the words; and (id, seq, n_removed, sha, kept) of the
    first copies that lose words."""
    if window < base or window % base or (window // base) & (window // base - 1):
        raise ValueError("window must be base times a power of two")
    docs = docs.select(F.coalesce(F.col(identity).cast("long"), F.lit(LAST)).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    docs = docs.withColumn("x", F.xxhash64("text"))
    read = stored(sequences(docs, base, window), "sub-documents")
    every = read.select("id", "x", "seq", "n", "sha")
    firsts = every.groupBy("seq").agg(F.min("id").alias("first"))
    every = stored(every.join(firsts, "seq"), "sub-first")

    # The counting and the join back read one shuffle by fingerprint.
    anchors = read.select("seq", F.explode(F.arrays_zip("hs", "places")).alias("a")).select("seq", F.col("a.hs").alias("h"), F.col("a.places").alias("pos"))
    anchors = anchors.repartition("h")
    place = F.struct("seq", "pos")
    again = anchors.groupBy("h").agg(F.min(place).alias("x"), F.max(place).alias("y")).filter("x <> y").select("h")
    alive = stored(anchors.join(again, "h").groupBy("seq").agg(F.collect_set("pos").alias("places")), "sub-alive")
    # One text a sequence, found by its own fingerprint too: many texts may have one identity, or none.
    open_ids = every.filter("id = first").groupBy("id", "seq").agg(F.min("x").alias("x")).join(alive, "seq")
    discard(read)
    open_ = stored(docs.join(open_ids, ["id", "x"]).dropDuplicates(["id", "x", "seq"]).drop("x"), "sub-open")
    every = every.drop("x")

    length = base
    while True:
        shorter, length = length, min(2 * length, window)
        found = stored(next_anchors(open_, length, shorter, window), "sub-windows")
        place = F.struct("id", "seq", "pos")
        spans = found.groupBy("h").agg(F.min(place).alias("first"), F.count("*").alias("k")).filter("k > 1")
        both = found.join(spans.select(F.col("h").alias("g"), "first"), F.col("h") == F.col("g"))
        if length == window:
            both = both.filter(place > F.col("first"))
        alive = both.groupBy("id", "seq").agg(F.collect_set("pos").alias("places"))
        left = stored(open_.drop("places").join(alive, ["id", "seq"]), "sub-open")
        discard(found)
        discard(open_)
        open_ = left
        if length == window:
            return every, cut_out(open_, window)


def deduplicated(docs: DataFrame, *, identity: str = "doc_id", text: str = "text", window: int = 20, base: int = 10, with_text: bool = True) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) and, with ``with_text``, what is left of the text, one row per document.

    Untouched texts come with ``kept`` null: their words are the input's.
    """
    every, lost = repeated(docs, identity=identity, text=text, window=window, base=base)
    lost = lost.select("id", "seq", "n_removed", F.col("sha").alias("left_sha"), *(["kept"] if with_text else []))
    out = every.join(lost, ["id", "seq"], "left")
    copy = (F.col("id") > F.col("first")) & (F.col("n") >= window)
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(
        F.when(F.col("id") != LAST, F.col("id")).alias("id"),
        F.col("n").alias("n_words"),
        F.when(copy, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(nothing)).otherwise(F.coalesce("left_sha", "sha")).alias("kept_sha256"),
        *([F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept")] if with_text else []),
    )
