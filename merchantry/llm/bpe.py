"""Byte-level BPE by a file of ranks: encoding and decoding.

Text is split by a pattern; each match is looked up as a whole in a minimal perfect hash over the vocabulary. Matches that aren't in it are merged pair by pair: their bytes
are a linked list, and a heap gives the pair of lowest rank, leftmost first; entries that a merge has made stale are skipped.

The hash places every vocabulary entry in a slot of its own: entries are dealt to small buckets, and buckets, largest first, get the first displacement that puts all their entries into
free slots; a bucket of one entry names its slot instead. A slot's entry is compared with the key, so a key outside the vocabulary is recognised. The tables are built on the driver and broadcast; their size is the vocabulary's.

Encoded matches are remembered in each Python worker, up to a fixed number of those used last. This changes no result.

A worker encodes and decodes a few texts at a time and hands on what it made of them, so it never holds the ids and bytes of a whole batch of Spark's.

Defined cases: null and empty text have no ids; decoding null gives null; repeated rows are encoded each; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import base64
import heapq
import itertools
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class PerfectHash:
    """Minimal perfect hash from byte strings to 0..n-1."""

    def __init__(self, keys: list[bytes], per_bucket: int = 2) -> None:
        self.size = max(1, len(keys))
        self.buckets = max(1, self.size // per_bucket)
        places = [self._places(k) for k in keys]
        groups: list[list[int]] = [[] for _ in range(self.buckets)]
        for i, (b, _, _) in enumerate(places):
            groups[b].append(i)
        self.displace = np.zeros(self.buckets, dtype=np.int64)
        self.slots = np.full(self.size, -1, dtype=np.int64)
        free = 0
        for b in sorted(range(self.buckets), key=lambda b: -len(groups[b])):
            if len(groups[b]) == 1:  # alone: takes the next free slot, which stands in place of a displacement
                while self.slots[free] >= 0:
                    free += 1
                self.slots[free] = groups[b][0]
                self.displace[b] = -1 - free
                continue
            d = 0
            while groups[b]:
                at = [self._at(places[i], d) for i in groups[b]]
                if len(set(at)) == len(at) and all(self.slots[s] < 0 for s in at):
                    self.slots[at] = groups[b]
                    self.displace[b] = d
                    break
                d += 1
        self.displace = self.displace.tolist()

    def _places(self, key: bytes) -> tuple[int, int, int]:
        h = xxhash.xxh3_128_intdigest(key)
        return (h & 0xFFFFFFFF) % self.buckets, (h >> 32 & 0xFFFFFFFF) % self.size, 1 + (h >> 64) % self.size

    def _at(self, place: tuple[int, int, int], d: int) -> int:
        return (place[1] + d * place[2] + (d * d * d >> 3)) % self.size

    def slot(self, key: bytes) -> int:
        place = self._places(key)
        d = self.displace[place[0]]
        return -1 - d if d < 0 else self._at(place, d)


class Ranks:
    """A vocabulary: bytes of each id, and the perfect hash that finds ids."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as f:
            pairs = [(base64.b64decode(a), int(b)) for a, b in (line.split() for line in f if line.strip())]
        self.hash = PerfectHash([k for k, _ in pairs])
        self.entries = [pairs[i] if i >= 0 else (b"", -1) for i in self.hash.slots.tolist()]
        self.hash.slots = None  # entries stand in slot order
        self.merges = dict(pairs)  # for the parts inside a word, which are looked up many times
        self.bytes_of = [b""] * (1 + max((r for _, r in pairs), default=-1))
        for k, r in pairs:
            self.bytes_of[r] = k

    def rank(self, key: bytes) -> int:
        """The id of ``key``, -1 for bytes outside the vocabulary."""
        entry, rank = self.entries[self.hash.slot(key)]
        return rank if entry == key else -1

    def merge(self, word: bytes) -> list[int]:
        """Merges pairs of lowest rank, leftmost first, until no pair of parts is in the vocabulary."""
        n, rank = len(word), self.merges.get
        ends, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that starts at a byte; an end of 0 marks a merged one
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            _, i, end = pop(heap)
            j = ends[i]
            if not j or j >= n or ends[j] != end:
                continue  # one of the two has changed since
            ends[j], ends[i] = 0, end
            if end < n:
                before[end] = i
                if (r := rank(word[i : ends[end]])) is not None:
                    push(heap, (r, i, ends[end]))
            if (p := before[i]) >= 0 and (r := rank(word[p:end])) is not None:
                push(heap, (r, p, end))
        out, i = [], 0
        while i < n:
            out.append(self.merges[word[i : ends[i]]])
            i = ends[i]
        return out

    def encode(self, word: str) -> bytes:
        raw = word.encode()
        r = self.rank(raw)
        ids = [r] if r >= 0 else self.merge(raw)
        return struct.pack(f"<{len(ids)}I", *ids)


class Remembered(dict):
    """Encoded matches: those asked for since the memory last turned over, and behind them the generation before, each of ``limit`` at most."""

    def __init__(self, ranks: Ranks, limit: int) -> None:
        super().__init__()
        self.ranks, self.limit, self.older = ranks, limit, {}

    def __missing__(self, word: str) -> bytes:
        out = self.older.get(word) or self.ranks.encode(word)
        if len(word) <= 64:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[word] = out
        return out


#: The memory of a Python worker, by the vocabulary it is for; one at a time.
_STATE: dict[int, Remembered] = {}


_KEYS = itertools.count()

#: Rows that are worked on before their results are handed on.
AT_ONCE = 128


def in_parts(batches: Iterator[pa.Array], size: int = AT_ONCE) -> Iterator[list]:
    """The values of all batches, ``size`` at a time."""
    for batch in batches:
        for at in range(0, len(batch), size):
            yield batch.slice(at, size).to_pylist()


class Codec:
    """Encoder and decoder columns over one vocabulary file."""

    def __init__(self, spark: SparkSession, path: str, pattern: str, *, remember: int = 200_000) -> None:
        self.ranks = spark.sparkContext.broadcast(Ranks(path))
        self.pattern, self.remember = pattern, remember
        self.key = next(_KEYS)

    def _encoder(self) -> Callable[[], Callable[[str | None], bytes]]:
        """What makes, in a worker, the function from a text to its ids."""
        shared, key, pattern, limit = self.ranks, self.key, self.pattern, self.remember

        def made() -> Callable[[str | None], bytes]:
            find = regex.compile(pattern).findall
            if key not in _STATE:
                _STATE.clear()
                _STATE[key] = Remembered(shared.value, limit)
            known = _STATE[key].__getitem__
            return lambda text: b"".join(map(known, find(text))) if text else b""

        return made

    def _decoder(self) -> Callable[[], Callable[[bytes | None], bytes | None]]:
        shared = self.ranks

        def made() -> Callable[[bytes | None], bytes | None]:
            part = shared.value.bytes_of.__getitem__
            return lambda ids: None if ids is None else b"".join(map(part, np.frombuffer(ids, "<u4").tolist()))

        return made

    def encode(self, text: Column) -> Column:
        """The ids of a text, as little-endian unsigned 32-bit integers."""
        encoder = self._encoder()

        @F.arrow_udf("binary")
        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            one = encoder()
            for texts in in_parts(batches):
                yield pa.array([one(t) for t in texts], pa.binary())

        return encode(text)

    def decode(self, ids: Column) -> Column:
        """The bytes that ids stand for. An id outside the vocabulary is an error."""
        decoder = self._decoder()

        @F.arrow_udf("binary")
        def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            one = decoder()
            for rows in in_parts(batches):
                yield pa.array([one(x) for x in rows], pa.binary())

        return decode(ids)

    def round_trip(self, text: Column) -> Column:
        """A struct of what :meth:`encode` gives, and of what :meth:`decode` gives for those ids. Both steps run in one worker: two columns would take two for each task, and send the ids between them."""
        encoder, decoder = self._encoder(), self._decoder()

        @F.arrow_udf("ids binary, decoded binary")
        def round_trip(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            encode, decode = encoder(), decoder()
            for texts in in_parts(batches):
                ids = [encode(t) for t in texts]
                columns = [pa.array(ids, pa.binary()), pa.array([decode(x) for x in ids], pa.binary())]
                yield pa.StructArray.from_arrays(columns, names=["ids", "decoded"])

        return round_trip(text)


def encoded(docs: DataFrame, path: str, pattern: str, *, text: str = "text", into: str = "ids") -> DataFrame:
    """``docs`` with the ids of ``text`` in the column ``into``."""
    return docs.withColumn(into, Codec(docs.sparkSession, path, pattern).encode(F.col(text)))


def decoded(rows: DataFrame, path: str, pattern: str, *, ids: str = "ids", into: str = "decoded") -> DataFrame:
    return rows.withColumn(into, Codec(rows.sparkSession, path, pattern).decode(F.col(ids)))
