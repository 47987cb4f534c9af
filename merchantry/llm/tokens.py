"""Exact token counts, with overlap resynchronisation for huge documents.

A text of up to ``chunk`` characters is encoded whole. A longer one is encoded in overlapping chunks with offsets, and two neighbours are spliced at a place in their
overlap that is a token boundary in both and is proven stable: no vocabulary piece holds the two characters around it side by side. Merges only ever make
vocabulary pieces, so none crosses such a place in any context, and the tokens before and after it are those of the whole text. Where an overlap has
no such place, it is widened to twice its length, in the end over the whole left chunk; a text without any stable place is encoded whole. The library sees
one chunk at a time, so a huge text costs memory for a chunk instead of for a lattice over the text.

A proof needs a model whose pieces are all there is: sentencepiece BPE with identity normalisation. ``.json`` tokenizers are encoded whole.

Defined cases: null and empty text have 0 tokens; repeated rows are counted each; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANK = "▁"


class PieceCounter:
    """Counts the tokens of a sentencepiece model."""

    def __init__(self, path: str, chunk: int, overlap: int) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.chunk, self.overlap = chunk, overlap
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        plain = [p for i, p in enumerate(pieces) if not (self.model.is_control(i) or self.model.is_byte(i) or self.model.is_unknown(i))]
        self.joined = {p[i : i + 2] for p in plain for i in range(len(p) - 1)}
        probe = "ﬁ ①  x́"
        self.identity = "".join(self.model.encode(probe, out_type=str)).startswith(BLANK + "ﬁ")

    def stable(self, text: str, at: int) -> bool:
        return text[at - 1 : at + 1].replace(" ", BLANK) not in self.joined

    def many(self, texts: list[str]) -> list[int]:
        short = [i for i, t in enumerate(texts) if len(t) <= self.chunk]
        out = [0] * len(texts)
        for i, ids in zip(short, self.model.encode([texts[i] for i in short], num_threads=1), strict=True):
            out[i] = len(ids)
        for i, t in enumerate(texts):
            if len(t) > self.chunk:
                out[i] = self.long(t)
        return out

    def begins(self, text: str, start: int, end: int) -> list[int]:
        """Where the tokens of a chunk begin, in the whole text."""
        part = text[start:end]
        found = self.model.encode(part, return_type="proto")
        # The library counts bytes; a byte inside a character stands for the character's place.
        place = start - 1 + np.cumsum((np.frombuffer(part.encode() + b"\0", np.uint8) & 0xC0) != 0x80)
        return place[[p.begin for p in found.pieces]].tolist()

    def long(self, text: str) -> int:
        if not self.identity:
            return len(self.model.encode(text))
        total, start, cut = 0, 0, 0
        end = self.chunk
        left = self.begins(text, start, end)
        while end < len(text):
            overlap = self.overlap
            while True:
                after = max(start, end - overlap)
                after_end = min(len(text), after + max(self.chunk, 2 * overlap))
                right = self.begins(text, after, after_end)
                both = set(left).intersection(right)
                # The first piece of the right chunk carries the blank that the library puts before a text.
                at = next((p for p in sorted(both) if max(after, cut) < p < end and self.stable(text, p)), None)
                if at is not None:
                    total += sum(cut <= b < at for b in left)
                    start, end, left, cut = after, after_end, right, at
                    break
                if after == start or overlap >= self.chunk:
                    # No stable place in the whole chunk: it grows, to the whole text if need be.
                    end = min(len(text), end + (end - start))
                    left = self.begins(text, start, end)
                    break
                overlap *= 2
        return total + sum(b >= cut for b in left)


class JsonCounter:
    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.no_truncation()
        self.model.no_padding()

    def many(self, texts: list[str]) -> list[int]:
        return [len(x.ids) for x in self.model.encode_batch(texts, add_special_tokens=False)]


_COUNTERS: dict[tuple, PieceCounter | JsonCounter] = {}


def counter(path: str, chunk: int, overlap: int) -> PieceCounter | JsonCounter:
    """One counter per Python worker."""
    key = (path, chunk, overlap)
    if key not in _COUNTERS:
        _COUNTERS[key] = JsonCounter(path) if path.endswith(".json") else PieceCounter(path, chunk, overlap)
    return _COUNTERS[key]


def token_count(text: Column, path: str, *, chunk: int = 32768, overlap: int = 512) -> Column:
    """The number of tokens of a text. ``path`` is the vocabulary file's place, the same on every machine."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        use = counter(path, chunk, overlap)
        for batch in batches:
            sizes: list[int] = []
            for i in range(0, len(batch), 256):
                sizes += use.many(["" if t is None else t for t in batch.iloc[i : i + 256]])
            yield pd.Series(sizes, dtype="int64")

    return count(text)


def with_token_counts(docs: DataFrame, path: str, *, text: str = "text", into: str = "n_tokens", **how) -> DataFrame:
    """``docs`` with the count in the column ``into``, which takes the place of one of that name."""
    return docs.withColumn(into, token_count(F.col(text), path, **how))
