"""Scalar column expressions. All of them stay inside whole-stage code generation where Spark can."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_key(c: str | Column) -> Column:
    """Join keys compare without case or padding, as in a case-insensitive store."""
    return F.upper(F.trim(col(c)))


def text_or(c: str | Column, default: str) -> Column:
    """The text, or ``default`` where it is null or blank."""
    c = col(c)
    return F.when(c.isNull() | (F.trim(c) == ""), F.lit(default)).otherwise(c)


def word_count(c: str | Column, mode: str = "spaces") -> Column:
    """``spaces``: single spaces + 1. ``tokens``: runs of non-white-space."""
    c = col(c)
    if mode == "spaces":
        return (F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit(""))) + 1).cast("int")
    if mode == "tokens":
        trimmed = F.regexp_replace(c, r"^\s+|\s+$", "")
        return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, r"\s+"))).cast("int")
    raise ValueError(f"unknown word count mode {mode!r}")


def first_match(c: str | Column, rules: Sequence[tuple[str, str]], default: str) -> Column:
    """Label of the first rule whose keyword alternation occurs anywhere in the text, ignoring case."""
    c = col(c)
    chain = None
    for label, pattern in rules:
        hit = c.rlike(f"(?i){pattern}")
        chain = F.when(hit, F.lit(label)) if chain is None else chain.when(hit, F.lit(label))
    return F.lit(default) if chain is None else chain.otherwise(F.lit(default))


def lookup(c: str | Column, groups: Mapping[str, Sequence[str]], default: str) -> Column:
    """Label of the group that lists the value (ignoring case), else ``default``."""
    key = normalise_key(c)
    chain = None
    for label, members in groups.items():
        hit = key.isin([m.upper() for m in members])
        chain = F.when(hit, F.lit(label)) if chain is None else chain.when(hit, F.lit(label))
    return F.lit(default) if chain is None else chain.otherwise(F.lit(default))


def band(c: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """First label whose inclusive upper edge holds the value; the last label is open."""
    c = col(c)
    chain = F.when(c <= edges[0], F.lit(labels[0]))
    for edge, label in zip(edges[1:], labels[1:], strict=False):
        chain = chain.when(c <= edge, F.lit(label))
    return chain.when(c.isNotNull(), F.lit(labels[-1]))


def interval_bin(c: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins (lo, hi]; null outside the edges."""
    c = col(c)
    chain = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels, strict=True):
        hit = (c > lo) & (c <= hi)
        chain = F.when(hit, F.lit(label)) if chain is None else chain.when(hit, F.lit(label))
    return chain


def rank_in(c: str | Column, order: Sequence[str]) -> Column:
    """1-based position of the value in a custom order, 0 where it is missing."""
    return F.coalesce(F.array_position(F.array(*[F.lit(x) for x in order]), col(c)), F.lit(0)).cast("int")


def clip(c: str | Column, low: float | Column, high: float | Column) -> Column:
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    c = col(c)
    return F.when(c.isNotNull(), F.greatest(low, F.least(high, c)))


def ratio(a: str | Column, b: str | Column) -> Column:
    """Double division that gives null, not an error, on a zero divisor."""
    return F.try_divide(col(a).cast("double"), col(b).cast("double"))


def rounded(c: str | Column, digits: int | None) -> Column:
    return col(c) if digits is None else F.round(col(c), digits)


def is_weekend(c: str | Column) -> Column:
    return F.dayofweek(col(c)).isin(1, 7).cast("int")


def is_cancelled(c: str | Column) -> Column:
    return F.upper(col(c)).startswith("C")


def churn_label(rule: str = "tiered", recency="Recency", frequency="Frequency", monetary="Monetary") -> Column:
    """``tiered``: three recency tiers that also look at orders and spend. ``recency90``: recency alone."""
    r, f, m = col(recency), col(frequency), col(monetary)
    if rule == "recency90":
        return (r > 90).cast("int")
    if rule == "tiered":
        gone = (r > 180) | ((r > 90) & (f <= 2)) | ((r > 60) & (f == 1) & (m < 100))
        return gone.cast("int")
    raise ValueError(f"unknown churn rule {rule!r}")


def polarity(c: str | Column, edge: float = 0.05, strict: bool = False) -> Column:
    """Positive / Negative / Neutral. The single scorers include the edge, the ensemble does not."""
    c = col(c)
    up, down = (c > edge, c < -edge) if strict else (c >= edge, c <= -edge)
    return F.when(c.isNotNull(), F.when(up, "Positive").when(down, "Negative").otherwise("Neutral"))


def clean_text(c: str | Column) -> Column:
    """Drop tags, web addresses and symbols, then collapse white space."""
    c = F.regexp_replace(col(c), r"<[^>]+>", "")
    c = F.regexp_replace(c, r"http\S+|www\S+", "")
    # No-break and other Unicode blanks count as white space.
    c = F.regexp_replace(c, r"[^\p{L}\p{N}_\s\p{Z}.,!?'-]", "")
    return F.trim(F.regexp_replace(c, r"[\s\p{Z}]+", " "))


def row_key(*cols: str | Column) -> Column:
    """Stable 128-bit surrogate for a fact row: needs no shuffle, survives retries, cannot collide in practice."""
    parts = [F.coalesce(col(c).cast("string"), F.lit("")) for c in cols]
    return F.md5(F.concat_ws("|", *parts))


def hash_fraction(c: str | Column, seed: int = 42) -> Column:
    """Repeatable pseudo-random number in [0, 1) per key: the same row always falls into the same split."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), col(c).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
