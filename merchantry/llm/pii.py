"""Personal data in texts: exact base patterns, and spans that a trained character tagger adds.

Base patterns give emails, IP addresses, card and phone numbers, leftmost and without overlap within a kind; a match that fails its check is dropped.

The tagger (:mod:`tagger`) is a bidirectional LSTM with CRF transitions, trained on labelled windows when first used. Every kind holds a digit or an ``@``, so the tagger reads the text around each of those, in
windows that overlap by half. What overlapping windows say is reconciled over the whole text: spans cut by a window's edge are left to its neighbour, and of spans that overlap the one found
farthest from an edge stays. A span is added when it passes the check of its kind and overlaps no base span.

Texts without a digit or ``@`` can't hold a span; they are told apart in the JVM and never reach Python. A text is handled as a whole, windows of all texts of a batch go through the network in groups of fixed size.

Defined cases: a text of any length is searched whole, in time that grows with its length, also where it is one number of any length; null and empty text have no spans; redaction leaves null as null; repeated rows are handled each; an empty table gives an empty result; other columns pass through. Offsets are code points, the end is exclusive.
"""

from __future__ import annotations

import bisect
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from merchantry.llm.tagger import KINDS, Tagger, char_classes, trained

#: The base patterns of each kind.
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
#: The same matches, looked for at the first digit of a run only: a match takes whole runs, and a search from every digit would cost the square of a run's length.
SEARCH = PATTERNS | {"ip": re.compile("(?<![0-9])" + PATTERNS["ip"].pattern)}
TRIGGER = "[0-9@]"
SPANS = "array<struct<kind:string,start:int,end:int,base:boolean>>"


def luhn(digits: str) -> bool:
    values = [int(c) for c in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def _digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def passes(kind: str, s: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        parts = [p.lstrip("0") for p in s.split(".")]  # a part may be any number of digits
        return all(len(p) <= 3 and int(p or "0") <= 255 for p in parts)
    d = _digits(s)
    return 14 <= len(d) <= 19 and luhn(d) if kind == "card" else 10 <= len(d) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Base matches of emails; looks only where an ``@`` follows, as a search from each character of the text would cost the square of a run's length."""
    done = 0
    for at in re.finditer("@", text):
        i = at.start()
        start = i
        while start > done and (c := text[start - 1]) < "\x80" and (c.isalnum() or c in "._%+-"):
            start -= 1
        if start < i and (m := PATTERNS["email"].match(text, start)) and m.start() >= done:
            yield m.span()
            done = m.end()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), by start and kind."""
    found = [(s, 0, e) for s, e in _emails(text)]
    for k, kind in enumerate(KINDS[1:], 1):
        if kind != "phone" or "+" in text:
            found += [(m.start(), k, m.end()) for m in SEARCH[kind].finditer(text) if passes(kind, m[0])]
    return sorted(found)


#: What an added span must look like, besides the check of its kind.
FORMS = {
    "email": re.compile(r"[^\s@]+ ?@ ?[^\s@]+\.[^\s@]*\w"),
    "ip": re.compile(r"[0-9]{1,3}([.][0-9]{1,3}){3}"),
    "card": re.compile(r"[0-9](?:[ .\- ]{0,2}[0-9])+"),
    "phone": re.compile(r"[+(]?[0-9](?:[ ().\-/ ]*[0-9])+"),
}


def windows(text: str, length: int) -> list[int]:
    """Starts of windows of ``length`` around digits and ``@``; neighbours overlap by half."""
    step, starts, covered = length // 2, [], -1
    for m in re.finditer(TRIGGER + "+", text):
        low, high = max(0, m.start() - step), min(len(text), m.end() + step)
        low = max(low, covered - step)  # goes on from the last window, half a window back
        while low < high and covered < high:
            starts.append(low)
            covered = low + length
            low += step
    return starts


def added_spans(texts: list[str], model: Tagger, length: int, group: int = 1024) -> list[list[tuple[int, int, int]]]:
    """Spans of each text that the tagger finds."""
    classes = [char_classes(t) for t in texts]
    where = [(i, s) for i, t in enumerate(texts) for s in windows(t, length)]
    seen: list[dict[tuple[int, int, int], int]] = [{} for _ in texts]
    for g in range(0, len(where), group):
        part = where[g : g + group]
        x = np.zeros((len(part), length), np.int8)
        for row, (i, s) in enumerate(part):
            piece = classes[i][s : s + length]
            x[row, : len(piece)] = piece
        for row, y in enumerate(model.decode(x)):
            i, s = part[row]
            n = min(length, len(texts[i]) - s)
            for at in np.flatnonzero(y[:n] % 2 == 1).tolist():
                end = at + 1
                while end < n and y[end] == y[at] + 1:
                    end += 1
                # How far the span is from an edge beyond which the text goes on.
                far = min(at if s else length, n - end if s + n < len(texts[i]) else length)
                span = (s + at, (int(y[at]) - 1) // 2, s + end)
                if far > 0 and (span := trimmed(texts[i], span)):
                    seen[i][span] = max(far, seen[i].get(span, 0))
    out = []
    for found in seen:
        spans: list[tuple[int, int, int]] = []  # apart from each other and in order
        for span, _ in sorted(found.items(), key=lambda x: (-x[1], x[0])):
            at = bisect.bisect(spans, span)
            if not (at and spans[at - 1][2] > span[0]) and not (at < len(spans) and spans[at][0] < span[2]):
                spans.insert(at, span)
        out.append(spans)
    return out


def trimmed(t: str, span: tuple[int, int, int]) -> tuple[int, int, int] | None:
    """The span without punctuation at its ends, None if it doesn't have the form of its kind."""
    s, k, e = span
    while s < e and t[s] in " \n\t.,;:!?-":
        s += 1
    while s < e and t[e - 1] in " \n\t.,;:!?-(":
        e -= 1
    piece, kind = t[s:e], KINDS[k]
    if (s > 0 and (t[s - 1].isalnum() or t[s - 1] in "._-@/")) or (e < len(t) and (t[e].isalnum() or t[e] in "@_/")):
        return None
    # A bare run of digits, a date or a time is no phone number.
    if kind == "phone" and re.fullmatch(r"[0-9]+|(19|20)[0-9]{2}[-./][01].*", piece):
        return None
    return (s, k, e) if FORMS[kind].fullmatch(piece) and passes(kind, piece) else None


def find(texts: list[str], model: Tagger, length: int) -> list[list[tuple[int, int, int, bool]]]:
    """All spans (start, kind number, end, base) of each text."""
    out = []
    for t, more in zip(texts, added_spans(texts, model, length), strict=True):
        base = base_spans(t)
        starts = [s for s, _, _ in base]
        reach = list(itertools.accumulate((e for _, _, e in base), max))  # how far the spans up to each one go
        extra = [x for x in more if not ((at := bisect.bisect_left(starts, x[2])) and reach[at - 1] > x[0])]
        out.append(sorted([(*x, True) for x in base] + [(*x, False) for x in extra]))
    return out


def found_in(batch: pd.Series, model: Tagger, length: int) -> Iterator[tuple[int, str, list[tuple[int, int, int, bool]]]]:
    """(place, text, spans) of the texts of a batch that aren't empty."""
    some = [i for i, t in enumerate(batch) if t]
    for j in range(0, len(some), 64):
        part = some[j : j + 64]
        texts = [batch.iloc[i] for i in part]
        yield from zip(part, texts, find(texts, model, length), strict=True)


class Detector:
    """Span and redaction columns. The model is trained on the driver on a bounded, fixed number of labelled windows and broadcast."""

    def __init__(self, spark: SparkSession, *, length: int = 48, **training) -> None:
        self.length = length
        self.model = spark.sparkContext.broadcast(trained(length=length, **training))

    def spans(self, text: Column) -> Column:
        """An array of (kind, start, end, base) by start and kind."""
        shared, length = self.model, self.length

        @F.pandas_udf(SPANS)
        def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                out: list = [[] for _ in range(len(batch))]
                for i, _, found in found_in(batch, shared.value, length):
                    out[i] = [{"kind": KINDS[k], "start": s, "end": e, "base": b} for s, k, e, b in found]
                yield pd.Series(out, dtype=object)

        return spans(F.when(text.rlike(TRIGGER), text))

    def redact(self, text: Column, spans: Column) -> Column:
        """The text with each span's characters replaced by its kind in brackets; of overlapping spans the first stands for all."""
        @F.pandas_udf("string")
        def redact(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            for texts, found in batches:
                yield pd.Series([redacted(t, [(x["start"], x["end"], x["kind"]) for x in s]) if s is not None and len(s) else t for t, s in zip(texts, found, strict=True)], dtype=object)

        some = F.size(F.coalesce(spans, F.array().cast(SPANS))) > 0
        return F.when(some, redact(F.when(some, text), F.when(some, spans))).otherwise(text)


    def replaced(self, text: Column) -> Column:
        """What :meth:`redact` gives for the text and its :meth:`spans`. Both steps run in one worker: two columns would take two for each task, and send texts twice."""
        shared, length = self.model, self.length

        @F.pandas_udf("string")
        def replaced(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                out: list = [None] * len(batch)
                for i, t, found in found_in(batch, shared.value, length):
                    if found:
                        out[i] = redacted(t, [(s, e, KINDS[k]) for s, k, e, _ in found])
                yield pd.Series(out, dtype=object)

        return F.coalesce(replaced(F.when(text.rlike(TRIGGER), text)), text)


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    parts, at = [], 0
    for s, e, kind in sorted(spans):
        if s >= at:
            parts += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join(parts) + text[at:]


def with_spans(docs: DataFrame, *, text: str = "text", into: str = "spans", **how) -> DataFrame:
    """``docs`` with the spans of ``text`` in the column ``into``."""
    return docs.withColumn(into, Detector(docs.sparkSession, **how).spans(F.col(text)))


def without_personal_data(docs: DataFrame, *, text: str = "text", **how) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; the same columns."""
    use = Detector(docs.sparkSession, **how)
    rows = docs.select(F.struct("*").alias("_row"), F.col(text).alias("_text"))
    rows = rows.withColumn("_new", use.replaced(F.col("_text")))
    return rows.select(*(F.col("_new").alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in docs.columns))
