"""The language of texts, by a byte convolutional network that is trained on labelled texts (:mod:`langnet`).

Training reads a bounded sample: of each language ``per_label`` texts at most, those of smallest hash, and of each text ``cuts`` windows spread over its whole length, and short beginnings of these. Languages are counted first and texts beyond a hash bound
that leaves about twice as many as wanted aren't shuffled, so a language of a third of all rows sends no more than a rare one. Texts of the held-out fold never take part.

Prediction reads whole texts in windows of ``length`` bytes. The windows' log chances are averaged, weighted by the bytes in them, and the softmax of the averages times the square root of the number of windows (at most
``sure``) is the score.

Defined cases: a null text or one without a letter is ``und`` with score 0, and isn't learned from; so are all texts when no labelled text is there to learn from; with one language only every text has it, with score 1; a null
identity belongs to the learning fold; repeated rows are predicted each; more than ``max_labels`` languages are refused; an empty table gives an empty result; other columns pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from merchantry.llm.langnet import PAD, Network, trained, windows

UNKNOWN = "und"
#: Bytes of the beginnings that a text's windows are learned by too.
SHORT = (16, 32, 64, 128)
ANSWER = "label string, score double"


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def held_out(identity: Column) -> Column:
    """The fold that is never learned from."""
    return F.coalesce(F.crc32(identity.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def sample(docs: DataFrame, text: str, label: str, identity: str, *, per_label: int, cuts: int, length: int, max_labels: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The labels in order, windows of bytes and the number of each window's label."""
    rows = docs.select(F.col(text).alias("t"), F.col(label).cast("string").alias("lab"), held_out(F.col(identity)).alias("out"), F.col(identity).cast("string").alias("id"))
    rows = rows.filter(~F.col("out") & F.col("lab").isNotNull())
    counts = {r["lab"]: r["n"] for r in rows.filter(has_letter(F.col("t"))).groupBy("lab").agg(F.count("*").alias("n")).orderBy("lab").limit(max_labels + 1).collect()}
    if len(counts) > max_labels:
        raise ValueError(f"more than {max_labels} languages")
    labels = sorted(counts)
    if not labels:
        return [], np.empty((0, length), np.int16), np.empty(0, np.int64)
    # 2**62 hash values; a language's bound leaves about twice the texts that are wanted.
    bound = F.create_map(*[F.lit(v) for lab, n in counts.items() for v in (lab, int(min(1.0, 2 * per_label / n) * ((1 << 62) - 1)))])
    hashed = F.shiftrightunsigned(F.xxhash64("id", "t"), 2)
    few = rows.withColumn("h", hashed).filter(F.col("h") <= bound[F.col("lab")]).filter(has_letter(F.col("t")))
    raw = F.encode("t", "UTF-8")
    spread = F.transform(F.sequence(F.lit(0), F.lit(cuts - 1)), lambda i: F.substring(raw, (F.greatest(F.octet_length("t") - length, F.lit(0)) * i / max(1, cuts - 1) + 1).cast("int"), F.lit(length)))
    few = few.select("lab", "h", spread.alias("w"))
    best = few.withColumn("at", F.row_number().over(Window.partitionBy("lab").orderBy("h", "w"))).filter(F.col("at") <= per_label)
    xs, ys = [], []
    for r in best.orderBy("lab", "at").toLocalIterator():
        own = dict.fromkeys(bytes(w) for w in r["w"])
        # Beginnings of windows too, so that short texts look like something learned.
        for w in [*own, *(w[:n] for w, n in zip(own, SHORT))]:
            xs.append(windows(w, length)[0])
            ys.append(labels.index(r["lab"]))
    return labels, np.array(xs, np.int16).reshape(-1, length), np.array(ys, np.int64)


def answers(texts: Iterable[str | None], model: Network, labels: int, length: int, sure: float, group: int = 256) -> np.ndarray:
    """The chances of each label for each text. Windows of all texts go through the network in groups; of a long text only sums are kept."""
    totals: list[np.ndarray] = []
    weights, counts = [], []
    open_: list[np.ndarray] = []
    owners: list[int] = []

    def flush() -> None:
        x = np.concatenate(open_) if open_ else np.empty((0, length), np.int16)
        for i in range(0, len(x), group):
            part = x[i : i + group]
            logs = model.log_chances(part) * np.maximum((part != PAD).sum(axis=1), 1)[:, None]
            for owner, row in zip(owners[i : i + group], logs, strict=True):
                totals[owner] += row
        open_.clear()
        owners.clear()

    for text in texts:
        raw = (text or "").encode()
        totals.append(np.zeros(labels))
        weights.append(max(1, len(raw)))
        counts.append(max(1, -(-len(raw) // length)))
        for i in range(0, max(1, len(raw)), length * group):
            x = windows(raw[i : i + length * group], length)
            open_.append(x)
            owners.extend([len(totals) - 1] * len(x))
            if len(owners) >= 4 * group:
                flush()
    flush()
    if not totals:
        return np.empty((0, labels))
    mean = np.stack(totals) / np.array(weights)[:, None] * np.minimum(np.sqrt(counts), sure)[:, None]
    chances = np.exp(mean - mean.max(axis=1, keepdims=True))
    return chances / chances.sum(axis=1, keepdims=True)


class Identifier:
    """A prediction column. The network is trained on the driver on the bounded sample and broadcast."""

    def __init__(
        self, docs: DataFrame, *, text: str = "text", label: str = "lang", identity: str = "doc_id", per_label: int = 500, cuts: int = 4, length: int = 256, sure: float = 4.0, max_labels: int = 500, **training
    ) -> None:
        self.labels, x, y = sample(docs, text, label, identity, per_label=per_label, cuts=cuts, length=length, max_labels=max_labels)
        self.length, self.sure = length, sure
        model = trained(x, y, len(self.labels), **training) if len(self.labels) > 1 else None
        self.model = docs.sparkSession.sparkContext.broadcast(model)

    def predict(self, text: Column) -> Column:
        """A struct (label, score)."""
        if not self.labels:
            return F.struct(F.lit(UNKNOWN).alias("label"), F.lit(0.0).alias("score"))
        shared, labels, length, sure = self.model, self.labels, self.length, self.sure

        @F.pandas_udf(ANSWER)
        def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                chances = answers(batch, shared.value, len(labels), length, sure)
                best = chances.argmax(axis=1)
                yield pd.DataFrame({"label": [labels[i] for i in best], "score": chances.max(axis=1)})

        some = has_letter(text)
        if len(labels) == 1:
            return F.struct(F.when(some, F.lit(labels[0])).otherwise(UNKNOWN).alias("label"), F.when(some, F.lit(1.0)).otherwise(0.0).alias("score"))
        # A text that needs no answer doesn't reach Python.
        out = predict(F.when(some, text))
        return F.struct(F.when(some, out["label"]).otherwise(UNKNOWN).alias("label"), F.when(some, out["score"]).otherwise(0.0).alias("score"))


def with_language(docs: DataFrame, *, text: str = "text", into: str = "lang_pred", score: str = "score", **how) -> DataFrame:
    """``docs`` with the predicted language and its score in the columns ``into`` and ``score``."""
    found = Identifier(docs, text=text, **how).predict(F.col(text))
    rows = docs.select(F.struct("*").alias("_row"), found.alias("_found"))
    own = [c for c in docs.columns if c not in (into, score)]
    return rows.select(*(F.col(f"_row.`{c}`").alias(c) for c in own), F.col("_found.label").alias(into), F.col("_found.score").alias(score))
