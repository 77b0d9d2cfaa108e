"""Quality scores by positive-unlabelled learning.

Documents that are trusted to be good, and a sample of unlabelled ones, train a linear
model on features of the whole text. The share of good documents among the unlabelled,
the class prior, is estimated first; the model then minimises the non-negative unbiased
risk: the loss on positives weighed by the prior, and the loss on unlabelled as negatives
less what the positives among them account for, never below zero.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 12_000  # most documents of either sort that the model is fitted on
THRESHOLD = 0.7
STEPS = 600
RATE = 0.05
DECAY = 1e-4
SHORT = 4  # a text of so many words is believed half as much as a long one
FEATURE_MARKS = b"!?$%&*#|.,;:'\"()[]{}<>/\\=+-_@^~`"
BATCH = 64


def features(text: str | None) -> np.ndarray:
    """Shape of a whole text: shares of character classes, and of words and lines of some kinds.

    The last value says how far the others can be believed.
    """
    data = (text or "").encode("utf-8", "surrogatepass")
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256).astype(float)
    n = max(len(data), 1)
    words, lines = data.split(), data.split(b"\n")
    w, distinct = max(len(words), 1), set(words)
    upper = sum(word.isupper() for word in distinct)
    marked = sum(not word[-1:].isalnum() and word[-1] < 128 for word in distinct)
    bare = sum(not any(c > 127 or chr(c).isalnum() for c in word) for word in distinct)
    digit = sum(word.isdigit() for word in distinct)
    shares = [
        counts[65:91].sum() / n,
        counts[97:123].sum() / n,
        counts[48:58].sum() / n,
        counts[[9, 10, 11, 12, 13, 32]].sum() / n,
        counts[:9].sum() / n + counts[14:32].sum() / n,
        counts[128:].sum() / n,
        *(counts[mark] / w for mark in FEATURE_MARKS),
        upper / max(len(distinct), 1),
        marked / max(len(distinct), 1),
        bare / max(len(distinct), 1),
        digit / max(len(distinct), 1),
        len(distinct) / w,
        len(set(lines)) / len(lines),
        sum(map(len, words)) / w / 20,
        len(words) / len(lines) / 100,
        np.log1p(len(words)) / 10,
        float(not words),
    ]
    found = np.minimum(np.array(shares), 4.0)
    return np.concatenate([found, np.sqrt(found), [len(words) / (len(words) + SHORT)]])


WIDTH = len(features(""))


def held_out(id_col: str) -> Column:
    """Rows whose crc32 of the id as text leaves 2 modulo 4; labels are never learnt from them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def _descend(x: np.ndarray, gradient, steps: int = STEPS) -> np.ndarray:
    """Adam from zero; ``gradient`` maps margins to their derivatives of the risk."""
    weights, first, second = (np.zeros(x.shape[1]) for _ in range(3))
    for step in range(1, steps + 1):
        g = x.T @ gradient(x @ weights) + DECAY * weights
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        weights -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return weights


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, confidence: float = 0.1) -> float:
    """Share of positives among the unlabelled, from scores that rank positives high.

    The share of unlabelled above a threshold is at least the prior times that of
    positives; the least ratio over thresholds, with a margin for chance, is the estimate.
    """
    positive, unlabelled = np.sort(positive), np.sort(unlabelled)
    above_p = 1 - np.arange(len(positive)) / len(positive)
    above_u = 1 - np.searchsorted(unlabelled, positive) / len(unlabelled)
    slack = np.sqrt(np.log(4 / confidence) / 2)
    margin = slack / np.sqrt(len(positive)) + slack / np.sqrt(len(unlabelled))
    best = np.argmin((above_u + margin) / above_p)
    return float(np.clip(above_u[best] / above_p[best], 0.01, 0.99))


@dataclass(frozen=True)
class Model:
    """A linear model on standardised features; ``prior`` is the estimated class prior."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.weights):
            return np.full(len(x), self.prior)
        # summed row by row, so that a score does not depend on the rows beside it
        return np.round(_sigmoid((_standardised(x, self.mean, self.scale) * self.weights).sum(axis=1)), 9)


def _standardised(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised features, drawn in to the mean for short texts, and a constant."""
    z = np.clip((x[:, :-1] - mean) / scale, -8, 8) * x[:, -1:]
    return np.ascontiguousarray(np.hstack([z, np.ones((len(z), 1))]))


def fit_arrays(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None) -> Model:
    """Fit on feature rows. Without positives or without unlabelled rows every score is 0.5."""
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(0), np.ones(0), np.zeros(0), 0.5)
    both = np.vstack([positive, unlabelled])
    mean, scale = both[:, :-1].mean(axis=0), both[:, :-1].std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    x = _standardised(both, mean, scale)
    n_p, n_u = len(positive), len(unlabelled)
    is_p = np.arange(len(x)) < n_p

    if prior is None:
        margins = np.zeros(len(x))
        half = np.arange(len(x)) % 2 == 0
        for seen in (half, ~half):  # each half is ranked by a model of the other, which knows none of its rows
            n = max((is_p & seen).sum(), 1), max((~is_p & seen).sum(), 1)

            def apart(found: np.ndarray, p=is_p[seen], n=n) -> np.ndarray:
                return np.where(p, (_sigmoid(found) - 1) / n[0], _sigmoid(found) / n[1])

            margins[~seen] = x[~seen] @ _descend(x[seen], apart)
        prior = class_prior(margins[:n_p], margins[n_p:])

    def risk(margins: np.ndarray) -> np.ndarray:
        up = _sigmoid(margins)  # derivative of the loss of calling a row negative
        as_negative = np.logaddexp(0, margins)
        left = as_negative[~is_p].mean() - prior * as_negative[is_p].mean()
        if left < 0:  # push back up what has fallen below zero
            return np.where(is_p, prior * up / n_p, -up / n_u)
        return np.where(is_p, prior * ((up - 1) - up) / n_p, up / n_u)

    return Model(mean, scale, _descend(x, risk), prior)


def _features(rows: DataFrame) -> DataFrame:
    """(label, x) of (label, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.stack([features(t.as_py()) for t in batch.column(1)])
                values = pa.array(x.ravel())
                offsets = pa.array(np.arange(len(x) + 1) * WIDTH, type=pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, values)], ["label", "x"])

    return rows.mapInArrow(run, "label int, x array<double>")


def _below(key: Column, share: float) -> Column:
    """True for about this share of the keys, the same ones on every run."""
    return F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    label_col: str = "quality",
    sample: int = SAMPLE,
) -> Model:
    """Fit on about ``sample`` trusted documents and as many unlabelled ones.

    Trusted are documents whose every label is 1, among the rows not held out; a document
    labelled otherwise counts as unlabelled, and null labels are none. Both samples are
    chosen by a hash of the id, so they are the same on every run, and only their
    features, never texts, reach the driver.
    """
    learnt = labels.filter(~held_out(label_id_col) & F.col(label_col).isNotNull() & F.col(label_id_col).isNotNull())
    trusted = learnt.groupBy(F.col(label_id_col).cast("long").alias("_id")).agg(F.min(label_col).alias("_least")).filter("_least = 1")
    rows = docs.filter(~held_out(id_col) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")
    )
    few = trusted.filter(_below(F.col("_id"), sample / max(trusted.count(), 1))).select("_id")
    positive = rows.join(F.broadcast(few), F.col("id") == F.col("_id"), "left_semi")
    share = sample / max(rows.select("id").count(), 1)
    drawn = rows.filter(_below(F.concat(F.lit("u"), F.col("id").cast("string")), share))
    ids = trusted.filter(_below(F.concat(F.lit("u"), F.col("_id").cast("string")), share)).select("_id")
    unlabelled = drawn.join(ids, F.col("id") == F.col("_id"), "left_anti")
    found = [
        _features(side.select(F.lit(label).alias("label"), "text")).limit(2 * sample)  # met by rows that repeat an id only
        for label, side in ((1, positive), (0, unlabelled))
    ]
    table = found[0].unionByName(found[1]).toArrow()
    label = table.column("label").to_numpy()
    x = np.array(table.column("x").combine_chunks().flatten()).reshape(-1, WIDTH)
    order = np.lexsort((*x.T[::-1], label))  # not in order of arrival
    label, x = label[order], x[order]
    return fit_arrays(x[label == 1], x[label == 0])


def scored(rows: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``rows`` with the score of the string column ``text``, which is dropped; other names must be plain."""
    kept = [f for f in rows.schema if f.name != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            x = [features(t.as_py()) for t in texts]
            score = model.score(np.stack(x)) if x else np.zeros(0)
            others = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays([*others, pa.array(score)], [*(f.name for f in kept), out])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return rows.mapInArrow(run, f"{kinds}, {out} double")


def quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    **fit_options,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``.

    Scores depend on the text alone; null and empty texts score like each other. Rows that
    repeat an id are scored each. Without a trusted or without an unlabelled document
    every score is 0.5. An empty table gives no rows.
    """
    model = fit(docs, labels, id_col, text_col, **fit_options)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).cast("string").alias("text")
    )
    found = scored(rows, model)
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **fit_options
) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` at least, with all their columns."""
    model = fit(docs, labels, id_col, text_col, **fit_options)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t.as_py()) for t in batch.column(at)]
            if x:
                yield batch.filter(pa.array(model.score(np.stack(x)) >= threshold))

    return docs.mapInArrow(run, docs.schema)
