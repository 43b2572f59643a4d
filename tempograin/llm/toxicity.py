"""Toxicity: a linear classifier over character n-grams whose features are
scaled by naive Bayes log-count ratios, trained on labelled text.

A text is scored by the stretch of it that is most toxic: the highest sum of
feature scores over any ``STRETCH`` bytes, so that a long text doesn't drown a short
insult. Features are hashed n-grams (4 to 7 bytes, A-Z lower-cased), multiplied by
the log ratio of the counts of toxic and other training texts that have them; a
logistic regression learns weights for the scaled features of the very stretches
that are scored, chosen anew in each round. Two models
are fitted, each on half of the training rows; their mean is the model, and the
scores that each half gets from the other's model calibrate it (Platt).

The model is fitted on at most ``rows`` labelled rows, those with the smallest
hash of their id, so one task holds them whole. Scoring runs over all texts.

Defined cases: a null or empty text has no features and scores as the weakest
stretch does; very long texts are scored whole; of equally toxic stretches any
gives the score, the first is learned from; a label other than 0 or 1 or null
isn't learned from; with labels of one kind only, every score is the smoothed
share of label 1; an id labelled twice is learned from twice; repeated rows are
scored each; further columns pass through, but one named as the score is
replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import joined, slices, to_batch
from .ngrams import char_grams, fit_logistic, fit_platt, lowered, sigmoid

ORDERS, BITS, STRETCH = (4, 5, 6, 7), 20, 24
#: Labelled rows that the model is fitted on, at most.
TRAIN_ROWS = 6_000
#: A feature counts if so many training texts have it.
MIN_TEXTS = 4
#: ... and if its log ratio is so many standard errors from 0.
CLEAR = 2.5
#: Rounds of choosing stretches and fitting; what the features are divided by; the penalty beside the summed loss.
ROUNDS, SCALE, L2 = 2, 8.0, 0.5
_MODEL = pa.schema([("weights", pa.binary()), ("a", pa.float64()), ("b", pa.float64())])


def _stretches(data: np.ndarray, starts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The sum of the weights of the n-grams that start in the STRETCH bytes from
    each position of the texts; the end of the text each is in; the n-grams."""
    data = lowered(data)
    total, gain = np.zeros(len(data) + 1), np.zeros(len(data))
    ends = np.repeat(starts[1:], np.diff(starts))
    grams = [char_grams(data, k, BITS, ends) for k in ORDERS]
    for g in grams:
        gain += weights[g]
    np.cumsum(gain, out=total[1:])
    at = np.arange(len(data))
    return total[np.minimum(at + STRETCH, ends)] - total[at], ends, grams


def _strongest(data: np.ndarray, starts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The score of each text's most toxic stretch."""
    if len(starts) < 2:
        return np.zeros(0)
    return np.maximum(np.maximum.reduceat(_stretches(data, starts, weights)[0], starts[:-1]), 0.0)


def _in_strongest(data: np.ndarray, starts: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    """The n-grams, repeats too, of each text's most toxic stretch."""
    score, ends, grams = _stretches(data, starts, weights)
    out = []
    for i, j in zip(starts, starts[1:], strict=False):
        at = i + int(np.argmax(score[i:j]))
        out.append(np.concatenate([g[at : min(at + STRETCH, ends[at])] for g in grams]))
    return out


class Half(NamedTuple):
    """Training texts: batches of bytes and starts, the distinct n-grams of each text, labels."""

    texts: list[tuple[np.ndarray, np.ndarray]]
    rows: list[np.ndarray]
    labels: list[float]


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All training rows -> the model's one row."""
    halves = (Half([], [], []), Half([], [], []))
    for b in slices(batches):
        fold = b.column("fold").to_numpy() % 2
        for k, half in enumerate(halves):
            part = b.filter(pa.array(fold == k))
            data, starts = joined(part.column("text"))
            low, ends = lowered(data), np.repeat(starts[1:], np.diff(starts))
            grams = [char_grams(low, n, BITS, ends) for n in ORDERS]
            half.rows.extend(np.unique(np.concatenate([g[i:j] for g in grams])).astype(np.int32) for i, j in zip(starts, starts[1:], strict=False))
            half.texts.append((data, starts))
            half.labels.extend(part.column("label").to_pylist())
    weights, found, y = np.zeros(1 << BITS, dtype=np.float32), [], []
    for own, other in (halves, halves[::-1]):
        w = _fit_weights(own.rows, own.texts, np.array(own.labels))
        weights += w / 2
        found += [_strongest(d, s, w) for d, s in other.texts]
        y += other.labels
    a, b = fit_platt(np.concatenate(found) if found else np.zeros(0), np.array(y, dtype=float))
    # Multiples of 2**-16 add up exactly, so a score doesn't hang on what a batch holds.
    weights = (np.round(weights.astype(float) * 65536) / 65536).astype(np.float32)
    yield to_batch({"weights": [weights.tobytes()], "a": [max(a, 0.0)], "b": [b]}, _MODEL)


def _ratios(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """The naive Bayes log-count ratio of each bucket; 0 where chance explains it."""
    has, with_pos = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for r, label in zip(rows, y, strict=True):
        has[r] += 1
        with_pos[r] += label
    pos, neg = with_pos + 1.0, has - with_pos + 1.0
    ratio = np.log(pos / (y.sum() + 2)) - np.log(neg / (len(y) - y.sum() + 2))
    ratio[(has < MIN_TEXTS) | (np.abs(ratio) < CLEAR * np.sqrt(1 / pos + 1 / neg))] = 0
    ratio[0] = 0
    return ratio


def _fit_weights(rows: list[np.ndarray], texts: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> np.ndarray:
    """A weight for each bucket. What is fitted is what is scored: the scaled
    n-grams of the most toxic stretch, by the ratios alone at first, then by the
    weights of the round before."""
    if not 0 < y.sum() < len(y):
        return np.zeros(1 << BITS, dtype=np.float32)
    ratio = _ratios(rows, y)
    weights = ratio.astype(np.float32)
    for _ in range(ROUNDS):
        found = [g[ratio[g] != 0] for d, s in texts for g in _in_strongest(d, s, weights)]
        cols, of = np.concatenate(found), np.repeat(np.arange(len(found)), [len(g) for g in found])
        if not len(cols):
            break
        names, cols = np.unique(cols, return_inverse=True)
        w, _ = fit_logistic(of, cols, ratio[names][cols] / SCALE, y, len(names), l2=L2 / len(y))
        weights = np.zeros(1 << BITS, dtype=np.float32)
        weights[names] = np.maximum(w, 0) * ratio[names] / SCALE
    return weights


def train(labelled: DataFrame) -> tuple[np.ndarray, float, float]:
    """labelled (doc_id, text, label) -> (weights, a, b), fitted by one task."""
    few = labelled.filter("label in (0, 1)").select("text", F.col("label").cast("double").alias("label"), (F.abs(F.xxhash64("doc_id", F.lit("fold"))) % 4).cast("int").alias("fold"))
    got = few.repartition(1).mapInArrow(_fit, "weights binary, a double, b double").collect()
    r = got[0] if got else None
    return (np.frombuffer(r["weights"], dtype=np.float32), r["a"], r["b"]) if r else (np.zeros(1 << BITS, dtype=np.float32), 0.0, 0.0)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, where: Column, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, text, label of at most ``rows`` labelled documents, repeated ones
    counted: the ids with the smallest hashes among those that ``where`` (on
    doc_id) admits."""
    ids = labels.select(F.col("doc_id").alias("id"), F.col(label).alias("label")).filter(F.col("label").isin(0, 1) & F.col("id").isNotNull())
    ids = ids.withColumn("doc_id", F.col("id")).filter(where).drop("doc_id").orderBy(F.xxhash64("id"), "id", "label").limit(rows)
    # At most ``rows`` ids and labels: a few hundred kilobytes.
    found = docs.select("doc_id", "text").join(F.broadcast(ids), F.col("doc_id") == F.col("id"))
    return found.orderBy(F.xxhash64("id"), "id", F.xxhash64("text"), "label").limit(rows).select("doc_id", "text", "label")


def scored(docs: DataFrame, model: tuple, name: str = "score") -> DataFrame:
    """docs, with all its columns, and the score (0 to 1) of every document; a
    column of that name is replaced."""
    docs = docs.drop(name)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, a, b = held.value
        for batch in slices(batches):
            data, starts = joined(batch.column("text"))
            p = sigmoid(a * _strongest(data, starts, weights) + b)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], names=[*batch.schema.names, name])

    return docs.mapInArrow(score, StructType([*docs.schema.fields, StructField(name, DoubleType())]))
