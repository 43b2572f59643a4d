"""Quality rules: a calibrated n-gram classifier beside counted rules.

A logistic regression over hashed word n-grams (1, 2) and character n-grams (1
to 3 bytes), as shares of the text, is trained on labelled quality rows. Rows kept from
the fit calibrate its probability (Platt), and texts are scored in Arrow batches
against fixed thresholds, together with counted rules.

The model is fitted on at most ``TRAIN_ROWS`` labelled rows, those with the
smallest hash of their id. Counts and scores are of whole texts.

Defined cases: a null or empty text has no words, so all counts are 0 and the
base rule fails it; labels other than 0, 1 aren't learned from; with labels of
one kind the classifier is constant; repeated rows are judged each, alike
whatever batch they come in; very long texts are judged whole; a probability equal
to the threshold keeps; further columns pass through, but those named as a result
are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .common import SPACES, joined, slices, to_batch, window_hashes, word_hashes, word_spans
from .ngrams import char_grams, fit_logistic, fit_platt, lowered, sigmoid, word_grams

BITS, CHAR_ORDERS, WORD_ORDERS = 18, (1, 2, 3), (1, 2)
TRAIN_ROWS = 6_000
#: A text is kept if its probability of quality 1 is at least this.
KEEP_FROM = 0.25
#: The base rule: fewer words, or a larger share of repeated words, fail.
LEAST_WORDS, MOST_REPEATED_PERCENT, WINDOW = 20, 30, 8
_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
_MODEL = pa.schema([("weights", pa.binary()), ("bias", pa.float64()), ("a", pa.float64()), ("b", pa.float64())])
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _features(data: np.ndarray, starts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(buckets, first position) for each order; a bucket of 0 counts nothing."""
    low, ends, every = lowered(data), np.repeat(starts[1:], np.diff(starts)), np.arange(len(data))
    out = [(char_grams(data, k, BITS, ends), every) for k in CHAR_ORDERS]
    for k in WORD_ORDERS:
        out.append(word_grams(low, k, BITS, starts))
    return out


def _logits(data: np.ndarray, starts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    total = np.zeros(len(starts) - 1)
    for buckets, at in _features(data, starts):
        doc = np.searchsorted(starts, at, side="right") - 1
        n = np.maximum(np.bincount(doc, minlength=len(total)), 1)
        total += np.bincount(doc, weights[buckets], minlength=len(total)) / n
    return total


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All training rows -> the model's one row."""
    cols, rows, values, y, fold, n, texts = [], [], [], [], [], 0, []
    for b in slices(batches):
        data, starts = joined(b.column("text"))
        texts.append((data, starts))
        for buckets, at in _features(data, starts):
            doc = np.searchsorted(starts, at, side="right") - 1
            share = 1.0 / np.maximum(np.bincount(doc, minlength=b.num_rows), 1)
            key, times = np.unique(doc.astype(np.int64) << BITS | buckets, return_counts=True)
            cols.append((key & ((1 << BITS) - 1)).astype(np.int32))
            rows.append((key >> BITS).astype(np.int32) + n)
            values.append((times * share[key >> BITS]).astype(np.float32))
        n += b.num_rows
        y += b.column("label").to_pylist()
        fold += b.column("fold").to_pylist()
    y, fit = np.array(y, dtype=float), np.array(fold, dtype=int) != 0
    weights, bias = np.zeros(1 << BITS, dtype=np.float32), 0.0
    if 0 < y[fit].sum() < fit.sum():
        col, row, value = np.concatenate(cols), np.concatenate(rows), np.concatenate(values).astype(float)
        use = fit[row] & (np.bincount(col, minlength=1 << BITS)[col] >= 3) & (col > 0)
        # Features of like spread: shares of common n-grams don't drown the rest.
        spread = np.sqrt(np.bincount(col[use], value[use] ** 2, minlength=1 << BITS) / fit.sum() + 1e-6)
        names, col = np.unique(col[use], return_inverse=True)
        number = np.cumsum(fit) - 1
        w, bias = fit_logistic(number[row[use]], col, value[use] / spread[names][col], y[fit], len(names), l2=1e-3, steps=80)
        weights[names] = w / spread[names]
    logits = np.concatenate([_logits(d, s, weights) for d, s in texts]) + bias if texts else np.zeros(0)
    held = ~fit if 0 < y[~fit].sum() < (~fit).sum() else np.ones(len(y), dtype=bool)
    a, b = fit_platt(logits[held], y[held])
    yield to_batch({"weights": [weights.tobytes()], "bias": [float(bias)], "a": [max(a, 0.0)], "b": [b]}, _MODEL)


def train(labelled: DataFrame) -> tuple[np.ndarray, float, float, float]:
    """labelled (doc_id, text, label) -> weights, bias and calibration, fitted by one task."""
    few = labelled.filter("label in (0, 1)").select("text", F.col("label").cast("double").alias("label"), (F.abs(F.xxhash64("doc_id", F.lit("fold"))) % 4).cast("int").alias("fold"))
    r = few.repartition(1).mapInArrow(_fit, "weights binary, bias double, a double, b double").collect()
    return (np.frombuffer(r[0]["weights"], dtype=np.float32), r[0]["bias"], r[0]["a"], r[0]["b"]) if r else (np.zeros(1 << BITS, dtype=np.float32), 0.0, 0.0, 0.0)


def _counted(data: np.ndarray, starts: np.ndarray) -> dict[str, np.ndarray]:
    n = len(starts) - 1
    doc = lambda at: np.searchsorted(starts, at, side="right") - 1
    inside = ~SPACES[data]
    s, e = word_spans(inside)
    of = doc(s)
    points = np.add.reduceat((inside & ((data & 0xC0) != 0x80)).astype(np.int64), starts[:-1])
    symbols = np.add.reduceat(_SYMBOLS[data].astype(np.int64), starts[:-1])
    # Lines, by hash; a line without a word isn't counted.
    ends = np.flatnonzero(data == 10)
    begins = np.concatenate([[0], ends[:-1] + 1])
    with_word = np.add.reduceat(np.append(inside, False).astype(np.int64), begins) * (ends > begins) > 0
    begins, ends = begins[with_word], ends[with_word]
    lines, line_doc = word_hashes(data, begins, ends), doc(begins)
    order = np.lexsort((lines, line_doc))
    again = (np.diff(lines[order]) == 0) & (np.diff(line_doc[order]) == 0)
    dup = np.bincount(line_doc[order][1:][again], minlength=n) if len(order) > 1 else np.zeros(n, dtype=np.int64)
    # Words in a window of which the text has more than one.
    words = word_hashes(data, s, e)
    windows = window_hashes(words, WINDOW)
    repeated = np.zeros(n, dtype=np.int64)
    if len(windows):
        own = of[: len(windows)] == of[WINDOW - 1 :]
        at = np.flatnonzero(own)
        order = np.lexsort((windows[at], of[at]))
        w, d = windows[at][order], of[at][order]
        same = (w[1:] == w[:-1]) & (d[1:] == d[:-1])
        twice = np.zeros(len(at), dtype=bool)
        twice[1:] |= same
        twice[:-1] |= same
        cover = np.zeros(len(words) + 1, dtype=np.int64)
        first = at[order][twice]
        np.add.at(cover, first, 1)
        np.add.at(cover, first + WINDOW, -1)
        repeated = np.bincount(of[np.cumsum(cover)[:-1] > 0], minlength=n)
    return {"n_words": np.bincount(of, minlength=n), "word_chars": points, "n_symbols": symbols, "n_dup_lines": dup, "n_repeat_words": repeated}


def judged(docs: DataFrame, model: tuple, keep_from: float = KEEP_FROM) -> DataFrame:
    """docs, with all its columns, the counts, the probability of quality 1
    (quality_score), base_failed and kept; such columns of its own are replaced."""
    docs = docs.drop(*COUNTS, "quality_score", "base_failed", "kept")
    held = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias, a, b = held.value
        for batch in slices(batches):
            data, starts = joined(batch.column("text"))
            counts = _counted(data, starts)
            p = sigmoid(a * (_logits(data, starts, weights) + bias) + b)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(counts[c], pa.int64()) for c in COUNTS), pa.array(p)], names=[*batch.schema.names, *COUNTS, "quality_score"])

    schema = StructType([*docs.schema.fields, *(StructField(c, LongType()) for c in COUNTS), StructField("quality_score", DoubleType())])
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT)
    return docs.mapInArrow(judge, schema).withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("quality_score") >= keep_from))
