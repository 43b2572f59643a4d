"""Operators on vectors and boxes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column | str, b: Column | str) -> Column:
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def against(rows: DataFrame, few: DataFrame, key: str, most: int = 4096) -> DataFrame:
    """Every row with every row of a reference set, such as one centroid for
    each label: the set is broadcast in blocks of about ``most`` rows."""
    blocks = max(1, -(-few.count() // most))
    out = None
    for i in range(blocks):
        part = rows.join(F.broadcast(few.filter(F.pmod(F.xxhash64(key), F.lit(blocks)) == i)))
        out = part if out is None else out.unionByName(part)
    return out


def centroids(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """The mean vector of each key: sums of places, then one array."""
    places = rows.select(key, F.posexplode(vector).alias("at", "v")).groupBy(key, "at").agg(F.avg(F.col("v").cast("double")).alias("v"))
    return places.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("at", "v"))).alias("p")).select(key, F.transform("p", lambda x: x["v"]).alias("centroid"))


def softmax_ranks(rows: DataFrame, keys: list[str], axis: str, label: str, logit: str) -> DataFrame:
    """Adds probability (softmax inside the axis), rank from 0 by falling
    probability (ties by label) and is_top."""
    w = Window.partitionBy(*keys, axis)
    e = F.exp(F.col(logit) - F.max(logit).over(w))
    rank = F.row_number().over(w.orderBy(F.desc(logit), F.col(label))) - 1
    return rows.withColumn("score", e / F.sum(e).over(w)).withColumn("rank", rank.cast("long")).withColumn("is_top", F.col("rank") == 0)


def largest(rows: DataFrame, keys: list[str], size: str, tie: str, name: str = "is_largest") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(size), F.col(tie))) == 1)


def best_boxes(x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray, most_overlap: float = 0.5) -> np.ndarray:
    """Places of the boxes, given best first, that no better kept one overlaps by more."""
    area, kept, left = (x1 - x0) * (y1 - y0), [], np.arange(len(x0))
    while len(left):
        i, left = left[0], left[1:]
        kept.append(i)
        w = np.minimum(x1[left], x1[i]) - np.maximum(x0[left], x0[i])
        h = np.minimum(y1[left], y1[i]) - np.maximum(y0[left], y0[i])
        both = np.maximum(w, 0) * np.maximum(h, 0)
        left = left[both <= most_overlap * (area[left] + area[i] - both)]
    return np.array(kept, dtype=np.int64)


def suppressed_boxes(rows: DataFrame, keys: list[str], most_overlap: float = 0.5) -> DataFrame:
    """Non-maximum suppression: boxes (x0, y0, x1, y1, score) of a key that no
    better kept box overlaps by more. A key is the boxes of one frame and class."""

    def best_of(boxes: pd.DataFrame) -> np.ndarray:
        return best_boxes(*(boxes[c].to_numpy() for c in ("x0", "y0", "x1", "y1")), most_overlap)

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # the last key of a batch may go on in the next
        for batch in chain(batches, [None]):
            rows = held if batch is None else batch if held is None else pd.concat([held, batch], ignore_index=True)
            if rows is None or not len(rows):
                continue
            number = rows.groupby(keys, sort=False, dropna=False).ngroup().to_numpy()
            first = np.flatnonzero(np.diff(number, prepend=-1))
            whole = len(rows) if batch is None else first[-1]
            held = None if batch is None else rows.iloc[whole:]
            ends = np.append(first[1:], len(rows))
            picked = [s + best_of(rows.iloc[s:e]) for s, e in zip(first, ends, strict=True) if e <= whole]
            if picked:
                yield rows.iloc[np.concatenate(picked)]

    sorted_ = rows.repartition(*keys).sortWithinPartitions(*keys, F.desc("score"), "x0", "y0", "x1", "y1")
    return sorted_.mapInPandas(keep, rows.schema)
