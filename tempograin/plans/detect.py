"""Objects from the raw output of an anchor-free detector.

The network's output for a frame is a row of numbers for each anchor: offsets of
the centre from the anchor's place in the grid, logarithms of width and height (both in steps
of the grid), objectness and a score for each class. There is a grid for each stride; anchors
come grid by grid, row by row. Boxes are decoded in Arrow batches, a frame's all at once, so
nothing is shuffled.

Defined cases: a frame without any box above the threshold has no row; of equal
class scores the first class counts; boxes of equal score are taken in the order of their anchors;
an output of another size than the grids imply is an error; a null output is a frame
that wasn't read and has no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import rnd
from ..operators.vectors import best_boxes
from ..registry import query
from .base import table

# Fixed values of the detector and of the rows made of it.
STRIDES, SCORE_ABOVE, MOST_OVERLAP = (8, 16, 32), 0.4, 0.5


def anchor_grid(height: int, width: int) -> np.ndarray:
    """(x, y, stride) of each anchor of an input of this size."""
    grids = []
    for stride in STRIDES:
        y, x = (a.ravel() for a in np.indices((height // stride, width // stride)))
        grids.append(np.stack([x, y, np.full(len(x), stride)], axis=1))
    return np.concatenate(grids).astype(float)


def decoded(output: np.ndarray, grid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Outputs (frames, anchors, 5 + classes) -> boxes (x0, y0, x1, y1 in pixels
    of the input), scores, classes."""
    centre, size = (output[..., :2] + grid[:, :2]) * grid[:, 2:], np.exp(output[..., 2:4]) * grid[:, 2:]
    best = output[..., 5:].argmax(axis=-1)
    score = output[..., 4] * np.take_along_axis(output[..., 5:], best[..., None], axis=-1)[..., 0]
    return np.concatenate([centre - size / 2, centre + size / 2], axis=-1), score, best


def object_detections(frames: DataFrame, height: int, width: int, classes: list[str], least: float = SCORE_ABOVE, most_overlap: float = MOST_OVERLAP) -> DataFrame:
    """frames (width and height of the picture, output: array of the network's
    numbers, and any columns that name the frame) of an input of ``height`` by
    ``width``, in which pictures are fitted at the upper left -> a row for each object: the frame's
    columns, detection_index (by falling score), class_id, class_name, score, box
    and area as shares of the picture."""
    keys = [f for f in frames.schema.fields if f.name not in ("width", "height", "output")]
    schema = StructType([*keys, *StructType.fromDDL("detection_index int, class_id int, class_name string, score double, x0 double, y0 double, x1 double, y1 double, area_frac double").fields])
    grid = anchor_grid(height, width)

    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(b.column("output").is_valid())
            numbers = b.column("output").flatten().to_numpy(zero_copy_only=False).astype(float)
            if b.num_rows and len(numbers) != b.num_rows * len(grid) * (5 + len(classes)):
                raise ValueError(f"{len(numbers) / b.num_rows:g} numbers a frame, {len(grid)} anchors of {5 + len(classes)} expected")
            boxes, scores, best = decoded(numbers.reshape(b.num_rows, len(grid), 5 + len(classes)), grid)
            of, index, at = [], [], []
            for i in range(b.num_rows):
                likely = np.flatnonzero(scores[i] > least)
                likely = likely[np.argsort(-scores[i][likely], kind="stable")]
                kept = likely[best_boxes(*boxes[i][likely].T, most_overlap)]
                of += [i] * len(kept)
                index += range(len(kept))
                at += kept.tolist()
            of, at = np.array(of, dtype=np.int64), np.array(at, dtype=np.int64)
            w, h = (b.column(c).to_numpy().astype(float)[of] for c in ("width", "height"))
            box = boxes[of, at] / np.minimum(height / h, width / w)[:, None]
            area = (box[:, 2] - box[:, 0]) * (box[:, 3] - box[:, 1]) / (w * h)
            shares = [np.clip(x, 0, 1) for x in (box[:, 0] / w, box[:, 1] / h, box[:, 2] / w, box[:, 3] / h, area)]
            cls = best[of, at]
            columns = [b.column(f.name).take(pa.array(of)) for f in keys]
            columns += [pa.array(index, pa.int32()), pa.array(cls, pa.int32()), pa.array([classes[c] for c in cls.tolist()], pa.string()), pa.array(scores[of, at]), *map(pa.array, shares)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    rows = frames.mapInArrow(detect, schema)
    return rows.withColumns({"score": rnd("score", 4), **{c: rnd(c, 5) for c in ("x0", "y0", "x1", "y1")}, "area_frac": rnd("area_frac", 6)})


#: Every event is an anchor's output; 21 of a user's, in the order of their ids, are a frame of 64 by 48 in an input of 32 by 32.
_RAW = "event_id % 7 / 4.0D, event_id % 5 / 4.0D, event_id * 3 % 16 / 8.0D, event_id * 5 % 16 / 8.0D, least(coalesce(value, 0), 100) / 100.0D, event_id % 11 / 10.0D, event_id % 13 / 12.0D, event_id % 17 / 16.0D"
_CLASSES = ["person", "bottle", "chair"]


@query("""WITH RECURSIVE e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS n FROM events),
a AS (SELECT user_id, n // 21 AS frame_index, n % 21 AS anchor, event_id AS i, least(coalesce(value, 0), 100) / 100.0::DOUBLE AS obj,
 [i % 11 / 10.0::DOUBLE, i % 13 / 12.0::DOUBLE, i % 17 / 16.0::DOUBLE] AS cls,
 CASE WHEN anchor < 16 THEN anchor % 4 WHEN anchor < 20 THEN (anchor - 16) % 2 ELSE 0 END AS gx, CASE WHEN anchor < 16 THEN anchor // 4 WHEN anchor < 20 THEN (anchor - 16) // 2 ELSE 0 END AS gy,
 CASE WHEN anchor < 16 THEN 8 WHEN anchor < 20 THEN 16 ELSE 32 END AS stride FROM e),
b AS (SELECT user_id, frame_index, anchor, obj * list_max(cls) AS score, list_position(cls, list_max(cls)) - 1 AS class_id,
 (i % 7 / 4.0::DOUBLE + gx) * stride AS cx, (i % 5 / 4.0::DOUBLE + gy) * stride AS cy, exp(i * 3 % 16 / 8.0::DOUBLE) * stride AS w, exp(i * 5 % 16 / 8.0::DOUBLE) * stride AS h FROM a),
r AS (SELECT user_id, frame_index, class_id, score, cx - w / 2 AS x0, cy - h / 2 AS y0, cx + w / 2 AS x1, cy + h / 2 AS y1,
 row_number() OVER (PARTITION BY user_id, frame_index ORDER BY score DESC, anchor) AS r FROM b WHERE score > 0.4),
k AS (SELECT user_id, frame_index, r, [{'c': class_id, 's': score, 'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1}] AS kept FROM r WHERE r = 1
UNION ALL SELECT k.user_id, k.frame_index, r.r, CASE WHEN len(list_filter(kept, lambda q: greatest(least(q.x1, r.x1) - greatest(q.x0, r.x0), 0) * greatest(least(q.y1, r.y1) - greatest(q.y0, r.y0), 0) > 0.5 * ((q.x1 - q.x0) * (q.y1 - q.y0) + (r.x1 - r.x0) * (r.y1 - r.y0) - greatest(least(q.x1, r.x1) - greatest(q.x0, r.x0), 0) * greatest(least(q.y1, r.y1) - greatest(q.y0, r.y0), 0)))) = 0
 THEN list_append(kept, {'c': r.class_id, 's': r.score, 'x0': r.x0, 'y0': r.y0, 'x1': r.x1, 'y1': r.y1}) ELSE kept END FROM k JOIN r ON r.user_id = k.user_id AND r.frame_index = k.frame_index AND r.r = k.r + 1),
f AS (SELECT user_id, frame_index, unnest(kept) AS q, generate_subscripts(kept, 1) - 1 AS detection_index FROM (SELECT user_id, frame_index, arg_max(kept, r) AS kept FROM k GROUP BY 1, 2)),
p AS (SELECT user_id, frame_index, detection_index, q, q.x0 * 2 / 64 AS x0, q.y0 * 2 / 48 AS y0, q.x1 * 2 / 64 AS x1, q.y1 * 2 / 48 AS y1, (q.x1 - q.x0) * (q.y1 - q.y0) * 4 / (64 * 48) AS area FROM f)
SELECT user_id, frame_index, detection_index::INTEGER AS detection_index, q.c::INTEGER AS class_id, ['person', 'bottle', 'chair'][q.c + 1] AS class_name, round(q.s, 4) AS score,
round(greatest(least(x0, 1), 0), 5) AS x0, round(greatest(least(y0, 1), 0), 5) AS y0, round(greatest(least(x1, 1), 0), 5) AS x1, round(greatest(least(y1, 1), 0), 5) AS y1, round(least(area, 1), 6) AS area_frac FROM p""")
def detector_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of frames whose raw outputs are made of the events."""
    number = F.expr("row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1")
    anchors = table(spark, sf_dir, "events").select("user_id", F.expr("event_id").alias("event_id"), "value", number.cast("long").alias("n"))
    rows = anchors.select("user_id", F.expr("n div 21").alias("frame_index"), F.struct(F.expr("n % 21").alias("anchor"), F.expr(f"array({_RAW})").alias("x")).alias("row"))
    frames = rows.groupBy("user_id", "frame_index").agg(F.array_sort(F.collect_list("row")).alias("rows"))  # 21 rows at most
    numbers = F.concat(F.flatten(F.transform("rows", lambda r: r["x"])), F.array_repeat(F.lit(0.0), 8 * (F.lit(21) - F.size("rows"))))
    return object_detections(frames.select("user_id", "frame_index", F.lit(64).alias("width"), F.lit(48).alias("height"), numbers.alias("output")), 32, 32, _CLASSES)
