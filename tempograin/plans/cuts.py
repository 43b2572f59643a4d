"""Shots from pixels: how much a frame's content differs from the frame before,
and cuts where it differs enough.

The difference is the mean, over all pixels, of the absolute differences in hue
(0 to 179), saturation and value (0 to 255), averaged over the three. Frames
are dealt to sorted ranges of (creative, frame) and streamed; the last
frame of a range is carried to the first of the next, so a long creative is
measured by many tasks.

Defined cases: the first frame of a creative has no change (null); neither has one
whose size is another than that of the frame before, or either of whose pixels are
null; a cut nearer to the cut before (or to the first frame) than the shortest
shot is passed over; a creative without cuts is one shot.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, StructField, StructType

from ..functions.columns import rnd
from ..registry import query
from ..sources.lineage import cut
from .base import table

# The change that makes a cut, and the frames of the shortest shot.
CUT_FROM, SHORTEST = 27.0, 15


def hue_saturation_value(rgb: np.ndarray) -> np.ndarray:
    """Pixels (..., 3) of bytes -> hue in half degrees, saturation, value, as whole numbers."""
    r, g, b = (rgb[..., i].astype(float) for i in range(3))
    high, low = np.maximum(np.maximum(r, g), b), np.minimum(np.minimum(r, g), b)
    spread = np.where(high > low, high - low, 1.0)
    degrees = np.select([high == low, high == r, high == g], [0.0, 60 * (g - b) / spread, 120 + 60 * (b - r) / spread], 240 + 60 * (r - g) / spread)
    degrees = np.where(degrees < 0, degrees + 360, degrees)
    saturation = np.where(high > 0, 255 * (high - low) / np.maximum(high, 1), 0.0)
    return np.stack([np.floor(degrees / 2 + 0.5) % 180, np.floor(saturation + 0.5), high], axis=-1)


def _change(one: tuple | None, other: tuple | None) -> float | None:
    """Of two (width, height, pixels) or None; pixels are rows of RGB bytes."""
    if one is None or other is None or one[:2] != other[:2]:
        return None
    a, b = (hue_saturation_value(np.frombuffer(x[2], dtype=np.uint8).reshape(-1, 3)) for x in (one, other))
    return float(np.abs(a - b).mean(axis=0).sum() / 3) if len(a) else None


def content_changes(frames: DataFrame, key: str = "creative_id", ranges: int | None = None) -> DataFrame:
    """frames (key, frame_index, width, height, pixels: RGB bytes, and other
    columns) -> key, frame_index, the other columns and change."""
    n = ranges or int(frames.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = [f for f in frames.schema.fields if f.name not in ("width", "height", "pixels")]
    schema = StructType([*rest, StructField("change", DoubleType()), StructField("__part", IntegerType()), StructField("__first", BinaryType()), StructField("__last", BinaryType())])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before, of, held = TaskContext.get().partitionId(), None, None, None
        for b in batches:
            changes, firsts = [], []
            keys = b.column(key).to_pylist()
            for i, (k, *now) in enumerate(zip(keys, *(b.column(c).to_pylist() for c in ("width", "height", "pixels")), strict=True)):
                now = None if any(x is None for x in now) else tuple(now)
                changes.append(_change(before, now) if (held is not None or i) and k == of else None)
                firsts.append(_packed(now) if held is None and not i else None)
                before, of = now, k
            out = pa.RecordBatch.from_arrays([*(b.column(f.name) for f in rest), pa.array(changes, pa.float64()), pa.array([part] * len(keys), pa.int32()), pa.array(firsts, pa.binary()), pa.nulls(len(keys), pa.binary())], names=schema.names)
            if b.num_rows:
                if held is not None:
                    yield held
                held = out
        if held is not None:  # only now is the last row of the range known
            last = pa.array([*[None] * (held.num_rows - 1), _packed(before)], pa.binary())
            yield pa.RecordBatch.from_arrays([*held.columns[:-1], last], names=schema.names)

    dealt = frames.repartitionByRange(n, key, "frame_index").sortWithinPartitions(key, "frame_index")
    measured = cut(dealt.select(*(f.name for f in rest), "width", "height", "pixels").mapInArrow(measure, schema))
    # One row a range: its first and last frames.
    edges = measured.filter("__first is not null or __last is not null").groupBy("__part").agg(F.min_by(key, F.struct(key, "frame_index")).alias("k0"), F.max_by(key, F.struct(key, "frame_index")).alias("k1"), F.max("__first").alias("first"), F.max("__last").alias("last"))
    w = Window.orderBy("__part")
    meet = edges.withColumns({"k": F.lag("k1").over(w), "before": F.lag("last").over(w)}).filter(F.col("k").eqNullSafe(F.col("k0")) & F.col("before").isNotNull())

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [_change(_unpacked(x), _unpacked(y)) for x, y in zip(b.column("before").to_pylist(), b.column("first").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("__part"), pa.array(found, pa.float64())], names=["__at", "__carried"])

    carried = meet.select("__part", "before", "first").mapInArrow(carry, "__at int, __carried double")
    out = measured.join(F.broadcast(carried), (F.col("__part") == F.col("__at")) & F.col("__first").isNotNull(), "left")
    return out.select(*(f.name for f in rest), F.coalesce("change", "__carried").alias("change"))


def _packed(frame: tuple | None) -> bytes:
    return b"" if frame is None else frame[0].to_bytes(4, "big") + frame[1].to_bytes(4, "big") + frame[2]


def _unpacked(raw: bytes) -> tuple | None:
    return (int.from_bytes(raw[:4], "big"), int.from_bytes(raw[4:8], "big"), raw[8:]) if raw else None


def cut_frames(changes: DataFrame, key: str = "creative_id", threshold: float = CUT_FROM, shortest: int = SHORTEST) -> DataFrame:
    """changes (key, frame_index, change) -> key, frame_index of each cut. A task
    walks the frames above the threshold in order and holds one of them."""
    firsts = changes.groupBy(key).agg(F.min("frame_index").alias("start"))
    likely = changes.filter(F.col("change") >= threshold).select(key, "frame_index").join(firsts, key)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, last = object(), 0
        for b in batches:
            keep = []
            for k, i, start in zip(b.column(key).to_pylist(), b.column("frame_index").to_pylist(), b.column("start").to_pylist(), strict=True):
                if k != of:
                    of, last = k, start
                keep.append(i - last >= shortest)
                last = i if keep[-1] else last
            yield b.select([key, "frame_index"]).filter(pa.array(keep, pa.bool_()))

    return likely.repartition(key).sortWithinPartitions(key, "frame_index").mapInArrow(walk, likely.select(key, "frame_index").schema)


def shots_from_changes(changes: DataFrame, key: str = "creative_id", threshold: float = CUT_FROM, shortest: int = SHORTEST) -> DataFrame:
    """changes (key, frame_index, t_start_s, t_end_s, change) -> shots: key,
    shot_index, start_s, end_s, duration_s, start_frame, end_frame."""
    cuts = cut_frames(changes, key, threshold, shortest).withColumn("__cut", F.lit(1))
    marked = changes.join(cuts, [key, "frame_index"], "left")
    numbered = marked.withColumn("shot_index", F.coalesce(F.sum("__cut").over(Window.partitionBy(key).orderBy("frame_index")), F.lit(0)))
    shots = numbered.groupBy(key, "shot_index").agg(F.min("t_start_s").alias("start_s"), F.max("t_end_s").alias("end_s"), F.min("frame_index").alias("start_frame"), F.max("frame_index").alias("end_frame"))
    return shots.select(key, "shot_index", "start_s", "end_s", rnd(F.col("end_s") - F.col("start_s"), 3).alias("duration_s"), "start_frame", "end_frame")


#: A user's events as frames of four pixels, a quarter of a second each.
_PIXELS = """e AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS frame_index, CAST(floor(coalesce(value, 0)) AS BIGINT) AS v FROM events),
x AS (SELECT user_id, frame_index, p, (event_id * 37 + p * 91) % 256 AS r, (event_id * 59 + p * 17) % 256 AS g, (v * 3 + p) % 256 AS b FROM e, (SELECT unnest(range(4)) AS p)),
s AS (SELECT *, greatest(r, g, b)::DOUBLE AS high, (greatest(r, g, b) - least(r, g, b))::DOUBLE AS spread FROM x),
d AS (SELECT *, CASE WHEN spread = 0 THEN 0 WHEN high = r THEN 60 * (g - b)::DOUBLE / spread WHEN high = g THEN 120 + 60 * (b - r)::DOUBLE / spread ELSE 240 + 60 * (r - g)::DOUBLE / spread END AS deg FROM s),
hsv AS (SELECT user_id, frame_index, p, floor(CASE WHEN deg < 0 THEN deg + 360 ELSE deg END / 2 + 0.5) % 180 AS h, CASE WHEN high > 0 THEN floor(255 * spread / high + 0.5) ELSE 0 END AS s, high AS v FROM d),
c AS (SELECT a.user_id, a.frame_index, round((avg(abs(a.h - b.h)) + avg(abs(a.s - b.s)) + avg(abs(a.v - b.v))) / 3, 5) AS change FROM hsv a JOIN hsv b ON a.user_id = b.user_id AND a.p = b.p AND a.frame_index = b.frame_index + 1 GROUP BY 1, 2),
changes AS (SELECT e.user_id, e.frame_index, change FROM e LEFT JOIN c USING (user_id, frame_index))"""


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_id", F.coalesce(F.floor("value"), F.lit(0)).cast("long").alias("v"), F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")).cast("long").alias("frame_index"))
    byte = lambda x: F.lpad(F.hex(x), 2, "0")
    pixels = [byte(F.expr(f"(event_id * 37 + {p} * 91) % 256")) for p in range(4)], [byte(F.expr(f"(event_id * 59 + {p} * 17) % 256")) for p in range(4)], [byte(F.expr(f"(v * 3 + {p}) % 256")) for p in range(4)]
    raw = F.unhex(F.concat(*(c for rgb in zip(*pixels, strict=True) for c in rgb)))
    frames = events.select("user_id", "frame_index", ((F.col("frame_index") - 1) / 4).alias("t_start_s"), (F.col("frame_index") / 4).alias("t_end_s"), F.lit(2).alias("width"), F.lit(2).alias("height"), raw.alias("pixels"))
    return content_changes(frames, "user_id").withColumn("change", rnd("change", 5))


@query(f"WITH {_PIXELS} SELECT user_id, frame_index, change FROM changes")
def content_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change of each event's picture against that of the user's event before."""
    return _changes(spark, sf_dir).select("user_id", "frame_index", "change")


@query(f"""WITH RECURSIVE {_PIXELS}, w AS (SELECT user_id, frame_index, 0 AS is_cut, frame_index AS last FROM changes WHERE frame_index = 1
UNION ALL SELECT n.user_id, n.frame_index, CASE WHEN n.change >= 60 AND n.frame_index - w.last >= 4 THEN 1 ELSE 0 END, CASE WHEN n.change >= 60 AND n.frame_index - w.last >= 4 THEN n.frame_index ELSE w.last END
 FROM w JOIN changes n ON n.user_id = w.user_id AND n.frame_index = w.frame_index + 1),
m AS (SELECT *, sum(is_cut) OVER (PARTITION BY user_id ORDER BY frame_index)::BIGINT AS shot_index FROM w)
SELECT user_id, shot_index, (min(frame_index) - 1) / 4 AS start_s, max(frame_index) / 4 AS end_s, round(max(frame_index) / 4 - (min(frame_index) - 1) / 4, 3) AS duration_s, min(frame_index) AS start_frame, max(frame_index) AS end_frame FROM m GROUP BY 1, 2""")
def content_shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shots of at least four frames, cut where the change is 60 or more."""
    return shots_from_changes(_changes(spark, sf_dir), "user_id", 60.0, 4)
