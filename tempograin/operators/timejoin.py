"""Joins along time: as-of, point in interval, interval overlap.

Points and intervals carry a key (list of columns) and doubles for time.
Intervals are half open. With few keys an equi join alone has no parallelism, so
the interval joins deal both sides by key and time bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..sources.lineage import cut


def asof_backward(points: DataFrame, starts: DataFrame, keys: list[str], time: str, start: str, columns: list[str], ranges: int | None = None) -> DataFrame:
    """Each point with ``columns`` of the latest row of ``starts`` at or before
    it; nulls where there is none. Of starts at one time the largest columns count;
    null starts, times and keys match nothing.

    Both sides are put together, dealt to sorted ranges of (keys, time) and streamed:
    the last start is carried forward, and from the end of a range to the first key of
    the next. So one key alone keeps all tasks busy, and none holds more than a batch."""
    n = ranges or int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    right = starts.filter(F.col(start).isNotNull()).select(*keys, F.col(start).alias("__t"), F.lit(0).alias("__side"), F.struct(*columns).alias("__right"))
    for k in keys:
        right = right.filter(F.col(k).isNotNull())
    kind = right.schema["__right"].dataType
    left = points.select(*keys, F.col(time).alias("__t"), F.lit(1).alias("__side"), F.struct("*").alias("__left"))
    both = left.unionByName(right, allowMissingColumns=True)
    # Equal starts stay together; points may be dealt anyhow behind them.
    tie = F.when(F.col("__side") == 1, F.rand(7)).otherwise(0.0)
    dealt = both.select(F.xxhash64(*keys).alias("__key"), *keys, "__t", "__side", "__left", "__right").repartitionByRange(n, *keys, "__t", "__side", tie)
    rows = dealt.sortWithinPartitions(*keys, "__t", "__side", "__right").select("__key", "__side", "__left", "__right")
    schema = StructType([StructField("__left", left.schema["__left"].dataType), StructField("__found", kind), StructField("__key", LongType()), StructField("__part", IntegerType()), StructField("__edge", IntegerType())])

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, now, first, held = TaskContext.get().partitionId(), None, True, None
        for b in batches:
            if not b.num_rows:
                continue
            key, mark, at = b.column("__key").to_numpy(), b.column("__side").to_numpy() == 0, np.arange(b.num_rows)
            new = np.append(now is None or key[0] != now, key[1:] != key[:-1])
            begins = np.maximum.accumulate(np.where(new, at, -1))  # -1: the key of the batch before goes on
            last = np.maximum.accumulate(np.where(mark, at, -1))
            held = pa.nulls(1, b.column("__right").type) if held is None else held
            # Place 0 is what is carried in, and the rows come after it.
            place = np.where((last >= begins) & (last >= 0), last + 1, np.where(begins < 0, 0, -1))
            found = pa.concat_arrays([held, b.column("__right")]).take(pa.array(place, mask=place < 0))
            edge = first & (np.cumsum(new) == (now is None))  # of the range's first key
            first = bool(edge[-1])
            yield _batch(schema, [b.column("__left"), found, b.column("__key"), pa.array([part] * len(at), pa.int32()), pa.array(edge.astype(np.int32))]).filter(pa.array(~mark))
            now, held = int(key[-1]), found[-1:] if not mark[-1] else b.column("__right")[-1:]
        if now is not None:  # the end of the range: its last key and start
            yield _batch(schema, [pa.nulls(1, pa.null()), held, pa.array([now]), pa.array([part], pa.int32()), pa.array([-1], pa.int32())])

    found = cut(rows.mapInArrow(carry, schema))
    # A row for each range: what its last key carries into the next range that has rows.
    ends = found.filter("__edge = -1").select("__key", "__part", F.struct("__found").alias("f"))
    carried = F.last(F.when(F.col("f.__found").isNotNull(), F.col("f")), ignorenulls=True).over(Window.partitionBy("__key").orderBy("__part"))
    into = ends.select(F.col("__key").alias("__of"), F.lead("__part").over(Window.orderBy("__part")).alias("__in"), carried["__found"].alias("__carried"))
    on = (F.col("__edge") == 1) & F.col("__found").isNull() & (F.col("__key") == F.col("__of")) & (F.col("__part") == F.col("__in"))
    out = found.filter("__edge >= 0").join(F.broadcast(into), on, "left")
    return out.select("__left.*", *(F.coalesce(F.col("__found"), F.col("__carried"))[c].alias(c) for c in columns))


def _batch(schema: StructType, columns: list[pa.Array]) -> pa.RecordBatch:
    types = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.nulls(len(c), f.type) if pa.types.is_null(c.type) else c for c, f in zip(columns, types, strict=True)], names=schema.names)


def asof_small(points: DataFrame, starts: DataFrame, keys: list[str], time: str, start: str, columns: list[str], most: int = 100_000) -> DataFrame:
    """The same, by the same rules, with at most so many starts, which are
    broadcast: starts become intervals to the next one, joined by range. More starts
    take the other way."""
    if starts.limit(most + 1).count() > most:
        return asof_backward(points, starts, keys, time, start, columns)
    once = starts.filter(F.col(start).isNotNull()).groupBy(*keys, F.col(start).alias("__from")).agg(F.max(F.struct(*columns)).alias("__c"))
    until = F.lead("__from").over(Window.partitionBy(*keys).orderBy("__from"))
    spans = once.select(*(F.col(k).alias(f"__{k}") for k in keys), "__from", until.alias("__to"), "__c")
    on = [F.col(k) == F.col(f"__{k}") for k in keys] + [F.col(time) >= F.col("__from"), F.col("__to").isNull() | (F.col(time) < F.col("__to"))]
    return points.join(F.broadcast(spans), on, "left").select(*points.columns, *(F.col("__c")[c].alias(c) for c in columns))


#: A bucket is ``_WIDER`` times as wide as one of the level below; an interval is in that many buckets or few more.
_WIDER = 16.0


def _at(c: Column | str, width: float) -> Column:
    """The bucket at the row's level."""
    return F.floor((F.col(c) if isinstance(c, str) else c) / (F.lit(width) * F.pow(F.lit(_WIDER), "__level"))).cast("long")


def _levelled(intervals: DataFrame, start: str, end: str, width: float) -> tuple[DataFrame, list[int]]:
    """The intervals in a row for each bucket they meet, of a level by their
    length, so a long one is few rows too; and the levels there are, some small numbers."""
    level = F.greatest(F.lit(0), F.ceil(F.log(_WIDER, (F.col(end) - F.col(start)) / F.lit(width * _WIDER)))).cast("int")
    rows = intervals.filter(F.col(end) > F.col(start)).withColumn("__level", level)
    levels = sorted(r[0] for r in rows.select("__level").distinct().collect())
    return rows.withColumn("__bucket", F.explode(F.sequence(_at(start, width), _at(end, width)))), levels


def _on_levels(rows: DataFrame, levels: list[int]) -> DataFrame:
    """The rows once for each level."""
    if len(levels) < 2:
        return rows.withColumn("__level", F.lit(levels[0] if levels else 0))
    return rows.withColumn("__level", F.explode(F.array(*map(F.lit, levels))))


def points_in_intervals(points: DataFrame, intervals: DataFrame, keys: list[str], time: str, start: str, end: str, width: float) -> DataFrame:
    """Inner join: every point with every interval of its key that holds it. A
    point is in one bucket of a level, so no pair comes twice."""
    right, levels = _levelled(intervals, start, end, width)
    left = _on_levels(points, levels).withColumn("__bucket", _at(time, width))
    return left.join(right, [*keys, "__level", "__bucket"]).filter((F.col(time) >= F.col(start)) & (F.col(time) < F.col(end))).drop("__level", "__bucket")


def overlap_flag(frames: DataFrame, intervals: DataFrame, keys: list[str], frame: tuple[str, str], interval: tuple[str, str], width: float, name: str) -> DataFrame:
    """frames with a boolean: does any interval of the key overlap the frame?"""
    a, b = frame
    s, e = interval
    right, levels = _levelled(intervals.select(*keys, F.col(s).alias("__s"), F.col(e).alias("__e")), "__s", "__e", width)
    rows = frames.withColumn("__rid", F.struct(*keys, a, b))
    left = _on_levels(rows.select(*keys, a, b, "__rid").filter(F.col(b) > F.col(a)), levels)
    left = left.withColumn("__bucket", F.explode(F.sequence(_at(a, width), _at(b, width))))
    hit = left.join(right, [*keys, "__level", "__bucket"]).filter((F.col(a) < F.col("__e")) & (F.col(b) > F.col("__s")))
    return rows.join(hit.select("__rid", F.lit(True).alias("__hit")).distinct(), "__rid", "left").withColumn(name, F.col("__hit").isNotNull()).drop("__rid", "__hit")
