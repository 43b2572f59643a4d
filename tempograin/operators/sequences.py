"""Operators over ordered rows of a key."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.lineage import cut


#: The place of a row's range in the order of all ranges.
PART = "__part"


def in_ranges(rows: DataFrame, keys: list[str], order: list[str], ranges: int | None = None) -> DataFrame:
    """The rows dealt to sorted ranges of keys and order, with ``PART``. A key may
    be longer than a task holds; rows alike in keys and order stay together. Ranges come
    from a sample, so the rows are written before they are used."""
    n = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut(rows.repartitionByRange(n, *keys, *order).withColumn(PART, F.spark_partition_id()))


def _with_carried(rows: DataFrame, ends: DataFrame, keys: list[str]) -> DataFrame:
    """rows with ``__carried`` (of ends: keys, PART, __carried). Only the first key of a
    range goes on from another, so there is a row for each range at most."""
    into = ends.select(*(F.col(c).alias(f"__of{i}") for i, c in enumerate([*keys, PART])), "__carried")
    on = [F.col(c).eqNullSafe(F.col(f"__of{i}")) for i, c in enumerate([*keys, PART])]
    return rows.join(F.broadcast(into), on, "left").select(*rows.columns, "__carried")


def running(dealt: DataFrame, keys: list[str], order: list[str], value: Column, name: str, ties_apart: bool = True) -> DataFrame:
    """Rows of ``in_ranges`` with the sum of a value along their key up to them;
    rows alike in the order have one sum unless they are kept apart. Sums inside the ranges
    are moved by those of the key's ranges before. Order may be another one than
    that of the ranges if it sorts the key's rows alike."""
    w = Window.partitionBy(PART, *keys).orderBy(*order)
    inside = dealt.withColumn("__value", value).withColumn(name, F.sum("__value").over(w.rowsBetween(Window.unboundedPreceding, 0) if ties_apart else w))
    before = F.sum("__sum").over(Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1))
    ends = dealt.groupBy(*keys, PART).agg(F.sum(value).alias("__sum")).withColumn("__carried", before).filter("__carried is not null")
    return _with_carried(inside, ends, keys).withColumn(name, F.coalesce(F.col(name) + F.col("__carried"), name, "__carried")).drop("__value", "__carried")


def previous(dealt: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Rows of ``in_ranges`` with the value of the row before along their key, null for the first."""
    w = Window.partitionBy(PART, *keys).orderBy(*order)
    last = dealt.groupBy(*keys, PART).agg(F.max_by(F.struct(value), F.struct(*order)).alias("__last"))
    ends = last.withColumn("__carried", F.lag("__last").over(Window.partitionBy(*keys).orderBy(PART))).filter("__carried is not null")
    inside = dealt.withColumn("__first", F.row_number().over(w) == 1).withColumn(name, F.lag(value).over(w))
    return _with_carried(inside, ends, keys).withColumn(name, F.when(F.col("__first"), F.col("__carried")[value]).otherwise(F.col(name))).drop("__first", "__carried")


def islands(rows: DataFrame, keys: list[str], time: str, gap: Column | float, name: str = "span_id", ranges: int | None = None) -> DataFrame:
    """Numbers runs whose neighbours are at most ``gap`` apart, from 1 in each key.
    Time before and number are carried from range to range, so no key is one task's work."""
    timed = previous(in_ranges(rows, keys, [time], ranges), keys, [time], time, "__before")
    new = F.when(F.col(time) - F.col("__before") <= gap, 0).otherwise(1)
    return running(timed, keys, [time], new, name, ties_apart=False).drop("__before", PART)


def first_in(keys: list[str], order: str) -> Column:
    return F.row_number().over(Window.partitionBy(*keys).orderBy(order)) == 1


def global_number(rows: DataFrame, order: list[Column | str], name: str, ranges: int | None = None) -> DataFrame:
    """Numbers all rows from 1 in an order, without one task for all: rows are
    dealt to sorted ranges, numbered inside, and moved by the counts before.
    Ranges come from a sample, so they are written before they are counted."""
    n = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut(rows.repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id()))
    counts = dealt.groupBy("__part").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("__part", before.alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return dealt.withColumn("__in", inside).join(offsets, "__part").withColumn(name, (F.col("__before") + F.col("__in")).cast("long")).drop("__part", "__in", "__before")


def latest_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row of each key: the one with the largest order."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__r"))
    return best.select(*keys, *(F.col("__r")[c].alias(c) for c in rest)).select(*rows.columns)


def first_crossing(rows: DataFrame, keys: list[str], time: str, crosses: Column) -> DataFrame:
    """keys and ``stopped_at``, the first time at which the condition holds."""
    return rows.groupBy(*keys).agg(F.min(F.when(crosses, F.col(time))).alias("stopped_at"))


def autoregressive(rows: DataFrame, keys: list[str], time: str, noise: str, rho: float, name: str, ranges: int | None = None) -> DataFrame:
    """x_t = rho x_(t-1) + noise_t along each key (x_0 = noise_0), ties in time
    by noise. A key may be longer than a task holds: rows are dealt to sorted
    ranges of all keys, each folded from zero by its own, and what is carried
    into a range, rho**k times the end of the one before, is added to its k-th row."""
    n = ranges or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [f"__k{i}" for i in range(len(keys))]
    slim = rows.select(*(F.col(c).alias(k) for c, k in zip(keys, names, strict=True)), F.col(time).alias("__t"), F.col(noise).cast("double").alias("__e"))
    # Rows of one key, time and noise are alike, so a random number may part them.
    dealt = slim.repartitionByRange(n, *names, "__t", "__e", F.rand(17)).sortWithinPartitions(*names, "__t", "__e")
    schema = f"{', '.join(f'{k} {t}' for k, t in slim.dtypes)}, __x double, __n long, __part int"

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, now, x, k = TaskContext.get().partitionId(), None, 0.0, 0
        for b in batches:
            at, xs, ks = list(zip(*(b.column(c).to_pylist() for c in names), strict=True)), [], []
            for key, e in zip(at, b.column("__e").to_pylist(), strict=True):
                if key != now:
                    now, x, k = key, 0.0, 0
                x = None if x is None or e is None else rho * x + e
                k += 1
                xs.append(x)
                ks.append(k)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(xs, pa.float64()), pa.array(ks, pa.int64()), pa.array([part] * len(xs), pa.int32())], names=[*b.schema.names, "__x", "__n", "__part"])

    folded = cut(dealt.mapInArrow(fold, schema))
    ends = folded.groupBy(*names, "__part").agg(F.max_by("__x", "__n").alias("x"), F.max("__n").alias("n"))
    # A key has an end in each range it reaches, so these rows are as few as ranges.
    parts = F.array_sort(F.collect_list(F.struct("__part", "x", "n")))
    step = lambda acc, r: F.struct(F.concat(acc["out"], F.array(F.struct(r["__part"].alias("__part"), acc["x"].alias("carry")))).alias("out"), (r["x"] + acc["x"] * F.pow(F.lit(rho), r["n"])).alias("x"))
    zero = F.struct(F.array().cast("array<struct<__part: int, carry: double>>").alias("out"), F.lit(0.0).alias("x"))
    many = ends.groupBy(*names).agg(parts.alias("p")).filter(F.size("p") > 1)
    carried = many.select(*names, F.explode(F.aggregate("p", zero, step)["out"]).alias("c")).select(*(F.col(k).alias(f"{k}c") for k in names), F.col("c.__part").alias("__in"), "c.carry").filter("carry is null or carry != 0")
    same = F.col("__part") == F.col("__in")
    for k in names:
        same &= F.col(k).eqNullSafe(F.col(f"{k}c"))
    x = F.when(F.col("__in").isNull(), F.col("__x")).otherwise(F.col("__x") + F.col("carry") * F.pow(F.lit(rho), "__n"))
    out = folded.join(F.broadcast(carried), same, "left")
    return out.select(*(F.col(k).alias(c) for k, c in zip(names, keys, strict=True)), F.col("__t").alias(time), x.alias(name))
