"""Streams of files: tumbling windows, sessions, duplicates, until all is read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sequences import latest_per_key
from ..sources.lineage import shared_dir

LATE = "2 hours"


def event_stream(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Events of the folder's files as they come; schema from what is there."""
    schema = spark.read.parquet(f"{folder}/{pattern}").schema
    files = spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").parquet(folder)
    return files.withColumn("at", F.to_timestamp("ts"))


def drained(rows: DataFrame, mode: str, keys: list[str] | None = None) -> DataFrame:
    """Runs the stream over all that is there and returns what it wrote. In
    update mode a batch writes only the rows that it changed, and the last of each
    key counts. A batch that is run again overwrites its own folder; a source without
    rows gives an empty table."""
    spark = rows.sparkSession
    folder = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/__batch={n}")

    write(spark.createDataFrame([], rows.schema), -1)
    q = rows.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/state").foreachBatch(write).trigger(availableNow=True).start()
    q.awaitTermination()
    found = spark.read.parquet(f"{folder}/out")
    return (latest_per_key(found, keys, ["__batch"]) if keys else found).drop("__batch")


def tumbling_counts(spark: SparkSession, folder: str, pattern: str, width: str) -> DataFrame:
    """event_type, start, n, total for each window."""
    events = event_stream(spark, folder, pattern)
    counts = events.groupBy("event_type", F.window("at", width).alias("w")).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return drained(counts.select("event_type", F.col("w.start").alias("start"), "n", "total"), "update", ["event_type", "start"])


def session_counts(events: DataFrame, key: str, gap: str) -> DataFrame:
    """Sessions of a key (a pause of at most ``gap``), for a stream with a watermark."""
    return events.withWatermark("at", LATE).groupBy(key, F.session_window("at", gap).alias("w")).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def without_repeats(events: DataFrame, keys: list[str]) -> DataFrame:
    """Batches sent twice count once, within the watermark."""
    return events.withWatermark("at", LATE).dropDuplicatesWithinWatermark(keys)
