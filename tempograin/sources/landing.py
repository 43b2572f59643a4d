"""The landing zone: batches of viewer-seconds, validated, flattened, appended;
loaded as one table from all files, or as a stream of new files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import snapshot
from .raw import conform
from .schemas import EMOTIONS, LANDING

#: A batch as it comes: JSON lines of this schema.
BATCH = "session_id string, viewer_id string, creative_id string, rows array<struct<second: int, attention_index: double, gaze_on_screen: boolean, face_detected: boolean, valence: double, arousal: double, emotions: map<string, double>>>"
LEAST_ROWS, MOST_ROWS = 1, 10_000


def _within(c: str, low: float, high: float) -> Column:
    return F.col(c).isNull() | F.col(c).between(low, high)


def split_valid(batches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Batches that keep the contract, and the others with a reason. A batch is
    taken whole or not at all."""
    known = F.array(*map(F.lit, EMOTIONS))
    bad_row = lambda r: ~(
        F.coalesce(r["second"] >= 0, F.lit(False))
        & F.coalesce(r["attention_index"].between(0, 1), F.lit(True))
        & F.coalesce(r["valence"].between(-1, 1), F.lit(True))
        & F.coalesce(r["arousal"].between(0, 1), F.lit(True))
    )
    strange = lambda r: F.size(F.array_except(F.coalesce(F.map_keys(r["emotions"]), F.array().cast("array<string>")), known)) > 0
    reason = (
        F.when(F.col("session_id").isNull() | F.col("viewer_id").isNull() | F.col("creative_id").isNull(), "missing id")
        .when(F.col("rows").isNull() | ~F.size("rows").between(LEAST_ROWS, MOST_ROWS), "number of rows")
        .when(F.exists("rows", bad_row), "value out of bounds")
        .when(F.exists("rows", strange), "unknown emotion label")
    )
    judged = batches.withColumn("reason", reason)
    return judged.filter("reason IS NULL").drop("reason"), judged.filter("reason IS NOT NULL")


def flattened(batches: DataFrame) -> DataFrame:
    """One row for each viewer-second, emotions as columns, stamped."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")
    rows = batches.withColumn("batch_id", F.substring(F.sha2(F.to_json(F.struct("*")), 256), 1, 12)).select("session_id", "viewer_id", "creative_id", "batch_id", F.explode("rows").alias("r"))
    flat = rows.select("session_id", "viewer_id", "creative_id", "r.*", "batch_id", F.lit("ingested").alias("data_source"), now.alias("received_at"))
    flat = flat.withColumns({f"p_{e}": F.try_element_at("emotions", F.lit(e)) for e in EMOTIONS})
    return conform(flat, LANDING)


def land(batches: DataFrame, folder: str) -> DataFrame:
    """Appends the valid batches; returns the rejected ones."""
    good, bad = split_valid(batches)
    flattened(good).write.mode("append").option("compression", "zstd").parquet(folder)
    return bad


def load(spark: SparkSession, folder: str) -> DataFrame:
    """All landed rows; loading again gives the same table."""
    return spark.read.schema(LANDING).parquet(folder)


def load_table(spark: SparkSession, folder: str, table: str) -> None:
    """Replaces a table by all landed rows, whole: readers see the old rows or the
    new ones, and a load that dies leaves the old ones."""
    snapshot.replace(load(spark, folder), table)


def load_stream(spark: SparkSession, folder: str, out: str, state: str) -> None:
    """Appends files that weren't read yet to ``out``, then stops."""
    new = spark.readStream.schema(LANDING).parquet(folder)
    new.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start().awaitTermination()
