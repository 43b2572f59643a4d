"""Tables of a folder, and views of them that several queries share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a signal: user, event, type, value, seconds since 2024 began."""
    seconds = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', cast(ts AS timestamp_ntz)) / 1e6D - 1704067200.0D")
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", seconds.alias("t"))


def report(checks: list[tuple[str, DataFrame, Column]]) -> DataFrame:
    """One row for each (name, rows, violates): the violations, and passed if none."""
    out = None
    for name, rows, violates in checks:
        one = rows.agg(F.count_if(violates).alias("n")).select(F.lit(name).alias("check_name"), F.concat(F.col("n").cast("string"), F.lit(" violations")).alias("detail"), (F.col("n") == 0).alias("passed"))
        out = one if out is None else out.unionByName(one)
    return out


#: Signals in SQL.
SIGNALS = "sig AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) / 1e6 - 1704067200.0 AS t FROM events)"
