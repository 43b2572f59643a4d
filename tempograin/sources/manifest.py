"""The run manifest: append-only history of extractor runs, and what is fresh.

Every run appends a small file. Compaction merges them into one snapshot and deletes
them after the snapshot is in place, so a compaction that dies, or is done again,
loses nothing and counts nothing twice: rows that are in both places are one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sequences import latest_per_key
from . import snapshot
from .raw import conform, raw_parts, union_by_name
from .schemas import RAW


_MERGED = "_manifest_merged"
#: A file of the snapshot for each so many bytes that are merged.
_FILE_BYTES = 64 << 20


def append(runs: DataFrame, folder: str) -> None:
    conform(runs, RAW["_manifest"]).write.mode("append").option("compression", "zstd").parquet(f"{folder}/_manifest")


def history(spark: SparkSession, folder: str) -> DataFrame:
    """All runs: those of the snapshot, whose rows differ, and those appended since."""
    merged, appended = snapshot.read(spark, f"{folder}/{_MERGED}", RAW["_manifest"]), raw_parts(spark, folder, "_manifest")
    return union_by_name([merged, *appended]).distinct() if appended else merged


def latest_runs(spark: SparkSession, folder: str, columns: tuple[str, ...] = tuple(RAW["_manifest"].names)) -> DataFrame:
    """The last run of each creative and extractor; a run that is in two files is one."""
    merged, appended = snapshot.read(spark, f"{folder}/{_MERGED}", RAW["_manifest"]), raw_parts(spark, folder, "_manifest")
    keys, order = ["creative_id", "extractor"], ["finished_at", "run_id"]
    return latest_per_key(union_by_name([merged, *appended]).select(*dict.fromkeys([*keys, *order, *columns])), keys, order).select(*columns)


def compact(spark: SparkSession, folder: str) -> int:
    """Merges the appended files into a new snapshot; returns how many they were."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    root = path(f"{folder}/_manifest")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    # Only what is listed now is merged, and only that goes; later files wait for the next time.
    found = [s for s in fs.listStatus(root) if s.getPath().getName().endswith(".parquet")] if fs.exists(root) else []
    listed = [s.getPath() for s in found]
    if listed:
        appended = [conform(spark.read.parquet(*(p.toString() for p in listed)), RAW["_manifest"])]
        merged = snapshot.read(spark, f"{folder}/{_MERGED}", RAW["_manifest"])
        now = snapshot.current(spark, f"{folder}/{_MERGED}")
        size = sum(s.getLen() for s in found) + (fs.getContentSummary(path(f"{folder}/{_MERGED}/{now}")).getLength() if now else 0)
        snapshot.replace(union_by_name([merged, *appended]).distinct().coalesce(1 + size // _FILE_BYTES), f"{folder}/{_MERGED}")
        for p in listed:
            fs.delete(p, False)
        snapshot.prune(spark, f"{folder}/{_MERGED}")
    return len(listed)


#: What of a run tells whether it must be done again.
STATE = ("creative_id", "creative_sha256", "extractor", "extractor_version", "status")


def stale(work: DataFrame, runs: DataFrame) -> DataFrame:
    """The items (creative_id, creative_sha256, extractor, extractor_version)
    whose bytes this version hasn't worked on with success."""
    done = runs.filter("status = 'ok'").select("creative_id", "creative_sha256", "extractor", "extractor_version")
    return work.join(done, done.columns, "left_anti")


def status(runs: DataFrame) -> DataFrame:
    ok = F.col("status") == "ok"
    return runs.groupBy("extractor", "extractor_version").agg(F.count_if(ok).alias("ok"), F.count_if(~ok).alias("errors"), F.sum("rows_written").alias("rows_written"), F.max("finished_at").alias("last_run"))
