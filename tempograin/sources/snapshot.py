"""Tables that are replaced whole: a new snapshot is written beside the old one,
and a pointer is swapped to it by a rename. Readers see one whole snapshot or the
other; a load that dies leaves the old one."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_POINTER = "_current"


def _files(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    return path, path(folder).getFileSystem(conf), spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(path(folder).toUri() if "://" in folder else path(folder).getFileSystem(conf).getUri(), conf)


def current(spark: SparkSession, folder: str) -> str | None:
    """The snapshot that the pointer names."""
    path, fs, _ = _files(spark, folder)
    at = path(f"{folder}/{_POINTER}")
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return stream.readUTF()
    finally:
        stream.close()


def read(spark: SparkSession, folder: str, schema: StructType | None = None) -> DataFrame:
    """The rows of the current snapshot; with a schema, none where there is no snapshot."""
    name = current(spark, folder)
    if name is None:
        if schema is None:
            raise FileNotFoundError(f"no snapshot in {folder}")
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema) if schema else spark.read).parquet(f"{folder}/{name}")


def replace(rows: DataFrame, folder: str) -> str:
    """Writes the rows as a new snapshot and makes it the current one. The rows
    may be read from the old one."""
    spark, name = rows.sparkSession, f"snapshot-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    rows.write.option("compression", "zstd").parquet(f"{folder}/{name}")
    point(spark, folder, name)
    return name


def point(spark: SparkSession, folder: str, name: str) -> None:
    path, fs, context = _files(spark, folder)
    part = path(f"{folder}/{_POINTER}-{uuid.uuid4().hex}")
    stream = fs.create(part)
    stream.writeUTF(name)
    stream.close()
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename
    over = spark.sparkContext._gateway.new_array(options, 1)
    over[0] = options.OVERWRITE
    context.rename(fs.makeQualified(part), fs.makeQualified(path(f"{folder}/{_POINTER}")), over)


def prune(spark: SparkSession, folder: str, keep: int = 2) -> int:
    """Deletes all snapshots but the current one and the newest ``keep``; those
    that readers may still be at work on are among these."""
    path, fs, _ = _files(spark, folder)
    names = sorted(s.getPath().getName() for s in fs.listStatus(path(folder)) if s.getPath().getName().startswith("snapshot-"))
    gone = [n for n in names[: max(0, len(names) - keep)] if n != current(spark, folder)]
    for n in gone:
        fs.delete(path(f"{folder}/{n}"), True)
    return len(gone)
