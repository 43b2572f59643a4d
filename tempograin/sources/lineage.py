"""Cutting lineage where a result must not be computed anew."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which driver and executors share; a
    temporary one serves a local master without that setting, others need it."""
    folder, master = spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.master
    if not folder and not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return folder or tempfile.mkdtemp(prefix="shared-")


def cut(rows: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read from there."""
    spark = rows.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return rows.checkpoint()
