"""Raw tables: one folder each, files with or without all declared columns."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .schemas import RAW


def union_by_name(tables: list[DataFrame]) -> DataFrame:
    """All rows; columns that a table lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def conform(rows: DataFrame, schema: StructType) -> DataFrame:
    """The declared columns in order, cast; missing ones null, others dropped."""
    return rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema))


def read_raw(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A raw table by its declared schema. A file whose column is all null has a
    physical type of its own, which no common schema reads; so tasks read the
    schemas of the files (one file is one creative's rows), and files are read in
    groups of equal physical schema, cast, and united by name."""
    tables = raw_parts(spark, folder, name)
    return union_by_name(tables) if tables else spark.createDataFrame([], RAW[name])


def raw_parts(spark: SparkSession, folder: str, name: str) -> list[DataFrame]:
    """A raw table's groups of files, none if it has no file."""
    schema, root = RAW[name], f"{folder}/{name}"
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return []
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
    groups = files.select("path").mapInArrow(_physical, "path string, kind string").groupBy("kind").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    return [conform(spark.read.parquet(*g["paths"]), schema) for g in groups.orderBy("kind").collect()]


def opened(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system of a path or URI, and the path there."""
    if re.match(r"file:/(?!/)", uri):
        uri = uri.removeprefix("file:")
    return pa.fs.FileSystem.from_uri(uri if "://" in uri else os.path.abspath(uri))


def _physical(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The physical schema of each file, from its footer alone."""
    for b in batches:
        kinds = []
        for path in b.column("path").to_pylist():
            fs, name = opened(path)
            with fs.open_input_file(name) as f:
                kinds.append(str(pq.read_schema(f).remove_metadata()))
        yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(kinds, pa.string())], names=["path", "kind"])


def raw_views(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All raw tables, also as temporary views named raw_<table>; of the manifest, what was merged too."""
    from . import manifest

    tables = {n: manifest.history(spark, folder) if n == "_manifest" else read_raw(spark, folder, n) for n in RAW}
    for n, df in tables.items():
        df.createOrReplaceTempView("raw_" + n.lstrip("_"))
    return tables
