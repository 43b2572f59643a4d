"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Multiplier of the polynomial word hash, and of the window hash over words.
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_PIECE = 1 << 18
#: Bytes that part words: blank, and tab to carriage return.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder of spark.checkpoint.dir; only where neither it nor
    a checkpoint folder is set and the master is local, take a temporary one."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="ckpt-"))


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and read them from there."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder as Parquet, which takes a
    third of what a checkpoint does, and read them from there. The rows come back in
    any order and partitioning; the files go when the application ends."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/rows-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    gone_at_exit(spark, folder)
    # Shuffle files go when the driver's JVM collects what made them; a quiet driver may not for long.
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(folder)


def gone_at_exit(spark: SparkSession, folder: str) -> None:
    """Delete the folder, in whatever file system it is, when the driver ends."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)


def few(written: DataFrame, rows: int = 20_000) -> DataFrame:
    """Rows that were cut, read in tasks of ``rows`` rows or so: a small table
    doesn't need as many tasks as the shuffle that made it."""
    return written.coalesce(max(1, -(-written.count() // rows)))


def parallel(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def mod_of_id(doc_id: Column, m: int) -> Column:
    """crc32 of the id as text, modulo m; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % m


def mix64(x: np.ndarray) -> np.ndarray:
    """Scatter the bits of 64-bit integers (splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=4)
def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int, base: int = _BASE) -> np.ndarray:
    """base**0 .. base**(n-1), modulo 2**64."""
    return _powers(1 << max(n - 1, 0).bit_length(), base)[:n]


def raw_texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text; a null text is empty."""
    for x in column.cast(pa.large_binary()):
        yield x.as_py() or b""


def joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a batch behind one another, each followed by a newline, as
    bytes; and the start of each text, with the end of all."""
    data = list(raw_texts(column))
    lengths = np.fromiter((len(x) + 1 for x in data), dtype=np.int64, count=len(data))
    starts = np.concatenate([[0], np.cumsum(lengths)])
    data.append(b"")
    return np.frombuffer(b"\n".join(data), dtype=np.uint8), starts


def word_spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word data[start:end], in pieces of a quarter of a megabyte or so."""
    out, i = np.zeros(len(starts), dtype=np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _PIECE)))
        low, high = int(starts[i]), int(ends[j - 1])
        total = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * powers(high - low), out=total[1:])
        s, e = starts[i:j] - low, ends[i:j] - low
        h = (total[e] - total[s]) * powers(high - low, _BASE_INV)[s]
        out[i:j] = mix64(h + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        i = j
    return out


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of each k consecutive word hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    for i in range(k):
        h = h * np.uint64(_BASE) + words[i : i + n]
    return mix64(h)


def release() -> None:
    """Give back what is freed: workers wait for their next task with little memory."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, again, in batches of about a megabyte of text (or one row)."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(size + 64) // most
        bounds = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for i, j in zip(bounds, bounds[1:], strict=False):
            if j > i:
                yield batch.slice(i, j - i)
        release()


def to_batch(rows: dict[str, list | np.ndarray], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rows[f.name], type=f.type) for f in schema], schema=schema)


def guarded(docs: DataFrame, operator: Callable[[DataFrame], DataFrame], used: tuple[str, ...] = ("doc_id", "text", "source")) -> DataFrame:
    """The operator's result on docs whose other columns can't clash with names
    of its own: they are renamed on the way in and back on the way out."""
    names = {c if c in used else f"__column{i}": c for i, c in enumerate(docs.columns)}
    out = operator(docs.toDF(*names))
    return out.toDF(*(names.get(c, c) for c in out.columns))


def schema_of(fields: list[StructField], ddl: str) -> StructType:
    """The fields given and those of the DDL text."""
    return StructType([*fields, *StructType.fromDDL(ddl).fields])
