"""Line dedup: range-partitioned hashes, sorted by document, streamed.

A row (hash of a line's key, document, positions) goes to a range partition,
sorted by hash and then by document, the largest id first. Each partition is
streamed once: the first document of a hash keeps its lines, the others lose
theirs if enough documents share it. The result is a bitmap of the lines kept,
compressed, for each document that loses any: no text moves.

The ranges are of (hash, document), so a line that a third of all documents
share is dealt over many partitions. What a run of one hash that crosses a
boundary needs from its neighbours (documents, largest id) is two rows for each
partition, gathered beforehand.

Defined cases: null or empty text is one empty line; rows that share a doc_id
are one document when documents are counted, and each row loses the lines that
its document loses; a null doc_id is a document, below all others; a doc_id that
is no whole number is an error; very long texts and lines are compared whole;
further columns pass through the removal untouched, whatever their names; an empty
table gives no bitmaps.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from .common import cut, guarded, parallel, raw_texts, slices

#: A key has at least so many code points, and so many documents share it.
LEAST_POINTS, LEAST_DOCS = 40, 5
_BLANK = b" \t\n\x0b\x0c\r"
_NO_ID = -(1 << 63)
_LINES = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("id", pa.int64()), ("row", pa.int64()), ("n", pa.int32()), ("at", pa.list_(pa.int32()))])
_EDGES = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("docs", pa.int64()), ("top", pa.int64())])
_DROPS = pa.schema([("id", pa.int64()), ("row", pa.int64()), ("n", pa.int32()), ("at", pa.list_(pa.int32()))])


def keys_of(text: bytes) -> Iterator[tuple[int, bytes]]:
    """(position, key) of each line whose key is long enough."""
    for i, line in enumerate(text.split(b"\n")):
        key = line.strip(_BLANK)
        if len(key) >= LEAST_POINTS and (len(key) >= 4 * LEAST_POINTS or len(key.decode()) >= LEAST_POINTS):
            yield i, key.lower()


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        out = []
        for i, r, x in zip(b.column("id").to_pylist(), b.column("row").to_pylist(), raw_texts(b.column("text")), strict=True):
            found: dict[bytes, list[int]] = {}
            for pos, key in keys_of(x):
                found.setdefault(xxhash.xxh3_128_digest(key), []).append(pos)
            n = x.count(b"\n") + 1
            out += [(int.from_bytes(h[:8], "big", signed=True), int.from_bytes(h[8:], "big", signed=True), i, r, n, at) for h, at in found.items()]
        columns = list(zip(*out, strict=True)) or [()] * len(_LINES)
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, _LINES, strict=True)], schema=_LINES)


def _runs(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and ids of a batch; starts of the runs of a hash; whether a row's
    document is another than the row's before (in the same run)."""
    h1, h2, ids = (b.column(c).to_numpy() for c in ("h1", "h2", "id"))
    new_hash = np.ones(len(h1), dtype=bool)
    new_hash[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    new_doc = new_hash.copy()
    new_doc[1:] |= ids[1:] != ids[:-1]
    return h1, h2, ids, np.flatnonzero(new_hash), new_doc


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents and largest id of a partition's first and last run."""
    first = last = None  # [h1, h2, docs, top, latest id]
    for b in batches:
        if not b.num_rows:
            continue
        h1, h2, ids, starts, new_doc = _runs(b)
        docs = np.add.reduceat(new_doc.astype(np.int64), starts)
        ends = np.append(starts[1:], len(h1))
        for j in {0, len(starts) - 1}:
            s, e = starts[j], ends[j]
            run = [int(h1[s]), int(h2[s]), int(docs[j]), int(ids[s]), int(ids[e - 1])]
            if last and last[:2] == run[:2]:
                run = [*run[:2], last[2] + run[2] - (last[4] == ids[s]), last[3], run[4]]
            if first is None or first[:2] == run[:2]:
                first = run
            last = run
    rows = [first, last] if first and first[:2] != last[:2] else [first] if first else []
    # A document split between partitions would count twice, but its rows are one (hash, id) group.
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], schema=_EDGES)


def _stream(edges: dict[tuple[int, int], tuple[int, int]], least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that lose their lines. A run is judged with its batch; the last
    one may go on in the next, so the rows of its first documents wait there
    until it is known whether enough documents follow."""
    now, docs, top, latest, waiting = None, 0, 0, 0, []
    for b in batches:
        if not b.num_rows:
            continue
        h1, h2, ids, starts, new_doc = _runs(b)
        first, last = (int(h1[0]), int(h2[0])), (int(h1[-1]), int(h2[-1]))
        tops, shared = ids[starts], np.add.reduceat(new_doc.astype(np.int64), starts)
        if first == now:
            shared[0] += docs - (latest == ids[0])
            tops[0] = top
        else:
            waiting = []
        docs = int(shared[-1])
        for j, key in ((0, first), (len(starts) - 1, last)):  # these may reach into other partitions
            shared[j], tops[j] = edges.get(key, (shared[j], tops[j]))
        size = np.diff(np.append(starts, len(h1)))
        rest, other = b.select(_DROPS.names), ids != np.repeat(tops, size)
        if shared[0] >= least:
            yield from waiting
        yield rest.filter(pa.array(other & np.repeat(shared >= least, size)))
        begun = waiting if first == last and shared[0] < least else []
        now, top, latest = last, int(tops[-1]), int(ids[-1])
        at = int(starts[-1])
        waiting = [*begun, rest.slice(at).filter(pa.array(other[at:]))] if shared[-1] < least and last not in edges else []


def keep_bitmap(n_lines: int, dropped: np.ndarray) -> bytes:
    """One bit for each line, 1 for kept, deflated."""
    bits = np.ones(n_lines, dtype=bool)
    bits[dropped] = False
    return zlib.compress(np.packbits(bits).tobytes())


def read_bitmap(bitmap: bytes | None, n_lines: int) -> np.ndarray:
    if bitmap is None:
        return np.ones(n_lines, dtype=bool)
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), dtype=np.uint8), count=n_lines).astype(bool)


def _id(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(_NO_ID))


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keep = [keep_bitmap(n, np.array(at)) for n, at in zip(b.column("n").to_pylist(), b.column("at").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("row"), pa.array(keep, pa.binary())], names=["id", "row", "keep"])


def bitmaps(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """docs (doc_id, text) -> id, row (hash of the text), keep (compressed
    bitmap), for each document and text that loses lines."""
    spark = docs.sparkSession
    lines = docs.select(_id(F.col("doc_id")).alias("id"), F.xxhash64("text").alias("row"), "text")
    keyed = lines.mapInArrow(_lines, "h1 long, h2 long, id long, row long, n int, at array<int>")
    ranged = cut(keyed.repartitionByRange(parallel(spark), "h1", "h2", F.desc("id")).sortWithinPartitions("h1", "h2", F.desc("id")))
    edges = ranged.mapInArrow(_edges, "h1 long, h2 long, docs long, top long")
    # Runs that meet a boundary: at most two for each partition.
    shared = {(r["h1"], r["h2"]): (r["docs"], r["top"]) for r in edges.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.max("top").alias("top")).collect()}
    held = spark.sparkContext.broadcast(shared)
    drops = ranged.mapInArrow(lambda it: _stream(held.value, least, it), "id long, row long, n int, at array<int>")
    return drops.groupBy("id", "row").agg(F.max("n").alias("n"), F.flatten(F.collect_list("at")).alias("at")).mapInArrow(_compressed, "id long, row long, keep binary")


def with_bitmaps(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """docs, with all its columns, and ``__keep``, null where all lines stay."""
    marks = bitmaps(docs.select("doc_id", "text"), least).select(F.col("id").alias("__id"), F.col("row").alias("__row"), F.col("keep").alias("__keep"))
    return docs.join(marks, (_id(F.col("doc_id")) == F.col("__id")) & (F.xxhash64("text") == F.col("__row")), "left").drop("__id", "__row")


def kept_text(text: bytes, keep: bytes | None) -> tuple[int, int, bytes]:
    """Lines before, lines dropped, and the text of those that stay."""
    lines = text.split(b"\n")
    if keep is None:
        return len(lines), 0, text
    stay = read_bitmap(keep, len(lines))
    return len(lines), int((~stay).sum()), b"\n".join([x for x, s in zip(lines, stay, strict=True) if s])


def line_digests(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every row."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [kept_text(x, k) for x, k in zip(raw_texts(b.column("text")), b.column("__keep").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64()), pa.array([hashlib.sha256(g[2]).hexdigest() for g in got], pa.string())], names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    slim = docs.select("doc_id", "text")
    return with_bitmaps(slim, least).mapInArrow(digests, StructType([slim.schema["doc_id"], StructField("n_lines", LongType()), StructField("n_dropped", LongType()), StructField("kept_sha256", StringType())]))


def lines_removed(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """docs with their columns, the dropped lines taken out of the texts."""
    return guarded(docs, lambda d: _lines_removed(d, least))


def _lines_removed(docs: DataFrame, least: int) -> DataFrame:
    names = docs.columns

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = b.column("__keep").to_pylist()
            texts = [x if k is None else kept_text(x.encode(), k)[2].decode() for x, k in zip(b.column("text").to_pylist(), keep, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else b.column(c) for c in names], names=names)

    return with_bitmaps(docs, least).mapInArrow(apply, docs.schema)
