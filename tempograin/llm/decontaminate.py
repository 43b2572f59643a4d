"""Benchmark decontamination with a broadcast hash set of token windows.

Windows of ``WINDOW`` words of every benchmark item (the whole item if it is
shorter) are hashed into a sorted array that is broadcast; documents are scanned
window by window, hits are verified word by word, and the words of verified
windows are reported as spans, for removal of spans or of documents.

The set is broadcast in blocks of at most ``BLOCK`` windows, one scan each, so
what is broadcast at once has a bound whatever the size of the benchmark.

Defined cases: null or wordless texts have no words and hit nothing; a wordless
item has no window; equal items are reported each by its id; null item ids are
written as the empty text; repeated documents are answered each; an empty
benchmark leaves every document clean.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import LOWER, cut, guarded, joined, raw_texts, slices, window_hashes, word_hashes, word_spans

WINDOW, BLOCK = 10, 200_000
#: Bytes of a word: digits, a-z and everything beyond ASCII (after lower-casing).
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_TO_WORDS = bytes(int(LOWER[i]) if _WORD[LOWER[i]] else 0x20 for i in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        item, size, text = [], [], []
        for i, x in zip(b.column("item_id").to_pylist(), raw_texts(b.column("text")), strict=True):
            w = words_of(x)
            k = min(WINDOW, len(w))
            for at in range(len(w) - k + 1 if w else 0):
                item.append(i)
                size.append(k)
                text.append(b" ".join(w[at : at + k]))
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.string()), pa.array(size, pa.int64()), pa.array(text, pa.binary())], names=["item_id", "size", "window"])


class WindowSet:
    """One block of windows: sorted hashes for each length, and what they stand for."""

    def __init__(self, rows: list[tuple[int, bytes, list[str]]]):
        self.items: dict[bytes, list[str]] = {w: items for _, w, items in rows}
        self.hashes: dict[int, np.ndarray] = {}
        for k in {k for k, _, _ in rows}:
            found = []
            for _, w, _ in (r for r in rows if r[0] == k):
                data = np.frombuffer(w, dtype=np.uint8)
                found.append(window_hashes(word_hashes(data, *word_spans(data != 0x20)), k))
            self.hashes[k] = np.unique(np.concatenate(found))

    def scan(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, dict[int, tuple[set[int], set[str]]]]:
        """Words of each document; words hit and items for those with hits."""
        low = LOWER[data]
        s, e = word_spans(_WORD[low])
        of = np.searchsorted(starts, s, side="right") - 1
        words, hits = word_hashes(low, s, e), {}
        first = np.searchsorted(of, np.arange(len(starts) - 1))
        for k, known in self.hashes.items():
            h = window_hashes(words, k)
            at = np.searchsorted(known, h)
            at = np.flatnonzero((known[np.minimum(at, len(known) - 1)] == h) & (of[: len(h)] == of[k - 1 :]))
            for i in at.tolist():
                window = b" ".join(low[s[j] : e[j]].tobytes() for j in range(i, i + k))
                if items := self.items.get(window):
                    hit, ids = hits.setdefault(int(of[i]), (set(), set()))
                    hit.update(range(i - int(first[of[i]]), i - int(first[of[i]]) + k))
                    ids.update(items)
        return np.bincount(of, minlength=len(starts) - 1), hits


def window_sets(benchmark: DataFrame, block: int = BLOCK) -> Iterator[WindowSet]:
    """The distinct windows in blocks of at most ``block``, about, by hash."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), "text").mapInArrow(_windows, "item_id string, size long, window binary")
    rows = cut(rows.groupBy("window", "size").agg(F.collect_set("item_id").alias("items")))
    n = -(-rows.count() // block) or 1
    for i in range(n):
        yield WindowSet([(r["size"], bytes(r["window"]), list(r["items"])) for r in rows.filter(F.pmod(F.xxhash64("window"), F.lit(n)) == i).collect()])


def _scan(docs: DataFrame, windows: WindowSet) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(windows)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            n, hits = held.value.scan(*joined(b.column("text")))
            none: tuple[set, set] = (set(), set())
            words = [sorted(hits.get(i, none)[0]) for i in range(b.num_rows)]
            items = [sorted(hits.get(i, none)[1]) for i in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n, pa.int64()), pa.array(words, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))], names=[*b.schema.names, "n_words", "hit_words", "items"])

    return docs.mapInArrow(scan, StructType([*docs.schema.fields, StructField("n_words", LongType()), StructField("hit_words", ArrayType(LongType())), StructField("items", ArrayType(StringType()))]))


def find_leaks(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """docs, with all its columns (n_words, hit_words and items of its own are
    replaced), and n_words, hit_words (positions, from 0, of the words inside an
    occurrence) and items (ids, sorted as texts)."""
    docs = docs.drop("n_words", "hit_words", "items")
    out, names = None, docs.columns
    for windows in window_sets(benchmark, block):
        now = _scan(docs if out is None else out.select(*names, F.struct("hit_words", "items").alias("__before")), windows)
        if out is not None:
            now = now.select(*names, "n_words", F.array_sort(F.array_union("hit_words", "__before.hit_words")).alias("hit_words"), F.array_sort(F.array_union("items", "__before.items")).alias("items"))
        out = now
    return out


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a verified window, with their columns."""
    return guarded(docs, lambda d: find_leaks(d, benchmark).filter(F.size("hit_words") == 0).select(*d.columns))


def spans_removed(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs with the words of verified windows taken out of the text (what lies
    between removed words goes too; the rest of the text stays as it is)."""

    def removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for x, hit in zip(b.column("text").to_pylist(), b.column("hit_words").to_pylist(), strict=True):
                if hit:
                    hit = set(hit)
                    raw = x.encode()
                    s, e = word_spans(_WORD[LOWER[np.frombuffer(raw, dtype=np.uint8)]])
                    gone = np.zeros(len(raw), dtype=bool)
                    for i in hit:
                        gone[s[i] : s[i + 1] if i + 1 in hit else e[i]] = True
                    x = np.frombuffer(raw, dtype=np.uint8)[~gone].tobytes().decode()
                texts.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if n == "text" else b.column(n) for n in b.schema.names if n != "hit_words"], names=[n for n in b.schema.names if n != "hit_words"])

    return guarded(docs, lambda d: find_leaks(d, benchmark).select(*d.columns, "hit_words").mapInArrow(removed, d.schema))
