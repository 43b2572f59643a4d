"""Substring dedup: paragraphs that repeat, by MinHash banding, and passages of
them that repeat whatever the line breaks.

A paragraph is a line of at least ``LEAST_WORDS`` words; its set is its distinct
five-word shingles (A-Z lower-cased). Sets collide in any of ``BANDS`` bands of
``ROWS`` minwise values: a pair of similarity 0.8 collides with probability
1 - (1 - 0.8**2)**8 = 0.9997. Colliding paragraphs are verified by exact Jaccard
similarity, and in each component all paragraphs go but the first one of the
smallest document.

Passages repeat whatever the line breaks: of every ``STEP`` consecutive windows
of ``WINDOW`` words one is sampled (the smallest hash), so that any run of ``RUN``
words that occurs twice shares a sample. Around the samples that repeat the windows at
the ends are looked up in all texts, and windows that overlap are joined; joined runs of
``RUN`` words or more are passages. Windows of fewer than ``DISTINCT`` different words
(junk, rules of tables) are none.

Only paragraphs with a sample that repeats are banded. Of s shingles a pair of
similarity 0.8 has s / 9 at most that the other lacks, and a change inside a line
costs five, at its ends one. So lines of fewer than 49 words keep one run of all but
these, which is ``RUN`` words from 26 words on, and 19 words for one of 20; longer ones are
parted by a change of five in each 45 at most, and keep such a run between two.
Hence lines of up to ``SHORT`` words, which a line of 25 may resemble, are sampled
at every ``SHORT_STEP`` windows too: 19 words have as many. (Lines
that repeat words so that their sets are far smaller than they may fall outside
this.) The same holds for passages: one of over 50 words with a copy of similarity
0.8 has a run of ``RUN`` words unchanged.

Defined cases: null and empty texts have no paragraph; a paragraph repeated in
one document counts as a repeat; rows that share a doc_id are told apart by a
hash of the text, and rows repeated whole are one place, so the first of them
keeps its paragraphs in each; of paragraphs in one component the first line of the
smallest id stays, null ids last; very long texts and lines are compared whole;
further columns of the input pass through the removals untouched, whatever their
names; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import similar
from .bloom import BlockedBloom
from .common import LOWER, SPACES, guarded, joined, schema_of, slices, stored, window_hashes, word_hashes, word_spans

BANDS, ROWS, WORDS, PERCENT, LEAST_WORDS = 8, 2, 5, 80, 20
WINDOW, STEP, DISTINCT = 13, 12, 6
RUN = WINDOW + STEP - 1
#: Lines of up to so many words have a sample among so many windows of theirs.
SHORT, SHORT_STEP = 31, 7


class Words(NamedTuple):
    """Of a batch: the starts of its texts; of each word its hash, text, start and end;
    hashes of all windows, and the samples among them."""

    starts: np.ndarray
    ends_of_lines: np.ndarray
    words: np.ndarray
    of: np.ndarray
    s: np.ndarray
    e: np.ndarray
    windows: np.ndarray
    samples: np.ndarray


def _words(batch: pa.RecordBatch) -> Words:
    data, starts = joined(batch.column("text"))
    low = LOWER[data]
    s, e = word_spans(~SPACES[low])
    of = np.searchsorted(starts, s, side="right") - 1
    words = word_hashes(low, s, e)
    h, at = window_hashes(words, WINDOW), np.zeros(0, dtype=np.int64)
    if len(words) >= RUN:
        first = np.flatnonzero(of[: len(of) - RUN + 1] == of[RUN - 1 :])
        least = np.lib.stride_tricks.sliding_window_view(h, STEP).argmin(axis=1)
        at = first + least[first]
    ends = np.flatnonzero(data == 10)  # a text ends in one more newline
    line = np.searchsorted(ends, s)
    n = np.bincount(line, minlength=len(ends))
    short = (n >= LEAST_WORDS) & (n <= SHORT)
    some = np.zeros(0, dtype=np.int64)
    if len(words) >= WINDOW + SHORT_STEP - 1:
        last = line[WINDOW + SHORT_STEP - 2 :]
        some = np.flatnonzero((line[: len(last)] == last) & short[last])
        some = some + np.lib.stride_tricks.sliding_window_view(h, SHORT_STEP)[some].argmin(axis=1)
    return Words(starts, ends, words, of, s, e, h, np.union1d(at, some).astype(np.int64))


def _samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        x = _words(b)
        yield pa.RecordBatch.from_arrays([pa.array(x.windows[x.samples].view(np.int64))], names=["node"])


def _shared(slim: DataFrame) -> Broadcast:
    """A Bloom filter (of bounded size) of the samples that repeat."""
    found = stored(slim.select("text").mapInArrow(_samples, "node long").groupBy("node").agg(F.count("*").alias("n")).filter("n > 1").select("node"))
    return slim.sparkSession.sparkContext.broadcast(BlockedBloom.build(found, "node", found.count()))


def _sketch(shared: Broadcast):
    """The paragraphs with a sample that others may have too: where they are,
    their class, band keys, sketch and set."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            x = _words(b)
            line = np.searchsorted(x.ends_of_lines, x.s)
            words = np.bincount(line, minlength=len(x.ends_of_lines))
            hit = x.samples[shared.value.might_contain(x.windows[x.samples].view(np.int64))]
            use = np.zeros(len(words), dtype=bool)
            use[line[hit][line[hit] == line[hit + WINDOW - 1]]] = True
            long = np.flatnonzero(use & (words >= LEAST_WORDS))
            of = np.searchsorted(long, line)
            mine = np.flatnonzero((of < len(long)) & (long[np.minimum(of, len(long) - 1)] == line)) if len(long) else long
            h, text = similar.shingles(x.words[mine], of[mine], len(long), WORDS)
            sizes, found, starts = similar.classes(h, text, len(long))
            values = similar.minhashes(h, starts) if len(h) else np.zeros((0, similar.COORDS), dtype=np.uint32)
            keys, sig = similar.node_keys(values[:, : BANDS * ROWS], ROWS), (values & 0xFF).astype(np.uint8)
            begins = np.append(0, x.ends_of_lines + 1)[long]
            row = np.searchsorted(x.starts, begins, side="right") - 1
            number = long - np.searchsorted(x.ends_of_lines, x.starts)[row]
            grams = [g.tobytes() for g in np.split(h, starts[1:])] if len(h) else []
            picked = pa.array(row, pa.int64())
            columns = [pa.array(c, pa.int64()) for c in (number, begins - x.starts[row], x.ends_of_lines[long] - x.starts[row])]
            columns += [pa.array(found, pa.binary()), pa.array(sizes, pa.int64()), pa.array([r.tobytes() for r in sig], pa.binary()), pa.array(list(keys), pa.list_(pa.int64())), pa.array(grams, pa.binary())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(picked), b.column("__row").take(picked), *columns], names=["doc_id", "__row", "paragraph", "from_byte", "to_byte", "cls", "n", "sig", "keys", "grams"])

    return sketch


def _fetcher(sketched: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """The sets of the classes asked for, each once; no others are shuffled."""

    def fetch(ids: DataFrame) -> DataFrame:
        asked = ids.sparkSession.sparkContext.broadcast(BlockedBloom.build(ids.select(F.xxhash64("cls").alias("h")), "h", ids.count()))

        def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.filter(pa.array(asked.value.might_contain(b.column("h").to_numpy()), pa.bool_())).select(["cls", "grams"])

        sets = sketched.select("cls", "grams", F.xxhash64("cls").alias("h")).mapInArrow(some, "cls binary, grams binary")
        return sets.join(ids, "cls", "left_semi").groupBy("cls").agg(F.max("grams").alias("grams"))

    return fetch


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("__row"), "text")


def repeated_paragraphs(docs: DataFrame, shared: Broadcast | None = None, **limits) -> DataFrame:
    """docs (doc_id, text) -> the paragraphs of every component of two or more:
    doc_id, __row, paragraph (line number from 0), from_byte, to_byte,
    n_shingles, component_id (smallest doc_id with one), n_copies, removed."""
    slim = _slim(docs)
    schema = schema_of([slim.schema["doc_id"]], "__row long, paragraph long, from_byte long, to_byte long, cls binary, n long, sig binary, keys array<long>, grams binary")
    sketched = stored(slim.mapInArrow(_sketch(shared or _shared(slim)), schema))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "__row", "paragraph")
    units = stored(sketched.groupBy("cls").agg(*(F.any_value(c).alias(c) for c in ("n", "sig", "keys")), F.count("*").alias("copies"), F.min(place).alias("first")))
    labels = similar.link(units.select("cls", "n", "sig", "keys"), _fetcher(sketched), PERCENT, **limits)
    known = units.select("cls", "copies", "first").join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    groups = known.groupBy("label").agg(F.sum("copies").alias("n_copies"), F.min("first").alias("keep")).filter("n_copies > 1")
    repeated = known.join(groups, "label").select("cls", "n_copies", "keep")
    found = sketched.drop("sig", "keys", "grams").join(repeated, "cls")
    return found.select("doc_id", "__row", "paragraph", "from_byte", "to_byte", F.col("n").alias("n_shingles"), F.col("keep.doc_id").alias("component_id"), "n_copies", (place != F.col("keep")).alias("removed"))


def repeats(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text) -> repeated paragraphs, and repeated passages (whose
    paragraph is null): doc_id, __row, paragraph, from_byte, to_byte,
    component_id, n_copies, removed. The samples are counted once for both."""
    shared = _shared(_slim(docs))
    columns = ["doc_id", "__row", "paragraph", "from_byte", "to_byte", "component_id", "n_copies", "removed"]
    lines = stored(repeated_paragraphs(docs, shared).select(*columns))
    passages = repeated_passages(docs, shared).withColumn("paragraph", F.lit(None).cast("long"))
    return lines.union(passages.select(*columns))


def paragraphs_removed(docs: DataFrame, **limits) -> DataFrame:
    """docs with their columns, the repeats taken out of the texts."""
    return guarded(docs, lambda d: _paragraphs_removed(d, **limits))


def _paragraphs_removed(docs: DataFrame, **limits) -> DataFrame:
    names = docs.columns
    gone = repeated_paragraphs(docs.select("doc_id", "text"), **limits).filter("removed").groupBy("doc_id", "__row").agg(F.collect_set("paragraph").alias("__gone"))
    gone = gone.withColumnsRenamed({"doc_id": "__id", "__row": "__text"})
    both = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__text")), "left").drop("__id", "__text")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for x, lines in zip(b.column("text").to_pylist(), b.column("__gone").to_pylist(), strict=True):
                out = set(lines or ())
                texts.append("\n".join(t for i, t in enumerate(x.split("\n")) if i not in out) if out else x)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else b.column(c) for c in names], names=names)

    return both.mapInArrow(apply, docs.schema)


def _around(n: int, of: np.ndarray, ways: tuple[tuple[int, np.ndarray], ...]) -> np.ndarray:
    """The windows up to the next sample, before (-1) or after (1) those given."""
    near = np.zeros(n + 2 * STEP, dtype=bool)
    for way, found in ways:
        for k in range(1, STEP):
            near[found + way * k + STEP] = True
    return near[STEP : n + STEP] & (of[:n] == of[len(of) - n :])


def _ends(shared: Broadcast):
    """Hashes of the windows before and after each stretch of samples that
    others may have too."""

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            x = _words(b)
            h, at, of = x.windows, x.samples, x.of
            hit = shared.value.might_contain(h[at].view(np.int64))
            next_too = hit[1:] & hit[:-1] & (of[at[1:]] == of[at[:-1]])
            near = _around(len(h), of, ((-1, at[hit & ~np.append(False, next_too)[: len(at)]]), (1, at[hit & ~np.append(next_too, False)[: len(at)]])))
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(h[near]).view(np.int64))], names=["node"])

    return ends


def _occurrences(shared: Broadcast, sought: Broadcast):
    """The samples that others may have too, and of the windows around them
    those that may be an end somewhere."""

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            starts, _, words, of, s, e, h, at = _words(b)
            hit = at[shared.value.might_contain(h[at].view(np.int64))]
            i = np.flatnonzero(_around(len(h), of, ((-1, hit), (1, hit))))
            i = np.union1d(hit, i[sought.value.might_contain(h[i].view(np.int64))]).astype(np.int64)
            sorted_ = np.sort(words[i[:, None] + np.arange(WINDOW)], axis=1)
            i = i[(np.diff(sorted_, axis=1) != 0).sum(axis=1) + 1 >= DISTINCT]
            row, picked = of[i], pa.array(of[i], pa.int64())
            number = i - np.searchsorted(of, row)
            columns = [pa.array(x, pa.int32()) for x in (number, s[i] - starts[row], e[i + WINDOW - 1] - starts[row])]
            yield pa.RecordBatch.from_arrays([pa.array(h[i].view(np.int64)), b.column("doc_id").take(picked), b.column("__row").take(picked), *columns], names=["h", "doc_id", "__row", "word", "from_byte", "to_byte"])

    return occurrences


def repeated_passages(docs: DataFrame, shared: Broadcast | None = None) -> DataFrame:
    """docs (doc_id, text) -> the runs of at least ``RUN`` words whose windows
    occur again: doc_id, __row, word (number of the first, from 0), n_words,
    from_byte, to_byte, component_id (smallest doc_id with one of the windows),
    n_copies (of the most frequent window), removed (all but the first)."""
    slim = _slim(docs)
    filter_ = shared or _shared(slim)
    ends = stored(slim.select("text").mapInArrow(_ends(filter_), "node long").distinct())
    sought = slim.sparkSession.sparkContext.broadcast(BlockedBloom.build(ends, "node", ends.count()))
    schema = schema_of([*schema_of([], "h long").fields, slim.schema["doc_id"]], "__row long, word int, from_byte int, to_byte int")
    found = stored(slim.mapInArrow(_occurrences(filter_, sought), schema))
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "__row", "word")
    again = found.groupBy("h").agg(F.count("*").alias("n"), F.min(place).alias("keep")).filter("n > 1")
    rows = found.join(again, "h").select("doc_id", "__row", "word", "from_byte", "to_byte", F.col("n").cast("int").alias("n"), (place != F.col("keep")).alias("removed"), F.col("keep.last").alias("last"), F.col("keep.doc_id").alias("first_id"))
    w = Window.partitionBy("doc_id", "__row").orderBy("word")
    joins = (F.col("word") - F.lag("word").over(w) <= WINDOW) & (F.col("removed") == F.lag("removed").over(w))
    rows = rows.withColumn("new", F.when(joins, 0).otherwise(1)).withColumn("run", F.sum("new").over(w))
    least = F.min(F.struct("last", "first_id"))["first_id"]
    runs = rows.groupBy("doc_id", "__row", "run").agg(F.min("word").cast("long").alias("word"), (F.max("word") - F.min("word") + WINDOW).cast("long").alias("n_words"), F.min("from_byte").cast("long").alias("from_byte"), F.max("to_byte").cast("long").alias("to_byte"), least.alias("component_id"), F.max("n").cast("long").alias("n_copies"), F.any_value("removed").alias("removed"))
    return runs.filter(F.col("n_words") >= RUN).drop("run")


def passages_removed(docs: DataFrame) -> DataFrame:
    """docs with their columns, the repeated passages taken out of the texts."""
    return guarded(docs, _passages_removed)


def _passages_removed(docs: DataFrame) -> DataFrame:
    names = docs.columns
    gone = repeated_passages(docs.select("doc_id", "text")).filter("removed").groupBy("doc_id", "__row").agg(F.array_sort(F.collect_list(F.struct("from_byte", "to_byte"))).alias("__gone"))
    gone = gone.withColumnsRenamed({"doc_id": "__id", "__row": "__text"})
    both = docs.join(gone, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__text")), "left").drop("__id", "__text")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for x, spans in zip(b.column("text").to_pylist(), b.column("__gone").to_pylist(), strict=True):
                if spans:
                    raw, parts, done = x.encode(), [], 0
                    for sp in spans:
                        parts.append(raw[done : max(done, sp["from_byte"])])
                        done = max(done, sp["to_byte"])
                    x = b"".join([*parts, raw[done:]]).decode()
                texts.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else b.column(c) for c in names], names=names)

    return both.mapInArrow(apply, docs.schema)
