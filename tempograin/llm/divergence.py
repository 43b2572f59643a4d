"""Source divergence audit: how far the words of each source are from those of
its language and of the language's other sources, and which terms tell it.

Terms are counted for each language and source; a language keeps the terms that
enough of its documents have. With N occurrences of V kept terms a group
(or a whole language) gives a term that occurs c times the share
p = 1 + floor(SCALE * (c + 2) / (N + 2 V)); two shares differ by
f = floor((p - q)^2 / (p + q)). A pair of sources differs by the sum of f over all
kept terms; a source's telling terms are those with p > q, q the language's, by f.

Telling terms are ranked by a dominance skyband: f rises with a term's count in
the group and falls with that in the language, so a term comes after every other
with a higher or equal count in the group, a lower or equal one in the
language and an earlier place in UTF-8. Terms that ``TOP`` or more dominate can't be
among the first ``TOP``: partitions drop them, the skybands that are left are merged (the
skyband of skybands is the whole's, so in any number of steps), and what is left is
ranked exactly.

Pairs need no table of sources by terms: a term that neither source has gives one
value, a term of one source depends on its count alone, so a histogram
of counts does; only terms that both have are met, in slices of the vocabulary.

Defined cases: null lang, source and text are empty ones; every row of the input is
a document, repeated ones too; a group without terms, and a language that
keeps none, have their pairs (0 where nothing is kept) and no telling term; ties of a
value are ranked by UTF-8; very long texts are counted whole; further columns are
ignored; an empty table gives an empty result. Shares are computed in whole numbers
without rounding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, joined, release, slices, stored, word_spans

LEAST_DOCS, TOP, SCALE = 10, 10, 1_000_000_000
#: Counts of terms of groups that a task holds before it adds them up; where more than half are left, it hands them on.
HELD = 1_000_000
#: Counts among which a task looks for skybands at a time, at least.
BANDED = 200_000
#: Counts of a language's terms that are met at a time, about.
TERMS = 200_000
#: Tasks whose skybands are merged at a time.
MERGED = 32
#: Bytes of terms: all but those up to 0x40, 0x5B to 0x60 and 0x7B to 0x7F.
_TERM = np.ones(256, dtype=bool)
_TERM[[*range(0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = False
_COUNTS = "lang string, source string, term string, n long, docs long"


def _numbered(b: pa.RecordBatch) -> tuple[np.ndarray, list[tuple[str, str]]]:
    """The group of each row, as its place in the list of groups."""
    found: dict[tuple[str, str], int] = {}
    of = [found.setdefault(g, len(found)) for g in zip(b.column("lang").to_pylist(), b.column("source").to_pylist(), strict=True)]
    return np.array(of, dtype=np.int64), list(found)


class _Counts:
    """Occurrences and documents of each term of each group, for a part of the rows:
    columns (group's number, term, occurrences, documents), added up when many are held."""

    def __init__(self):
        self.groups: dict[tuple[str, str], int] = {}
        self.parts: list[tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]] = []
        self.size = 0

    def hold(self, *part: np.ndarray | pa.Array) -> None:
        self.parts.append(part)
        self.size += len(part[0])

    def add(self, b: pa.RecordBatch) -> None:
        data, starts = joined(b.column("text"))
        low = LOWER[data]
        inside = _TERM[low]
        s, e = word_spans(inside)
        of, pair = _numbered(b)
        number = np.array([self.groups.setdefault(g, len(self.groups)) for g in pair], dtype=np.int64)
        if not len(s):  # a group without terms is a group
            return
        text = np.searchsorted(starts, s, side="right") - 1
        ends = np.concatenate([[0], np.cumsum(e - s)])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(s), [None, pa.py_buffer(ends), pa.py_buffer(low[inside])]).dictionary_encode()
        distinct = len(words.dictionary)
        # Group, term and text in one number, all small in a slice: sorted, equal ones lie together.
        key = (of[text] * distinct + words.indices.to_numpy()) * b.num_rows + text
        key.sort()
        new_doc = np.diff(key, prepend=-1) != 0
        key //= b.num_rows
        at = np.flatnonzero(np.diff(key, prepend=-1))
        n, key = np.diff(np.append(at, len(key))), key[at]
        self.hold(number[key // distinct], words.dictionary.take(pa.array(key % distinct)), n, np.add.reduceat(new_doc, at, dtype=np.int64))

    def add_up(self) -> None:
        """One row for each term of a group, instead of one for each slice."""
        if len(self.parts) < 2:
            return
        group, n, docs = (np.concatenate([p[c] for p in self.parts]) for c in (0, 2, 3))
        words = pa.concat_arrays([p[1] for p in self.parts]).dictionary_encode()
        distinct = len(words.dictionary)
        key = group * distinct + words.indices.to_numpy()
        order = np.argsort(key)
        key = key[order]
        at = np.flatnonzero(np.diff(key, prepend=-1))
        key = key[at]
        self.parts, self.size = [], 0
        self.hold(key // distinct, words.dictionary.take(pa.array(key % distinct)), np.add.reduceat(n[order], at), np.add.reduceat(docs[order], at))

    def batch(self) -> pa.RecordBatch:
        """All counts, and a row without a term for each group."""
        self.add_up()
        many = len(self.groups)
        none = np.arange(many), pa.nulls(many, pa.large_binary()), np.zeros(many, dtype=np.int64), np.zeros(many, dtype=np.int64)
        group, term, n, docs = zip(none, *self.parts, strict=True)
        lang, source = (pa.array([g[c] for g in self.groups], pa.string()).take(pa.array(np.concatenate(group))) for c in (0, 1))
        columns = [lang, source, pa.concat_arrays(term).cast(pa.binary()).cast(pa.string()), pa.array(np.concatenate(n)), pa.array(np.concatenate(docs))]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])


def _count(batches: Iterator[pa.RecordBatch], most: int = HELD) -> Iterator[pa.RecordBatch]:
    held = _Counts()
    for b in slices(batches):
        held.add(b)
        if held.size > most:
            held.add_up()
            if held.size > most // 2 or len(held.groups) > most:
                yield held.batch()
                held = _Counts()
            release()
    yield held.batch()


def term_counts(docs: DataFrame) -> DataFrame:
    """docs (text, lang, source) -> lang, source, term, n (occurrences), docs
    (documents with it); a row with a null term for each group."""
    known = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")), F.col("text"))
    counts = known.mapInArrow(_count, _COUNTS)
    return counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), exactly."""
    wide = lambda c: c.cast("decimal(20,0)")
    return (F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * wide(count + 2), wide(total + 2 * terms)) + 1).cast("long")


def apart(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)) of whole numbers below 2^31."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _shares(n: np.ndarray, total: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """The same as ``share``; three digits at a time keep it in 64 bits."""
    rest, below = n + 2, total + 2 * terms
    out = rest // below
    rest = rest % below
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // below
        rest = rest % below
    return out + 1


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def skyband(group: np.ndarray, lang: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Which of the points fewer than k others dominate: those with a higher or
    equal count in the group, a lower or equal one in the language, an earlier place."""
    order = np.lexsort((place, lang, -group))  # whoever dominates a point comes before it
    x, y = lang[order], place[order]
    kept = np.zeros(0, dtype=np.int64)
    for low in range(0, len(order), 512):
        block = np.arange(low, min(low + 512, len(order)))
        over = ((x[kept] <= x[block][:, None]) & (y[kept] < y[block][:, None])).sum(axis=1)
        block, over = block[over < k], over[over < k]
        inside = np.tril((x[block] <= x[block][:, None]) & (y[block] < y[block][:, None]), -1)
        # Dominators that went count no more: the first k of whoever has k or more are all in the skyband.
        kept = np.append(kept, block[over + inside.sum(axis=1) < k])
    out = np.zeros(len(order), dtype=bool)
    out[order[kept]] = True
    return out


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of so many or more (but the last), without empty ones."""
    held, size = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            size += b.num_rows
        if size >= rows:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _bands(k: int):
    """The rows (lang, source, term, n, lang_n) of some batches that are in the skyband of their group there."""

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _gathered(batches, BANDED):
            terms = b.column("term").cast(pa.binary())
            place = np.empty(b.num_rows, dtype=np.int64)
            place[pc.sort_indices(terms).to_numpy()] = np.arange(b.num_rows)
            groups = _numbered(b)[0]
            n, lang_n = b.column("n").to_numpy(), b.column("lang_n").to_numpy()
            order = np.argsort(groups, kind="stable")
            bounds = np.append(np.flatnonzero(np.diff(groups[order], prepend=-1)), len(order))
            keep = [i[skyband(n[i], lang_n[i], place[i], k)] for i in (order[s:e] for s, e in zip(bounds, bounds[1:], strict=False))]
            yield b.take(pa.array(np.concatenate(keep)))

    return bands


def telling_terms(kept: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """kept (lang, source, term, n, lang_n): counts of kept terms; groups (lang,
    source, total, lang_total, terms) -> lang, source, item, value, rank."""
    schema, k = "lang string, source string, term string, n long, lang_n long", top
    band = kept.select("lang", "source", "term", "n", "lang_n").mapInArrow(_bands(k), schema)

    def merged(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(_bands(k)(table.combine_chunks().to_batches())), table.schema)

    band = stored(band.withColumn("task", F.spark_partition_id() % MERGED).groupBy("lang", "source", "task").applyInArrow(lambda t: merged(t.drop_columns(["task"])), schema))
    band = band.groupBy("lang", "source").applyInArrow(merged, schema).join(groups, ["lang", "source"])
    p, q = share(F.col("n"), F.col("total"), F.col("terms")), share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    ranked = band.withColumns({"p": p, "q": q}).filter("p > q").withColumn("value", apart(F.col("p"), F.col("q")))
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")))
    return ranked.filter(F.col("rank") <= top).select("lang", "source", F.col("term").alias("item"), "value", "rank")


def _met(table: pa.Table) -> pa.Table:
    """Counts (lang, source, number, total, terms, term, n) of some terms of a
    language -> for each two sources with terms in common (one, other), what their sum
    of f gains over the terms of either counted as if the other had none."""
    number, n = table.column("number").to_numpy(), table.column("n").to_numpy()
    term = table.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
    total, terms = table.column("total").to_numpy(), table.column("terms").to_numpy()
    p, none = _shares(n, total, terms), _shares(np.zeros_like(n), total, terms)
    sources, of = np.unique(number, return_inverse=True)
    dense = np.zeros(int(term.max()) + 1, dtype=np.int64)  # of one source: its share of each term, 0 for none
    order = np.argsort(of, kind="stable")
    bounds = np.searchsorted(of[order], np.arange(len(sources) + 1))
    one, other, gain = [], [], []
    for g in range(len(sources) - 1):
        i = order[bounds[g] : bounds[g + 1]]
        dense[term[i]] = p[i]
        rest = order[bounds[g + 1] :]
        rest = rest[dense[term[rest]] > 0]
        if len(rest):
            x, y, x0, y0 = dense[term[rest]], p[rest], none[i[0]], none[rest]
            f = _apart(x, y) - _apart(x, y0) - _apart(x0, y) + _apart(x0, y0)
            start = np.flatnonzero(np.diff(of[rest], prepend=-1))
            one += [int(sources[g])] * len(start)
            other += sources[of[rest][start]].tolist()
            gain += np.add.reduceat(f, start).tolist()
        dense[term[i]] = 0
    lang = table.column("lang")[0].as_py()
    return pa.table({"lang": pa.array([lang] * len(one), pa.string()), "one": pa.array(one, pa.int64()), "other": pa.array(other, pa.int64()), "gain": pa.array(gain, pa.int64())})


def pair_sums(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """kept and groups as of ``telling_terms`` -> lang, source, item (each other
    source of the language), value."""
    own = groups.select("lang", "source", "total", "terms", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long").alias("number"))
    slices_ = F.greatest(F.lit(1), F.ceil(F.lit(kept.count() / TERMS)))
    counts = kept.select("lang", "source", "term", "n").join(own, ["lang", "source"]).withColumn("slice", F.pmod(F.xxhash64("term"), slices_))
    gains = counts.groupBy("lang", "slice").applyInArrow(lambda t: _met(t), "lang string, one long, other long, gain long")
    gains = gains.groupBy("lang", "one", "other").agg(F.sum("gain").alias("gain"))
    # Terms of one source as if the other had none: as many as its distinct counts.
    sizes = kept.groupBy("lang", "source", "n").agg(F.count("*").alias("of_size"))
    alone = sizes.groupBy("lang", "source").agg(F.sum("of_size").alias("has"))
    hist = sizes.join(own, ["lang", "source"])
    every = own.select("lang", F.col("number").alias("to"), F.col("total").alias("to_total"))
    f = apart(share(F.col("n"), F.col("total"), F.col("terms")), share(F.lit(0), F.col("to_total"), F.col("terms")))
    lone = hist.join(every, "lang").filter("number != to").withColumn("f", f * F.col("of_size")).groupBy("lang", "number", "to").agg(F.sum("f").alias("lone"))
    facts = own.join(alone, ["lang", "source"], "left").withColumn("has", F.coalesce("has", F.lit(0)))
    a = facts.select("lang", "terms", *(F.col(c).alias(f"a_{c}") for c in ("source", "number", "total", "has")))
    b = facts.select("lang", *(F.col(c).alias(f"b_{c}") for c in ("source", "number", "total", "has")))
    pairs = a.join(b, "lang").filter("a_number != b_number")  # what is returned: each source with each other
    pairs = pairs.join(lone.toDF("lang", "a_number", "b_number", "f_a"), ["lang", "a_number", "b_number"], "left").join(lone.toDF("lang", "b_number", "a_number", "f_b"), ["lang", "a_number", "b_number"], "left")
    pairs = pairs.withColumns({"one": F.least("a_number", "b_number"), "other": F.greatest("a_number", "b_number")}).join(gains, ["lang", "one", "other"], "left")
    none = F.when(F.col("terms") > 0, apart(share(F.lit(0), F.col("a_total"), F.col("terms")), share(F.lit(0), F.col("b_total"), F.col("terms"))) * (F.col("terms") - F.col("a_has") - F.col("b_has")))
    value = sum((F.coalesce(c, F.lit(0)) for c in (F.col("f_a"), F.col("f_b"), F.col("gain"), none)), F.lit(0).cast("long"))
    return pairs.select("lang", F.col("a_source").alias("source"), F.col("b_source").alias("item"), value.cast("long").alias("value"))


def audit(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """docs (text, lang, source) -> lang, source, part (pair or term), item,
    value, rank."""
    counts = stored(term_counts(docs))
    of_lang = counts.filter("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("lang_docs")).filter(F.col("lang_docs") >= least)
    kept = stored(counts.filter("term is not null").join(of_lang, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"))
    langs = of_lang.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.filter("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = stored(groups.select("lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "lang_total", "terms"))))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    pairs = pair_sums(kept, groups).withColumn("rank", rank)
    both = pairs.withColumn("part", F.lit("pair")).unionByName(telling_terms(kept, groups, top).withColumn("part", F.lit("term")))
    return both.select("lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank"))
