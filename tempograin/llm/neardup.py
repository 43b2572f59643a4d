"""Near-duplicate documents by a chosen-path similarity join.

Documents are sets of word shingles. ``TREES`` independent trees branch them by
selected minwise tokens: each tree starts with two tokens of its own, so a pair
of similarity 0.8 shares a first node with probability 1 - 0.2**8; small nodes
are compared exhaustively and large ones branched further (``similar.link``).
Verified links make components, of which the document with the smallest id stays.

Defined cases: a null, empty or blank text has the empty set, is linked with
nothing and stays; a text of fewer words than a shingle is one shingle; equal
sets are linked; rows that share a doc_id are documents each, and of those that
would stay in a component for one id, the one with the smallest text hash does;
null ids are never the smallest unless all are null; very long texts are compared
by their whole sets; further columns pass through the removal untouched, whatever
their names.

Which pairs are found, whatever the size of the corpus: those that share a small
node, surely; in crowded nodes, those that share a longer path (``similar.PATHS``).
``recall_corpus`` of the tests measures it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import similar
from .common import LOWER, SPACES, cut, few, guarded, joined, schema_of, slices, word_hashes, word_spans

TREES, FIRST = 4, 2
WORDS, PERCENT = 5, 80


def _sets(batch: pa.RecordBatch, k: int):
    data, starts = joined(batch.column("text"))
    low = LOWER[data]
    s, e = word_spans(~SPACES[low])
    of = np.searchsorted(starts, s, side="right") - 1
    h, text = similar.shingles(word_hashes(low, s, e), of, batch.num_rows, k)
    return h, *similar.classes(h, text, batch.num_rows)


def _sketch(k: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            h, sizes, found, starts = _sets(b, k)
            values = similar.minhashes(h, starts) if len(h) else np.zeros((0, similar.COORDS), dtype=np.uint32)
            keys, sig = similar.node_keys(values[:, : TREES * FIRST], 1), (values & 0xFF).astype(np.uint8)
            at = iter(range(len(values)))
            row = [None if c is None else next(at) for c in found]
            rest = [n for n in b.schema.names if n != "text"]
            columns = [pa.array(found, pa.binary()), pa.array(sizes, pa.int64()), pa.array([None if r is None else sig[r].tobytes() for r in row], pa.binary()), pa.array([None if r is None else keys[r] for r in row], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in rest), *columns], names=[*rest, "cls", "n", "sig", "keys"])

    return sketch


def near_duplicates(docs: DataFrame, k: int = WORDS, percent: int = PERCENT, **limits) -> DataFrame:
    """docs (doc_id, text) -> doc_id, __row (hash of the text), n_shingles,
    component_id (smallest doc_id of the component), kept (doc_id is that id),
    label (of the component; null without shingles)."""
    slim = docs.select("doc_id", F.xxhash64("text").alias("__row"), "text")
    schema = schema_of([f for f in slim.schema.fields if f.name != "text"], "cls binary, n long, sig binary, keys array<long>")
    rows = cut(slim.mapInArrow(_sketch(k), schema))
    of_class = rows.filter("cls is not null").groupBy("cls").agg(*(F.any_value(c).alias(c) for c in ("n", "sig", "keys")), F.min("doc_id").alias("least"), F.min("__row").alias("one"))
    units = few(cut(of_class))

    def scan(batches):
        for b in slices(batches):
            h, _, found, starts = _sets(b, k)
            yield found, h, starts

    labels = similar.link(units.select("cls", "n", "sig", "keys"), similar.fetcher(scan, docs.select("text")), percent, **limits)
    least = units.select("cls", "least").join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    component = least.groupBy("label").agg(F.min("least").alias("component_id"))
    known = least.join(component, "label").select("cls", "label", "component_id")
    out = rows.drop("sig", "keys").join(known, "cls", "left")
    out = out.withColumn("component_id", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return out.select("doc_id", "__row", F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"), "label")


def duplicates_removed(docs: DataFrame, k: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One document of each component, and all those without shingles, with
    their columns."""
    return guarded(docs, lambda d: _duplicates_removed(d, k, percent))


def _duplicates_removed(docs: DataFrame, k: int, percent: int) -> DataFrame:
    words = F.coalesce(F.regexp_like("text", F.lit(r"[^\x20\x09-\x0D]")), F.lit(False))
    kept = near_duplicates(docs.filter(words).select("doc_id", "text"), k, percent).filter("kept")
    # Almost always one row already; equal ids in a component are told apart by the text.
    stays = kept.groupBy("label", "doc_id").agg(F.min("__row").alias("__row")).select(F.col("doc_id").alias("__id"), "__row")
    both = docs.filter(words).join(stays, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__row")))
    # Rows repeated whole: one of them stays.
    once = both.groupBy("__id", "__row").agg(F.any_value(F.struct(*docs.columns)).alias("one")).select("one.*")
    return once.union(docs.filter(~words))
