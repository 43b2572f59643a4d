"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint has a bit set where over half the 64-bit hashes of its word
shingles, repeats included, have it set. Fingerprints that differ in at most
two bits are linked; links make components.

Equal fingerprints are one class, so copies never meet each other. Each class is
put in two tables, by the low and by the high half of its bits. If two classes
differ in two bits at most, they differ in one bit of the low half or fewer, or
else not at all in the high half: so the low table is asked for the ball of
radius one around the low half (the half itself and what setting one clear bit
gives, as the class with the bit clear asks for the one with it set), and the
high table for the high half itself. Whatever a table holds there is verified by
its whole distance.

A place of a table with more than ``FULL`` classes isn't walked: each class that
asks for it enumerates the ball around the other half with the bits that are left
to differ, and looks these whole fingerprints up, of which there is one class
each. So no place, however many classes meet there, makes pairs of all.

Defined cases: A-Z are lower-cased, words are what blanks and tab to carriage
return leave; a text of fewer words than a shingle has one shingle, of all its
words; a null, empty or blank text has the fingerprint zero and is linked as any
other; repeated rows have a row each; the component of rows without an id is null
only if none of its rows has one; very long texts are hashed whole; further
columns are ignored, and pass through the removal whatever their names; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from . import similar
from .common import cut, few, guarded, raw_texts, slices, stored

WORDS, BITS, SEED = 3, 2, 42
#: Classes at a place of a table that are compared one by one.
FULL = 64
#: A class with a share of one in so many rows, or more, is joined from a list, which is no longer than this.
OFTEN = 1_000
_HALF, _LOW = 32, (1 << 32) - 1
#: Shingles whose bits are added up at a time.
_AT_ONCE = 1 << 16


def fingerprint(text: bytes, k: int = WORDS) -> int:
    """The fingerprint of a text, as a signed 64-bit number."""
    text = b" ".join(text.lower().split())
    if not text:
        return 0
    blanks = np.flatnonzero(np.frombuffer(text, dtype=np.uint8) == 32)
    first, last = np.append(0, blanks + 1), np.append(blanks, len(text))
    n = max(1, len(first) - k + 1)
    ends = last[k - 1 :] if len(first) >= k else last[-1:]
    votes = np.zeros(64, dtype=np.int64)
    for i in range(0, n, _AT_ONCE):
        h = np.array([xxhash.xxh64_intdigest(text[s:e], SEED) for s, e in zip(first[i : min(i + _AT_ONCE, n)].tolist(), ends[i : i + _AT_ONCE].tolist(), strict=True)], dtype=">u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n).view(">i8")[0])


def fingerprints(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """docs with all columns but the text, and ``fp``."""
    rest = [f for f in docs.schema.fields if f.name != "text"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            found = pa.array([fingerprint(x, k) for x in raw_texts(b.column("text"))], pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(f.name) for f in rest), found], names=[*(f.name for f in rest), "fp"])

    return docs.mapInArrow(scan, StructType([*rest, StructField("fp", LongType())]))


def _half(fp: Column, low: bool) -> Column:
    return fp.bitwiseAND(_LOW) if low else F.shiftrightunsigned(fp, _HALF)


def _flips(radius: int, high: bool) -> Column:
    """Masks of the changes of exactly ``radius`` bits in the low or the high half."""
    masks = [sum(1 << (i + _HALF * high) for i in c) for c in combinations(range(_HALF), radius)]
    return F.array(*(F.lit(m - (1 << 64) if m >> 63 else m) for m in masks))


def _asked(classes: DataFrame) -> DataFrame:
    """fp, table, place and flipped (bits flipped to get to the place), for each place that a class asks for."""
    bits = F.transform(F.sequence(F.lit(0), F.lit(_HALF - 1)), lambda i: F.call_function("shiftleft", F.lit(1).cast("long"), i))
    clear = F.filter(bits, lambda m: F.col("fp").bitwiseAND(m) == 0)
    low, at = _half(F.col("fp"), True), lambda table, place, n: F.struct(F.lit(table).alias("table"), place.alias("place"), F.lit(n).alias("flipped"))
    near = F.transform(clear, lambda m: at(0, low.bitwiseOR(m), 1))
    every = F.concat(F.array(at(0, low, 0), at(1, _half(F.col("fp"), False), 0)), near)
    return classes.select("fp", F.explode(every).alias("x")).select("fp", "x.*")


def _balls(asked: DataFrame) -> DataFrame:
    """fp, other: whole fingerprints to look up for those who ask for a full
    place. In the low table the high half differs in the bits that are left; in the
    high table, which serves what differs in two bits of the low half, exactly these do."""
    low = F.col("fp").bitwiseAND(~_LOW).bitwiseOR(F.col("place"))  # the place in the low table, with the class's own high half
    one, two = _flips(1, True), _flips(2, True)
    flips = F.when(F.col("table") == 1, _flips(BITS, False)).when(F.col("flipped") == 1, F.concat(F.array(F.lit(0).cast("long")), one)).otherwise(F.concat(one, two))
    start = F.when(F.col("table") == 1, F.col("fp")).otherwise(low)
    return asked.select("fp", F.explode(F.transform(flips, lambda m: start.bitwiseXOR(m))).alias("other"))


def linked(classes: DataFrame, full: int = FULL) -> DataFrame:
    """classes (fp), each once -> pairs (fp, other) that differ in at most two
    bits; every such pair, once or twice."""
    halves = F.array(F.struct(F.lit(0).alias("table"), _half(F.col("fp"), True).alias("place")), F.struct(F.lit(1).alias("table"), _half(F.col("fp"), False).alias("place")))
    placed = classes.select("fp", F.explode(halves).alias("x")).select("fp", "x.*")
    sizes = placed.groupBy("table", "place").agg(F.count("*").alias("size"))
    small = placed.join(sizes.filter(F.col("size") <= full), ["table", "place"])
    # Bounded lists: a place has ``full`` classes at most.
    tables = small.groupBy("table", "place").agg(F.collect_list("fp").alias("others")).unionByName(sizes.filter(F.col("size") > full).select("table", "place", F.lit(None).cast("array<long>").alias("others")))
    met = stored(_asked(classes).join(tables, ["table", "place"]).filter("others is null or flipped > 0 or size(others) > 1"))
    walked = met.filter("others is not null").select("fp", F.explode("others").alias("other"))
    near = walked.filter((F.col("fp") != F.col("other")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= BITS))
    looked_up = _balls(met.filter("others is null")).join(classes.select(F.col("fp").alias("other")), "other").select("fp", "other")
    return near.union(looked_up)


def _bytes(fp: Column) -> Column:
    return F.unhex(F.lpad(F.hex(fp), 16, "0"))


def near_duplicates(docs: DataFrame, k: int = WORDS, full: int = FULL) -> DataFrame:
    """docs (doc_id, text) -> doc_id, fp, fingerprint (16 hex digits),
    component_id (smallest doc_id of the component)."""
    return _labelled(stored(fingerprints(docs.select("doc_id", "text"), k)), full)


def _labelled(rows: DataFrame, full: int = FULL) -> DataFrame:
    """rows (doc_id, fp and any other columns) with fingerprint, component_id and
    label (of the component)."""
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    edges = linked(few(classes.select("fp")), full).select(_bytes(F.col("fp")).alias("a"), _bytes(F.col("other")).alias("b"))
    labels = similar.components(edges).select(F.conv(F.hex("cls"), 16, -10).cast("long").alias("fp"), "label")
    named = classes.join(labels, "fp", "left").withColumn("label", F.coalesce("label", _bytes(F.col("fp"))))
    least = named.groupBy("label").agg(F.min("least").alias("component_id"))
    known = cut(named.join(least, "label").select("fp", "component_id", "label", "n"))
    total = rows.count()
    # At most OFTEN classes have so many rows each.
    often = F.broadcast(known.filter(F.col("n") * OFTEN >= total).select("fp", F.struct("component_id", "label").alias("listed")))
    both = rows.join(often, "fp", "left")
    hot = both.filter("listed is not null").select(*rows.columns, "listed.component_id", "listed.label")
    rest = both.filter("listed is null").join(known.filter(F.col("n") * OFTEN < total).drop("n"), "fp")
    out = hot.unionByName(rest.drop("listed"))
    return out.withColumn("fingerprint", F.lower(F.lpad(F.hex("fp"), 16, "0")))


def duplicates_removed(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """docs with their columns: of each component only the rows of its smallest
    doc_id whose text has the smallest hash, repeated rows once."""
    return guarded(docs, lambda d: _duplicates_removed(d, k))


def _duplicates_removed(docs: DataFrame, k: int) -> DataFrame:
    slim = docs.select("doc_id", F.xxhash64("text").alias("__row"), "text")
    kept = _labelled(stored(fingerprints(slim, k))).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stays = kept.groupBy("label").agg(F.min("__row").alias("__row"), F.any_value("doc_id").alias("__id")).select("__id", "__row").distinct()
    both = docs.join(stays, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__row")))
    return both.groupBy("__id", "__row").agg(F.any_value(F.struct(*docs.columns)).alias("one")).select("one.*")
