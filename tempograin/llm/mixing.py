"""Mixing sources to target weights by weighted fair queueing.

Every document of a source, in a shuffled order that depends on its id alone,
is a run of packets of at most ``PACKET`` words. A packet's virtual finish time is
the words its source has offered up to its end, divided by the source's target.
All packets of all copies, sorted by that time in ranges over the whole cluster,
are the queue; it is truncated where the running total reaches the budget, and
each document takes its packets before that place (the one there in part).

Only DataFrame operations. The running sums inside a source, and those over the
queue, are taken in two steps (sums of ranges, then rows within a range), so a
source with a third of all rows is never one task's work.

Defined cases: a null text, or one of blanks, has size 0 and is taken 0 words;
a null source is a source of its own, last in order; a null doc_id is shuffled
by its text; repeated rows are rows of their own; packets that finish at one time
are served in the order of their sources; a very long text is no different, its
packets alternate with others'; an empty table gives an empty mix; further columns
of the input pass through ``mix_documents`` untouched (one named ``taken`` is
replaced).
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5, 2, 1)
#: A source is taken at most this many times over.
MOST_COPIES = 3
#: Words of a packet at most: a source's share of the mix is met within so many.
PACKET = 32
#: Rows that share one range of the shuffle order, about; ranges of the queue at most.
RANGE_ROWS, QUEUE_RANGES = 4_000, 10_000


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, copies: int = MOST_COPIES) -> DataFrame:
    """sizes (source, source_size), a row for each source -> place (in order),
    total, target and latest (virtual time at which the budget is surely reached).

    The targets share the total by weight, but stop at ``copies`` times the
    source's size. With the caps sorted by cap over weight, the sources that
    stop are a prefix of that order; the rest share what is left by weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy(F.lit(0))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    after = by_level.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))
    return (
        sizes.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * copies)
        .withColumn("total", F.sum("source_size").over(every))
        .withColumn("stops", F.col("cap") * F.sum("weight").over(after) <= left * F.col("weight"))
        .withColumn("shared", F.col("total") - F.coalesce(F.sum(F.when(F.col("stops"), F.col("cap"))).over(every), F.lit(0)))
        .withColumn("sharing", F.sum(F.when(~F.col("stops"), F.col("weight"))).over(every))
        .withColumn("target", F.when(F.col("stops"), F.col("cap").cast("double")).otherwise(F.col("shared").cast("double") * F.col("weight") / F.col("sharing")))
        # Each source is behind by less than a packet, so the budget is reached by then.
        .withColumn("latest", 1 + F.try_divide(F.count("*").over(every) * PACKET, F.sum(F.when(~F.col("stops"), F.col("target"))).over(every)))
        .select("source", "source_size", "place", "total", "target", "latest")
    )


def fair_queue(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, copies: int = MOST_COPIES, keep_row: bool = True) -> DataFrame:
    """docs (doc_id, text, source, ...) -> for each document doc_id, source,
    size, ``ahead`` (words of its source before it in the shuffled order), what
    ``source_targets`` says of its source, and ``row``, a struct of the input's
    columns, if kept.
    """
    order = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.col("text")))
    row = [F.struct("*").alias("row")] * keep_row
    rows = docs.select(*row, "doc_id", "source", n_words(F.col("text")).alias("size"), order.alias("order"))
    parts = max(1, -(-docs.count() // RANGE_ROWS))
    # The upper 31 bits of the hash deal the rows to ranges of the order.
    rows = rows.withColumn("range", F.floor(F.shiftrightunsigned("order", 33) * F.lit(parts) / F.lit(2.0**31)).cast("int"))
    ranges = rows.groupBy("source", "range").agg(F.sum("size").alias("words"))
    sizes = ranges.groupBy("source").agg(F.sum("words").alias("source_size"))
    before = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    targets = source_targets(sizes, weights, copies).withColumnRenamed("source", "of")
    ranges = ranges.withColumn("ahead_of_range", F.coalesce(F.sum("words").over(before), F.lit(0))).drop("words")
    ranges = ranges.join(targets, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumnsRenamed({"source": "of", "range": "of_range"})
    inside = Window.partitionBy("source", "range").orderBy("order", "size").rowsBetween(Window.unboundedPreceding, -1)
    return (
        rows.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(ranges, F.col("source").eqNullSafe(F.col("of")) & (F.col("range") == F.col("of_range")))
        .withColumn("ahead", F.col("ahead") + F.col("ahead_of_range"))
        .drop("of", "of_range", "ahead_of_range", "range", "order")
    )


class Cut(NamedTuple):
    """Where the queue ends: the packet there, and how many of its words are served."""

    finish: float
    place: int
    words: int


def _finish(start: Column, end: Column | int) -> Column:
    """Virtual finish time of words that end so many after the start; null where the source has no words."""
    return F.try_divide(start + end, F.col("target"))


def _packet_end(packet: Column) -> Column:
    return F.least((packet + 1) * PACKET, F.col("size"))


def _start(copy: Column | int) -> Column:
    return F.lit(copy) * F.col("source_size") + F.col("ahead")


def queue_end(queue: DataFrame, copies: int = MOST_COPIES) -> Cut:
    """Sorts the packets of all copies by finish time, in ranges, and truncates
    them at the budget, the words of all documents. A copy whose packets all lie in one
    range is added up whole; packets are rows only where a copy reaches
    over the end of a range, and in the range of the cut."""
    ranges = min(QUEUE_RANGES, 8 * max(1, -(-queue.count() // RANGE_ROWS)))
    # The queue serves words evenly in virtual time, so equal ranges of it are equal work.
    of = lambda f: F.floor(f / F.col("latest") * ranges)
    finished = lambda packet: _finish(F.col("start"), _packet_end(packet))
    words = lambda packet: _packet_end(packet) - packet * PACKET
    rows = queue.filter("size > 0").withColumn("start", F.explode(F.array(*map(_start, range(copies))))).filter(F.col("start") <= F.col("latest") * F.col("target"))
    rows = rows.withColumns({"packets": F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / PACKET)), "first": of(finished(F.lit(0))), "last": of(_finish(F.col("start"), F.col("size")))})
    parts = F.transform("packets", lambda p: F.struct(of(finished(p)).alias("range"), words(p).cast("long").alias("words")))
    whole = F.array(F.struct(F.col("first").alias("range"), F.col("size").alias("words")))
    shares = rows.select("total", F.explode(F.when(F.col("first") == F.col("last"), whole).otherwise(parts)).alias("s")).select("total", "s.*")
    sums = shares.groupBy("range").agg(F.sum("words").alias("words"), F.max("total").alias("total"))
    before = lambda *keys: F.coalesce(F.sum("words").over(Window.partitionBy(*keys[:-1]).orderBy(*keys[-1]).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    reached = (F.col("before") < F.col("total")) & (F.col("before") + F.col("words") >= F.col("total"))
    last = sums.withColumn("before", before(F.lit(0), ["range"])).filter(reached).first()
    if last is None:
        return Cut(float("inf"), 0, 0)
    near = rows.filter((F.col("first") <= last["range"]) & (F.col("last") >= last["range"])).withColumn("packet", F.explode("packets"))
    near = near.select("place", "total", finished(F.col("packet")).alias("finish"), words(F.col("packet")).alias("words"), of(finished(F.col("packet"))).alias("range")).filter(F.col("range") == last["range"])
    at = near.withColumn("before", F.lit(last["before"]) + before("range", ["finish", "place"])).filter(reached).first()
    return Cut(at["finish"], at["place"], at["total"] - at["before"])


def _served(copy: Column | int, cut: Cut) -> Column:
    """Words of a copy before the cut: whole copies, none, or those of its packets."""
    early = lambda f: (f < cut.finish) | ((f == cut.finish) & (F.col("place") < cut.place))
    at = lambda f: (f == cut.finish) & (F.col("place") == cut.place)
    start = _start(copy)
    first = _finish(start, _packet_end(F.lit(0)))

    def add(total: Column, packet: Column) -> Column:
        f, words = _finish(start, _packet_end(packet)), _packet_end(packet) - packet * PACKET
        return total + F.when(early(f), words).when(at(f), F.lit(cut.words)).otherwise(F.lit(0)).cast("long")

    packets = F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / PACKET))
    part = F.when(early(first) | at(first), F.aggregate(packets, F.lit(0).cast("long"), add)).otherwise(F.lit(0))
    return F.when(F.col("size") == 0, F.lit(0)).when(early(_finish(start, F.col("size"))), F.col("size")).otherwise(part).cast("long")


def finish(copy: Column | int = 0) -> Column:
    """Virtual finish time of a copy; null where the source has no words."""
    return _finish(_start(copy), F.col("size"))


def taken(queue: DataFrame, cut: Cut, copies: int = MOST_COPIES) -> DataFrame:
    """Each row of the queue with ``taken``, the words of all its copies, and
    the finish time of the first."""
    return queue.withColumn("taken", sum((_served(c, cut) for c in range(1, copies)), _served(0, cut))).withColumn("finish", finish())


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, copies: int = MOST_COPIES) -> DataFrame:
    """docs (doc_id, text, source) -> every document's doc_id, size, source_size,
    target and taken, sorted over the cluster by its first copy's finish."""
    queue = stored(fair_queue(docs.select("doc_id", "source", "text"), weights, copies, keep_row=False))
    return taken(queue, queue_end(queue, copies), copies).orderBy("finish").select("doc_id", "size", "source_size", "target", "taken")


def _with_rows(docs: DataFrame, weights: tuple[int, ...], copies: int) -> tuple[DataFrame, Cut]:
    slim = stored(fair_queue(docs.select("doc_id", "source", "text"), weights, copies, keep_row=False))
    return fair_queue(docs, weights, copies), queue_end(slim, copies)


def mix_copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, copies: int = MOST_COPIES) -> DataFrame:
    """The mix itself, a row for each copy, sorted over the cluster by virtual
    finish time: ``row``, copy, finish, served."""
    queue, cut = _with_rows(docs, weights, copies)
    every = queue.filter("size > 0").select("*", F.explode(F.array(*(F.struct(F.lit(c).alias("copy"), finish(c).alias("finish"), _served(c, cut).alias("served")) for c in range(copies)))).alias("one"))
    return every.select("row", "one.*").filter("served > 0").orderBy("finish", "copy")


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, copies: int = MOST_COPIES) -> DataFrame:
    """The documents of the mix with all their columns, and ``taken``, sorted
    over the cluster by their first copy's finish; those with no word taken go."""
    queue, cut = _with_rows(docs, weights, copies)
    return taken(queue, cut, copies).filter("taken > 0").orderBy("finish").select(*(f"row.{c}" for c in docs.columns if c != "taken"), "taken")
