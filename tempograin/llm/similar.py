"""Links between texts whose shingle sets have a Jaccard similarity of at least
a threshold, and the components that the links make.

Works on classes (distinct shingle sets), so copies never meet each other. A
class comes with node keys (chosen by the caller: minwise tokens or bands) and a
sketch of 64 minwise bytes. Classes that share a node are candidates:

* a small node is compared exhaustively, on sketches;
* in a large node every class is compared with one of them (its hub), and its
  classes are branched again by ``PATHS`` longer paths: each node chooses the
  next minwise tokens, until nodes are small or all of one component;
* what is still large then is compared in blocks, those outside the node's
  largest component against all, so no candidate is given up.

Candidates are verified on the full sets, fetched once for each class that any names.
First the links of a spanning forest of each node, then those candidates that
still lie in different components: any other link is inside a component.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bloom import BlockedBloom
from .common import cut, few, mix64, stored, window_hashes

COORDS = 64
#: Classes in a node that is compared exhaustively.
SMALL = 24
#: Longer paths from the root, and their lengths. A pair of similarity 0.8 shares
#: one of length 5 almost surely, of length 7 with probability 0.996 and of length 9
#: with 0.975 (all draw on one sketch; at similarity 0.85 it is 0.997). A longer one
#: counts only where all shorter nodes that the pair shares are crowded.
PATHS, LENGTHS = 40, (5, 7, 9)
#: Similar bytes of a sketch from which a pair is verified, as a share: four
#: standard deviations below a similarity of 0.8. With 0 every candidate is verified.
LIKELY = 0.6
_RANDOM = np.random.default_rng(20240229)
_A = _RANDOM.integers(0, 1 << 63, COORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RANDOM.integers(0, 1 << 63, COORDS, dtype=np.uint64)


def shingles(words: np.ndarray, of: np.ndarray, n_texts: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of k words (all words, where there are
    fewer) and the text each is of, sorted by text and hash. ``of``: the text of
    each word."""
    h = window_hashes(words, k)
    own = of[: len(h)] == of[k - 1 :] if len(h) else np.zeros(0, dtype=bool)
    h, text = h[own], of[: len(h)][own]
    counts = np.bincount(of, minlength=n_texts)
    first = np.searchsorted(of, np.arange(n_texts))
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        h = np.concatenate([h, [window_hashes(words[first[i] : first[i] + counts[i]], int(counts[i]))[0] ^ np.uint64(counts[i]) for i in short]]).astype(np.uint64)
        text = np.concatenate([text, short])
    order = np.lexsort((h, text))
    h, text = h[order], text[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
    return h[new], text[new]


def classes(h: np.ndarray, text: np.ndarray, n_texts: int) -> tuple[np.ndarray, list[bytes | None], np.ndarray]:
    """Set sizes; a 128-bit digest of each set, None for the empty one; and the
    first shingle of each set that isn't empty."""
    sizes = np.bincount(text, minlength=n_texts)
    starts = np.flatnonzero(np.diff(text, prepend=-1))
    out: list[bytes | None] = [None] * n_texts
    if len(h):
        d = np.stack([np.add.reduceat(mix64(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts), np.add.reduceat(mix64(h + np.uint64(0x1234567)), starts)], axis=1).astype(">u8").tobytes()
        for j, i in enumerate(text[starts].tolist()):
            out[i] = d[16 * j : 16 * j + 16]
    return sizes, out, starts


def minhashes(h: np.ndarray, starts: np.ndarray, n: int = COORDS) -> np.ndarray:
    """A row of the first n minwise values for each set."""
    out = np.empty((len(starts), n), dtype=np.uint32)
    for i in range(n):
        out[:, i] = np.minimum.reduceat(((h * _A[i] + _B[i]) >> np.uint64(32)).astype(np.uint32), starts)
    return out


def node_keys(values: np.ndarray, band: int) -> np.ndarray:
    """A 64-bit key for each ``band`` columns of minwise values."""
    v = values.astype(np.uint64).reshape(len(values), values.shape[1] // band, band)
    key = np.tile(np.arange(v.shape[1], dtype=np.uint64), (len(v), 1))
    for i in range(band):
        key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + v[:, :, i] + np.uint64(1))
    return key.view(np.int64)


def _agree(sketches: np.ndarray, one: np.ndarray) -> np.ndarray:
    return (sketches == one).mean(axis=-1)


def _members(column: pa.Array) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, list[bytes]]]:
    for group in column.to_pylist():
        group.sort(key=lambda m: m["cls"])
        yield [m["cls"] for m in group], np.array([m["n"] for m in group]), np.frombuffer(b"".join(m["sig"] for m in group), dtype=np.uint8).reshape(len(group), COORDS), [m["label"] for m in group]


def _find(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


_PAIRS = "a binary, b binary, first boolean"


def _node_pairs(percent: int, least: float):
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for ids, n, sig, labels in _members(b.column("members")):
                i, j = np.triu_indices(len(ids), 1)
                likely = _agree(sig[i], sig[j])
                use = (likely >= least) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
                parent = list(range(len(ids)))
                for x, y, _ in sorted(zip(i[use].tolist(), j[use].tolist(), (-likely[use]).tolist(), strict=True), key=lambda p: p[2]):
                    if labels[x] != labels[y]:
                        rx, ry = _find(parent, x), _find(parent, y)
                        parent[rx] = ry
                        out.append((ids[x], ids[y], rx != ry))
            a, c, f = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(c, pa.binary()), pa.array(f, pa.bool_())], names=["a", "b", "first"])

    return pairs


def _likely_rows(percent: int, least: float):
    """Rows (cls, n, sig, hub, hub_n, hub_sig) -> pairs."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                sig, hub = (np.frombuffer(b"".join(b.column(c).to_pylist()), dtype=np.uint8).reshape(-1, COORDS) for c in ("sig", "hub_sig"))
                n, m = (b.column(c).to_numpy() for c in ("n", "hub_n"))
                use = pa.array((_agree(sig, hub) >= least) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m)))
                a = b.column("hub").filter(use)
                yield pa.RecordBatch.from_arrays([a, b.column("cls").filter(use), pa.array(np.ones(len(a), dtype=bool))], names=["a", "b", "first"])

    return pairs


def _block_links(percent: int):
    """A group: classes of a node (cls, label, grams), and some of those outside
    its largest component (query). -> links between the two that hold on the full
    sets, as many as join their components."""

    def links(group: pa.Table) -> pa.Table:
        ids, grams = group.column("cls").to_pylist(), [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in group.column("grams")]
        labels, query = group.column("label").to_pylist(), group.column("query").to_numpy(zero_copy_only=False).astype(bool)
        size = np.array([len(g) for g in grams])
        values, place = np.unique(np.concatenate(grams), return_inverse=True)
        row = np.repeat(np.arange(len(ids)), size)
        both = np.zeros((int((~query).sum()), int(query.sum())), dtype=np.float32)
        step = max(1, 8_000_000 // len(ids))
        for low in range(0, len(values), step):  # the sets as 0 and 1, some shingles at a time
            here = (place >= low) & (place < low + step)
            has = np.zeros((len(ids), min(step, len(values) - low)), dtype=np.float32)
            has[row[here], place[here] - low] = 1
            both += has[~query] @ has[query].T
        x, y = np.flatnonzero(~query), np.flatnonzero(query)
        either = size[x][:, None] + size[y][None, :] - both
        out, parent = [], {}

        def find(label: bytes) -> bytes:
            while parent.get(label, label) != label:
                label = parent[label]
            return label

        for i, j in zip(*np.nonzero(100 * both >= percent * either), strict=True):
            one, other = find(labels[x[i]]), find(labels[y[j]])
            if one != other:
                parent[one] = other
                out.append((ids[x[i]], ids[y[j]]))
        return pa.table([pa.array([p[0] for p in out], pa.binary()), pa.array([p[1] for p in out], pa.binary())], names=["a", "b"])

    return links


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links -> each class they name with the smallest that they join it to."""
    parent: dict[bytes, bytes] = {}

    def find(c: bytes) -> bytes:
        root = c
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[c] != root:
            parent[c], c = root, parent[c]
        return root

    for b in batches:
        for x, y in zip(b.column("a").to_pylist(), b.column("b").to_pylist(), strict=True):
            x, y = find(x), find(y)
            parent[max(x, y)] = min(x, y)
    names = list(parent)
    yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array([find(c) for c in names], pa.binary())], names=["a", "b"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union of the sets."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), dtype=np.uint64), np.frombuffer(y.as_buffer(), dtype=np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])

    one, two = sets.select(F.col("cls").alias("a"), F.col("grams").alias("x")), sets.select(F.col("cls").alias("b"), F.col("grams").alias("y"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y").mapInArrow(verify, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) -> cls, label (the smallest class of its component), for
    every class with an edge. What a task's edges join is joined at once; only
    where tasks differ on a class are their answers joined in turn."""
    stars = few(cut(edges.mapInArrow(_forest, "a binary, b binary")))
    least = few(cut(stars.groupBy("a").agg(F.min("b").alias("low"))))
    differ = few(cut(stars.join(least, "a").filter("b != low").select(F.col("low").alias("a"), "b").distinct()))
    if differ.isEmpty():
        return least.toDF("cls", "label")
    roots = _propagated(differ).toDF("low", "label")
    return few(cut(least.join(roots, "low", "left").select(F.col("a").alias("cls"), F.coalesce("label", "low").alias("label"))))


def _propagated(edges: DataFrame) -> DataFrame:
    """The same, by least labels of neighbours with pointer jumping, until
    nothing changes."""
    ways = [F.struct(F.col(x).alias("cls"), F.col(y).alias("to")) for x in "ab" for y in "ab"]
    both = edges.select(F.explode(F.array(*ways)).alias("e")).select("e.cls", "e.to")
    both = few(cut(both.distinct()))
    labels = few(cut(both.groupBy("cls").agg(F.min("to").alias("label"))))
    while True:
        told = both.join(labels.withColumnRenamed("cls", "to"), "to").groupBy("cls").agg(F.min("label").alias("low"), F.max(F.when(F.col("to") == F.col("cls"), F.col("label"))).alias("old"))
        jump = told.select(F.col("cls").alias("low"), F.col("low").alias("far"))
        now = few(cut(told.join(jump, "low").select("cls", "old", F.least("low", "far").alias("label"))))
        labels = now.select("cls", "label")
        if now.filter("label != old").isEmpty():
            return labels


def _with_label(rows: DataFrame, labels: DataFrame, cls: str, label: str) -> DataFrame:
    known = labels.select(F.col("cls").alias(cls), F.col("label").alias(label))
    return rows.join(known, cls, "left").withColumn(label, F.coalesce(label, cls))


def _member(label: Column | str = "label") -> Column:
    return F.collect_list(F.struct("cls", "n", "sig", F.col(label).alias("label") if isinstance(label, str) else label.alias("label")))


def _longer(node: Column, steps: int) -> Column:
    """The node's child for a class: it chooses a coordinate, the class's minwise
    byte there is the branch; ``steps`` times."""
    for _ in range(steps):
        place = F.pmod(F.xxhash64(node, F.lit("place")), F.lit(COORDS)).cast("int") + 1
        node = F.xxhash64(node, F.substring("sig", place, F.lit(1)))
    return node


def link(units: DataFrame, fetch: Callable[[DataFrame], DataFrame], percent: int = 80, small: int = SMALL, lengths: tuple[int, ...] = LENGTHS, likely: float = LIKELY) -> DataFrame:
    """units (cls, n, sig, keys), a row for each class; fetch: from a DataFrame
    of cls to (cls, grams) -> the cls and label of every class with a link. Pairs
    whose sketches agree less than ``likely`` aren't verified; 0 verifies all."""
    facts = units.select("cls", "n", "sig")
    nodes = units.select("cls", F.explode("keys").alias("node"))
    shared = nodes.groupBy("node").agg(F.count("*").alias("size"), F.min("cls").alias("hub")).filter("size > 1")
    rows = few(cut(nodes.join(shared, "node").join(facts, "cls")))
    pairs = rows.filter(F.col("size") <= small).groupBy("node").agg(_member("cls").alias("members")).select("members").mapInArrow(_node_pairs(percent, likely), _PAIRS)
    hubs = facts.select(F.col("cls").alias("hub"), F.col("n").alias("hub_n"), F.col("sig").alias("hub_sig"))
    wide = rows.filter((F.col("size") > small) & (F.col("cls") != F.col("hub")))
    pairs = pairs.union(wide.select("cls", "n", "sig", "hub").distinct().join(hubs, "hub").mapInArrow(_likely_rows(percent, likely), _PAIRS))
    pairs = few(cut(pairs.groupBy("a", "b").agg(F.max("first").alias("first"))))

    # The sets of all classes that any later candidate can name, fetched once.
    crowded = stored(rows.filter(F.col("size") > small).groupBy("cls").agg(F.any_value("n").alias("n"), F.any_value("sig").alias("sig")))
    sets = stored(fetch(stored(pairs.select(F.explode(F.array("a", "b")).alias("cls")).union(crowded.select("cls")).distinct())))

    def check(some: DataFrame) -> DataFrame:
        return few(cut(_verified(some.select("a", "b"), sets, percent)))

    edges = check(pairs.filter("first"))
    labels = components(edges)
    # Second round: candidates between what are different components so far.
    rest = pairs.filter("not first").select("a", "b")
    level = _with_label(crowded, labels, "cls", "label").withColumn("root", F.explode(F.sequence(F.lit(1), F.lit(PATHS)))).select(_longer(F.xxhash64("root"), lengths[0]).alias("node"), "cls", "n", "sig", "label")
    for at, length in enumerate(lengths):
        stats = level.groupBy("node").agg(F.count("*").alias("size"), F.min("label").alias("low"), F.max("label").alias("high")).filter("low != high").select("node", "size")
        level = few(cut(level.join(stats, "node")))
        if level.isEmpty():
            break
        rest = rest.union(level.filter(F.col("size") <= small).groupBy("node").agg(_member().alias("members")).select("members").mapInArrow(_node_pairs(percent, likely), _PAIRS).select("a", "b"))
        level = level.filter(F.col("size") > small)
        if at + 1 == len(lengths):
            edges = edges.union(_in_blocks(few(cut(level)), sets, percent))
        else:
            level = level.select(_longer(F.col("node"), lengths[at + 1] - length).alias("node"), "cls", "n", "sig", "label")
    more = _with_label(_with_label(rest.distinct(), labels, "a", "la"), labels, "b", "lb").filter("la != lb")
    more = few(cut(more))
    return components(edges.union(check(more)))


def _in_blocks(level: DataFrame, sets: DataFrame, percent: int, block: int = 256) -> DataFrame:
    """Links of each node's classes outside its largest component with all of
    it, on full sets, block by block."""
    sizes = level.groupBy("node", "label").agg(F.count("*").alias("n_label"))
    main = sizes.groupBy("node").agg(F.max(F.struct("n_label", "label")).alias("m"), F.sum("n_label").alias("all"))
    main = main.select("node", F.col("m.label").alias("main"), F.ceil((F.col("all") - F.col("m.n_label")) / block).cast("int").alias("n_few"), F.ceil(F.col("all") / block).cast("int").alias("n_many"))
    rows = level.select("node", "cls", "label").join(main, "node").join(sets, "cls")
    deal = lambda seed, n: F.pmod(F.xxhash64("cls", F.lit(seed)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["node", "few_at", "many_at", "cls", "label", "grams", "query"]
    members = rows.withColumns({"many_at": deal(1, "n_many"), "query": F.lit(False)}).withColumn("few_at", every("n_few")).select(*columns)
    queries = rows.filter("label != main").withColumns({"few_at": deal(2, "n_few"), "query": F.lit(True)}).withColumn("many_at", every("n_many")).select(*columns)
    return members.union(queries).groupBy("node", "few_at", "many_at").applyInArrow(_block_links(percent), "a binary, b binary")


def fetcher(scan: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[list[bytes | None], np.ndarray, np.ndarray]]], texts: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """``scan`` gives, for batches of texts, the classes, shingles and starts of
    their sets; the fetcher reads the texts again and returns the sets of the
    classes asked for, each once."""

    def fetch(ids: DataFrame) -> DataFrame:
        filter_ = ids.sparkSession.sparkContext.broadcast(BlockedBloom.build(ids.select(F.xxhash64("cls").alias("h")), "h", ids.count()))

        def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[bytes] = set()
            for found, h, starts in scan(batches):
                with_set = [c for c in found if c is not None]
                hashes = np.array([xxhash.xxh64_intdigest(c, seed=42) for c in with_set], dtype=np.uint64).view(np.int64)
                ends, ids_, grams = [*starts[1:].tolist(), len(h)], [], []
                for j in np.flatnonzero(filter_.value.might_contain(hashes)).tolist():
                    if with_set[j] not in seen:
                        seen.add(with_set[j])
                        ids_.append(with_set[j])
                        grams.append(h[starts[j] : ends[j]].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(ids_, pa.binary()), pa.array(grams, pa.binary())], names=["cls", "grams"])

        return texts.mapInArrow(sets, "cls binary, grams binary").join(ids, "cls", "left_semi").groupBy("cls").agg(F.max("grams").alias("grams"))

    return fetch
