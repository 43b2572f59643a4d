"""SimHash against a plain version: all pairs, bit by bit."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from tempograin.llm import simhash


def plain_fingerprint(text, k=3):
    words = brute_words(text)
    grams = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_words(text):
    from .brute import LOWER, WORD

    return WORD.findall((text or "").translate(LOWER))


def plain_components(fps):
    """fps: (doc_id, fingerprint) -> smallest doc_id reachable, for each row."""
    values = sorted({f for _, f in fps})
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, x in enumerate(values):
        for y in values[i + 1 :]:
            if (x ^ y).bit_count() <= 2:
                parent[find(x)] = find(y)
    least = {}
    for d, f in fps:
        if d is not None:
            least[find(f)] = min(d, least.get(find(f), d))
    return [(d, f, least.get(find(f))) for d, f in fps]


LONG = " ".join(f"w{i % 977}" for i in range(140_000))
TEXTS = [(1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one\x0btwo"), (5, "one\x0btwo"), (6, "a b c d"), (7, "A  b\tc d "), (8, LONG), (9, LONG + " x"), (None, "one two"), (None, "alone here"), (10, "Ünter den Linden \x1c und so"), (11, "x" * 70_000)]


def test_against_plain(spark):
    df = spark.createDataFrame([(i, t, 1, "a", "b") for i, t in TEXTS], "doc_id long, text string, fp int, label string, component_id string")
    got = sorted(((r["doc_id"], int(r["fingerprint"], 16), r["component_id"]) for r in simhash.near_duplicates(df).collect()), key=repr)
    assert got == sorted(plain_components([(d, plain_fingerprint(t)) for d, t in TEXTS]), key=repr)
    out = simhash.duplicates_removed(df)
    assert out.columns == df.columns
    assert sorted(r["doc_id"] for r in out.collect() if r["doc_id"]) == sorted({c for d, _, c in got if d == c and d})
    assert out.filter("doc_id is null").count() == 1  # of those without id, the one that no other class holds


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(none).count() == 0 == simhash.duplicates_removed(none).count()


@pytest.mark.parametrize("full", [simhash.FULL, 2, 0])
def test_every_link(spark, full):
    """All pairs at two bits or fewer and no other, with few or all places full: crowded halves, sign bits, both ends of each half."""
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(12)] + [0, (1 << 64) - 1, 1 << 63, 1 << 31, 1 << 32]
    values = set(base)
    for x in base:
        for _ in range(14):
            values.add(x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    low = rng.getrandbits(32)
    values |= {low | rng.getrandbits(32) << 32 for _ in range(80)} | {low << 32 | 1 << b for b in range(32)}
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    got = {frozenset((r["fp"], r["other"])) for r in simhash.linked(spark.createDataFrame([(v,) for v in signed], "fp long"), full).collect()}
    want = {frozenset((x, y)) for i, x in enumerate(signed) for y in signed[i + 1 :] if ((x ^ y) & ((1 << 64) - 1)).bit_count() <= 2}
    assert len(want) > 300 and got == want


def test_hot_class(spark):
    """A third of all rows in one class, and a few in others: each row once."""
    rows = [(i, "the same text for all of these" if i % 3 else f"text number {i} of its own {i * 7}") for i in range(3_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = simhash.near_duplicates(df)
    assert got.count() == 3_000 and got.filter(F.col("component_id") == 1).count() >= 2_000
