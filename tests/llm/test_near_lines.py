"""Recall of near copies of lines, whatever their length and the place of the change."""

import numpy as np
import pytest

from tempograin.llm import neardup, paragraphs

from . import brute


def lines_of(n_words, rng, kind):
    """A line and a near copy of it."""
    words = [f"w{x}" for x in rng.integers(0, 10**9, n_words)]
    other = list(words)
    new = lambda: f"n{rng.integers(0, 10**9)}"
    if kind == "first":
        other[0] = new()
    elif kind == "last":
        other[-1] = new()
    elif kind == "second":
        other[1] = new()
    elif kind == "before":
        other = [new(), *other]
    elif kind == "behind":
        other = [*other, new(), new()]
    elif kind == "both ends":
        other = [new(), *other, new()]
    elif kind == "inside":
        other[int(rng.integers(5, n_words - 5))] = new()
    return " ".join(words), " ".join(other)


KINDS = ["first", "last", "second", "before", "behind", "both ends", "inside"]


def test_recall_of_changed_lines(spark):
    rng = np.random.default_rng(2)
    rows, pairs = [], []
    for i in range(1500):
        one, other = lines_of(int(rng.integers(20, 61)), rng, KINDS[i % len(KINDS)])
        own = lambda: " ".join(f"o{x}" for x in rng.integers(0, 10**9, rng.integers(0, 30)))
        texts = (one, other) if i % 2 else (f"{own()}\n{one}\n{own()}", f"{own()}\n{other}")
        rows += [(2 * i, texts[0]), (2 * i + 1, texts[1])]
        a, b = brute.shingles(one, 5), brute.shingles(other, 5)
        if 100 * len(a & b) >= 80 * len(a | b):
            pairs.append((2 * i, 2 * i + 1))
    found = paragraphs.repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    component = {}
    for r in found:
        component.setdefault(r["doc_id"], set()).add(r["component_id"])
    hit = sum(bool(component.get(a, set()) & component.get(b, set())) for a, b in pairs)
    assert len(pairs) > 600 and hit >= 0.99 * len(pairs)
    assert all(min(c) >= d - d % 2 for d, c in component.items())  # no line of another pair


@pytest.mark.parametrize("likely", [0, 0.6])
def test_every_candidate_verified(spark, likely):
    """Without the sketch's filter the same links, none lost to it."""
    rng = np.random.default_rng(9)
    rows = []
    for i in range(60):
        one, other = lines_of(40, rng, KINDS[i % len(KINDS)])
        rows += [(2 * i, one), (2 * i + 1, other)]
    want = {d: c for d, _, c, _ in brute.near_duplicates(rows, 5)}
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5, likely=likely).collect()}
    assert got == want
