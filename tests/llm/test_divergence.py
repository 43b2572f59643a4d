"""The divergence audit against a plain version; its skyband against all pairs."""

import itertools
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tempograin.llm import divergence

from .brute import LOWER

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def plain(rows, least=10, top=10):
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), set()
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = TERM.findall((text or "").translate(LOWER))
        count[lang, source].update(words)
        docs[lang].update(set(words))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        mine = sorted(s for x, s in groups if x == lang)
        whole = Counter()
        for s in mine:
            whole.update(count[lang, s])
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[x] for x in kept) + 2 * len(kept)) for t in kept}
        p, q = {s: share(count[lang, s]) for s in mine}, share(whole)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in mine:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in mine if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if count[lang, s][t] > 0 and p[s][t] > q[t]]
            order = lambda x: (-x[1], x[0].encode())
            out += [(lang, s, "pair", o, v, i + 1) for i, (o, v) in enumerate(sorted(pairs, key=order))]
            out += [(lang, s, "term", t, v, i + 1) for i, (t, v) in enumerate(sorted(terms, key=order)[:top])]
    return sorted(out)


def got(spark, rows, **limits):
    df = spark.createDataFrame([(t, x, s, 1, "a", "b") for t, x, s in rows], "text string, lang string, source string, n int, term string, value string")
    return sorted(tuple(r) for r in divergence.audit(df, **limits).collect())


def corpus(n, seed=5):
    rng = np.random.default_rng(seed)
    words = np.array([f"{a}{b}" for a in "abcdeé漢ZQ" for b in "xyzuvwäß"])
    rows = []
    for i in range(n):
        source = [None, "", "s1", "s2", "s3", "S\0"][min(5, int(rng.zipf(1.6)) - 1)]
        lang = ["en", "de", None][i % 7 // 3]
        shift = 0 if source in ("s1", None) else 9
        rows.append((" ".join(words[(np.minimum(rng.zipf(1.4, rng.integers(0, 60)), 60) + shift) % len(words)]) + rng.choice(["", " 4x7_y", " A-B!"]), lang, source))
    return rows


ODD = [(None, "en", "s1"), ("", None, None), ("\n", "fr", "only"), ("x" * 80_000 + " ax ax", "en", "s2"), ("solo", "it", "a"), ("solo", "it", "b")]


@pytest.mark.parametrize("least", [1, 10])
def test_against_plain(spark, least):
    rows = corpus(250) + ODD + ODD[:1]
    assert got(spark, rows, least=least) == plain(rows, least)


def test_few_at_a_time(spark, monkeypatch):
    """Counts handed on often, and a vocabulary in many slices."""
    monkeypatch.setattr(divergence, "TERMS", 20)
    rows = corpus(120, 8)
    assert got(spark, rows, least=2, top=3) == plain(rows, 2, 3)


def counted(rows, **limits):
    """What the batches of a task add up to: occurrences and documents of each term of a group."""
    out = defaultdict(lambda: [0, 0])
    text, lang, source = (pa.array(c, pa.string()) for c in zip(*rows, strict=True))
    batch = pa.RecordBatch.from_arrays([lang, source, text], names=["lang", "source", "text"])
    made = list(divergence._count(iter([batch.slice(i, 40) for i in range(0, len(rows), 40)]), **limits))
    for b in made:
        for r in b.to_pylist():
            now = out[r["lang"], r["source"], r["term"]]
            now[0] += r["n"]
            now[1] += r["docs"]
    return {k: tuple(v) for k, v in out.items()}, made


def counted_plainly(rows):
    out = defaultdict(lambda: [0, 0])
    for text, lang, source in rows:
        out[lang, source, None]
        for t, n in Counter(TERM.findall((text or "").translate(LOWER))).items():
            out[lang, source, t][0] += n
            out[lang, source, t][1] += 1
    return {k: tuple(v) for k, v in out.items()}


@pytest.mark.parametrize("most", [1, 150, 10**6])
def test_counts_handed_on(most):
    rows = [(t, x or "", s or "") for t, x, s in corpus(300, 3) + ODD]
    got, made = counted(rows, most=most)
    assert got == counted_plainly(rows)
    if most == 10**6:
        assert len(made) == 1 and made[0].num_rows == len(got)


def test_terms_of_one_hash():
    """Two words that a polynomial hash modulo 2**64 can't tell apart are two terms."""
    one = "".join("ab"[i.bit_count() % 2] for i in range(4096))
    rows = [(one, "en", "s"), (one.translate(str.maketrans("ab", "ba")), "en", "s"), (one + " " + one, "en", "s")]
    got, _ = counted(rows)
    assert got == counted_plainly(rows) and len(got) == 3


def test_empty(spark):
    assert got(spark, []) == []


def test_large_counts(spark):
    """Shares of counts whose product with the scale is past 64 bits."""
    n = np.array([0, 3, 10**13, 9 * 10**14])
    total, terms = np.full(4, 9 * 10**14 + 5), np.full(4, 10**7)
    want = [1 + 10**9 * (int(x) + 2) // (9 * 10**14 + 5 + 2 * 10**7) for x in n]
    assert divergence._shares(n, total, terms).tolist() == want
    df = spark.createDataFrame([(int(x), int(t), int(v)) for x, t, v in zip(n, total, terms, strict=True)], "n long, t long, v long")
    assert [r[0] for r in df.select(divergence.share(df.n, df.t, df.v)).collect()] == want


@pytest.mark.parametrize("k", [1, 3, 10])
def test_skyband(k):
    rng = np.random.default_rng(k)
    g, lang, place = rng.integers(1, 9, 900), rng.integers(1, 30, 900), rng.permutation(900)
    over = ((g >= g[:, None]) & (lang <= lang[:, None]) & (place < place[:, None])).sum(axis=1)
    assert divergence.skyband(g, lang, place, k).tolist() == (over < k).tolist()
    parts = [np.arange(900)[i::4] for i in range(4)]
    left = np.concatenate([i[divergence.skyband(g[i], lang[i], place[i], k)] for i in parts])
    merged = left[divergence.skyband(g[left], lang[left], place[left], k)]
    assert sorted(merged.tolist()) == np.flatnonzero(over < k).tolist()
    assert len(list(itertools.chain(merged))) < 900
