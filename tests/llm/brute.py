"""Slow, plain versions of what the corpus queries return."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PII = [
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
]


def sha(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def pii(text: str | None) -> list[tuple[int, int, int]]:
    out = []
    for k, (kind, pattern) in enumerate(PII):
        for m in pattern.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def line_dedup(docs: list[tuple]) -> list[tuple]:
    key = lambda x: x.strip("\x20\x09\x0a\x0b\x0c\x0d").translate(LOWER)
    holds = defaultdict(set)
    for i, t in docs:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 40:
                holds[key(x)].add(-1 if i is None else i)
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(key(x)) < 40 or len(holds[key(x)]) < 5 or max(holds[key(x)]) == (-1 if i is None else i)]
        out.append((i, len(lines), len(lines) - len(stay), sha("\n".join(stay))))
    return out


def shingles(text: str | None, k: int) -> frozenset:
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def near_duplicates(docs: list[tuple], k: int = 4) -> list[tuple]:
    sets = [shingles(t, k) for _, t in docs]
    by = defaultdict(set)
    for i, s in enumerate(sets):
        for g in s:
            by[g].add(i)
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        for j, n in Counter(j for g in s for j in by[g] if j > i).items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(docs)]


def leaks(docs: list[tuple], items: list[tuple]) -> list[tuple]:
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        k = min(10, len(w))
        for at in range(len(w) - k + 1 if w else 0):
            windows[tuple(w[at : at + k])].add(str(i))
    sizes, out = {len(x) for x in windows}, []
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for k in sizes:
            for at in range(len(w) - k + 1):
                if tuple(w[at : at + k]) in windows:
                    hit.update(range(at, at + k))
                    ids |= windows[tuple(w[at : at + k])]
        out.append((d, len(w), len(hit), len(ids), sha(",".join(sorted(ids))), bool(hit)))
    return out


def targets(sizes: dict, weights=(5, 2, 1)) -> dict:
    """Shares by weight; what is above three times a source's size is dealt again."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    got, full, left = dict.fromkeys(order, 0.0), set(), float(sum(sizes.values()))
    while True:
        rest = [s for s in order if s not in full]
        share = sum(weight[s] for s in rest)
        now = {s: left * weight[s] / share for s in rest}
        above = [s for s in rest if now[s] >= 3 * sizes[s]]
        if not above:
            return got | now
        for s in above:
            got[s] = 3.0 * sizes[s]
            full.add(s)
            left -= 3 * sizes[s]
        if not rest or len(full) == len(order):
            return got


def quality_counts(text: str | None) -> tuple:
    text = text or ""
    w = WORD.findall(text)
    seen, dup = set(), 0
    for x in text.split("\n"):
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    at = defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i : i + 8])].append(i)
    again = {j for x in at.values() if len(x) > 1 for i in x for j in range(i, i + 8)}
    failed = len(w) < 20 or 100 * len(again) > 30 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(again), failed


def unigram_scores(docs: list[tuple]) -> list[tuple]:
    toks = lambda t: [*WORD.findall((t or "").translate(LOWER)), None]
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    c = Counter(x for d, t in docs if not held(d) for x in toks(t))
    n, v = sum(c.values()), len(c)
    return [(d, held(d), len(toks(t)), sum(c[x] > 0 for x in toks(t)), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in toks(t))) for d, t in docs]
