"""A hierarchical Pitman-Yor bigram model, trained and scored over the cluster.

Each context (the word before) is a restaurant whose dishes are words; a table
of it is a customer of the parent restaurant, which all contexts share and whose
base is uniform over the vocabulary and one unknown word. Seatings are sampled
by Gibbs moves of single customers, and the score of a token is its predictive
probability averaged over the last ``SAMPLES`` sweeps.

Tokens are dealt once, packed, to groups by context, so a group has whole
restaurants. Very frequent contexts are dealt by context and dish, and a pair
of two very frequent words by the text as well. The parent is dealt by dish.
Restaurants and parent are sampled in turn, each given the other:

1. With one table for each pair, the groups tell the parent how many tables a
   dish has; the parent seats these customers and answers with its totals.
2. Given the parent, the groups move their customers and tell the tables of each
   sample; the parent seats again, once for each sample.
3. The groups replay their seatings and score with the parent's totals.

What is told is one number for a dish, a group and a sample, so no word is too
frequent for a task. The same channel adds up what no group has whole: tables of
contexts dealt by dish, customers and tables of pairs dealt by text. Within a
pass the totals of others are held still, as parallel Gibbs samplers do. Every
word has a restaurant of its own; the start of a text is the context of the end
token.

Defined cases: a null or empty text is one token, the end; repeated rows are
trained on and scored each; without training rows every token is unknown; very
long texts are cut nowhere; further columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, SPACES, joined, mix64, release, slices, stored, word_hashes, word_spans

GROUP_TOKENS, SLICE = 2_000_000, 8 << 20
#: Parts of the parent for each root of the groups.
SHARDS = 8
#: Words that are sent as places in a list of them (64 MB), at most; others are sent as hashes.
TOP_WORDS = 8_000_000
BURN_IN, SAMPLES, BLOCKS = 2, 2, 4
#: Discount and strength of the context restaurants, and of the parent.
D, THETA, D0, THETA0 = 0.75, 2.0, 0.6, 10.0
_BASE_UNITS, _SCORE_UNITS = float(1 << 20), float(1 << 16)
_END = np.uint64(0x9D39247E33776D41)
_ZSTD = pa.Codec("zstd", 1)


def _squeeze(*arrays: np.ndarray) -> bytes:
    """The arrays, with their types, compressed; all first bytes of an array go
    before all second ones, so those of small numbers are nothing but zeros."""
    kinds = ",".join(f"{x.dtype.str}:{len(x)}" for x in arrays).encode()
    planes = [np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes() for x in arrays]
    raw = b"".join([len(kinds).to_bytes(4, "little"), kinds, *planes])
    return len(raw).to_bytes(8, "little") + _ZSTD.compress(raw, asbytes=True)


def _spread(blob: bytes) -> list[np.ndarray]:
    raw = _ZSTD.decompress(blob[8:], int.from_bytes(blob[:8], "little"), asbytes=True)
    at = 4 + int.from_bytes(raw[:4], "little")
    out = []
    for kind, n in (x.split(":") for x in raw[4:at].decode().split(",")):
        size = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, dtype=np.uint8, count=int(n) * size, offset=at).reshape(size, int(n))
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += planes.nbytes
    return out


def _coded(top: np.ndarray, words: np.ndarray) -> list[np.ndarray]:
    """Sorted hashes as three arrays: which are of frequent words, the steps
    between the places of these, and the others."""
    at = _lookup(top, words)
    known = at >= 0
    return [known, np.diff(at[known], prepend=0).astype(np.uint32), words[~known]]


def _decoded(top: np.ndarray, known: np.ndarray, steps: np.ndarray, others: np.ndarray) -> np.ndarray:
    out = np.empty(len(known), dtype=np.uint64)
    out[known] = top[np.cumsum(steps, dtype=np.int64)]
    out[~known] = others
    return out


def shards_of(groups: int) -> int:
    """Parts that the dishes, and so the parent, are dealt to. A group sends a
    message to each, so these grow with the root of the groups."""
    return min(groups, math.ceil(SHARDS * math.sqrt(groups)))


class Shared(NamedTuple):
    """What every task knows: sizes and frequent words."""

    tokens: int
    vocabulary: int
    groups: int
    hot: np.ndarray  # sorted hashes of the contexts dealt by dish too
    hot_count: np.ndarray
    most: int  # training tokens of a group
    top: np.ndarray  # sorted hashes of the most frequent words, which are sent as their places here
    shards: int  # parts of the parent

    def parts(self, dish: np.ndarray, context: np.ndarray) -> np.ndarray:
        """In how many parts the pairs are dealt: of a quarter of a group at most, were all
        of the rarer word in the pair."""
        u = _lookup(self.hot, context)
        out = np.ones(len(u), dtype=np.int64)
        i = np.flatnonzero(u >= 0)
        w = _lookup(self.hot, dish[i])
        i, w = i[w >= 0], w[w >= 0]
        out[i] = -(-4 * np.minimum(self.hot_count[u[i]], self.hot_count[w]) // self.most)
        return out


def _context_key(context: np.ndarray) -> np.ndarray:
    return mix64(context ^ np.uint64(0x5A5A5A5A5A5A5A5A))


def _pair_key(dish: np.ndarray, context: np.ndarray) -> np.ndarray:
    return mix64(mix64(dish ^ np.uint64(0xA5A5A5A5A5A5A5A5)) + context)


def _tokens(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's end included, and the text of each."""
    data, starts = joined(b.column("text"))
    low = LOWER[data]
    s, e = word_spans(~SPACES[low])
    of = np.searchsorted(starts, s, side="right") - 1
    n = np.bincount(of, minlength=b.num_rows) + 1
    token = np.full(n.sum(), _END, dtype=np.uint64)
    token[np.arange(len(s)) + of] = word_hashes(low, s, e)
    return token, np.repeat(np.arange(b.num_rows), n)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, count), each once for about a million distinct tokens."""
    held, n = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.view(np.int64)), pa.array(n)], names=["token", "n"])

    for b in slices(batches, most=SLICE):
        t, c = np.unique(_tokens(b)[0], return_counts=True)
        held, inverse = np.unique(np.concatenate([held, t]), return_inverse=True)
        n = np.bincount(inverse, np.concatenate([n, c]), minlength=len(held)).astype(np.int64)
        if len(held) > 1_000_000:
            yield out()
            held, n = held[:0], n[:0]
    yield out()


def _lookup(known: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Places of x in the sorted values, -1 for none."""
    if not len(known):
        return np.full(len(x), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(known, x), len(known) - 1)
    return np.where(known[at] == x, at, -1)


def _dealt(shared: Shared, b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all tokens: hash, hash of the context, text and group."""
    token, of = _tokens(b)
    before = np.full(len(token), _END, dtype=np.uint64)
    before[1:] = token[:-1]
    hot = np.flatnonzero(_lookup(shared.hot, before) >= 0)
    key = before.copy()
    parts = shared.parts(token[hot], before[hot]).astype(np.uint64)
    part = mix64(b.column("rid").to_numpy().view(np.uint64))[of[hot]] % parts
    key[hot] = mix64(before[hot] + mix64(token[hot] + part))
    return token, before, of, (key % np.uint64(shared.groups)).astype(np.int64)


def _pack(shared: Shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each group a blob: contexts, dishes, texts and counts, sorted. The
    texts are known by their places in the slice, whose ids come with its first blob."""
    for b in slices(batches, most=SLICE):
        token, before, of, group = _dealt(shared, b)
        order = np.argsort(token, kind="stable")
        order = order[np.argsort(before[order], kind="stable")]
        order = order[np.argsort(group[order].astype(np.uint16 if shared.groups < 65536 else np.int64), kind="stable")]
        u, w, d, g = before[order], token[order], of[order], group[order]
        new_pair = np.ones(len(w), dtype=bool)
        new_pair[1:] = (w[1:] != w[:-1]) | (u[1:] != u[:-1]) | (g[1:] != g[:-1])
        new_entry = new_pair.copy()
        new_entry[1:] |= d[1:] != d[:-1]
        entry = np.flatnonzero(new_entry)
        times = np.diff(np.append(entry, len(w))).astype(np.uint32)
        pair = np.flatnonzero(new_pair)
        first_entry = np.searchsorted(entry, pair)
        rid, train = b.column("rid").to_numpy(), b.column("train").to_numpy(zero_copy_only=False).astype(np.uint8)
        bounds = np.searchsorted(g[pair], np.arange(shared.groups + 1))
        groups, blobs = [], []
        name = int(np.bitwise_xor.reduce(mix64(rid.view(np.uint64) + np.arange(len(rid), dtype=np.uint64))).view(np.int64)) if len(rid) else 0
        for i in np.flatnonzero(np.diff(bounds)).tolist():
            p = pair[bounds[i] : bounds[i + 1]]
            low = first_entry[bounds[i]]
            high = first_entry[bounds[i + 1]] if bounds[i + 1] < len(pair) else len(entry)
            docs, local = np.unique(d[entry[low:high]], return_inverse=True)
            new = np.flatnonzero(np.diff(u[p], prepend=~u[p][:1]) != 0)
            known, dish = np.unique(w[p], return_inverse=True)
            entries = np.diff(np.append(first_entry[bounds[i] : bounds[i + 1]], high)).astype(np.uint32)
            groups.append(i)
            blobs.append(_squeeze(*_coded(shared.top, u[p][new]), np.diff(np.append(new, len(p))).astype(np.uint32), *_coded(shared.top, known), dish.astype(np.uint32), entries, local.astype(np.uint32 if len(docs) > 65536 else np.uint16), times[low:high], np.isin(np.arange(b.num_rows), docs), train[docs], rid if not groups[1:] else rid[:0]))
        yield pa.RecordBatch.from_arrays([pa.array(groups, pa.int64()), pa.array([name] * len(groups), pa.int64()), pa.array(blobs, pa.binary())], names=["group", "slice", "blob"])


class Group:
    """All tokens of a group's contexts: pairs (context, dish) with the training
    customers, and entries (pair, text, times)."""

    def __init__(self, shared: Shared, blobs: list[tuple[int, bytes]]):
        dish, context, count, entry_pair, text, times, n_pairs, n_docs = [], [], [], [], [], [], 0, 0
        self.slices: list[tuple[int, np.ndarray, np.ndarray]] = []  # name, which of its texts are here, ids of all or none
        for name, blob in blobs:
            *u, u_n, w0, w1, w2, w, n, doc, tf, here, train, rids = _spread(blob)
            u, known = _decoded(shared.top, *u), _decoded(shared.top, w0, w1, w2)
            pair = np.repeat(np.arange(len(w), dtype=np.int32), n)
            context.append(np.repeat(u, u_n))
            dish.append(known[w])
            count.append(np.bincount(pair, tf * train[doc], minlength=len(w)).astype(np.int64))
            entry_pair.append(pair + np.int32(n_pairs))
            text.append(doc.astype(np.int32) + np.int32(n_docs))
            times.append(tf)
            self.slices.append((name, here, rids))
            n_pairs, n_docs = n_pairs + len(w), n_docs + len(train)
        self.texts, self.text, self.times = n_docs, np.concatenate(text), np.concatenate(times)
        self.dishes, w = np.unique(np.concatenate(dish), return_inverse=True)
        self.contexts, u = np.unique(np.concatenate(context), return_inverse=True)
        key, inverse = np.unique(u << 32 | w, return_inverse=True)
        self.context, self.dish = (key >> 32).astype(np.int32), (key & 0xFFFFFFFF).astype(np.int32)
        self.count = np.bincount(inverse, np.concatenate(count), minlength=len(key)).astype(np.int64)
        self.pair = inverse.astype(np.int32)[np.concatenate(entry_pair)]
        # What other groups have parts of: contexts dealt by dish, pairs dealt by text.
        hot = _lookup(shared.hot, self.contexts)
        self.hot = np.flatnonzero(hot >= 0)
        self.customers = np.bincount(self.context, self.count, minlength=len(self.contexts))
        self.customers[self.hot] = shared.hot_count[hot[self.hot]]
        self.split = np.flatnonzero(shared.parts(self.dishes[self.dish], self.contexts[self.context]) > 1)
        self.told = np.concatenate([self.dishes, _context_key(self.contexts[self.hot]), _pair_key(self.dishes[self.dish[self.split]], self.contexts[self.context[self.split]])])
        self.kind = np.repeat(np.arange(3, dtype=np.uint8), [len(self.dishes), len(self.hot), len(self.split)])
        to = (mix64(self.told) % np.uint64(shared.shards)).astype(np.int64)
        self.deal = np.lexsort((self.told, to))
        self.bounds = np.searchsorted(to[self.deal], np.arange(shared.shards + 1))
        # Customers of the pairs with two or more; the table of each, named by a seat of the pair.
        self.many = np.flatnonzero(self.count > 1)
        self.size = self.count[self.many]
        self.offset = np.concatenate([[0], np.cumsum(self.size)]).astype(np.int64)
        self.who = np.repeat(np.arange(len(self.many), dtype=np.int32), self.size)
        self.seat = np.zeros(len(self.who), dtype=np.int64)

    def summed(self, of_pairs: np.ndarray) -> np.ndarray:
        """A number of each pair, added up for all that others are told of."""
        by_dish = np.bincount(self.dish, of_pairs, minlength=len(self.dishes))
        by_context = np.bincount(self.context, of_pairs, minlength=len(self.contexts))
        return np.concatenate([by_dish, by_context[self.hot], of_pairs[self.split]]).astype(np.int64)

    def messages(self, *columns: np.ndarray, keys: np.ndarray | None = None) -> list[bytes]:
        """What each shard of dishes is told, in a fixed order; of what, if it doesn't know."""
        code = lambda at: [] if keys is None else _coded(keys, self.told[at])
        return [_squeeze(*code(self.deal[i:j]), *(c[self.deal[i:j]] for c in columns)) for i, j in zip(self.bounds, self.bounds[1:], strict=False)]

    def answers(self, blobs: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
        """The answers of all shards of dishes: columns in the order of ``told``, and their sums added up."""
        rows = [_spread(x) for x in blobs]
        columns = []
        for k in range(len(rows[0]) - 1):
            c = np.empty(len(self.told), dtype=np.int64)
            c[self.deal] = np.concatenate([r[k] for r in rows])
            columns.append(c)
        return columns, np.sum([r[-1] for r in rows], axis=0)

    def tables_of_contexts(self, tables: np.ndarray, told: np.ndarray) -> np.ndarray:
        """Tables of each context: counted here, or told where others have parts."""
        out = np.bincount(self.context, tables, minlength=len(self.contexts))
        out[self.hot] = told[self.kind == 1]
        return out

    def sweep(self, rng: np.random.Generator, open_mass: np.ndarray) -> np.ndarray:
        """Moves every customer once; returns the tables of the pairs. A block's
        customers move at a time, by the seating before it. open_mass: of a new
        table, for each pair of ``many``."""
        base = self.offset[:-1]
        block = rng.integers(0, BLOCKS, len(self.who), dtype=np.uint8)
        for k in range(BLOCKS):
            at = np.bincount(base[self.who] + self.seat, minlength=len(self.who)).astype(np.int32)
            tables = np.add.reduceat(at > 0, base, dtype=np.int32) if len(base) else at
            i = np.flatnonzero(block == k)
            p, seat = self.who[i], self.seat[i]
            start, alone = base[p], at[base[p] + seat] == 1
            others = self.size[p] - 1 - D * (tables[p] - alone)
            mass = open_mass[p]
            opens = rng.random(len(i)) * (mass + np.maximum(others, 0)) < mass
            new = seat.copy()
            # A table is chosen by its guests less the discount: a random guest's, taken with that share.
            waits = np.flatnonzero(~opens)
            for _ in range(4):
                guest = start[waits] + rng.integers(0, self.size[p[waits]])
                table = self.seat[guest]
                guests = at[start[waits] + table] - (table == seat[waits])
                takes = (guest != i[waits]) & (guests > 0) & (rng.random(len(waits)) * guests < guests - D)
                new[waits[takes]] = table[takes]
                waits = waits[~takes]
            free = opens & (at[i] == 0)  # a new table is named by its first guest's seat
            new[free] = i[free] - start[free]
            self.seat[i] = new
        at = np.bincount(base[self.who] + self.seat, minlength=len(self.who))
        out = np.minimum(self.count, 1)
        if len(base):
            out[self.many] = np.add.reduceat(at > 0, base)
        return out


def _parent_tables(rng: np.random.Generator, guests: np.ndarray, mass: float) -> np.ndarray:
    """Tables of the parent's dishes, its customers seated one after another;
    from the sixteenth on, some at a time by the tables before them."""
    tables = np.minimum(guests, 1)
    m = 1
    while (more := np.flatnonzero(guests > m)).size:
        step = max(1, m // 8)
        n = np.minimum(guests[more] - m, step)
        tables[more] += rng.binomial(n, mass / (mass + m + (n - 1) / 2 - D0 * tables[more]))
        m += step
    return tables


def _parent(shared: Shared, tables: np.ndarray, seated: np.ndarray, all_tables: float, all_seated: float) -> np.ndarray:
    """The parent's predictive probabilities."""
    return (tables - D0 * seated + (THETA0 + D0 * all_seated) / (shared.vocabulary + 1)) / (THETA0 + all_tables)


def _tell_first(shared: Shared, group: Group) -> list[bytes]:
    one = np.minimum(group.count, 1)
    return group.messages(group.kind, group.summed(group.count), group.summed(one), keys=shared.top)


def _seatings(shared: Shared, group: Group, number: int, columns: list[np.ndarray], sums: np.ndarray) -> Iterator[np.ndarray]:
    """The samples: tables of the pairs, given the parent's first answer."""
    _, tables, seated = columns[:3]
    own = group.kind == 0
    parent = _parent(shared, tables[own], seated[own], sums[0], sums[1])
    opened = group.tables_of_contexts(np.minimum(group.count, 1), tables)
    mass = (THETA + D * opened[group.context[group.many]]) * parent[group.dish[group.many]]
    rng = np.random.default_rng(number)
    group.seat[:] = 0
    for n in range(BURN_IN + SAMPLES):
        now = group.sweep(rng, mass)
        if n >= BURN_IN:
            yield now


def _tell_second(shared: Shared, group: Group, number: int, first: list[bytes]) -> list[bytes]:
    return group.messages(*(group.summed(t) for t in _seatings(shared, group, number, *group.answers(first))))


def _answer(shared: Shared, number: int, first: dict[int, bytes], second: dict[int, bytes] | None) -> dict[int, bytes]:
    """A shard of dishes answers each group: customers, tables and the parent's
    tables of what it told; with its second message those of every sample too. Last
    the sums over all dishes here."""
    told = {i: [_decoded(shared.top, *x[:3]), *x[3:]] for i, x in ((i, _spread(x)) for i, x in sorted(first.items()))}
    keys, inverse = np.unique(np.concatenate([x[0] for x in told.values()]), return_inverse=True)
    total = lambda rows: np.bincount(inverse, np.concatenate(rows), minlength=len(keys)).astype(np.int64)
    own = np.zeros(len(keys), dtype=bool)
    own[inverse] = np.concatenate([x[1] for x in told.values()]) == 0
    rng, mass = np.random.default_rng(number), (THETA0 + D0 * 1.5 * max(shared.vocabulary, 1)) / (shared.vocabulary + 1)
    columns, sums = [total([x[2] for x in told.values()])], []
    samples = [[x[3] for x in told.values()]]
    if second is not None:
        later = [_spread(second[i]) for i in told]
        samples += [[x[s] for x in later] for s in range(SAMPLES)]
    for rows in samples:
        tables = total(rows)
        seated = np.zeros(len(keys), dtype=np.int64)
        seated[own] = _parent_tables(rng, tables[own], mass)
        columns += [tables, seated]
        sums += [tables[own].sum(), seated.sum()]
    bounds = np.concatenate([[0], np.cumsum([len(x[0]) for x in told.values()])])
    return {i: _squeeze(*(c[inverse[a:b]] for c in columns), np.array(sums, dtype=np.int64)) for i, a, b in zip(told, bounds, bounds[1:], strict=False)}


def _predictive(shared: Shared, group: Group, number: int, answers: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs: the predictive probability, averaged over the samples; of
    the dishes: training customers everywhere."""
    columns, sums = group.answers(answers)
    own, p = group.kind == 0, np.zeros(len(group.count))
    count = group.count.copy()
    count[group.split] = columns[0][group.kind == 2]
    for s, tables in enumerate(_seatings(shared, group, number, columns, sums)):
        told, seated = columns[3 + 2 * s : 5 + 2 * s]
        parent = _parent(shared, told[own], seated[own], *sums[2 + 2 * s : 4 + 2 * s])
        opened = group.tables_of_contexts(tables, told)
        tables = tables.copy()
        tables[group.split] = told[group.kind == 2]
        back = THETA + D * opened[group.context]
        p += (count - D * tables + back * parent[group.dish]) / (THETA + group.customers[group.context])
    return p / SAMPLES, columns[0][own]


def _scores(shared: Shared, group: Group, number: int, answers: list[bytes]) -> list[tuple[int, bytes]]:
    """For each slice of texts: which have tokens here, and of those the number of
    tokens, of known ones, base and score; the ids of all, if they came here."""
    p, dish_count = _predictive(shared, group, number, answers)
    base = np.log10((dish_count + 1.0) / (shared.tokens + shared.vocabulary + 1))[group.dish]
    of_pairs = (np.ones(len(p)), dish_count[group.dish] > 0, base, np.log10(p))
    sums = [np.bincount(group.text, group.times * x[group.pair], minlength=group.texts) for x in of_pairs]
    # Log probabilities as whole numbers of 2**-20 and 2**-16 take half the bytes.
    columns = [sums[0].astype(np.uint32), sums[1].astype(np.uint32), np.round(sums[2] * _BASE_UNITS).astype(np.int64), np.round(sums[3] * _SCORE_UNITS).astype(np.int64)]
    out, at = [], 0
    for name, here, rids in group.slices:
        end = at + int(here.sum())
        out.append((name, _squeeze(here, *(c[at:end] for c in columns), rids)))
        at = end
    return out


def _summed(blobs: list[bytes]) -> list[np.ndarray]:
    """Of a slice's texts: ids, tokens, known ones, base and score."""
    rows = [_spread(x) for x in blobs]
    sums = [np.zeros(len(rows[0][0]), dtype=np.int64) for _ in range(4)]
    for here, *columns, _ in rows:
        for total, c in zip(sums, columns, strict=True):
            total[here] += c
    return [next(r[-1] for r in rows if len(r[-1])), *sums[:2], sums[2] / _BASE_UNITS, sums[3] / _SCORE_UNITS]


def _blobs(table: pa.Table, key: str) -> dict[int, bytes]:
    return dict(sorted(zip(table.column(key).to_pylist(), table.column("blob").to_pylist(), strict=True)))


def _rows(blobs: Iterable[tuple[int, bytes]], **columns: int) -> pa.Table:
    """A row for each number and blob; other columns are constant."""
    to, rows = zip(*blobs, strict=True)
    names = {"to": pa.array(to, pa.int64())} | {c: pa.array([x] * len(to), pa.int64()) for c, x in columns.items()}
    return pa.table({**names, "blob": pa.array(rows, pa.binary())})


def released(work: Callable[..., pa.Table]) -> Callable[..., pa.Table]:
    """The work on a group, after which its memory is given back."""

    def run(*tables: pa.Table) -> pa.Table:
        out = work(*tables)
        release()
        return out

    # Spark counts the parameters: one table, or the two of a cogroup.
    return (lambda one, other: run(one, other)) if work.__code__.co_argcount == 2 else lambda table: run(table)


def score_texts(docs: DataFrame, train: Column, group_tokens: int = GROUP_TOKENS, shards: int | None = None) -> DataFrame:
    """docs (doc_id, text) and which of them to learn from -> doc_id, train,
    n_tokens, n_known, train_tokens, base_score (unigrams with one added) and
    score: log10 probabilities of each whole text."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text", train.alias("train"), F.xxhash64("doc_id", "text").alias("rid"))
    counts = stored(rows.filter("train").select("text").mapInArrow(_count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")))
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    groups = max(1, -(-n // group_tokens))
    # Words of a share of 1 / (4 * groups) or more: no more than 4 * groups of them.
    frequent = counts.filter((F.col("n") * 4 * groups >= n) & F.lit(groups > 1)).toArrow()
    word, count = frequent.column("token").to_numpy().view(np.uint64), frequent.column("n").to_numpy()
    order = np.argsort(word)
    # The most frequent words, down to a count that all of them reach; counts in some hundred classes.
    size, at_least = F.floor(F.log2("n") * 8), 0
    for r in counts.groupBy(size.alias("size")).agg(F.count("*").alias("words"), F.min("n").alias("least")).withColumn("words", F.sum("words").over(Window.orderBy(F.desc("size")))).orderBy("size").collect():
        at_least = r["least"]
        if r["words"] <= TOP_WORDS:
            break
    top = np.sort(counts.filter(F.col("n") >= at_least).select("token").toArrow().column("token").to_numpy().view(np.uint64))
    held = spark.sparkContext.broadcast(Shared(int(n), int(v), int(groups), word[order], count[order], int(group_tokens), top, shards or shards_of(int(groups))))

    def group_of(table: pa.Table) -> tuple[int, Group]:
        return table.column("group")[0].as_py(), Group(held.value, list(zip(table.column("slice").to_pylist(), table.column("blob").to_pylist(), strict=True)))

    @released
    def tell_first(table: pa.Table) -> pa.Table:
        number, group = group_of(table)
        return _rows(enumerate(_tell_first(held.value, group)), of=number)

    @released
    def answer_first(told: pa.Table) -> pa.Table:
        number = told.column("to")[0].as_py()
        return _rows(_answer(held.value, number, _blobs(told, "of"), None).items(), of=number)

    @released
    def tell_second(table: pa.Table, answers: pa.Table) -> pa.Table:
        number, group = group_of(table)
        return _rows(enumerate(_tell_second(held.value, group, number, list(_blobs(answers, "of").values()))), of=number)

    @released
    def answer_second(first: pa.Table, second: pa.Table) -> pa.Table:
        number = first.column("to")[0].as_py()
        return _rows(_answer(held.value, number, _blobs(first, "of"), _blobs(second, "of")).items(), of=number)

    @released
    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        number, group = group_of(table)
        return _rows(_scores(held.value, group, number, list(_blobs(answers, "of").values())))

    def summed(table: pa.Table) -> pa.Table:
        return pa.table([pa.array(x) for x in _summed(table.column("blob").to_pylist())], names=["rid", "n_tokens", "n_known", "base_score", "score"])

    # One plan: the shuffles of packed tokens and first messages are read again by what comes later.
    packed = rows.select("rid", "train", "text").mapInArrow(lambda it: _pack(held.value, it), "group long, slice long, blob binary")
    message = "to long, of long, blob binary"
    first = packed.groupBy("group").applyInArrow(tell_first, message)
    answers = first.groupBy("to").applyInArrow(answer_first, message)
    second = packed.groupBy("group").cogroup(answers.groupBy("to")).applyInArrow(tell_second, message)
    answers = first.groupBy("to").cogroup(second.groupBy("to")).applyInArrow(answer_second, message)
    parts = packed.groupBy("group").cogroup(answers.groupBy("to")).applyInArrow(score, "to long, blob binary")
    sums = parts.groupBy("to").applyInArrow(summed, "rid long, n_tokens long, n_known long, base_score double, score double")
    sums = sums.groupBy("rid").agg(*(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")))
    ids = rows.groupBy("rid").agg(F.any_value("doc_id").alias("doc_id"), F.any_value("train").alias("train"), F.count("*").alias("rows"))
    out = ids.join(sums, "rid").withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    whole = [(F.col(c) / F.col("rows")).cast("long").alias(c) for c in ("n_tokens", "n_known")]
    shares = [(F.col(c) / F.col("rows")).alias(c) for c in ("base_score", "score")]
    return out.select("doc_id", "train", *whole, F.lit(int(n)).cast("long").alias("train_tokens"), *shares)
