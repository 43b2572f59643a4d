"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same
bytes, in each document and in the corpus, counted by external spilling.

A document's text, after one blank, is encoded by a byte-level BPE (A) and by a
piece BPE with byte fallback (B). Where tokens of both end, both are cut into
groups; tokens whose byte ranges overlap are linked. A pair of ids counts how many links of
the corpus hold it.

Counting spills by radix: each slice of texts writes, for each of ``RADIX``
parts of the B ids, one run of its records (pair, document, links), sorted by B
id, A id and document and compressed. Runs are dealt to blocks of ``BLOCK`` runs, so what a
task holds has a bound, whatever the size of the corpus and however often a
token occurs; their number grows with the texts, not with its square. A task merges the
runs of a block with a heap and counts each pair; the blocks' counts are added up. In the order of
B ids a part's counts then yield each B id's highest count in one pass, and go
to the part's blocks, whose runs are streamed once more: every record gives its
document what its pair counts.

Units of text, from one blank between two characters that aren't white space to
the next, are encoded once for all their occurrences in a slice: no token of
either vocabulary crosses such a blank (checked when the files are read).

Defined cases: null and empty texts, and those which either vocabulary can't give
back byte by byte, have no tokens and take no part in the counts; special tokens'
names in a text are plain text; repeated rows are documents each; very long texts
are encoded whole; further columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, groupby
from operator import itemgetter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import release, slices, stored
from .lm import _spread as unpacked
from .lm import _squeeze as packed

#: Parts of the B ids; runs of a part that a task merges; bytes of text of a slice.
RADIX, BLOCK, SLICE = 32, 64, 4 << 20
_ID_BITS = 24
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_NONE = "", 0, 0, 0, 0


def tokenizer_folder() -> str:
    """Where the public vocabulary files are."""
    return os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


class Vocabularies:
    """Both encoders, and the bytes of each of their tokens."""

    def __init__(self, a_file: str, b_file: str):
        with open(a_file, encoding="utf-8") as f:
            files = json.load(f)
        byte = {c: i for i, c in enumerate(_byte_characters())}
        # An entry's id is its place in the order of merges; special tokens, spelt in plain characters, come after all of them.
        special = {x["content"] for x in files["added_tokens"]}
        ranks = {bytes(byte[c] for c in entry): i for entry, i in files["model"]["vocab"].items() if entry not in special}
        self.a = tiktoken.Encoding("a", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        self.a_bytes = [x for x, _ in sorted(ranks.items(), key=itemgetter(1))]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in known], dtype=np.int64) for known in (self.a_bytes, self.b_bytes))
        crossing = [p for p in pieces if "▁" in p.lstrip("▁")]
        if crossing:
            raise ValueError(f"tokens may cross a blank between words: {crossing[:5]}")


def _byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary:
    itself where Latin-1 prints it, else the next of those from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = [chr(i) if i in shown else "" for i in range(256)]
    for n, i in enumerate(i for i in range(256) if i not in shown):
        out[i] = chr(256 + n)
    return out


@lru_cache(maxsize=2)
def vocabularies(a_file: str, b_file: str) -> Vocabularies:
    return Vocabularies(a_file, b_file)


class Units(NamedTuple):
    """Tokens and links of units; without tokens where these don't give the unit back."""

    back: np.ndarray  # whether they do
    groups: list[bytes]  # a1,a2|b1;a3|b2,b3;
    sizes: np.ndarray  # of each unit: A tokens, B tokens, groups
    links: np.ndarray  # of each unit, how many
    pairs: np.ndarray  # of all links, unit by unit: the B id above the A id


_EMPTY = np.zeros(0, dtype=np.int64)


def _bounds(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


def _encode(v: Vocabularies, units: list[bytes]) -> Units:
    """The units, each of which starts with a blank."""
    texts = [u.decode() for u in units]
    a, b = [v.a.encode_ordinary(t) for t in texts], v.b.encode([t[1:] for t in texts], num_threads=1)
    spell = lambda known, ids: b"".join([known[i] for i in ids])
    back = np.ones(len(units), dtype=bool)
    if not b"".join(units) == spell(v.a_bytes, chain.from_iterable(a)) == spell(v.b_bytes, chain.from_iterable(b)):
        back = np.array([u == spell(v.a_bytes, x) == spell(v.b_bytes, y) for u, x, y in zip(units, a, b, strict=True)])
        a, b, units = ([x if ok else x[:0] for x, ok in zip(c, back, strict=True)] for c in (a, b, units))
    n_a, n_b, size = (np.fromiter(map(len, c), dtype=np.int64, count=len(c)) for c in (a, b, units))
    ids_a, ids_b = (np.fromiter(chain.from_iterable(c), dtype=np.int64, count=n.sum()) for c, n in ((a, n_a), (b, n_b)))
    return _aligned(v, back, ids_a, ids_b, n_a, n_b, np.cumsum(size))


def _aligned(v: Vocabularies, back: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, unit_ends: np.ndarray) -> Units:
    """All units behind one another: where tokens end, and so where groups and links do."""
    ends_a, ends_b = np.cumsum(v.a_sizes[ids_a]), np.cumsum(v.b_sizes[ids_b])
    ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
    twice = ends[1:] == ends[:-1]
    both, ends = ends[1:][twice], ends[np.append(True, ~twice)[: len(ends)]]
    # Between two neighbouring ends lies the overlap of one token of each, and of no other two.
    pairs = ids_b[np.searchsorted(ends_b, ends)] << _ID_BITS | ids_a[np.searchsorted(ends_a, ends)]
    per_unit = lambda at: np.diff(_bounds(np.ones(len(at), dtype=np.int64))[np.searchsorted(at, np.append(0, unit_ends), side="right")])
    # Each group's A ids, then its B ids; the last of either has another sign behind it.
    of_a, of_b = np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)
    order = np.argsort(np.concatenate([2 * of_a, 2 * of_b + 1]), kind="stable")
    code = np.concatenate([4 * ids_a + (both[of_a] == ends_a), 4 * ids_b + 2 + (both[of_b] == ends_b)])[order]
    distinct, code = np.unique(code, return_inverse=True)
    words = [b"%d%s" % (c >> 2, (b",", b"|", b",", b";")[c & 3]) for c in distinct.tolist()]
    text = b"".join([words[c] for c in code.tolist()])
    at = _bounds(np.array([len(w) for w in words], dtype=np.int64)[code])[_bounds(n_a + n_b)].tolist()
    return Units(back, [text[i:j] for i, j in zip(at, at[1:], strict=False)], np.stack([n_a, n_b, per_unit(both)], axis=1), per_unit(ends), pairs)


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
#: First bytes of the characters above 0x7F that may be white space.
_MAYBE = np.zeros(256, dtype=bool)
_MAYBE[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def _units(data: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where the units start: texts, and single blanks between characters that
    surely aren't white space. ``data`` begins with three bytes and ends with one that are of no text;
    the last is a blank, as behind any other text: a blank that ends a text isn't between two characters."""
    at = np.flatnonzero(data[3:-1] == 0x20) + 3
    before, after = data[at - 1], data[at + 1]
    wide = (before >= 0x80) & (_MAYBE[data[at - 2]] | _MAYBE[data[at - 3]])
    return np.union1d(at[~(_SPACE[before] | wide | _SPACE[after] | _MAYBE[after])], texts)


def digest(v: Vocabularies, texts: list[bytes]) -> tuple[list[tuple[str, int, int, int, int]], np.ndarray, np.ndarray, np.ndarray]:
    """(groups_sha256, n_a, n_b, n_groups, n_links) of each text; and pair,
    place of the text and links of each record, sorted."""
    filled = [i for i, x in enumerate(texts) if x]
    starts = np.cumsum([3, *(len(texts[i]) + 1 for i in filled)])
    data = np.frombuffer(b"\0\0\0" + b"".join(b" " + texts[i] for i in filled) + b" ", dtype=np.uint8)
    at = _units(data, starts[:-1])
    if not len(at):
        return [_NONE] * len(texts), _EMPTY, _EMPTY, _EMPTY
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, len(data) - 1)), pa.py_buffer(data)]).dictionary_encode()
    units, code = _encode(v, column.dictionary.to_pylist()), column.indices.to_numpy()
    bounds, sizes, bad = np.searchsorted(at, starts), units.sizes, ~units.back
    out, of, what, times = [_NONE] * len(texts), [], [], []
    for i, s, e in zip(filled, bounds.tolist(), bounds[1:].tolist(), strict=False):
        mine = code[s:e]
        if bad[mine].any():
            continue
        n_a, n_b, n_groups = sizes[mine].sum(axis=0).tolist()
        sha = hashlib.sha256(b"".join([units.groups[c] for c in mine.tolist()])[:-1]).hexdigest()
        out[i] = sha, n_a, n_b, n_groups, n_a + n_b - n_groups
        distinct, n = np.unique(mine, return_counts=True)
        of.append(np.full(len(distinct), i))
        what.append(distinct)
        times.append(n)
    if not what:
        return out, _EMPTY, _EMPTY, _EMPTY
    return out, *_records(units, np.concatenate(of), np.concatenate(what), np.concatenate(times))


def _records(units: Units, of: np.ndarray, what: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of texts, with how often they occur -> pair, text and links, by pair and text."""
    n = units.links[what]
    at = np.arange(n.sum()) + np.repeat(_bounds(units.links)[what] - _bounds(n)[:-1], n)
    pair, text, count = units.pairs[at], np.repeat(of, n), np.repeat(times, n)
    order = np.lexsort((text, pair))
    pair, text, count = pair[order], text[order], count[order]
    new = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (text[1:] != text[:-1])))
    return pair[new], text[new], np.add.reduceat(count, new)


def _radix(pair: np.ndarray) -> np.ndarray:
    return (pair >> _ID_BITS) % RADIX


_WRITTEN = "slice long, at int, groups_sha256 string, n_a long, n_b long, n_groups long, n_links long, radix int, run binary"


def _spill(a_file: str, b_file: str, ids: StructType, slice_bytes: int):
    """Texts -> a row for each, with its own figures, and a run of records for
    each slice and radix."""
    names = [*(f.name for f in ids.fields), *(f.name for f in StructType.fromDDL(_WRITTEN).fields)]

    def spill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, number = vocabularies(a_file, b_file), TaskContext.get().partitionId() << 32
        for b in slices(batches, most=slice_bytes):
            found, pair, text, links = digest(v, [x.as_py() or b"" for x in b.column("text").cast(pa.large_binary())])
            radix, runs = _radix(pair), []
            for r in np.unique(radix).tolist():
                i = np.flatnonzero(radix == r)
                new = np.flatnonzero(np.diff(pair[i], prepend=-1))
                sizes = np.diff(np.append(new, len(i)))
                runs.append((r, packed(np.diff(pair[i][new], prepend=0), sizes.astype(np.uint32), text[i].astype(np.uint16 if b.num_rows < 65536 else np.uint32), links[i].astype(np.uint32))))
            n, m = b.num_rows, len(runs)
            columns = [pa.concat_arrays([b.column(f.name), pa.nulls(m, b.column(f.name).type)]) for f in ids.fields]
            columns += [pa.array([number] * (n + m), pa.int64()), pa.array([*range(n), *[None] * m], pa.int32())]
            columns += [pa.array([*c, *[None] * m], t) for c, t in zip(zip(*found, strict=True), (pa.string(), *[pa.int64()] * 4), strict=True)]
            columns += [pa.array([*[None] * n, *(r for r, _ in runs)], pa.int32()), pa.array([*[None] * n, *(x for _, x in runs)], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=names)
            number += 1

    return spill


def _counted(run: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A run's pairs and their links; and place of the pair, text and links of each record."""
    steps, sizes, text, links = unpacked(run)
    of, links = np.repeat(np.arange(len(sizes)), sizes), links.astype(np.int64)
    total = np.add.reduceat(links, np.append(0, np.cumsum(sizes[:-1]).astype(np.int64)))
    return np.cumsum(steps), total, of, text, links


def _merge(table: pa.Table) -> pa.Table:
    """The runs of a part and block, merged with a heap: each pair and its links, in order."""
    heads = []
    for run in table.column("run"):
        pair, total, *_ = _counted(run.as_py())
        heads.append(zip(pair.tolist(), total.tolist(), strict=True))
    pairs, counts = [], []
    for pair, found in groupby(heapq.merge(*heads, key=itemgetter(0)), key=itemgetter(0)):
        pairs.append(pair)
        counts.append(sum(n for _, n in found))
    release()
    return pa.table({"radix": pa.array([table.column("radix")[0].as_py()] * len(pairs), pa.int32()), "pair": pa.array(pairs, pa.int64()), "n": pa.array(counts, pa.int64())})


def _highest(table: pa.Table) -> pa.Table:
    """All pairs of a part and their counts -> one row: pairs in the order of B
    ids, counts, and whether a count is its B id's highest."""
    order = np.argsort(table.column("pair").to_numpy())
    pair, n = table.column("pair").to_numpy()[order], table.column("n").to_numpy()[order]
    start = np.flatnonzero(np.diff(pair >> _ID_BITS, prepend=-1))
    best = n == np.repeat(np.maximum.reduceat(n, start), np.diff(np.append(start, len(n))))
    return pa.table({"radix": pa.array([table.column("radix")[0].as_py()], pa.int32()), "counts": pa.array([packed(np.diff(pair, prepend=0), n, best)], pa.binary())})


def _give_back(runs: pa.Table, counts: pa.Table) -> pa.Table:
    """The runs of a part and block, and the part's counts -> for each slice: texts, and what they get."""
    if not runs.num_rows:
        return pa.table({"slice": pa.array([], pa.int64()), "given": pa.array([], pa.binary())})
    steps, n, best = unpacked(counts.column("counts")[0].as_py())
    known, given = np.cumsum(steps), []
    for run in runs.column("run"):
        pair, _, of, text, links = _counted(run.as_py())
        at = np.searchsorted(known, pair)[of]
        n_best, count_sum = (np.zeros(int(text.max()) + 1, dtype=np.int64) for _ in range(2))
        np.add.at(n_best, text, links * best[at])
        np.add.at(count_sum, text, links * n[at])
        given.append(packed(n_best, count_sum))
    release()
    return pa.table({"slice": runs.column("slice").combine_chunks(), "given": pa.array(given, pa.binary())})


def align(docs: DataFrame, a_file: str | None = None, b_file: str | None = None, radix_block: int = BLOCK, slice_bytes: int = SLICE) -> DataFrame:
    """docs (doc_id, text) -> doc_id, n_a, n_b, n_groups, n_links, n_best (links
    whose pair counts as much as any of its B id), count_sum (of the pairs' counts,
    over the links), groups_sha256."""
    found = _written(docs, a_file, b_file, slice_bytes)
    runs = _blocks(found, radix_block)
    given = runs.groupBy("radix", "block").cogroup(_to_blocks(_pair_counts(runs), runs).groupBy("part", "of")).applyInArrow(lambda x, y: _give_back(x, y), "slice long, given binary")
    texts = found.filter("at is not null").drop("radix", "run")
    ids, numbers = texts.schema["doc_id"], "slice long, at int, groups_sha256 string, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long"

    def total(rows: pa.Table, parts: pa.Table) -> pa.Table:
        at = rows.column("at").to_numpy()
        sums = np.zeros((2, int(at.max()) + 1 if len(at) else 0), dtype=np.int64)
        for x in parts.column("given"):
            for k, part in enumerate(unpacked(x.as_py())):
                sums[k, : len(part)] += part
        return rows.append_column("n_best", pa.array(sums[0][at])).append_column("count_sum", pa.array(sums[1][at]))

    out = texts.groupBy("slice").cogroup(given.groupBy("slice")).applyInArrow(total, StructType([ids, *StructType.fromDDL(numbers).fields]))
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def pair_counts(docs: DataFrame, a_file: str | None = None, b_file: str | None = None, radix_block: int = BLOCK, slice_bytes: int = SLICE) -> DataFrame:
    """docs (text) -> a_id, b_id, n: the links of the corpus that hold the pair."""
    counts = _pair_counts(_blocks(_written(docs.select(F.lit(0).alias("doc_id"), "text"), a_file, b_file, slice_bytes), radix_block))
    return counts.select((F.col("pair") % (1 << _ID_BITS)).cast("int").alias("a_id"), F.shiftright("pair", _ID_BITS).cast("int").alias("b_id"), "n")


def _written(docs: DataFrame, a_file: str | None, b_file: str | None, slice_bytes: int) -> DataFrame:
    a_file, b_file = a_file or f"{tokenizer_folder()}/byte_bpe_50k.json", b_file or f"{tokenizer_folder()}/piece_bpe_32k.model"
    slim = docs.select("doc_id", "text")
    ids = StructType([StructField("doc_id", slim.schema["doc_id"].dataType)])  # null in the rows of runs
    return stored(slim.mapInArrow(_spill(a_file, b_file, ids, slice_bytes), StructType([*ids.fields, *StructType.fromDDL(_WRITTEN).fields])))


def _blocks(found: DataFrame, runs: int) -> DataFrame:
    """The runs, dealt to so many blocks that each part has about ``runs`` in one."""
    slices_ = found.filter("run is not null").agg(F.count_distinct("slice")).first()[0]
    block = F.pmod(F.xxhash64("slice"), F.lit(max(1, -(-slices_ // runs)))).cast("int")
    return found.filter("run is not null").select("slice", "radix", block.alias("block"), "run")


def _pair_counts(runs: DataFrame) -> DataFrame:
    merged = runs.groupBy("radix", "block").applyInArrow(_merge, "radix int, pair long, n long")
    return stored(merged.groupBy("radix", "pair").agg(F.sum("n").alias("n")))


def _to_blocks(counts: DataFrame, runs: DataFrame) -> DataFrame:
    """A part's counts, in one row, once for each of its blocks. What a part
    holds is bounded by the vocabularies, not by the corpus."""
    parts = counts.groupBy("radix").applyInArrow(_highest, "radix int, counts binary")
    return parts.join(runs.select("radix", F.col("block").alias("of")).distinct(), "radix").select(F.col("radix").alias("part"), "of", "counts")

