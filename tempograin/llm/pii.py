"""Information-theoretic sanitisation of personal data.

Patterns find the protected entities: e-mail and IP addresses, card and phone
numbers. The corpus tells how strongly a term reveals one of them: with df the
documents that hold a term (or an entity) and joint those where the term stands
within ``NEAR`` words of the entity, the pointwise mutual information is
log2(joint * N / (df(term) * df(entity))), and the entity's information content
log2(N / df(entity)). A term whose PMI reaches ``ALPHA`` of that content
discloses the entity; its occurrences are removed where it nearly always does
(``REMOVE_FROM`` of its documents), else generalised. Counts are of all
documents; disclosing terms are found again in all documents by a Bloom filter
and an exact join.

Defined cases: null or empty text has no spans; a term is a run of letters
(ASCII letters, lower-cased, and all characters beyond ASCII) of four bytes or
more outside the patterns' spans; repeated rows are documents each; an empty
table gives an empty result; of entities that a term reveals equally surely the
one of most documents, then of the largest hash, counts; very long texts are
scanned whole; further columns pass through, but base, spans and __row are
replaced. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import BlockedBloom
from .common import LOWER, cut, guarded, joined, schema_of, slices, word_hashes, word_spans

KINDS = ("email", "ip", "card", "phone", "term")
NEAR, ALPHA, LEAST_JOINT, REMOVE_FROM = 6, 0.9, 3, 0.95
#: A task adds up its counts of so many terms before it gives them away.
HELD_TERMS = 1 << 18
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only start where a run of digits does, and takes whole runs.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each @ with a local part to its left and a domain to its right; only what
    lies between one match and the next @ is looked at, so once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def _luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' spans, sorted."""
    out = [(s, 0, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m[0].replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and _luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_DIGIT.findall(m[0])) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def _hash(x: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(x, digest_size=8).digest(), "big", signed=True)


def _terms(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the terms of lower-cased bytes."""
    s, e = word_spans(_LETTER[data])
    long = e - s >= 4
    s, e = s[long], e[long]
    return word_hashes(data, s, e).view(np.int64), s, e


def _summed(counts: np.ndarray) -> np.ndarray:
    """(terms, numbers) -> distinct terms with the sums of their numbers."""
    terms, place = np.unique(counts[0], return_inverse=True)
    sums = np.zeros(len(terms), dtype=np.int64)
    np.add.at(sums, place, counts[1])
    return np.stack([terms, sums])


def _near(text: str, spans: list[tuple[int, int, int]]) -> Iterator[list[int]]:
    """For each span the terms among the ``NEAR`` before and after it, however
    long they are; a term that any span touches is none."""
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    h, s, e = _terms(LOWER[raw])
    byte = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
    bounds = [(byte[start], byte[end]) for start, _, end in spans]
    free = np.ones(len(h), dtype=bool)
    for low, high in bounds:
        free[np.searchsorted(e, low, side="right") : np.searchsorted(s, high)] = False
    h, s, e = h[free], s[free], e[free]
    for low, high in bounds:
        i, j = np.searchsorted(e, low, side="right"), np.searchsorted(s, high)
        yield [*h[max(0, i - NEAR) : i].tolist(), *h[j : j + NEAR].tolist()]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(entity, term) once for each document; term 0 stands for the entity itself."""
    for b in slices(batches):
        entity, term = [], []
        for text in b.column("text").to_pylist():
            found: dict[int, set[int]] = {}
            spans = base_spans(text) if text else []
            for (start, kind, end), near in zip(spans, _near(text, spans), strict=True) if spans else ():
                of = found.setdefault(_hash(f"{kind}:{re.sub(r'[ ().-]', '', text[start:end]).lower() if kind > 1 else text[start:end].lower()}".encode()), set())
                of.update(near)
            for x, terms in found.items():
                entity += [x] * (len(terms) + 1)
                term += [0, *terms]
        yield pa.RecordBatch.from_arrays([pa.array(entity, pa.int64()), pa.array(term, pa.int64())], names=["entity", "term"])


def disclosing_terms(docs: DataFrame) -> DataFrame:
    """term (hash), entity (hash), joint, pmi, content, share: the entity that
    each disclosing term reveals most surely."""
    spark = docs.sparkSession
    pairs = docs.select("text").mapInArrow(_pairs, "entity long, term long").groupBy("entity", "term").agg(F.count("*").alias("joint"))
    pairs = cut(pairs.filter((F.col("term") == 0) | (F.col("joint") >= LEAST_JOINT)))
    entities = pairs.filter("term = 0").select("entity", F.col("joint").alias("df_entity"))
    joint = pairs.filter("term != 0")
    terms = joint.select("term").distinct()
    filter_ = spark.sparkContext.broadcast(BlockedBloom.build(terms, "term", terms.count()))

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((2, 0), dtype=np.int64)  # what the task has counted since it last gave rows
        for b in slices(batches):
            data, starts = joined(b.column("text"))
            h, s, _ = _terms(LOWER[data])
            hit = filter_.value.might_contain(h)
            both = np.unique(np.stack([h[hit], np.searchsorted(starts, s[hit], side="right")]), axis=1)[0] if hit.any() else h[:0]
            held = _summed(np.concatenate([held, np.stack(np.unique(both, return_counts=True))], axis=1))
            if held.shape[1] > HELD_TERMS:
                yield pa.RecordBatch.from_arrays([*map(pa.array, held)], names=["term", "n"])
                held = held[:, :0]
        yield pa.RecordBatch.from_arrays([*map(pa.array, held)], names=["term", "n"])

    df = docs.select("text").mapInArrow(counts, "term long, n long").groupBy("term").agg(F.sum("n").alias("df_term"))
    n = float(docs.count())
    pmi, content = F.log2(F.col("joint") * F.lit(n) / (F.col("df_term") * F.col("df_entity"))), F.log2(F.lit(n) / F.col("df_entity"))
    told = joint.join(df, "term").join(entities, "entity").select("term", "entity", "joint", pmi.alias("pmi"), content.alias("content"), (F.col("joint") / F.col("df_term")).alias("share"))
    best = told.filter((F.col("content") > 0) & (F.col("pmi") >= ALPHA * F.col("content"))).groupBy("term").agg(F.max(F.struct("share", "joint", "entity", "pmi", "content")).alias("b"))
    return best.select("term", "b.entity", "b.joint", "b.pmi", "b.content", "b.share")


def find_spans(docs: DataFrame) -> DataFrame:
    """docs, with all its columns but the text (base and spans of its own are
    replaced, as is __row), a row hash ``__row``, ``base`` and ``spans``: arrays of (start,
    kind, end, removed), sorted; base spans only and all."""
    docs = docs.drop("base", "spans", "__row")
    spark = docs.sparkSession
    terms = cut(disclosing_terms(docs).select("term", (F.col("share") >= REMOVE_FROM).alias("removed")))
    filter_ = spark.sparkContext.broadcast(BlockedBloom.build(terms, "term", terms.count()))
    span = "array<struct<start: long, kind: long, end: long, removed: boolean>>"

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind_span = pa.struct([("start", pa.int64()), ("kind", pa.int64()), ("end", pa.int64()), ("removed", pa.bool_())])
        kind_hit = pa.struct([("term", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
        for b in slices(batches):
            texts = b.column("text").to_pylist()
            base = [base_spans(x) if x else [] for x in texts]
            data, starts = joined(b.column("text"))
            h, s, e = _terms(LOWER[data])
            hit = np.flatnonzero(filter_.value.might_contain(h))
            points = np.cumsum((data & 0xC0) != 0x80) if len(hit) else None
            hits: list[list[dict]] = [[] for _ in texts]
            for i in hit.tolist():
                d = int(np.searchsorted(starts, s[i], side="right")) - 1
                zero = int(points[starts[d] - 1]) if starts[d] else 0
                start, end = int(points[s[i]]) - 1 - zero, int(points[e[i] - 1]) - zero
                if not any(x < end and start < y for x, _, y in base[d]):
                    hits[d].append({"term": int(h[i]), "start": start, "end": end})
            found = [[{"start": x, "kind": k, "end": y, "removed": True} for x, k, y in spans] for spans in base]
            rest = [n for n in b.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in rest), pa.array(found, pa.list_(kind_span)), pa.array(hits, pa.list_(kind_hit))], names=[*rest, "__base", "__hits"])

    names = [c for c in docs.columns if c != "text"]
    slim = docs.select(*names, "text", F.monotonically_increasing_id().alias("__rid"), F.xxhash64("text").alias("__row"))
    schema = schema_of([f for f in slim.schema.fields if f.name != "text"], f"__base {span}, __hits array<struct<term: long, start: long, end: long>>")
    rows = slim.mapInArrow(spans, schema)
    # A row without possible hits gets a key of its own that no term has.
    one = rows.withColumn("__hit", F.explode_outer("__hits")).withColumn("__key", F.coalesce(F.col("__hit.term").cast("string"), F.concat(F.lit("#"), F.col("__rid")))).drop("__hits")
    known = terms.select(F.col("term").cast("string").alias("__key"), F.col("removed").alias("__removed"))
    term = F.when(F.col("__removed").isNotNull(), F.struct(F.col("__hit.start").alias("start"), F.lit(len(KINDS) - 1).cast("long").alias("kind"), F.col("__hit.end").alias("end"), F.col("__removed").alias("removed")))
    found = one.join(known, "__key", "left").groupBy("__rid").agg(*(F.any_value(c).alias(c) for c in (*names, "__row", "__base")), F.collect_list(term).alias("__terms"))
    return found.select(*names, "__row", F.col("__base").alias("base"), F.array_sort(F.concat("__base", "__terms")).alias("spans"))


def span_text(spans: str):
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(kinds, (x["kind"] + 1).cast("int")), x["start"], x["end"])), ",")


def sanitised(docs: DataFrame) -> DataFrame:
    """docs with their columns; in the text, entities give way to their kind in
    brackets, disclosing terms to [TERM] or, where they are removed, to nothing."""
    return guarded(docs, _sanitised)


def _sanitised(docs: DataFrame) -> DataFrame:
    names = docs.columns
    found = find_spans(docs.select("doc_id", "text")).select(F.col("doc_id").alias("__id"), "__row", F.col("spans").alias("__spans")).dropDuplicates(["__id", "__row"])
    both = docs.join(found, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__row")))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = []
            for x, spans in zip(b.column("text").to_pylist(), b.column("__spans").to_pylist(), strict=True):
                parts, done = [], 0
                for sp in spans or []:
                    if sp["start"] >= done:
                        parts += [x[done : sp["start"]], "" if sp["kind"] == len(KINDS) - 1 and sp["removed"] else f"[{KINDS[sp['kind']].upper()}]"]
                        done = sp["end"]
                texts.append(x if x is None else "".join([*parts, x[done:]]))
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else b.column(c) for c in names], names=names)

    return both.mapInArrow(apply, docs.schema)
