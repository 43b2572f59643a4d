"""The corpus queries on a whole small table, against plain versions."""

import math
import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tempograin.llm import mixing, ngrams, paragraphs, quality, queries, toxicity
from tempograin.llm.common import mod_of_id, table

from . import brute


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return sorted((r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect())


def rows(spark, sf_dir, name, *columns):
    return sorted(tuple(r[c] for c in columns) for r in queries.queries()[name](spark, sf_dir).collect())


def test_pii(spark, sf_dir, docs):
    got = rows(spark, sf_dir, "op1_pii", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    kinds = ("email", "ip", "card", "phone")
    want = []
    for d, t in docs:
        spans = brute.pii(t)
        want.append((d, *(sum(k == i for _, k, _ in spans) for i in range(4)), brute.sha(",".join(f"{kinds[k]}:{s}:{e}" for s, k, e in spans))))
    assert got == want
    spans = rows(spark, sf_dir, "op1_pii", "doc_id", "spans")
    assert all(set(f"{kinds[k]}:{s}:{e}" for s, k, e in brute.pii(t)) <= set(x.split(",")) for (_, t), (_, x) in zip(docs, spans, strict=True))


def test_line_dedup(spark, sf_dir, docs):
    assert rows(spark, sf_dir, "op2_line_dedup", "doc_id", "n_lines", "n_dropped", "kept_sha256") == brute.line_dedup(docs)


def test_near_duplicates(spark, sf_dir, docs):
    assert rows(spark, sf_dir, "op3_near_duplicates", "doc_id", "n_shingles", "component_id", "kept") == brute.near_duplicates(docs)


def test_leaks(spark, sf_dir, docs):
    items = [(r["item_id"], r["text"]) for r in table(spark, sf_dir, "benchmark").collect()]
    assert rows(spark, sf_dir, "op6_decontaminate", "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == brute.leaks(docs, items)


def test_mix(spark, sf_dir):
    data = table(spark, sf_dir, "documents").select("doc_id", "source", "text").collect()
    size = {r["doc_id"]: len(brute.WORD.findall(r["text"] or "")) for r in data}
    of = {r["doc_id"]: r["source"] for r in data}
    sources = {}
    for d, s in of.items():
        sources[s] = sources.get(s, 0) + size[d]
    target = brute.targets(sources)
    got = rows(spark, sf_dir, "op7_mix", "doc_id", "size", "source_size", "target", "taken")
    assert [(d, n, s) for d, n, s, _, _ in got] == [(d, size[d], sources[of[d]]) for d in sorted(size)]
    assert all(abs(t - target[of[d]]) <= 1e-9 * t + 1e-9 for d, _, _, t, _ in got)
    assert all(0 <= taken <= 3 * n for _, n, _, _, taken in got)
    for s in sources:
        assert abs(sum(x for d, _, _, _, x in got if of[d] == s) - target[s]) <= mixing.PACKET  # what service without packets would give
    assert sum(x[4] for x in got) == sum(size.values())  # the queue is truncated at the budget
    assert got == rows(spark, sf_dir, "op7_mix", "doc_id", "size", "source_size", "target", "taken")


def test_quality(spark, sf_dir, docs):
    got = rows(spark, sf_dir, "op8_quality", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert got == [(d, *brute.quality_counts(t)) for d, t in docs]
    kept = dict(rows(spark, sf_dir, "op8_quality", "doc_id", "kept"))
    assert not any(kept[r[0]] for r in got if r[-1])
    labels = [(r["doc_id"], r["quality"]) for r in table(spark, sf_dir, "labels").collect()]
    good = [kept[d] for d, q in labels if q == 1]
    assert sum(good) >= 0.8 * len(good)


def test_language_model(spark, sf_dir, docs):
    got = rows(spark, sf_dir, "op9_language_model", "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    want = brute.unigram_scores(docs)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert all(abs(g[5] - w[5]) <= 1e-6 * abs(w[5]) for g, w in zip(got, want, strict=True))
    held = [r for r in got if r[1]]
    assert all(r[6] < 0 for r in got)
    assert sum(r[6] for r in held) > sum(r[5] for r in held)  # the bigrams help on texts not learned from


@pytest.fixture(scope="module")
def larger(spark, sf_dir):
    """Ten times the rows, whose labels suffice to learn from: documents and labels."""
    folder = os.path.join(os.path.dirname(sf_dir), "sf0.01")
    return table(spark, folder, "documents").select("doc_id", "text").cache(), table(spark, folder, "labels").cache()


def area(scores, labels):
    """Probability that a row of label 1 scores above one of label 0."""
    ones, zeros = ([s for s, y in zip(scores, labels, strict=True) if y == k] for k in (1, 0))
    return sum((a > b) + (a == b) / 2 for a in ones for b in zeros) / (len(ones) * len(zeros))


def dealt(docs):
    """The documents in one partition, in forty, and in batches of one row."""
    spark = docs.sparkSession
    yield docs.coalesce(1)
    yield docs.repartition(40, F.xxhash64("doc_id", F.lit(1)))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    try:
        yield docs.limit(150).repartition(3, "doc_id")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_toxicity(spark, sf_dir, docs):
    got = rows(spark, sf_dir, "op10_toxicity", "doc_id", "held_out", "score", "predicted")
    assert [r[:2] for r in got] == [(d, zlib.crc32(str(d).encode()) % 3 == 1) for d, _ in docs]
    assert all(0 <= r[2] <= 1 and r[3] == (r[2] >= 0.7) for r in got)


def test_toxicity_held_out(larger):
    """Scores of rows not learned from: in order, those of a plain version, and alike however the rows are dealt."""
    docs, labels = larger
    model = toxicity.train(toxicity.training_rows(docs, labels, "toxic", mod_of_id(F.col("doc_id"), 3) != 1))
    score = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, model).collect()}
    held = [(r["doc_id"], r["toxic"]) for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert area([score[d] for d, _ in held], [y for _, y in held]) >= 0.85  # eighteen toxic rows
    assert sum(score[d] >= 0.7 for d, y in held if y) >= 0.5 * sum(y for _, y in held)
    assert sum(score[d] >= 0.7 for d, y in held if not y) <= 0.01 * len(held)
    for some in dealt(docs):
        assert all(r["score"] == score[r["doc_id"]] for r in toxicity.scored(some, model).collect())
    # The plain version: the best sum of weights over the n-grams that start in 24 bytes.
    weights, a, b = model
    for r in docs.filter("length(text) < 400").limit(60).collect():
        text = r["text"].translate(brute.LOWER).encode() + b"\n"
        gain = [0.0] * len(text)
        for n in toxicity.ORDERS:
            for i in range(len(text) - n + 1):
                data = np.frombuffer(text[i : i + n], dtype=np.uint8)
                gain[i] += float(weights[ngrams.char_grams(data, n, toxicity.BITS, np.full(n, n))[0]])
        best = max(0.0, *(sum(gain[i : i + toxicity.STRETCH]) for i in range(len(text))))
        assert score[r["doc_id"]] == pytest.approx(1 / (1 + math.exp(-max(-35, min(35, a * best + b)))), rel=1e-9)


def test_quality_held_out(larger):
    """Good rows not learned from stay and bad ones go; a score doesn't hang on a row's neighbours."""
    docs, labels = larger
    model = quality.train(toxicity.training_rows(docs, labels, "quality", mod_of_id(F.col("doc_id"), 3) != 1, quality.TRAIN_ROWS))
    judged = {r["doc_id"]: r for r in quality.judged(docs, model).collect()}
    held = [(judged[r["doc_id"]], r["quality"]) for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    good, bad = ([r["kept"] for r, y in held if y == k] for k in (1, 0))
    assert sum(good) >= 0.9 * len(good) and sum(bad) <= 0.5 * len(bad)
    assert area([r["quality_score"] for r, _ in held], [y for _, y in held]) >= 0.9
    for some in dealt(docs):
        assert all(r["quality_score"] == judged[r["doc_id"]]["quality_score"] for r in quality.judged(some, model).collect())


def test_training_rows_are_bounded(spark):
    """An id that is labelled once and repeated many times in documents doesn't pass the bound."""
    docs = spark.range(2000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.training_rows(docs, labels, "toxic", F.lit(True), 50).count() == 50


def test_paragraphs(spark, sf_dir, docs):
    found = queries.queries()["op4_paragraphs"](spark, sf_dir).filter("paragraph is not null")
    got = sorted(tuple(r[c] for c in ("doc_id", "paragraph", "component_id", "n_copies", "removed")) for r in found.collect())
    units = [((d, i), x) for d, t in docs for i, x in enumerate((t or "").split("\n")) if len(brute.WORD.findall(x)) >= 20]
    want = brute.near_duplicates(units, 5)
    size = {}
    for _, _, c, _ in want:
        size[c] = size.get(c, 0) + 1
    assert got == sorted((u[0], u[1], c[0], size[c], not kept) for u, _, c, kept in want if size[c] > 1)


def test_passages(spark, sf_dir, docs):
    """All words of runs that occur twice are in passages, and only words of windows that do."""
    words = {d: brute.WORD.findall((t or "").translate(brute.LOWER)) for d, t in docs}

    def covered(size):
        at = {}
        for d, w in words.items():
            for i in range(len(w) - size + 1):
                at.setdefault(tuple(w[i : i + size]), []).append((d, i))
        return {(d, j) for x, places in at.items() if len(places) > 1 and all(len(set(x[i : i + paragraphs.WINDOW])) >= paragraphs.DISTINCT for i in range(size - paragraphs.WINDOW + 1)) for d, i in places for j in range(i, i + size)}

    got = {(r["doc_id"], j) for r in queries.queries()["op4_passages"](spark, sf_dir).collect() for j in range(r["word"], r["word"] + r["n_words"])}
    assert covered(paragraphs.RUN) <= got <= covered(paragraphs.WINDOW) and len(got) > 1000


def test_urls(spark, sf_dir):
    urls = {r["page_id"]: r["url"] for r in table(spark, sf_dir, "pages").select("page_id", "url").collect()}
    for page, host, path, rule, verdict in rows(spark, sf_dir, "op5_url_filter", "page_id", "host", "path", "rule", "verdict"):
        rest = (urls[page] or "").partition("://")[2]
        want_host = brute.re.match(r"[^/?#]*", rest)[0].translate(brute.LOWER)
        want_path = brute.re.match(r"[^/?#]*([^?#]*)", rest)[1]
        fits = [(len(h + p), h + p, v) for h, p, v in queries.RULES if (want_host == h or want_host.endswith("." + h)) and want_path.startswith(p)]
        assert (host, path, rule) == (want_host, want_path, max(fits)[1] if fits else None)
        blocked = any(want_host == h or want_host.endswith("." + h) for h in queries.BLOCKED_HOSTS) and want_path.startswith("/")
        assert verdict == (max(fits)[2] if fits else "block" if blocked else "allow")
