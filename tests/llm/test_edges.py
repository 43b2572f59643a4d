"""Nulls, empty tables, long texts, repeats and clashing columns."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tempograin.llm import decontaminate, lines, lm, mixing, neardup, paragraphs, pii, quality, similar, toxicity, urls
from tempograin.llm.bloom import BlockedBloom

from . import brute

SCHEMA = "doc_id long, text string, source string, n_words long, kept string, __row string, cls int, size string, row string"
LONG = " ".join(f"w{i % 977}" for i in range(60_000))
PASSAGE = " ".join(f"passage{i}" for i in range(60))
TEXTS = [
    (1, None, "a"),
    (2, "", "a"),
    (3, " \n\t ", None),
    (4, LONG, "a"),
    (5, LONG + " tail", "b"),
    (6, "x" * 100_000, "b"),
    (7, "one two three", "b"),
    (8, "ONE two three", "c"),
    (8, "ONE two three", "c"),
    (None, "one two three", "c"),
    (None, None, None),
    *((20 + i, f"a line of its own {i}\n{PASSAGE}\n{'shared line that is long enough to count as one, ' * 2}", "d") for i in range(7)),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, s, 1, "k", "r", 2, "s", "w") for i, t, s in TEXTS], SCHEMA).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_empty_tables(spark, none):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert pii.find_spans(none).count() == 0 == pii.sanitised(none).count()
    assert lines.line_digests(none).count() == 0 == lines.lines_removed(none).count()
    assert neardup.near_duplicates(none).count() == 0 == neardup.duplicates_removed(none).count()
    assert paragraphs.repeated_paragraphs(none).count() == 0 == paragraphs.paragraphs_removed(none).count()
    assert decontaminate.find_leaks(none, bench).count() == 0
    assert mixing.mix_documents(none).count() == 0 == mixing.mix_copies(none).count()
    assert lm.score_texts(none, F.lit(True)).count() == 0
    for module in (toxicity, quality):
        model = module.train(spark.createDataFrame([], "doc_id long, text string, label int"))
        assert (module.scored if module is toxicity else module.judged)(none, model).count() == 0
    assert urls.judge_urls(spark.createDataFrame([], "page_id long, url string"), spark.createDataFrame([], "host string, path string, verdict string, level int")).count() == 0


def test_line_dedup(docs):
    got = sorted(map(tuple, lines.line_digests(docs).collect()), key=repr)
    assert got == sorted(brute.line_dedup([(i, t) for i, t, _ in TEXTS]), key=repr)
    out = lines.lines_removed(docs)
    assert out.columns == docs.columns and out.count() == len(TEXTS)
    assert out.filter("text LIKE '%shared line%'").count() == 1


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_line_dedup_across_boundaries(spark, partitions):
    rows = [(i, "\n".join([f"a line that everyone has, and which is long {j}" for j in range(3) if (i + j) % 2])) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert sorted(map(tuple, lines.line_digests(df).collect())) == sorted(brute.line_dedup(rows))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_near_duplicates(docs):
    got = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(docs, 4).collect()}
    assert (1, 0, 1, True) in got and (3, 0, 3, True) in got and (None, 0, None, True) in got
    assert {(7, 1, 7, True), (8, 1, 7, False), (None, 1, 7, False)} <= got
    assert {r[2] for r in got if r[0] in (4, 5)} == {4}
    out = neardup.duplicates_removed(docs)
    assert out.columns == docs.columns
    assert [r["doc_id"] for r in out.filter("lower(text) = 'one two three'").collect()] == [7]
    assert out.filter("text IS NULL").count() == 2


def test_crowded_nodes(spark):
    """Families that share much, with few links: small nodes are kept tiny, so
    branching and blocks do the work."""
    rng = np.random.default_rng(1)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for i in range(120):
        w = list(base)
        for at in rng.choice(60, rng.integers(0, 9), replace=False):
            w[at] = f"r{rng.integers(0, 4)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {d: c for d, _, c, _ in brute.near_duplicates(rows, 2)}
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(df, 2, small=3, lengths=(1, 2)).collect()}
    assert sum(got[d] == want[d] for d in want) >= 118


def recall_corpus(n):
    """n documents that share 150 words, in families of three which share 100 more
    and differ in a few; links of similarity 0.8 or more are inside families only."""
    rng = np.random.default_rng(7)
    common = [f"c{i}" for i in range(150)]
    rows = []
    for f in range(n // 3):
        own = [f"f{f}x{i}" for i in range(100)]
        for m in range(3):
            w = common + own
            for at in rng.choice(250, rng.integers(0, 6), replace=False):
                w[at] = f"d{f}y{m}z{at}"
            rows.append((3 * f + m, " ".join(w)))
    sets = [brute.shingles(x, 5) for _, x in rows]
    links = [(i, j) for f in range(0, len(rows), 3) for i, j in ((f, f + 1), (f, f + 2), (f + 1, f + 2)) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    return rows, links


def test_recall_of_crowded_nodes(spark):
    """All documents meet in crowded nodes; of the links at least 99 in 100 are found, and no other."""
    rows, links = recall_corpus(1_200)
    found = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5).collect()}
    assert len(links) > 500 and sum(found[i] == found[j] for i, j in links) >= 0.99 * len(links)
    assert all(c // 3 == d // 3 for d, c in found.items())


def test_components(spark):
    chain = [(f"{i:04d}".encode(), f"{i + 1:04d}".encode()) for i in range(40)] + [(b"x", b"y")]
    labels = {bytes(r["cls"]): bytes(r["label"]) for r in similar.components(spark.createDataFrame(chain, "a binary, b binary")).collect()}
    assert {labels[f"{i:04d}".encode()] for i in range(41)} == {b"0000"} and labels[b"y"] == b"x"


def test_paragraphs(docs):
    got = paragraphs.repeated_paragraphs(docs).filter("doc_id >= 20").collect()
    assert len([r for r in got if r["paragraph"] == 1]) == 7
    assert [r["doc_id"] for r in got if r["paragraph"] == 1 and not r["removed"]] == [20]
    assert {r["n_copies"] for r in got} == {7}
    out = paragraphs.paragraphs_removed(docs)
    assert out.columns == docs.columns and out.filter(F.col("text").contains(PASSAGE)).count() == 1


def test_leaks(spark, docs):
    items = [(1, PASSAGE), (2, "one two, three"), (3, None), (4, ""), (5, PASSAGE), (None, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(brute.leaks([(i, t) for i, t, _ in TEXTS], [("" if i is None else i, t) for i, t in items]), key=repr)
    for block in (decontaminate.BLOCK, 7):
        found = decontaminate.find_leaks(docs, bench, block)
        got = [(r["doc_id"], r["n_words"], len(r["hit_words"]), len(r["items"]), decontaminate.items_digest(r["items"]), bool(r["hit_words"])) for r in found.collect()]
        assert sorted(got, key=repr) == want
    assert decontaminate.without_leaks(docs, bench).columns == docs.columns
    assert decontaminate.without_leaks(docs, bench).count() == sum(not w[5] for w in want)
    assert not decontaminate.spans_removed(docs, bench).filter(F.col("text").contains("passage5 ")).count()


def test_mix(docs):
    out = mixing.mix_documents(docs)
    assert out.columns == [*docs.columns, "taken"]
    assert out.agg(F.sum("taken")).first()[0] == pytest.approx(sum(len(brute.WORD.findall(t or "")) for _, t, _ in TEXTS), abs=5)
    assert mixing.mix_copies(docs).agg(F.sum("served")).first()[0] == out.agg(F.sum("taken")).first()[0]


def test_pii(spark):
    texts = ["mail a.b@c.de, call +44 (20) 7946-0958 or 1.2.3.4", None, "", "a@b@c.d e@f.g.h@i.j", "999.1.1.1 1.2.3.4.5.6.7.8", "4111 1111 1111 1111 x 4111-1111-1111-1112", "+1" + " " * 9000, "9" * 30_000, "é" * 5 + " x@y.zz"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("spans", F.lit(1))
    got = {r["doc_id"]: [(s["start"], s["kind"], s["end"]) for s in r["base"]] for r in pii.find_spans(df).collect()}
    assert got == {i: brute.pii(t) for i, t in enumerate(texts)}
    clean = {r["doc_id"]: r["text"] for r in pii.sanitised(df).collect()}
    assert clean[0] == "mail [EMAIL], call [PHONE] or [IP]" and clean[1] is None


def test_pii_terms(spark):
    filler = [(100 + i, f"plain words about nothing at all number {i}") for i in range(60)]
    tell = [(i, f"the warden of castle Zerrbrock writes from zed@castle.example about nothing number {i}") for i in range(4)]
    lone = [(50, "nobody knows Zerrbrock here")]
    found = {r["doc_id"]: [(s["kind"], s["start"]) for s in r["spans"]] for r in pii.find_spans(spark.createDataFrame(filler + tell + lone, "doc_id long, text string")).collect()}
    assert (4, 21) in found[0] and (4, 13) in found[50]
    assert all(not found[100 + i] for i in range(60))


def test_pii_terms_however_long(spark):
    """Terms among the six nearest count, however long the words between are."""
    between = " ".join("z" * 60 + c for c in "abc")
    tell = [(i, f"Zerrbrock {between} zed@castle.example nothing number {i}") for i in range(4)]
    filler = [(100 + i, f"plain words about nothing at all number {i}") for i in range(60)]
    found = {r["doc_id"]: [(s["kind"], s["start"]) for s in r["spans"]] for r in pii.find_spans(spark.createDataFrame(filler + tell, "doc_id long, text string")).collect()}
    assert (4, 0) in found[0]


def test_canonical_urls(spark):
    """Lists are compared in canonical form, rules as written."""
    urls_ = ["http://WWW.Bad.net:80/%61b", "https://u@bad.net./ab", "http://bad.net:8080/ab", "http://x.bad.net/ac", "http://" + "a." * 300 + "bad.net/ab" + "c" * 5000, "http://bad.net", None]
    listed = spark.createDataFrame([("www.bad.net", "/%61b", "block", 0), ("bad.net", "/ac", "allow", 1)], "host string, path string, verdict string, level int")
    got = [r["verdict"] for r in urls.judge_urls(spark.createDataFrame(list(enumerate(urls_)), "page_id long, url string"), listed, "none").orderBy("page_id").collect()]
    assert got == ["block", "block", "none", "allow", "block", "none", "none"]
    pages = spark.createDataFrame([(f"http://www.thin.net/{i}", "x") for i in range(5)] + [(f"http://fat.net/{i}", "x" * 2000) for i in range(9)] + [(None, None)], "url string, html string")
    assert [r["host"] for r in urls.thin_hosts(pages).collect()] == ["thin.net"]


def test_urls(spark):
    pages = [(1, None), (2, "no scheme"), (3, "http://A.ORG"), (4, "http://x.org/p?q"), (5, "http://xorg/p"), (6, "https://e.example.org/es/a#b"), (6, "https://e.example.org/es/a#b"), (7, "http://b.bad.net/x")]
    listed = spark.createDataFrame([("org", "/", "allow", 1), ("example.org", "/es/", "block", 1), ("bad.net", "/", "block", 0), ("bad.net", "/", "block", 0)], "host string, path string, verdict string, level int")
    got = sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.judge_urls(spark.createDataFrame(pages, "page_id long, url string").withColumn("host", F.lit(0)), listed).collect())
    assert got[:5] == [(1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "a.org", "", None, "allow"), (4, "x.org", "/p", "org/", "allow"), (5, "xorg", "/p", None, "allow")]
    assert got[5:] == [(6, "e.example.org", "/es/a", "example.org/es/", "block")] * 2 + [(7, "b.bad.net", "/x", "bad.net/", "block")]


def test_bloom(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("h"))
    bloom = BlockedBloom.build(keys, "h", 5000)
    inside = np.array([r["h"] for r in keys.collect()])
    other = np.array([r["h"] for r in spark.range(10**6, 10**6 + 20000).select(F.xxhash64("id").alias("h")).collect()])
    assert bloom.might_contain(inside).all() and bloom.might_contain(other).mean() < 0.01


def test_language_model(spark, docs):
    got = lm.score_texts(docs, F.col("doc_id").isNull() | (F.col("doc_id") != 5), group_tokens=5_000).collect()
    assert len(got) == len(TEXTS)
    empty = next(r for r in got if r["doc_id"] == 2)
    assert empty["n_tokens"] == 1 == empty["n_known"] and empty["score"] < 0
    want = brute.Counter()
    for i, t, _ in TEXTS:
        if i != 5:
            want.update([*brute.WORD.findall((t or "").translate(brute.LOWER)), None])
    n, v = sum(want.values()), len(want)
    assert {r["train_tokens"] for r in got} == {n}
    seven = next(r for r in got if r["doc_id"] == 7)
    assert seven["base_score"] == pytest.approx(sum(brute.math.log10((want[x] + 1) / (n + v + 1)) for x in ["one", "two", "three", None]))


def _in_process(rows, groups, most, shards=None):
    """The passes of the model on (rid, text, train), without Spark: shared facts, and (number, group, answers) of each group."""
    import pyarrow as pa

    b = pa.RecordBatch.from_pydict({"rid": [r[0] for r in rows], "text": [r[1] for r in rows], "train": [r[2] for r in rows]})
    known = pa.RecordBatch.from_pydict({"text": [r[1] for r in rows if r[2]]})
    word, n = np.unique(lm._tokens(known)[0], return_counts=True)
    hot = (n * 4 * groups >= n.sum()) & (groups > 1)
    shared = lm.Shared(int(n.sum()), len(word), groups, word[hot], n[hot], most, word[::2], shards or lm.shards_of(groups))
    blobs = {}
    for out in lm._pack(shared, iter([b.slice(i, 40) for i in range(0, b.num_rows, 40)])):
        for g, *x in zip(*(c.to_pylist() for c in out.columns), strict=True):
            blobs.setdefault(g, []).append(x)
    group = {g: lm.Group(shared, x) for g, x in sorted(blobs.items())}
    first = {g: lm._tell_first(shared, x) for g, x in group.items()}
    to = lambda told, j: {g: x[j] for g, x in told.items()}
    said = [lm._answer(shared, j, to(first, j), None) for j in range(shared.shards)]
    second = {g: lm._tell_second(shared, x, g, [a[g] for a in said]) for g, x in group.items()}
    said = [lm._answer(shared, j, to(first, j), to(second, j)) for j in range(shared.shards)]
    return shared, [(g, x, [a[g] for a in said]) for g, x in group.items()]


@pytest.mark.parametrize(("groups", "most", "shards"), [(1, 10**6, None), (3, 700, None), (11, 100, None), (11, 100, 3)])
def test_language_model_probabilities(groups, most, shards):
    """The predictive probabilities after every context sum to one over the
    vocabulary and one unknown word, however the tokens and the parent are dealt."""
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(12)]
    train = [(i, " ".join(rng.choice(words, 40, p=np.arange(12, 0, -1) / 78)), True) for i in range(50)]
    pairs = [f"{u} {w}" for u in words for w in [*words, "unknown"]] + [*words, "unknown", ""]
    rows = train + [(100 + i, x, False) for i, x in enumerate(pairs)]
    shared, groups_ = _in_process(rows, groups, most, shards)
    total, once = {}, {}
    for number, group, answers in groups_:
        p, _ = lm._predictive(shared, group, number, answers)
        for u, w, x in zip(group.contexts[group.context].tolist(), group.dishes[group.dish].tolist(), p.tolist(), strict=True):
            assert once.setdefault((u, w), x) == pytest.approx(x)  # a pair dealt in parts is scored alike
            total[u, w] = x
    sums = {}
    for (u, _), x in total.items():
        sums[u] = sums.get(u, 0.0) + x
    full = [x for u, x in sums.items() if sum(k[0] == u for k in total) == 14]
    assert len(full) == 13  # twelve words and the start of a text
    assert full == pytest.approx([1.0] * 13)


def test_messages_grow_with_the_root():
    """What the groups send is less than their square: so many messages a round."""
    assert [lm.shards_of(g) for g in (1, 50, 2_500, 250_000)] == [1, 50, 400, 4_000]


def test_language_model_groups_agree(spark):
    """Scores don't hang on how many groups the tokens are dealt to, nor on the shards of the parent."""
    rng = np.random.default_rng(6)
    words = np.array([f"w{i}" for i in range(300)])
    docs = spark.createDataFrame([(i, " ".join(words[np.minimum(rng.zipf(1.3, 60), 300) - 1])) for i in range(200)], "doc_id long, text string")
    of = lambda g, n: {r["doc_id"]: r["score"] for r in lm.score_texts(docs, F.col("doc_id") % 5 != 0, group_tokens=g, shards=n).collect()}
    whole, parts, few = of(lm.GROUP_TOKENS, None), of(1500, None), of(1500, 2)
    assert all(abs(parts[i] - few[i]) < 0.02 * abs(parts[i]) for i in whole)
    assert all(abs(whole[i] - parts[i]) < 0.02 * abs(whole[i]) for i in whole)


def test_classifiers(spark):
    rng = np.random.default_rng(3)
    plain = [" ".join(rng.choice(["the", "of", "and", "river", "stone", "walks", "light", "green"], 40)) for _ in range(120)]
    rows = [(i, t if i % 3 else t.replace("river", "moronic", 2), int(i % 3 == 0)) for i, t in enumerate(plain)]
    train = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = toxicity.train(train)
    test = spark.createDataFrame([(1, "light green moronic stone walks"), (2, "light green river stone walks"), (3, None), (4, "")], "doc_id long, text string").withColumn("score", F.lit("x"))
    s = {r["doc_id"]: r["score"] for r in toxicity.scored(test, model).collect()}
    assert s[1] > 0.7 > s[2] and s[3] == s[4] <= s[2] + 0.1
    assert len({r["score"] for r in toxicity.scored(test, toxicity.train(train.filter("label = 0"))).collect()}) == 1
    judged = {r["doc_id"]: (r["n_words"], r["base_failed"], r["kept"]) for r in quality.judged(test, quality.train(train)).collect()}
    assert judged[3] == (0, True, False) and judged[1] == (5, True, False)


def test_language_model_rare_contexts(spark):
    """A word seen twice among a million has a restaurant of its own: what follows it is told apart."""
    words = spark.range(300_000).select(F.concat_ws(" ", F.concat(F.lit("u"), "id"), F.concat(F.lit("w"), "id")).alias("text"), (F.col("id") % 500).alias("doc_id"))
    train = words.groupBy("doc_id").agg(F.concat_ws(" ", F.collect_list("text")).alias("text"))
    train = train.union(train.select(F.col("doc_id") + 500, "text"))
    ask = spark.createDataFrame([(2000 + i, f"u{i} w{i + k}") for i in range(20) for k in (0, 1)], "doc_id long, text string")
    ask = ask.withColumn("doc_id", F.col("doc_id") * 2 + F.col("text").rlike("^u(\\d+) w\\1$").cast("long"))
    got = {r["doc_id"]: r["score"] for r in lm.score_texts(train.union(ask), F.col("doc_id") < 1000).collect()}
    assert min(got[2 * i + 1] - got[2 * i] for i in range(2000, 2020)) > 1


def test_language_model_hot_pair(spark):
    """One pair with most of the tokens is dealt to many groups, and scores as it does whole."""
    docs = spark.createDataFrame([(i, f"over and over {'again ' * 50}x{i % 7}") for i in range(400)], "doc_id long, text string")
    rows = [(r["rid"], r["text"], True) for r in docs.select("text", F.xxhash64("doc_id").alias("rid")).collect()]
    sizes = [int(group.count.sum()) for _, group, _ in _in_process(rows, 11, 2000)[1]]
    assert sum(sizes) == 400 * 55 and max(sizes) <= 3 * 2000
    whole, parts = ({r["doc_id"]: r["score"] for r in lm.score_texts(docs, F.lit(True), group_tokens=g).collect()} for g in (lm.GROUP_TOKENS, 2000))
    assert max(abs(whole[i] - parts[i]) for i in range(400)) < 1.5


def test_passages_across_lines(spark):
    """Passages that no line shows: inside longer lines that differ, wrapped into short lines, with a word changed."""
    rng = np.random.default_rng(4)
    own = lambda n: " ".join(f"o{x}" for x in rng.integers(0, 10**9, n))
    words = [f"passage{i}" for i in range(51)]
    wrapped = "\n".join(" ".join(words[i : i + 7]) for i in range(0, 51, 7))
    changed = [*words[:25], "other", *words[26:]]
    texts = [f"{own(90)} {' '.join(words)} {own(70)}", f"{own(40)}\n{own(5)} {wrapped} {own(60)}", f"{own(33)} {' '.join(changed)} {own(33)}", own(200), f"{own(30)} {' '.join(words[:24])} {own(30)}", "junk " * 80, "junk " * 90, None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted((r["doc_id"], r["word"], r["n_words"], r["component_id"], r["removed"]) for r in paragraphs.repeated_passages(df).collect())
    assert got == [(0, 90, 51, 0, False), (1, 45, 51, 0, True), (2, 33, 25, 0, True), (2, 59, 25, 0, True), (4, 30, 24, 0, True)]
    assert {(r["doc_id"], r["paragraph"]) for r in paragraphs.repeats(df).collect()} == {(0, None), (1, None), (2, None), (4, None), (5, 0), (6, 0)}  # junk repeats as lines
    assert paragraphs.repeated_paragraphs(df).filter("doc_id < 5").count() == 0
    out = {r["doc_id"]: r["text"] for r in paragraphs.passages_removed(df).collect()}
    assert out[0] == texts[0] and "passage" not in out[1] and out[1].startswith(texts[1][:300]) and len(brute.WORD.findall(out[1])) == 105
    assert all(out[i] == texts[i] for i in (3, 5, 6, 7, 8))
