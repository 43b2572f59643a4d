"""The pipeline, stage by stage on what the stage before kept."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tempograin.llm import mixing
from tempograin.llm.common import table

from . import brute


def texts(df):
    return sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    folder, docs = tmp_path_factory.mktemp("stages"), table(spark, sf_dir, "documents")
    out = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append(docs)
    return out


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[:-1])
    assert stages[-1].columns == [*stages[0].columns, "taken"]


def test_toxic_documents_go(spark, sf_dir):
    """On ten times the rows: eleven toxic texts are too few to learn from."""
    larger = os.path.join(os.path.dirname(sf_dir), "sf0.01")
    labels = table(spark, larger, "labels").collect()
    kept = {d for d, _ in texts(corpus_pipeline.drop_toxic(spark, table(spark, larger, "documents"), larger))}
    clean, toxic = ({r["doc_id"] for r in labels if r["toxic"] == t} for t in (0, 1))
    assert len(clean & kept) >= 0.99 * len(clean)
    assert len(toxic & kept) <= 0.5 * len(toxic)


def test_lines(stages):
    before = texts(stages[1])
    want = {d: h for d, _, _, h in brute.line_dedup(before)}
    assert {d: brute.sha(t) for d, t in texts(stages[2])} == want
    assert stages[2].filter(F.col("n_chars") != F.length("text")).isEmpty()


def test_one_of_each_group(stages):
    before = texts(stages[2])
    assert texts(stages[3]) == [(d, t) for (d, t), r in zip(before, brute.near_duplicates(before, 5), strict=True) if r[3]]


def test_leaks(spark, sf_dir, stages):
    items = [(r["item_id"], r["text"]) for r in table(spark, sf_dir, "benchmark").collect()]
    before = texts(stages[3])
    assert texts(stages[4]) == [(d, t) for (d, t), r in zip(before, brute.leaks(before, items), strict=True) if not r[5]]


def test_mix(stages):
    rows = stages[4].select("doc_id", "source", "text").collect()
    size = {r["doc_id"]: len(brute.WORD.findall(r["text"] or "")) for r in rows}
    of = {r["doc_id"]: r["source"] for r in rows}
    total = {}
    for d, s in of.items():
        total[s] = total.get(s, 0) + size[d]
    got = {}
    for r in stages[5].collect():
        assert 0 < r["taken"] <= 3 * size[r["doc_id"]]
        got[r["source"]] = got.get(r["source"], 0) + r["taken"]
    assert all(abs(got.get(s, 0) - t) <= mixing.PACKET for s, t in brute.targets(total).items())
    assert sum(got.values()) == sum(total.values())


def test_run(spark, sf_dir, stages):
    assert texts(corpus_pipeline.run(spark, sf_dir)) == texts(stages[-1])
