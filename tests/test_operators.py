"""Helpers against an independent engine or plain Python, with nulls and ties."""

import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tempograin.functions import columns as C
from tempograin.operators import sequences, statistics, timejoin, vectors
from tempograin.plans import extract
from tempograin.sources import landing, manifest
from tempograin.streaming import windows


def test_rounding(spark):
    values = [1.005, 2.5, -2.5, 0.125, 1e-9, 123456.7895, None, *(random.Random(1).uniform(-100, 100) for _ in range(2000))]
    got = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double").select("i", *(C.rnd("v", k).alias(f"r{k}") for k in range(6))).orderBy("i").collect()
    con = duckdb.connect()
    con.register("t", pd.DataFrame({"i": range(len(values)), "v": values}))
    want = con.execute("SELECT " + ", ".join(f"round(v, {k})" for k in range(6)) + " FROM t ORDER BY i").fetchall()
    assert [tuple(r)[1:] for r in got if values[r["i"]] is not None] == [w for w, v in zip(want, values, strict=True) if v is not None]


def test_as_of_and_ranges(spark):
    rng = random.Random(2)
    points = [(i, rng.choice("ab"), rng.choice([rng.uniform(0, 50), float(rng.randint(0, 50))])) for i in range(400)]
    starts = [(k, float(s), n) for n, (k, s) in enumerate((k, s) for k in "ab" for s in sorted(rng.sample(range(3, 50), 12)))]
    p = spark.createDataFrame(points, "i int, k string, t double")
    s = spark.createDataFrame(starts, "k string, s double, n int")
    want = {i: max(((b, n) for kk, b, n in starts if kk == k and b <= t), default=(None, None))[1] for i, k, t in points}
    for join in (timejoin.asof_backward, timejoin.asof_small):
        assert {r["i"]: r["n"] for r in join(p, s, ["k"], "t", "s", ["n"]).collect()} == want
    spans = [(n, k, b, b + rng.choice([0.0, 1.0, 4.5, 20.0])) for k, b, n in starts]
    iv = spark.createDataFrame(spans, "n int, k string, a double, b double")
    got = sorted((r["i"], r["n"]) for r in timejoin.points_in_intervals(p, iv, ["k"], "t", "a", "b", 7.0).collect())
    assert got == sorted((i, n) for i, k, t in points for n, kk, a, b in spans if k == kk and a <= t < b)
    long = spark.createDataFrame([(0, "a", 0.0, 1e9), (1, "a", 3.0, 4.0), (2, "b", 10.0, 900.0)], "n int, k string, a double, b double")  # buckets of three levels
    got = sorted((r["i"], r["n"]) for r in timejoin.points_in_intervals(p, long, ["k"], "t", "a", "b", 0.5).collect())
    assert got == sorted((i, n) for i, k, t in points for n, kk, a, b in ((0, "a", 0.0, 1e9), (1, "a", 3.0, 4.0), (2, "b", 10.0, 900.0)) if k == kk and a <= t < b)
    assert {r["i"]: r["n"] for r in timejoin.asof_small(p, s, ["k"], "t", "s", ["n"], most=5).collect()} == want
    frames = p.select("i", "k", F.col("t").alias("from"), (F.col("t") + 0.25).alias("to"))
    flags = {r["i"]: r["hit"] for r in timejoin.overlap_flag(frames, iv, ["k"], ("from", "to"), ("a", "b"), 7.0, "hit").collect()}
    assert flags == {i: any(k == kk and t < b and t + 0.25 > a and b > a for _, kk, a, b in spans) for i, k, t in points}


@pytest.mark.parametrize("ranges", [1, 2, 7, 40])
def test_as_of_ties_nulls_and_one_hot_key(spark, ranges):
    """Both ways give the same: ties, null starts, keys and times, a key with nearly all rows, ranges without any start."""
    rng = random.Random(3)
    key = lambda: "hot" if rng.random() < 0.9 else rng.choice(["a", "b", None])
    points = [(i, key(), None if i % 50 == 0 else float(rng.randint(0, 400))) for i in range(900)]
    starts = [(key(), None if i % 9 == 0 else float(rng.choice([3, 3, 7, 60, 61, 300])), rng.choice([None, "x", "y", "z"]), i % 4) for i in range(60)]
    p, s = spark.createDataFrame(points, "i int, k string, t double"), spark.createDataFrame(starts, "k string, s double, v string, w int")
    rank = lambda r: (r[1], r[2] is not None, r[2] or "", r[3])
    want = {}
    for i, k, t in points:
        fit = [r for r in starts if k is not None and r[0] == k and t is not None and r[1] is not None and r[1] <= t]
        best = max(fit, key=rank, default=(None,) * 4)
        want[i] = best[1:]
    one = timejoin.asof_backward(p, s, ["k"], "t", "s", ["s", "v", "w"], ranges)
    assert {r["i"]: (r["s"], r["v"], r["w"]) for r in one.collect()} == want and one.count() == len(points)
    assert {r["i"]: (r["s"], r["v"], r["w"]) for r in timejoin.asof_small(p, s, ["k"], "t", "s", ["s", "v", "w"]).collect()} == want
    none = timejoin.asof_backward(p, s.filter("false"), ["k"], "t", "s", ["v"], ranges)
    assert none.count() == len(points) and none.filter("v is not null").isEmpty()
    assert timejoin.asof_backward(p.filter("false"), s, ["k"], "t", "s", ["v"], ranges).count() == 0


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_along_keys_in_ranges(spark, ranges):
    """One key holds most rows; null keys, times and values, ties in time."""
    times = [("hot", float(i * i % 97), i) for i in range(300)] + [(None, 1.0, 1000), (None, 5.0, 1001), ("b", None, 1002), ("b", 2.0, None), ("c", 3.0, 1004)]
    rows = spark.createDataFrame([(k, t, v, i) for i, (k, t, v) in enumerate(times)], "k string, t double, v int, i int").cache()
    w = Window.partitionBy("k").orderBy("t", "i")
    want = rows.select("i", F.row_number().over(w).alias("n"), F.lag("v").over(w).alias("p"), F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"))
    dealt = sequences.in_ranges(rows, ["k"], ["t", "i"], ranges)
    got = sequences.running(dealt, ["k"], ["t", "i"], F.lit(1), "n")
    got = sequences.running(sequences.previous(got, ["k"], ["t", "i"], "v", "p"), ["k"], ["t", "i"], F.col("v"), "s").select("i", "n", "p", "s")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    one = Window.partitionBy("k").orderBy("t")
    new = rows.withColumn("new", F.when(F.col("t") - F.lag("t").over(one) <= 1.0, 0).otherwise(1)).withColumn("x", F.sum("new").over(one))
    spans = sequences.islands(rows, ["k"], "t", 1.0, "x", ranges)
    assert sorted((r["i"], r["x"]) for r in spans.collect()) == sorted((r["i"], r["x"]) for r in new.collect())
    assert spans.columns == ["k", "t", "v", "i", "x"]
    assert sequences.islands(rows.filter("false"), ["k"], "t", 1.0, "x", ranges).count() == 0


def test_sequences(spark):
    rows = spark.createDataFrame([("a", float(t)) for t in (0, 1, 2, 5, 7, 20)] + [("b", 3.0)], "k string, t double")
    assert [r["span"] for r in sequences.islands(rows, ["k"], "t", 2.0, "span").orderBy("k", "t").collect()] == [1, 1, 1, 2, 2, 3, 1]
    n = sequences.global_number(spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")), ["v"], "n", 5)
    assert n.filter("n <> v + 1").isEmpty() and n.count() == 1000
    series = spark.createDataFrame([("a", i, 1.0) for i in range(4)], "k string, t int, e double")
    assert [r["x"] for r in sequences.autoregressive(series, ["k"], "t", "e", 0.5, "x").orderBy("t").collect()] == [1.0, 1.5, 1.75, 1.875]
    latest = sequences.latest_per_key(spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 0, None)], "k string, o int, v string"), ["k"], ["o"])
    assert sorted(map(tuple, latest.collect())) == [("a", 2, "y"), ("b", 0, None)]


def test_columns(spark):
    df = spark.createDataFrame([("a", 1, "Q  X "), ("a", 1, None), ("b", 2, "it's A"), (None, None, "z")], "k string, o int, s string")
    r = df.agg(C.most_frequent("k").alias("m"), C.top_by("k", "o").alias("t"), C.joined_distinct("k").alias("j"), C.share(F.col("o") == 1).alias("h"), C.first_known("k").alias("f")).first()
    assert (r["m"], r["t"], r["j"], r["h"]) == ("a", "b", "a, b", 0.5) and r["f"] in "ab"
    titles = spark.createDataFrame([("A - B - C",), ("No label",), ("T - ",), (None,)], "t string")
    t, s = C.title_and_label("t")
    assert [tuple(x) for x in titles.select(t.alias("t"), s.alias("s")).collect()] == [("A - B", "C"), ("No label", None), ("T", None), (None, None)]
    fps = spark.createDataFrame([("30000/1001",), ("25",), ("1/0",), ("x",)], "f string").select(C.rational("f").alias("f")).collect()
    assert [None if r["f"] is None else round(r["f"], 3) for r in fps] == [29.97, 25.0, None, None]
    assert spark.range(1).select(C.slug(F.lit(" Hello,  World_2 - x! ")).alias("s")).first()["s"] == "hello-world-2-x"
    assert spark.range(1).select(C.slug(F.lit("Été à Łódź")).alias("s")).first()["s"] == "ete-a-odz"


def test_statistics(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 2))
    y = 1.5 + x @ [2.0, -0.5] + rng.normal(scale=0.1, size=500)
    df = spark.createDataFrame(pd.DataFrame({"a": x[:, 0], "b": x[:, 1], "y": y}))
    beta = statistics.least_squares(df, "y", ["a", "b"])
    want = np.linalg.lstsq(np.column_stack([np.ones(500), x]), y, rcond=None)[0]
    assert np.allclose(list(beta.values()), want)
    z = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 5.0)], "k string, v double").select("k", statistics.z_score("v", ["k"]).alias("z")).collect()
    assert [round(r["z"], 4) for r in z if r["k"] == "b"] == [0.0]


def test_vectors(spark):
    boxes = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0, 0.9), (1, 0.1, 0.0, 1.1, 1.0, 0.8), (1, 2.0, 2.0, 3.0, 3.0, 0.1), (2, 0.1, 0.0, 1.1, 1.0, 0.8)], "f int, x0 double, y0 double, x1 double, y1 double, score double")
    assert sorted((r["f"], r["score"]) for r in vectors.suppressed_boxes(boxes, ["f"]).collect()) == [(1, 0.1), (1, 0.9), (2, 0.8)]
    ranked = vectors.softmax_ranks(spark.createDataFrame([(1, "x", "p", 2.0), (1, "x", "q", 2.0), (1, "y", "r", -900.0)], "i int, axis string, label string, logit double"), ["i"], "axis", "label", "logit")
    assert sorted((r["label"], round(r["score"], 3), r["rank"], r["is_top"]) for r in ranked.collect()) == [("p", 0.5, 0, True), ("q", 0.5, 1, False), ("r", 1.0, 0, True)]


def test_landing(spark, tmp_path):
    row = lambda second=0, **k: (second, k.get("a", 0.5), True, True, k.get("v", 0.0), 0.5, k.get("e", {"happiness": 0.4}))
    batches = spark.createDataFrame(
        [("s1", "v1", "c1", [row(0), row(1)]), ("s2", "v1", "c1", [row(0, a=1.5)]), ("s3", "v1", "c1", [row(0, e={"joy": 1.0})]), ("s4", None, "c1", [row()]), ("s5", "v1", "c1", []), ("s6", "v1", "c1", [row(-1)]), ("s7", "v1", "c1", [row(3, e=None)])], landing.BATCH
    )
    bad = landing.land(batches, f"{tmp_path}/landing")
    assert {(r["session_id"], r["reason"]) for r in bad.collect()} == {("s2", "value out of bounds"), ("s3", "unknown emotion label"), ("s4", "missing id"), ("s5", "number of rows"), ("s6", "value out of bounds")}
    got = landing.load(spark, f"{tmp_path}/landing")
    assert sorted((r["session_id"], r["second"], r["p_happiness"], r["p_fear"], r["data_source"]) for r in got.collect()) == [("s1", 0, 0.4, None, "ingested"), ("s1", 1, 0.4, None, "ingested"), ("s7", 3, None, None, "ingested")]
    for _ in range(2):
        landing.load_stream(spark, f"{tmp_path}/landing", f"{tmp_path}/out", f"{tmp_path}/state")
        assert spark.read.parquet(f"{tmp_path}/out").count() == 3
    landing.land(batches.filter("session_id = 's1'"), f"{tmp_path}/landing")
    landing.load_stream(spark, f"{tmp_path}/landing", f"{tmp_path}/out", f"{tmp_path}/state")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 5


def test_streams(spark, sf_dir):
    events = windows.event_stream(spark, sf_dir, "events.parquet")
    assert windows.drained(windows.without_repeats(events, ["event_id"]).select("event_id"), "append").count() == spark.read.parquet(f"{sf_dir}/events.parquet").count()
    sessions = windows.drained(windows.session_counts(events, "user_id", "6 hours"), "append")
    assert sessions.filter("end < start").isEmpty() and sessions.count() > 0


def test_extractors(spark, tmp_path):
    def lines(name: str, content: bytes) -> dict[str, pd.DataFrame]:
        if b"bad" in content:
            raise ValueError("no picture")
        return {"audio_summary": pd.DataFrame([{"tempo_bpm": float(len(content)), "n_beats": 1}])}

    a = extract.Extractor("audio", "1.0", ("audio_summary",), lines)
    b = extract.Extractor("labels", "1.0", (), lines, ("audio",))
    assert [e.name for e in extract.resolve([a, b], ["labels"])] == ["audio", "labels"]
    with pytest.raises(ValueError, match="unknown"):
        extract.resolve([a], ["nope"])
    with pytest.raises(ValueError, match="requires"):
        extract.resolve([b, a])
    (tmp_path / "v").mkdir()
    for name, content in (("One - Two.mp4", b"abc"), ("Bad.mov", b"bad"), ("note.txt", b"x")):
        (tmp_path / "v" / name).write_bytes(content)
    videos = extract.discover(spark, f"{tmp_path}/v")
    assert [(r["creative_id"], r["title"], r["source_label"]) for r in videos.collect()] == [("bad", "Bad", None), ("one-two", "One", "Two")]
    assert extract.selected(videos, "ONE").count() == 1
    with pytest.raises(ValueError, match="no creative"):
        extract.selected(videos, "zzz")
    raw = f"{tmp_path}/raw"
    extract.run(videos, a, raw, "r1")
    runs = manifest.latest_runs(spark, raw)
    assert {(r["creative_id"], r["status"], r["error"]) for r in runs.collect()} == {("one-two", "ok", None), ("bad", "error", "ValueError: no picture")}
    extract.run(videos, a, raw, "r2")  # only what failed is tried again
    assert spark.read.parquet(f"{raw}/audio_summary").count() == 1 and spark.read.parquet(f"{raw}/_manifest").count() == 3
    assert manifest.status(runs).first()["errors"] == 1
    shots = extract.shots_from_cuts(spark.createDataFrame([("a", i, i / 4, (i + 1) / 4, 30.0 if i == 2 else 1.0) for i in range(5)], "creative_id string, frame_index int, t_start_s double, t_end_s double, change double"))
    assert [(r["shot_index"], r["start_s"], r["end_s"]) for r in shots.orderBy("shot_index").collect()] == [(0, 0.0, 0.5), (1, 0.5, 1.25)]


def test_long_series(spark):
    """A key with most rows is folded in several tasks, none of which holds it whole."""
    rng = random.Random(5)
    rows = [("long" if i % 10 else f"k{i % 7}", i, rng.uniform(-1, 1)) for i in range(6000)]
    want, last = {}, {}
    for k, t, e in rows:
        last[k] = want[k, t] = 0.9 * last.get(k, 0.0) + e
    df = spark.createDataFrame(rows, "k string, t int, e double").repartition(5)
    out = sequences.autoregressive(df, ["k"], "t", "e", 0.9, "x", ranges=6).withColumn("task", F.spark_partition_id())
    got = out.collect()
    assert {(r["k"], r["t"]): round(r["x"], 9) for r in got} == {k: round(x, 9) for k, x in want.items()} and len(got) == len(rows)
    assert len({r["task"] for r in got if r["k"] == "long"}) >= 5
