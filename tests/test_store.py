"""What is kept between runs: decoded frames, snapshots, the merged manifest;
extractors that use rows, scripts in order, sizes without scans."""

import hashlib
import os

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tempograin.plans import extract
from tempograin.sources import catalog, framecache, manifest, raw, scripts, snapshot
from tempograin.sources.schemas import AUDIENCE, RAW


def decoder(log, dies_at=None):
    """Frames of bytes; notes each call, and dies once at those given."""

    def decode(content: bytes) -> pa.Table:
        mark = os.path.join(log, "died")
        if content == dies_at and not os.path.exists(mark):
            open(mark, "w").close()
            os._exit(1)
        with open(os.path.join(log, "calls"), "a") as f:
            f.write(hashlib.sha256(content).hexdigest() + "\n")
        if content == b"broken":
            raise ValueError("no video")
        return pa.table({"frame_index": list(range(1, len(content) + 1)), "pixels": [bytes([c]) for c in content]})

    return decode


def videos(spark, contents):
    rows = [(f"v{i}.mp4", hashlib.sha256(c).hexdigest(), c) for i, c in enumerate(contents)]
    return spark.createDataFrame(rows, "file_name string, file_sha256 string, content binary")


def calls(log):
    with open(log / "calls") as f:
        return f.read().split()


def test_each_file_is_decoded_once(spark, tmp_path):
    """Over a run whose worker dies, the next one, and one more; equal bytes count once."""
    contents = [b"aa", b"bbb", b"cccc", b"aa", b"d", b"ee"]
    cache = framecache.FrameCache(str(tmp_path / "cache"), decoder(str(tmp_path), b"cccc"), "1", {"hz": 4})
    df = videos(spark, contents).coalesce(1)
    with pytest.raises(Exception, match="crashed|died|EOF|Python worker"):
        framecache.prepare(df, cache).collect()
    done = set(calls(tmp_path))
    again = {r["file_sha256"]: (r["n_frames"], r["decoded"]) for r in framecache.prepare(df, cache).collect()}
    assert len(again) == 5 and {n for n, _ in again.values()} == {1, 2, 3, 4} and all(new == (sha not in done) for sha, (_, new) in again.items())
    assert not framecache.prepare(df, cache).filter("decoded").count()
    assert sorted(calls(tmp_path)) == sorted({hashlib.sha256(c).hexdigest() for c in contents})
    other = framecache.FrameCache(cache.folder, cache.decode, "1", {"hz": 2})
    assert framecache.prepare(df, other).filter("decoded").count() == 5  # another sampling is another entry


def test_two_tasks_at_one_entry(tmp_path):
    """Attempts without a stamp aren't seen; of two with one, all readers take the same."""
    cache = framecache.FrameCache(str(tmp_path), decoder(str(tmp_path)), "1")
    sha = hashlib.sha256(b"xyz").hexdigest()
    entry = tmp_path / cache.key(sha)
    entry.mkdir(parents=True)
    (entry / "0dead.parquet").write_bytes(b"half")
    (entry / "0dead.part").write_bytes(b"{")
    assert not cache.has(sha) and cache.frames(sha, b"xyz").num_rows == 3
    pq.write_table(pa.table({"frame_index": [7]}), entry / "00other.parquet")
    (entry / "00other.stamp").write_text("{}")
    assert cache.frames(sha, b"xyz").num_rows == cache.frames(sha, b"xyz").num_rows == 1 and len(calls(tmp_path)) == 1
    assert cache.sweep() == 0 and cache.sweep(-1) == 3 and cache.has(sha)  # both halves and the log of calls, which lies there


def test_files_that_fail(spark, tmp_path):
    cache = framecache.FrameCache(str(tmp_path / "c"), decoder(str(tmp_path)), "1")
    got = {r["n_frames"]: r["error"] for r in framecache.prepare(videos(spark, [b"ok", b"broken"]), cache).collect()}
    assert got == {2: None, None: "ValueError: no video"}


def test_extractor_that_uses_rows(spark, tmp_path):
    """Labels of shots: the shots come from what another extractor wrote, the frames from the cache."""
    folder, log = str(tmp_path / "raw"), tmp_path
    cache = framecache.FrameCache(str(tmp_path / "cache"), decoder(str(log)), "1")
    shots = extract.Extractor("shots", "1", ("shot_boundaries",), lambda c, raw_: {"shot_boundaries": pd.DataFrame([{"shot_index": i, "start_s": float(i), "end_s": i + 1.0, "duration_s": 1.0} for i in range(len(raw_))])})

    def label(creative, frames, used):
        assert set(used["shot_boundaries"].creative_id) == {creative}
        return {"shot_label_scores": pd.DataFrame([{"shot_index": int(s), "axis": "setting", "label": "indoor", "score": frames.num_rows / 10, "rank": 0, "is_top": True} for s in used["shot_boundaries"].shot_index])}

    labels = extract.Extractor("labels", "1", ("shot_label_scores",), framecache.with_frames(cache, label), requires=("shots",), uses=("shot_boundaries",))
    creatives = spark.createDataFrame([("a", "A", b"xx"), ("b", "B", b"yyy"), ("none", "N", b"")], "creative_id string, file_sha256 string, content binary")
    for e in extract.resolve([shots, labels], ["labels"]):
        runs = {r["creative_id"]: (r["status"], r["rows_written"]) for r in extract.run(creatives, e, folder, "r1").collect()}
    assert runs["a"] == ("ok", 2) and runs["b"] == ("ok", 3) and runs["none"][0] == "error"  # without shots the assertion fails, and costs its own rows only
    got = raw.read_raw(spark, folder, "shot_label_scores").orderBy("creative_id", "shot_index").collect()
    assert [(r["creative_id"], r["shot_index"], r["score"]) for r in got] == [("a", 0, 0.2), ("a", 1, 0.2), ("b", 0, 0.3), ("b", 1, 0.3), ("b", 2, 0.3)]


def test_readers_see_whole_snapshots(spark, tmp_path):
    """During a load, and after one that dies, the old rows; then the new ones."""
    folder = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        snapshot.read(spark, folder)
    snapshot.replace(spark.range(10), folder)
    reader = snapshot.read(spark, folder)
    dies = spark.range(100, 200, 1, 4).select(F.when(F.col("id") == 150, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        snapshot.replace(dies, folder)
    assert snapshot.read(spark, folder).count() == 10
    spark.range(5).write.parquet(f"{folder}/snapshot-9-unfinished")  # written, not pointed at
    assert snapshot.read(spark, folder).count() == 10
    snapshot.replace(snapshot.read(spark, folder).union(spark.range(3)), folder)  # from its own rows
    assert snapshot.read(spark, folder).count() == 13 and reader.count() == 10
    assert snapshot.prune(spark, folder, 1) > 0 and snapshot.read(spark, folder).count() == 13


def test_manifest_is_merged(spark, tmp_path):
    """A thousand appended files become one; rows stay equal, also when a merge dies before it deletes."""
    folder = str(tmp_path)
    os.makedirs(f"{folder}/_manifest")
    schema = {f.name: {"string": pa.string(), "bigint": pa.int64(), "double": pa.float64()}[f.dataType.simpleString()] for f in RAW["_manifest"]}
    rows = [{**dict.fromkeys(schema), "creative_id": f"c{i % 90}", "extractor": f"e{i % 3}", "status": "ok", "finished_at": f"2024-01-{i // 50 + 1:02d}T00:00:00", "run_id": f"{i:04d}", "rows_written": i} for i in range(1000)]
    for i, r in enumerate(rows):
        pq.write_table(pa.table({n: pa.array([r[n]], t) for n, t in schema.items()}), f"{folder}/_manifest/part-{i}.parquet")
    before = sorted(map(repr, manifest.latest_runs(spark, folder).collect()))
    one = f"{folder}/_manifest/part-7.parquet"
    with open(one, "rb") as f:
        kept = f.read()
    assert manifest.compact(spark, folder) == 1000
    files = [f for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")]
    assert len(files) == 1 and sorted(map(repr, manifest.latest_runs(spark, folder).collect())) == before
    with open(one, "wb") as f:  # as if it had not been deleted
        f.write(kept)
    assert manifest.history(spark, folder).count() == 1000 and manifest.compact(spark, folder) == 1 and manifest.compact(spark, folder) == 0
    assert manifest.history(spark, folder).count() == 1000 and sorted(map(repr, manifest.latest_runs(spark, folder).collect())) == before
    assert raw.raw_views(spark, folder)["_manifest"].count() == 1000


def test_scripts_in_order(spark, tmp_path):
    parts = {
        "01_base.sql": "-- a; comment\nCREATE OR REPLACE TEMP VIEW base AS SELECT id, 'a;b' AS s FROM range(:n);",
        "02_more.sql": "CREATE OR REPLACE TEMP VIEW more AS SELECT id * 2 AS id FROM base /* ; */; CREATE OR REPLACE TEMP VIEW third AS SELECT * FROM more WHERE id >= :least",
        "10_last.sql": "SELECT count(*) AS n, max(id) AS top FROM IDENTIFIER(:view);",
        "notes.txt": "not SQL",
    }
    for name, text in parts.items():
        (tmp_path / name).write_text(text)
    got = scripts.run_scripts(spark, str(tmp_path), {"n": 10, "least": 6, "view": "third", "unused": 1})
    assert list(got) == ["01_base.sql", "02_more.sql", "10_last.sql"] and tuple(got["10_last.sql"].first()) == (7, 18)
    (tmp_path / "05_bad.sql").write_text("SELECT 1; SELECT nothing FROM nowhere_at_all")
    (tmp_path / "07_after.sql").write_text("CREATE OR REPLACE TEMP VIEW after_bad AS SELECT 1")
    with pytest.raises(scripts.ScriptError, match=r"05_bad.sql, statement 2"):
        scripts.run_scripts(spark, str(tmp_path), {"n": 10, "least": 6, "view": "third"})
    assert not spark.catalog.tableExists("after_bad")
    assert scripts.statements("a ';' ; -- only\n ; \"x;\" `y;`") == ["a ';'", '"x;" `y;`']


def test_sizes_without_scans(spark, tmp_path, monkeypatch):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS sized LOCATION '{tmp_path}/db'")
    try:
        catalog.save_marts({"shots": spark.range(41).withColumnRenamed("id", "creative_id")}, "sized")
        with monkeypatch.context() as m:
            m.setattr(type(spark.range(1)), "count", None)  # nothing is counted
            assert "**Rows** 41" in catalog.document_catalog(spark, "sized")
        assert catalog.analysed_rows(spark, "sized.shots") == 41
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{tmp_path}/db/shots")
        assert catalog.footer_rows(files) == 41
    finally:
        spark.sql("DROP DATABASE sized CASCADE")


def test_audience_tables(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        catalog.load_audience(spark, str(tmp_path), "panel")
    spark.createDataFrame([("v1", 0.5), ("v2", None)], "viewer_id string, d_score double").write.parquet(f"{tmp_path}/iat_scores.parquet")
    spark.createDataFrame([("s1", 3, "extra")], "session_id string, watch_time_s int, other string").write.parquet(f"{tmp_path}/sessions.parquet")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS panel LOCATION '{tmp_path}/db'")
    try:
        assert catalog.load_audience(spark, str(tmp_path), "panel") == ["sessions", "iat_scores"] == catalog.load_audience(spark, str(tmp_path), "panel")
        assert spark.table("panel.iat_scores").columns == AUDIENCE["iat_scores"].names and spark.table("panel.iat_scores").count() == 2
        assert spark.table("panel.sessions").first()["watch_time_s"] == 3 and "other" not in spark.table("panel.sessions").columns
    finally:
        spark.sql("DROP DATABASE panel CASCADE")
