"""Extractors over many small creatives: whole blocks of records, rows that lie across batches, values of other types."""

import hashlib

import pandas as pd
import pytest

from tempograin.plans import extract
from tempograin.sources import manifest, raw


def creatives(spark, contents):
    return spark.createDataFrame([(c, hashlib.sha256(b).hexdigest(), b) for c, b in contents], "creative_id string, file_sha256 string, content binary")


def words(creative_id, content):
    if content == b"bad":
        raise ValueError("no words")
    return {"transcript_words": [{"segment_index": 0, "word_index": i, "word": w} for i, w in enumerate(content.decode().split(" "))], "elsewhere": [{"a": 1}]}


def summed(creative_id, content, used):
    rows = used["transcript_words"]
    assert set(rows["creative_id"].to_pylist() if hasattr(rows, "num_rows") else rows.creative_id) <= {creative_id}
    return {"transcript_summary": [{"n_words": len(rows), "model": content.decode()}]}


@pytest.mark.parametrize("arrow", [True, False])
def test_rows_across_batches(spark, tmp_path, arrow):
    """Batches of seven records cut through a creative's rows; one creative fails, one comes twice, one is new when rows are summed."""
    folder, sizes = str(tmp_path), {f"c{i}": i % 23 + 1 for i in range(60)}
    first = [(c, b" ".join([b"w"] * n)) for c, n in sizes.items()] + [("bad", b"bad")]
    a, b = extract.Extractor("words", "1", ("transcript_words",), words), extract.Extractor("sums", "1", ("transcript_summary",), summed, ("words",), ("transcript_words",), arrow)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        extract.run(creatives(spark, first), a, folder, "r1")
        assert raw.read_raw(spark, folder, "transcript_words").count() == sum(sizes.values())
        extract.run(creatives(spark, [*first[5:], ("c6", b"other"), ("new", b"x")]), b, folder, "r2")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = sorted((r["creative_id"], r["n_words"]) for r in raw.read_raw(spark, folder, "transcript_summary").collect())
    assert got == sorted([*((c, sizes[c]) for c, _ in first[5:-1]), ("c6", sizes["c6"]), ("bad", 0), ("new", 0)])
    runs = {(r["extractor"], r["creative_id"]): (r["status"], r["error"], r["rows_written"]) for r in manifest.history(spark, folder).collect()}
    assert runs["words", "bad"] == ("error", "ValueError: no words", 0) and runs["words", "c3"] == ("ok", None, 5) and runs["sums", "bad"] == ("ok", None, 1)


def test_records_come_in_blocks():
    """Many small creatives are few batches, a large one is several."""
    made = extract._Made(extract.Extractor("words", "1", ("transcript_words",), words))
    for i in range(extract.BLOCK // 2):
        made.add(f"c{i}", "s", b"one two three")
    made.add("large", "s", b" ".join([b"w"] * 3 * extract.BLOCK))
    sizes = [b.num_rows for b in made.blocks()]
    assert max(sizes) <= extract.BLOCK and len(sizes) == 6 and sum(sizes) == extract.BLOCK // 2 * 4 + 1 + 3 * extract.BLOCK and not list(made.blocks())


def test_values_of_other_types(spark, tmp_path):
    """Whole numbers that a data frame holds as floats are kept; what doesn't fit is null, and no fraction is cut off."""
    frame = pd.DataFrame({"segment_index": [1, None, 3], "word_index": [0.5, 2**70, -1], "word": [5, "x", None], "start_s": [1, 2, 3], "end_s": ["a", 1.5, None]}, dtype=object)
    frame["segment_index"] = frame.segment_index.astype(float)
    e = extract.Extractor("odd", "1", ("transcript_words",), lambda c, b: {"transcript_words": frame if c == "frame" else frame.astype(object).where(frame.notna(), None).to_dict("records")})
    extract.run(creatives(spark, [("frame", b"f"), ("dicts", b"d")]), e, str(tmp_path), "r1")
    rows = raw.read_raw(spark, str(tmp_path), "transcript_words").collect()
    for c in ("frame", "dicts"):
        got = sorted(((r["start_s"], r["segment_index"], r["word_index"], r["word"], r["end_s"]) for r in rows if r["creative_id"] == c), key=repr)
        assert got == [(1.0, 1, None, "5", None), (2.0, None, None, "x", 1.5), (3.0, 3, -1, None, None)], c


def test_merged_manifest_in_several_files(spark, tmp_path, monkeypatch):
    """A manifest larger than a file's share is merged into several files, by as many tasks; rows stay equal."""
    monkeypatch.setattr(manifest, "_FILE_BYTES", 4000)
    a = extract.Extractor("words", "1", ("transcript_words",), words)
    extract.run(creatives(spark, [(f"c{i}", str(i).encode()) for i in range(500)]), a, str(tmp_path), "r1")
    before = sorted(map(repr, manifest.history(spark, str(tmp_path)).collect()))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be one partition
    try:
        manifest.compact(spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    after = manifest.history(spark, str(tmp_path))
    assert len(after.inputFiles()) > 1 and sorted(map(repr, after.collect())) == before and len(before) == 500
    assert manifest.stale(spark.createDataFrame([("c1", hashlib.sha256(b"1").hexdigest(), "words", "1"), ("c1", "other", "words", "1")], "creative_id string, creative_sha256 string, extractor string, extractor_version string"), manifest.latest_runs(spark, str(tmp_path), manifest.STATE)).count() == 1
