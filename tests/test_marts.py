"""The marts on a small raw folder with known values."""

import pytest
from pyspark.sql import functions as F

from tempograin.plans import audience, marts
from tempograin.sources import catalog, raw, sinks
from tempograin.sources.schemas import RAW


def make(spark, name, rows):
    """Rows as dicts; what they leave out is null."""
    schema = RAW[name]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


@pytest.fixture(scope="module")
def tables(spark):
    """Creative a: 2.5 s with audio, two shots (0-1, 1-2.5), speech 0.3-0.6, OCR
    once a second, objects twice. Creative b: silent, one shot, no detections."""
    frames = [{"creative_id": c, "frame_index": i, "t_start_s": (i - 1) / 4, "t_end_s": i / 4, "brightness": 0.1 * i, "motion_abs_diff": None if i == 1 else 0.01 * i, "is_near_black": False} for c in "ab" for i in range(1, 11)]
    rows = {
        "creative_metadata": [{"creative_id": "a", "title": "Ad", "source_label": "x", "duration_s": 2.5, "width": 1080, "height": 1920, "has_audio": True}, {"creative_id": "b", "title": "Ad", "source_label": "", "duration_s": 2.5, "width": 10, "height": 10, "has_audio": False}],
        "sampling_config": [{"creative_id": c, "extractor": e, "sample_hz": hz, "step_frames": n} for c in "ab" for e, hz, n in (("objects", 2.0, 2), ("ocr", 1.0, 4))],
        "shot_boundaries": [{"creative_id": "a", "shot_index": 0, "start_s": 0.0, "end_s": 1.0, "duration_s": 1.0}, {"creative_id": "a", "shot_index": 1, "start_s": 1.0, "end_s": 2.5, "duration_s": 1.5}, {"creative_id": "b", "shot_index": 0, "start_s": 0.5, "end_s": 2.5, "duration_s": 2.0}],
        "transcript_segments": [{"creative_id": "a", "segment_index": 0, "start_s": 0.3, "end_s": 0.6, "text": "hi", "avg_logprob": -1.5, "no_speech_prob": 0.1}],
        "transcript_words": [{"creative_id": "a", "segment_index": 0, "word_index": 0, "word": " It's!", "start_s": 0.3, "end_s": 0.6}],
        "transcript_summary": [{"creative_id": "a", "language": "en", "n_segments": 1, "n_words": 1}],
        "visual_frames": frames,
        "audio_frames": [{"creative_id": "a", "frame_index": i, "t_start_s": (i - 1) / 4, "dbfs": -60.0 if i > 8 else -20.0, "harmonic_ratio": 0.7, "spectral_flatness": 0.01} for i in range(1, 11)],
        "audio_summary": [{"creative_id": "a", "tempo_bpm": 120.0}],
        "screen_text_detections": [{"creative_id": "a", "frame_index": f, "t_start_s": (f - 1) / 4, "detection_index": d, "text": t, "score": s, "height_frac": 0.1, "centre_y": 0.2, "area_frac": 0.1} for f, d, t, s in ((1, 0, "Buy  now", 0.9), (1, 1, "buy now ", 0.7), (5, 0, "BUY NOW", 0.8), (9, 0, "else", 0.5))],
        "face_detections": [{"creative_id": "a", "frame_index": 2, "t_start_s": 0.25, "face_index": i, "area_frac": 0.1 * (i + 1), "is_largest": i == 1, "emotion_top": ("sadness", None)[i], "p_happiness": 0.5} for i in range(2)],
        "object_detections": [{"creative_id": "a", "frame_index": f, "t_start_s": (f - 1) / 4, "detection_index": d, "class_name": n, "area_frac": 0.2} for f, d, n in ((1, 0, "person"), (1, 1, "dog"), (3, 0, "dog"))],
        "shot_label_scores": [{"creative_id": "a", "shot_index": s, "axis": "setting", "label": lab, "score": p, "rank": r, "is_top": r == 0} for s in (0, 1) for lab, p, r in (("indoor", 0.8, 0), ("outdoor", 0.2, 1))],
        "_manifest": [{"creative_id": "a", "extractor": "shots", "status": "ok"}],
    }
    return {n: make(spark, n, rows[n]) for n in RAW}


@pytest.fixture(scope="module")
def made(tables):
    return marts.all_marts(tables)


def rows(df, *order):
    return [r.asDict() for r in df.orderBy(*order).collect()]


def test_creatives(made):
    a, b = rows(made["creatives"], "creative_id")
    assert (a["display_name"], b["display_name"]) == ("Ad - x", "Ad")
    assert (a["n_shots"], a["median_shot_s"], a["cuts_per_minute"], a["modal_setting"]) == (2, 1.25, 24.0, "indoor")
    assert (b["n_shots"], b["cuts_per_minute"], b["language"], b["modal_setting"]) == (1, 0.0, None, None)


def test_shots(made):
    first, second, b = rows(made["shots"], "creative_id", "shot_index")
    assert (first["n_sampled_frames"], second["n_sampled_frames"], b["n_sampled_frames"]) == (4, 6, 8)  # half open
    assert (first["object_classes"], first["n_object_classes"], second["object_classes"], second["n_object_classes"]) == ("dog, person", 2, None, 0)
    assert first["n_frames_with_face"] == 1 and first["modal_face_emotion"] is None
    assert (second["position_in_ad"], second["is_last_shot"], second["is_first_shot"]) == (0.4, True, False)


def test_frames(made):
    f = rows(made["creative_frames"], "creative_id", "frame_index")
    a, b = f[:10], f[10:]
    assert [r["shot_index"] for r in a] == [0] * 4 + [1] * 6
    assert [r["shot_index"] for r in b[:3]] == [None, None, 0]
    assert [r["frame_index"] for r in a if r["is_cut"]] == [5] and [r["frame_index"] for r in a if r["is_speech"]] == [2, 3]
    assert [r["n_objects"] for r in a[:5]] == [2, None, 1, None, 0] and [r["n_persons"] for r in a[:3]] == [1, None, 0]
    assert [r["n_text_detections"] for r in a] == [2, None, None, None, 1, None, None, None, 1, None]
    assert a[0]["screen_text"] == "Buy  now | buy now " and [r["n_faces"] for r in a[:3]] == [0, 2, 0]
    assert a[1]["largest_face_emotion"] is None
    # Cuts of the spine are the shots less the creatives.
    assert sum(bool(r["is_cut"]) for r in f) == 3 - 2


def test_seconds(made):
    s = rows(made["creative_seconds"], "creative_id", "second")
    assert [(r["creative_id"], r["second"], r["n_frames"]) for r in s] == [("a", 0, 4), ("a", 1, 4), ("a", 2, 2), ("b", 0, 4), ("b", 1, 4), ("b", 2, 2)]
    assert [r["audio_class"] for r in s] == ["speech_over_music", "music", "silence"] + ["no_audio"] * 3
    assert [r["has_screen_text"] for r in s] == [True, True, True, False, False, False]
    assert [r["max_objects"] for r in s] == [2, 0, 0, 0, 0, 0] and s[0]["speech_share"] == 0.5


def test_text_and_summary(made):
    spans = rows(made["screen_text"], "screen_text_id")
    assert [(r["screen_text_id"], r["text"], r["text_norm"], r["start_s"], r["end_s"], r["n_frames_present"]) for r in spans] == [(1, "Buy  now", "buy now", 0.0, 2.0, 2), (2, "else", "else", 2.0, 3.0, 1)]
    assert spans[0]["is_large_text"] and spans[0]["vertical_position"] == "upper_third"
    a, b = rows(made["creative_summary"], "creative_id")
    assert (a["resolution"], a["n_text_spans"], a["total_text_s"], a["top_non_person_object"], a["n_distinct_object_classes"]) == ("1080x1920", 2, 3.0, "dog", 2)
    assert (a["speech_second_share"], a["silence_second_share"], b["n_text_spans"], b["modal_audio_class"]) == (0.3333, 0.3333, None, "no_audio")
    assert rows(made["transcript_words"], "word")[0]["word_norm"] == "it's"
    assert rows(made["transcript_segments"], "segment_index")[0]["is_low_confidence"]
    assert rows(made["object_detections"], "frame_index", "detection_index")[2]["position_in_ad"] == 0.2


def test_raw_folder_and_sinks(spark, tables, made, tmp_path):
    for n, df in tables.items():
        sinks.write_parquet(df, f"{tmp_path}/raw/{n}/one")
    # A file of another creative whose texts are all null, with fewer columns.
    odd = spark.createDataFrame([("c", 0, 0.0)], "creative_id string, frame_index int, t_start_s double").withColumn("text", F.lit(None).cast("int"))
    odd.write.parquet(f"{tmp_path}/raw/screen_text_detections/two")
    views = raw.raw_views(spark, f"{tmp_path}/raw")
    assert views["screen_text_detections"].count() == 5 and views["screen_text_detections"].schema == RAW["screen_text_detections"]
    assert spark.table("raw_shot_boundaries").count() == 3
    assert raw.read_raw(spark, f"{tmp_path}/none", "visual_frames").count() == 0
    sinks.export_marts({"creative_summary": made["creative_summary"], "creatives": made["creatives"]}, f"{tmp_path}/marts")
    assert [r["creative_id"] for r in spark.read.parquet(f"{tmp_path}/marts/creatives.parquet").collect()] == ["a", "b"]
    assert spark.read.option("header", True).csv(f"{tmp_path}/marts/creative_summary.csv").count() == 2
    text = catalog.document({"creatives": made["creatives"]})
    assert "| `cuts_per_minute` | double |" in text and "**Rows** 2" in text


def test_analysis(spark, made):
    t = audience.generate(spark, made["creative_seconds"], 12)
    t["sessions"], t["biometric_seconds"] = t["sessions"].cache(), t["biometric_seconds"].cache()
    assert audience.integrity(t, made["creatives"]).filter("NOT passed").isEmpty()
    assert t["generator_params"].count() == sum(map(len, audience.PARAMETERS.values()))
    assert t["survey_responses"].count() == 8 * t["sessions"].count()
    seconds = audience.viewer_seconds(t, made["creative_seconds"])
    assert seconds.count() == t["biometric_seconds"].count()
    performance = rows(audience.creative_performance(t, seconds, made["creative_summary"]), "creative_id")
    assert len(performance) == 2 and performance[0]["n_sessions"] == 12
    again = audience.generate(spark, made["creative_seconds"], 12)
    assert again["biometric_seconds"].exceptAll(t["biometric_seconds"]).isEmpty()


def test_panel_is_found_again(spark, sf_dir):
    """All fourteen checks hold on a generated panel."""
    from tempograin.plans import creative_marts, footage

    seconds = creative_marts._seconds(footage.raw_tables(spark, sf_dir))[1].cache()
    t = audience.generate(spark, seconds, 300)
    t["biometric_seconds"] = t["biometric_seconds"].cache()
    checks = audience.validate(t, seconds).collect()
    assert len(checks) == 14 and all(r["passed"] for r in checks)
    t["biometric_seconds"].unpersist()
    seconds.unpersist()
