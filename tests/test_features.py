"""Measures of pictures and sound with known values."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tempograin.plans import beats, features


def test_pictures(spark):
    black, white = np.zeros((4, 6, 3), dtype=np.uint8), np.full((4, 6, 3), 255, dtype=np.uint8)
    red = white.copy()
    red[..., 1:] = 0
    rows = [("a", i + 1, i / 4, (i + 1) / 4, 6, 4, bytearray(x.tobytes())) for i, x in enumerate((black, white, white, red))]
    df = spark.createDataFrame(rows, "creative_id string, frame_index long, t_start_s double, t_end_s double, width int, height int, pixels binary")
    got = features.visual_frames(df).orderBy("frame_index").collect()
    assert [r["brightness"] for r in got] == [0.0, 1.0, 1.0, 1.0] and [r["is_near_black"] for r in got] == [True, False, False, False]
    assert [r["motion_abs_diff"] for r in got] == [None, 1.0, 0.0, 0.701]
    assert got[0]["hist_distance"] is None and got[1]["hist_distance"] > 1 and got[2]["hist_distance"] == 0.0
    assert [r["saturation"] for r in got] == [0.0, 0.0, 0.0, 1.0] and got[3]["colourfulness"] > 80


def test_sound(spark):
    t = np.arange(4000) / 16000
    rows = [("a", 1, 0.0, 0.25, 16000.0, np.sin(2 * np.pi * 1000 * t).tolist()), ("a", 2, 0.25, 0.5, 16000.0, [0.0] * 4000), ("a", 3, 0.5, 0.75, 16000.0, [])]
    df = spark.createDataFrame(rows, "creative_id string, frame_index long, t_start_s double, t_end_s double, rate double, samples array<float>")
    one, two, three = features.audio_frames(df).orderBy("frame_index").collect()
    assert abs(one["dbfs"] + 3.01) < 0.01 and abs(one["spectral_centroid_hz"] - 1000) < 20 and abs(one["zero_crossing_rate"] - 0.125) < 0.002
    assert two["is_silent"] and three["is_silent"] and one["spectral_flatness"] < 0.01
    s = features.audio_summary(features.audio_frames(df)).first()
    assert s["silence_share"] == 0.6667 and s["mean_dbfs"] == s["peak_dbfs"] == one["dbfs"] and s["dynamic_range_db"] == 0.0


def test_rhythm(spark):
    """A steady tone is harmonic, clicks are not; two clicks a second are 120 a minute."""
    rate, n = 16000, 8 * 4
    tone = np.sin(2 * np.pi * 440 * np.arange(rate * 8) / rate)
    clicks = np.zeros(rate * 8)
    clicks[:: rate // 2] = 1.0
    rows = [(c, i + 1, i / 4, (i + 1) / 4, float(rate), y[i * rate // 4 : (i + 1) * rate // 4].tolist()) for c, y in (("tone", tone), ("clicks", clicks), ("none", clicks * 0)) for i in range(n)]
    df = spark.createDataFrame(rows, "creative_id string, frame_index long, t_start_s double, t_end_s double, rate double, samples array<float>")
    s = {r["creative_id"]: r for r in features.audio_summary(features.audio_frames(df)).collect()}
    assert s["tone"]["mean_harmonic_ratio"] > 0.9 > 0.5 > s["clicks"]["mean_harmonic_ratio"] and s["none"]["mean_harmonic_ratio"] == 0
    times, tempo = beats.beat_times(df)
    beat = {r["creative_id"]: (r["tempo_bpm"], r["n_beats"]) for r in tempo.collect()}
    assert abs(beat["clicks"][0] - 120) < 2 and beat["clicks"][1] == 15 and beat["none"] == (None, 0)  # the first click has no rise before it
    at = [r["t_s"] for r in times.filter("creative_id = 'clicks'").orderBy("beat_index").collect()]
    assert max(abs(x - round(2 * x) / 2) for x in at) < 0.04 and np.abs(np.diff(at) - 0.5).max() < 0.02


def test_detections(spark):
    text = spark.createDataFrame([("a", 1, 0, " Hi ", 0.9, -10.0, 0.0, 50.0, 20.0, 100, 200), ("a", 1, 1, " ", 0.9, 0.0, 0.0, 1.0, 1.0, 100, 200), ("a", 1, 2, "x", 0.4, 0.0, 0.0, 1.0, 1.0, 100, 200)], "creative_id string, frame_index long, detection_index long, text string, score double, x0 double, y0 double, x1 double, y1 double, width int, height int")
    r = features.screen_text_detections(text).collect()
    assert len(r) == 1 and (r[0]["text"], r[0]["n_chars"], r[0]["x0"], r[0]["x1"], r[0]["height_frac"], r[0]["area_frac"]) == ("Hi", 2, 0.0, 0.5, 0.1, 0.05)
    p = [0.1, 0.6] + [0.05] * 6
    faces = spark.createDataFrame([("a", 1, 0, 0.0, 0.0, 40.0, 40.0, 100, 100, p), ("a", 1, 1, 0.0, 0.0, 10.0, 10.0, 100, 100, p)], "creative_id string, frame_index long, face_index long, x0 double, y0 double, x1 double, y1 double, width int, height int, probabilities array<double>")
    big, small = features.face_detections(faces).orderBy("face_index").collect()
    assert (big["emotion_top"], big["p_happiness"], big["is_largest"]) == ("happiness", 0.6, True)
    assert (small["emotion_top"], small["p_happiness"], small["is_largest"]) == (None, None, False)


def test_labels(spark):
    shots = spark.createDataFrame([("a", 0, 0.0, 4.0), ("a", 1, 4.0, 4.1)], "creative_id string, shot_index long, start_s double, end_s double")
    got = features.shot_samples(shots)
    assert sorted((r["shot_index"], r["frame_at"]) for r in got.collect()) == [(0, 4), (0, 8), (0, 12), (1, 16)]
    rows = [("a", 0, f, "setting", lab, s) for f in (4, 8) for lab, s in (("indoor", 0.30), ("outdoor", 0.30))] + [("a", 0, 4, "style", "x", 0.2)]
    scores = features.shot_label_scores(spark.createDataFrame(rows, "creative_id string, shot_index long, frame_at long, axis string, label string, similarity double"))
    assert sorted((r["label"], r["score"], r["rank"], r["n_frames_scored"]) for r in scores.collect()) == [("indoor", 0.5, 0, 2), ("outdoor", 0.5, 1, 2), ("x", 1.0, 0, 1)]
    names = spark.createDataFrame(pd.DataFrame({"n": ["Été", "ñandú", None]})).select(features.ascii_folded(F.col("n")).alias("n"))
    assert [r["n"] for r in names.collect()] == ["Ete", "nandu", None]
