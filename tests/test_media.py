"""Boxes from tensors, cuts from pixels, beats and transcripts, against plain versions."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tempograin.plans import beats, cuts, detect, extract, features


def plain_boxes(output, height, width, w, h, n_classes):
    """One frame, anchor by anchor."""
    found, a = [], 0
    for stride in (8, 16, 32):
        for gy in range(height // stride):
            for gx in range(width // stride):
                x, y, lw, lh, obj, *cls = output[a]
                best = cls.index(max(cls))
                bw, bh = math.exp(lw) * stride, math.exp(lh) * stride
                cx, cy = (x + gx) * stride, (y + gy) * stride
                if obj * cls[best] > 0.4:
                    found.append((obj * cls[best], a, best, cx - bw / 2, cy - bh / 2, cx + bw / 2, cy + bh / 2))
                a += 1
    kept = []
    for b in sorted(found, key=lambda b: (-b[0], b[1])):
        over = lambda q: max(min(b[5], q[5]) - max(b[3], q[3]), 0) * max(min(b[6], q[6]) - max(b[4], q[4]), 0)
        area = lambda q: (q[5] - q[3]) * (q[6] - q[4])
        if all(over(q) <= 0.5 * (area(b) + area(q) - over(q)) for q in kept):
            kept.append(b)
    r, clip = min(height / h, width / w), lambda v: min(max(v, 0), 1)
    return [(i, b[2], b[0], clip(b[3] / r / w), clip(b[4] / r / h), clip(b[5] / r / w), clip(b[6] / r / h), clip(area(b) / r / r / (w * h))) for i, b in enumerate(kept) for area in [lambda q: (q[5] - q[3]) * (q[6] - q[4])]]


def test_boxes(spark):
    rng = np.random.default_rng(1)
    names, height, width = ["a", "b", "c", "d"], 64, 96
    n = sum((height // s) * (width // s) for s in (8, 16, 32))
    frames = []
    for i in range(12):
        out = np.concatenate([rng.uniform(-1, 2, (n, 2)), rng.uniform(-1, 1.5, (n, 2)), rng.uniform(0, 1, (n, 5))], axis=1).astype(np.float32)
        out[:, 4] *= i % 3 > 0  # some frames without any object
        frames.append((f"v{i % 2}", i, 1920, 1080, out))
    df = spark.createDataFrame([(c, i, w, h, o.ravel().tolist()) for c, i, w, h, o in frames] + [("v", 99, 10, 10, None)], "creative_id string, frame_index int, width int, height int, output array<float>")
    got = {}
    for r in detect.object_detections(df, height, width, names).collect():
        got.setdefault(r["frame_index"], []).append((r["detection_index"], r["class_id"], r["score"], r["x0"], r["y0"], r["x1"], r["y1"], r["area_frac"]))
        assert r["class_name"] == names[r["class_id"]]
    for _, i, w, h, o in frames:
        want = plain_boxes(o.astype(float).tolist(), height, width, w, h, 4)
        mine = sorted(got.get(i, []))
        assert len(mine) == len(want) and (not want) == (i % 3 == 0)
        assert np.allclose(np.array(mine, dtype=float), np.array(want, dtype=float), atol=1e-4)
    with pytest.raises(Exception, match="anchors of 8 expected"):
        detect.object_detections(df, height, width, names[:3]).collect()


def pictures(spark, n, seed=3):
    rng = np.random.default_rng(seed)
    rows, base = [], None
    for i in range(n):
        if i % 7 == 0:
            base = rng.integers(0, 256, (3, 4, 3), dtype=np.uint8)
        now = np.clip(base.astype(int) + rng.integers(-3, 4, base.shape), 0, 255).astype(np.uint8)
        rows.append(["long" if i < n - 20 else f"s{i % 3}", i + 1, i / 4, (i + 1) / 4, 4, 3, bytearray(now.tobytes())])
    rows[11][6] = None
    return rows, spark.createDataFrame(rows, "creative_id string, frame_index long, t_start_s double, t_end_s double, width int, height int, pixels binary")


@pytest.mark.parametrize("ranges", [1, 3, 64])
def test_changes_across_ranges(spark, ranges):
    """One long creative over many ranges is measured as in one."""
    rows, df = pictures(spark, 150)
    want, before = {}, {}
    for c, i, *_, pixels in rows:
        one = None if pixels is None else cuts.hue_saturation_value(np.frombuffer(bytes(pixels), dtype=np.uint8).reshape(-1, 3))
        last = before.get(c)
        want[c, i] = None if one is None or last is None else np.abs(one - last).mean()
        before[c] = one
    got = {(r["creative_id"], r["frame_index"]): r["change"] for r in cuts.content_changes(df, ranges=ranges).collect()}
    assert got.keys() == want.keys() and all((got[k] is None) == (want[k] is None) and (want[k] is None or abs(got[k] - want[k]) < 1e-9) for k in want)


def test_hue_saturation_value():
    colours = np.array([[255, 0, 0], [0, 255, 0], [0, 0, 255], [255, 255, 0], [10, 10, 10], [0, 0, 0], [255, 0, 3]], dtype=np.uint8)
    assert cuts.hue_saturation_value(colours).tolist() == [[0, 255, 255], [60, 255, 255], [120, 255, 255], [30, 255, 255], [0, 0, 10], [0, 0, 0], [0, 255, 255]]


def test_shots(spark):
    rows = [("a", i, (i - 1) / 4, i / 4, c) for i, c in enumerate([None, 50, 0, 0, 90, 90, 0, 0, 0, 30, 27, 0], 1)] + [("b", 1, 0.0, 0.25, None), ("b", 2, 0.25, 0.5, 5.0)]
    df = spark.createDataFrame([(c, i, s, e, None if x is None else float(x)) for c, i, s, e, x in rows], "creative_id string, frame_index long, t_start_s double, t_end_s double, change double")
    got = cuts.shots_from_changes(df, shortest=3).orderBy("creative_id", "shot_index").collect()
    assert [(r["creative_id"], r["shot_index"], r["start_frame"], r["end_frame"], r["duration_s"]) for r in got] == [("a", 0, 1, 4, 1.0), ("a", 1, 5, 9, 1.25), ("a", 2, 10, 12, 0.75), ("b", 0, 1, 2, 0.5)]


def plain_beats(strength, period, tightness):
    """All chains, by recursion on their last step."""
    sd = float(np.std(strength, ddof=1))
    best = {}
    for t in range(len(strength)):
        before = [(best[t - lag][0] - tightness * math.log(lag / period) ** 2, -lag) for lag in range(max(1, round(period / 2)), round(2 * period) + 1) if t >= lag]
        gain, lag = max(before, default=(0, 0))
        best[t] = (strength[t] / sd + gain, best[t + lag][1] + [t]) if gain > 0 else (strength[t] / sd, [t])
    return max(best.values(), key=lambda b: b[0])[1]


def test_beat_steps():
    rng = np.random.default_rng(6)
    for n, period, tight in ((40, 4.0, 5.0), (90, 7.5, 100.0), (200, 12.0, 20.0), (3, 9.0, 1.0)):
        x = rng.gamma(0.5, 1, n)
        assert beats.beat_steps(x, period, tight) == plain_beats(x.tolist(), period, tight)
    assert beats.beat_steps(np.zeros(9), 3.0) == [] == beats.beat_steps(np.zeros(0), 3.0)
    regular = np.zeros(400)
    regular[5::20] = 1
    assert beats.beat_steps(regular, 20.0) == list(range(5, 400, 20))


def test_onsets_in_a_stream(spark):
    """Frames of uneven length, empty ones and null ones give what the whole sound gives."""
    rng = np.random.default_rng(8)
    y = rng.normal(0, 1, 20_000) * (np.arange(20_000) % 4000 < 300)
    bounds = sorted({0, 20_000, *rng.integers(0, 20_000, 30).tolist(), 100, 101})
    rows = [("a", i, 16000.0, y[s:e].tolist()) for i, (s, e) in enumerate(zip(bounds, bounds[1:], strict=False))] + [("a", 999, 16000.0, []), ("a", 1000, 16000.0, None), ("b", 0, 16000.0, [0.0] * 100)]
    df = spark.createDataFrame(rows, "creative_id string, frame_index long, rate double, samples array<double>").orderBy(F.rand(1))
    got = {r["creative_id"]: r["strength"] for r in beats.envelopes(beats.onset_strength(df)).collect()}
    want = features._rises(features._short_spectra(y))
    assert len(got["a"]) == len(want) and np.allclose(got["a"], want) and got["b"] == []
    times, tempo = beats.beat_times(df)
    assert {r["creative_id"]: r["n_beats"] for r in tempo.collect()}["b"] == 0 and times.filter("creative_id = 'b'").isEmpty()


def test_transcripts(spark):
    words = [{"start": 0.1234, "end": 0.5, "word": " Hi", "probability": 0.98765}, {"start": 0.5, "end": 1.0, "word": None, "probability": None}]
    segment = {"start": 0.1234, "end": 1.6236, "text": " Hi there ", "avg_logprob": -0.123456, "no_speech_prob": 0.00004, "compression_ratio": None, "words": words}
    spoken = spark.createDataFrame([("a", [segment, {**segment, "start": 2.0, "end": 2.0, "text": None, "words": None}]), ("b", [])], extract.SPOKEN)
    segments = extract.transcript_segments(spoken)
    one, two = segments.orderBy("segment_index").collect()
    assert (one["start_s"], one["end_s"], one["text"], one["n_words"], one["words_per_s"], one["avg_logprob"], one["no_speech_prob"], one["compression_ratio"]) == (0.123, 1.624, "Hi there", 2, 1.333, -0.1235, 0.0, None)
    assert (two["text"], two["n_words"], two["words_per_s"]) == ("", 0, 0.0)
    got = extract.transcript_words(spoken).orderBy("word_index").collect()
    assert [(r["segment_index"], r["word_index"], r["word"], r["start_s"], r["probability"]) for r in got] == [(0, 0, "Hi", 0.123, 0.9877), (0, 1, "", 0.5, None)]
    creatives = spark.createDataFrame([("a", 7.0, "en", 0.987654), ("b", 0.0, None, None)], "creative_id string, duration_s double, language string, language_probability double")
    a, b = extract.transcript_summary(segments, creatives, "small").orderBy("creative_id").collect()
    assert (a["language"], a["language_probability"], a["model"], a["n_segments"], a["n_words"], a["speech_s"], a["speech_share"], a["words_per_minute"]) == ("en", 0.9877, "small", 2, 2, 1.501, 0.2144, 17.14)
    assert (b["n_segments"], b["n_words"], b["speech_s"], b["speech_share"]) == (0, 0, 0.0, None)
