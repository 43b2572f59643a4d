"""Numeric and relational parts of the extractors, without their models.

Pictures are thumbnails of packed RGB bytes, sound is samples of one frame; both
come as columns, are measured in Arrow batches, and what compares a frame with
the one before is a window over the measures.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ratio, rnd
from ..operators.vectors import dot, largest, softmax_ranks
from ..sources.schemas import EMOTIONS

NEAR_BLACK, SILENCE_DBFS, OCR_LEAST_SCORE, LEAST_CROP_PX, SHOT_FRAMES, HIST_BINS = 16, -50.0, 0.5, 24, 3, 64
_LUMA = np.array([0.299, 0.587, 0.114])


def _picture(rgb: np.ndarray) -> dict:
    r, g, b = (rgb[..., i].astype(float) for i in range(3))
    high, low = rgb.max(axis=-1).astype(float), rgb.min(axis=-1).astype(float)
    gray = rgb @ _LUMA
    spread = np.where(high > low, high - low, 1.0)
    hue = np.select([high == low, high == r, high == g], [0.0, (g - b) / spread % 6, (b - r) / spread + 2], (r - g) / spread + 4) * 60
    rg, yb = r - g, (r + g) / 2 - b
    inner = gray[1:-1, 1:-1]
    laplace = gray[:-2, 1:-1] + gray[2:, 1:-1] + gray[1:-1, :-2] + gray[1:-1, 2:] - 4 * inner if inner.size else np.zeros(1)
    slope = np.hypot(*np.gradient(gray)) if min(gray.shape) > 1 else np.zeros(1)
    return {
        "brightness": high.mean() / 255,
        "brightness_std": high.std() / 255,
        "saturation": np.where(high > 0, (high - low) / np.maximum(high, 1), 0).mean(),
        "contrast": gray.std() / 255,
        "colourfulness": np.hypot(rg.std(), yb.std()) + 0.3 * np.hypot(rg.mean(), yb.mean()),
        "sharpness": laplace.var(),
        "edge_density": (slope > 50).mean(),
        "dominant_hue_deg": float(np.median(hue)),
        "is_near_black": bool(high.mean() < NEAR_BLACK),
        "luma": gray.astype(np.float32).ravel().tolist(),
        "hist": (np.histogram(gray, HIST_BINS, (0, 256))[0] - gray.size / HIST_BINS).tolist(),
    }


def visual_frames(thumbnails: DataFrame) -> DataFrame:
    """creative_id, frame_index, t_start_s, t_end_s, width, height, pixels (RGB
    bytes) -> the measures of each frame, and its distance from the one before."""
    keys = ["creative_id", "frame_index", "t_start_s", "t_end_s"]

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [_picture(np.frombuffer(p, dtype=np.uint8).reshape(h, w, 3)) for p, h, w in zip(b.pixels, b.height, b.width, strict=True)]
            yield pd.concat([b[keys].reset_index(drop=True), pd.DataFrame(found, columns=list(_MEASURES))], axis=1)

    kinds = {f.name: f.dataType.simpleString() for f in thumbnails.schema}
    frames = thumbnails.select(*keys, "width", "height", "pixels").mapInPandas(measure, ", ".join([*(f"{k} {kinds[k]}" for k in keys), *(f"{n} {t}" for n, t in _MEASURES.items())]))
    w = Window.partitionBy("creative_id").orderBy("frame_index")
    before, hist = F.lag("luma").over(w), F.lag("hist").over(w)
    change = F.aggregate(F.zip_with("luma", "before", lambda x, y: F.abs(x - y).cast("double")), F.lit(0.0), lambda s, x: s + x) / F.size("luma") / 255.0
    frames = frames.withColumn("before", before).withColumn("hist_before", hist)
    moved = frames.withColumn("motion_abs_diff", F.when(F.size("luma") == F.size("before"), rnd(change, 5))).withColumn("hist_distance", rnd(1.0 - _correlation("hist", "hist_before"), 5))
    digits = {"brightness": 5, "brightness_std": 5, "saturation": 5, "contrast": 5, "colourfulness": 4, "sharpness": 4, "edge_density": 5, "dominant_hue_deg": 2}
    return moved.select(*keys, *(rnd(n, d).alias(n) for n, d in digits.items()), "motion_abs_diff", "hist_distance", "is_near_black")


_MEASURES = {"brightness": "double", "brightness_std": "double", "saturation": "double", "contrast": "double", "colourfulness": "double", "sharpness": "double", "edge_density": "double", "dominant_hue_deg": "double", "is_near_black": "boolean", "luma": "array<float>", "hist": "array<double>"}


def _correlation(a: str, b: str) -> Column:
    """Of two arrays whose means are zero."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a) * dot(b, b)))


#: Samples of a short spectrum and of the step to the next; bins or spectra of the median that tells steady from sudden.
SHORT, HOP, AROUND = 512, 128, 17


def _short_spectra(y: np.ndarray) -> np.ndarray:
    """Magnitudes of the short spectra, one a row; none of fewer samples than one."""
    if len(y) < SHORT:
        return np.zeros((0, SHORT // 2 + 1))
    return np.abs(np.fft.rfft(np.lib.stride_tricks.sliding_window_view(y, SHORT)[::HOP] * np.hanning(SHORT), axis=1))


def _medians(x: np.ndarray, axis: int) -> np.ndarray:
    edge = [(0, 0), (0, 0)]
    edge[axis] = (AROUND // 2, AROUND // 2)
    return np.median(np.lib.stride_tricks.sliding_window_view(np.pad(x, edge, mode="edge"), AROUND, axis=axis), axis=-1)


def _steadiness(spectra: np.ndarray) -> float:
    """Share of the level that is steady in time rather than spread over pitch."""
    if not spectra.size or not spectra.any():
        return 0.0
    steady, sudden = _medians(spectra, 0) ** 2, _medians(spectra, 1) ** 2
    mask = steady / np.maximum(steady + sudden, 1e-20)
    level = [float(np.sqrt(((spectra * m) ** 2).mean())) for m in (mask, 1 - mask)]
    return level[0] / max(sum(level), 1e-9)


def _rises(spectra: np.ndarray) -> np.ndarray:
    """Mean rise in decibels from each short spectrum to the next."""
    loud = 20 * np.log10(np.maximum(spectra, 1e-5))
    return np.maximum(np.diff(loud, axis=0), 0).mean(axis=1) if len(loud) > 1 else np.zeros(0)


def audio_frames(sound: DataFrame) -> DataFrame:
    """creative_id, frame_index, t_start_s, t_end_s, rate, samples (array of
    floats, one frame period) -> level, spectrum, crossings, rises and steadiness of each frame."""
    keys = ["creative_id", "frame_index", "t_start_s", "t_end_s"]

    def one(samples, rate: float) -> list[float]:
        y = np.asarray(samples, dtype=float)
        if not y.size:
            return [0.0] * 7
        power = np.abs(np.fft.rfft(y * np.hanning(len(y)))) + 1e-10
        at = np.fft.rfftfreq(len(y), 1 / rate)
        rolled = np.cumsum(power)
        return [float(np.sqrt((y**2).mean())), float((at * power).sum() / power.sum()), float(np.exp(np.log(power**2).mean()) / (power**2).mean()), float(at[np.searchsorted(rolled, 0.85 * rolled[-1])]), float((np.diff(np.signbit(y)) != 0).mean()) if len(y) > 1 else 0.0, *of_short(y)]

    def of_short(y: np.ndarray) -> list[float]:
        spectra = _short_spectra(y)
        rises = _rises(spectra)
        return [float(rises.mean()) if len(rises) else 0.0, _steadiness(spectra)]

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = pd.DataFrame([one(s, r) for s, r in zip(b.samples, b.rate, strict=True)], columns=["rms", "spectral_centroid_hz", "spectral_flatness", "spectral_rolloff_hz", "zero_crossing_rate", "onset_strength", "harmonic_ratio"])
            yield pd.concat([b[keys].reset_index(drop=True), found], axis=1)

    kinds = {f.name: f.dataType.simpleString() for f in sound.schema}
    rows = sound.select(*keys, "rate", "samples").mapInPandas(measure, ", ".join([*(f"{k} {kinds[k]}" for k in keys), "rms double, spectral_centroid_hz double, spectral_flatness double, spectral_rolloff_hz double, zero_crossing_rate double, onset_strength double, harmonic_ratio double"]))
    level = 20.0 * F.log10(F.greatest("rms", F.lit(1e-9)))
    return rows.select(*keys, rnd("rms", 6).alias("rms"), rnd(level, 3).alias("dbfs"), rnd("spectral_centroid_hz", 2).alias("spectral_centroid_hz"), rnd("spectral_flatness", 6).alias("spectral_flatness"), rnd("spectral_rolloff_hz", 2).alias("spectral_rolloff_hz"), rnd("zero_crossing_rate", 5).alias("zero_crossing_rate"), rnd("onset_strength", 4).alias("onset_strength"), rnd("harmonic_ratio", 5).alias("harmonic_ratio"), (level < SILENCE_DBFS).alias("is_silent"))


def audio_summary(frames: DataFrame) -> DataFrame:
    """Level and silence of each creative; means over what is audible."""
    loud = F.when(F.col("dbfs") >= SILENCE_DBFS, F.col("dbfs"))
    return frames.groupBy("creative_id").agg(rnd(F.avg(loud), 3).alias("mean_dbfs"), rnd(F.max("dbfs"), 3).alias("peak_dbfs"), rnd(F.max(loud) - F.min(loud), 3).alias("dynamic_range_db"), rnd(F.avg(F.when(F.col("dbfs") < SILENCE_DBFS, 1.0).otherwise(0.0)), 4).alias("silence_share"), rnd(F.avg("harmonic_ratio"), 5).alias("mean_harmonic_ratio"))


def _placed(rows: DataFrame) -> DataFrame:
    """Pixel boxes (x0, y0, x1, y1 in a frame of width and height) as shares."""
    for c, size in (("x0", "width"), ("y0", "height"), ("x1", "width"), ("y1", "height")):
        rows = rows.withColumn(c, rnd(ratio(F.least(F.greatest(F.col(c), F.lit(0.0)), F.col(size).cast("double")), size), 5))
    span = lambda a, b: F.greatest(F.col(b) - F.col(a), F.lit(0.0))
    return rows.withColumn("area_frac", rnd(span("x0", "x1") * span("y0", "y1"), 6)).withColumn("height_frac", rnd(span("y0", "y1"), 5)).withColumns({"centre_x": rnd((F.col("x0") + F.col("x1")) / 2, 5), "centre_y": rnd((F.col("y0") + F.col("y1")) / 2, 5)})


def screen_text_detections(found: DataFrame) -> DataFrame:
    """Text boxes in pixels -> shares of the frame; empty and doubtful ones go."""
    text = F.trim("text")
    kept = found.withColumn("text", text).filter((F.col("text") != "") & (F.col("score") >= OCR_LEAST_SCORE))
    return _placed(kept).withColumn("n_chars", F.length("text").cast("long")).drop("width", "height", "centre_x")


def face_detections(found: DataFrame) -> DataFrame:
    """Face boxes in pixels with probabilities (array in the order of EMOTIONS)
    -> shares; a face too small to judge keeps its row without emotions."""
    w, h = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    clear = F.least(w, h) * 1.3 >= LEAST_CROP_PX  # the crop has 15 % more on each side
    known = found.withColumn("probabilities", F.when(clear, F.col("probabilities")))
    top = F.array_position("probabilities", F.array_max("probabilities"))
    named = known.withColumn("emotion_top", F.get(F.array(*map(F.lit, EMOTIONS)), (top - 1).cast("int"))).withColumn("emotion_top_prob", rnd(F.array_max("probabilities"), 4))
    named = named.withColumns({f"p_{e}": rnd(F.get("probabilities", F.lit(i)), 4) for i, e in enumerate(EMOTIONS)})
    return largest(_placed(named.drop("probabilities")), ["creative_id", "frame_index"], "area_frac", "face_index").drop("width", "height", "height_frac")


def shot_samples(shots: DataFrame, frame_hz: int = 4, n: int = SHOT_FRAMES) -> DataFrame:
    """The frames of a shot that are scored: at the inner quantiles of its time."""
    last = F.max("end_s").over(Window.partitionBy("creative_id")) * frame_hz
    at = [F.rint((F.col("start_s") + (F.col("end_s") - F.col("start_s")) * ((k + 1) / (n + 1))) * frame_hz).cast("long") for k in range(n)]
    picked = F.array_distinct(F.array(*(F.greatest(F.lit(0).cast("long"), F.least(x, F.ceil("last") - 1)) for x in at)))
    return shots.withColumn("last", last).select("creative_id", "shot_index", F.explode(picked).alias("frame_at"))


def shot_label_scores(similarities: DataFrame) -> DataFrame:
    """creative_id, shot_index, frame_at, axis, label, similarity (cosine) ->
    softmax inside each frame and axis, mean over the shot's frames, rank."""
    w = Window.partitionBy("creative_id", "shot_index", "frame_at", "axis")
    e = F.exp(100 * (F.col("similarity") - F.max("similarity").over(w)))
    p = similarities.withColumn("p", e / F.sum(e).over(w))
    mean = p.groupBy("creative_id", "shot_index", "axis", "label").agg(F.avg("p").alias("mean"), F.countDistinct("frame_at").alias("n_frames_scored"))
    ranked = softmax_ranks(mean.withColumn("logit", F.ln("mean")), ["creative_id", "shot_index"], "axis", "label", "logit")
    return ranked.select("creative_id", "shot_index", "axis", "label", rnd("mean", 5).alias("score"), "rank", "is_top", "n_frames_scored")


def ascii_folded(c: Column | str) -> Column:
    """Letters without their accents; what has no plain form goes."""

    @F.pandas_udf("string")
    def fold(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode())

    return fold(c)
