"""The creative marts: dimension, frame and second spines, spans, summaries.

Each mart is a function of raw tables (``raw``: name -> DataFrame, see
``sources.schemas.RAW``) and of other marts. Results don't depend on row order:
modes take the lowest of equally frequent values, texts are joined in order.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import display_name, first_known, joined_distinct, most_frequent, ratio, rnd, sampled, share, top_by, word_norm
from ..operators.sequences import first_in, global_number, islands
from ..operators.timejoin import asof_backward, overlap_flag, points_in_intervals

Raw = Mapping[str, DataFrame]
AXES = ("shot_scale", "setting", "subject", "style")
#: Seconds of a time bucket for interval joins; intervals are seconds long.
BUCKET_S = 5.0
#: Thresholds of the audio classes.
SILENCE_DBFS, MUSIC_HARMONIC_MIN, MUSIC_FLATNESS_MAX = -50.0, 0.55, 0.02
LARGE_TEXT, UPPER, LOWER = 0.08, 0.33, 0.66


def _means(digits: dict[str, tuple[str, int]], how=F.avg) -> list[Column]:
    """name -> (column, digits): rounded aggregates."""
    return [rnd(how(c), d).alias(name) for name, (c, d) in digits.items()]


def _position(start: str, digits: int = 4) -> Column:
    return rnd(ratio(start, "__length"), digits).alias("position_in_ad")


def _with_length(rows: DataFrame, creatives: DataFrame) -> DataFrame:
    """Rows of known creatives, with the creative's duration as __length. Of
    the creatives only this is read, so their raw metadata serve as well as the mart."""
    return rows.join(creatives.select("creative_id", F.col("duration_s").alias("__length")), "creative_id")


def creatives(raw: Raw) -> DataFrame:
    """One row for each creative: identity, pacing, voice, sound, modal look."""
    length = F.col("duration_s")
    pace = raw["shot_boundaries"].groupBy("creative_id").agg(F.count("*").alias("n_shots"), *(rnd(f(length), 3).alias(f"{n}_shot_s") for n, f in (("mean", F.avg), ("median", F.median), ("min", F.min), ("max", F.max))))
    look = raw["shot_label_scores"].filter("is_top").groupBy("creative_id").agg(*(most_frequent(F.when(F.col("axis") == a, F.col("label"))).alias(f"modal_{a}") for a in AXES))
    voice = raw["transcript_summary"].select("creative_id", "language", "language_probability", F.col("n_segments").alias("n_transcript_segments"), F.col("n_words").alias("n_spoken_words"), "speech_s", "speech_share", "words_per_minute")
    sound = raw["audio_summary"].select("creative_id", "tempo_bpm", "mean_dbfs", "peak_dbfs", "dynamic_range_db", "silence_share", "mean_harmonic_ratio")
    meta = raw["creative_metadata"].withColumn("display_name", display_name("title", "source_label"))
    identity = ["creative_id", "title", "source_label", "display_name", "file_name", "duration_s", "width", "height", "orientation", "aspect_ratio", "fps", "video_codec", "has_audio", "audio_codec", "file_size_bytes", "file_sha256"]
    whole = meta.select(*identity, "sampled_frame_hz", "n_sampled_frames")
    for part in (pace, voice, sound, look):
        whole = whole.join(part, "creative_id", "left")
    cuts = rnd(ratio((F.col("n_shots") - 1) * F.lit(60.0), "duration_s"), 2).alias("cuts_per_minute")
    return whole.select(*identity, *pace.columns[1:], cuts, *voice.columns[1:], *sound.columns[1:], *look.columns[1:], "sampled_frame_hz", "n_sampled_frames")


def shots(raw: Raw, creative: DataFrame) -> DataFrame:
    """One row for each shot, with what its frames hold: five range joins of
    points with [start_s, end_s), each aggregated before it meets the shot."""
    keys = ["creative_id", "shot_index"]
    spans = raw["shot_boundaries"].select(*keys, F.col("start_s").alias("__s"), F.col("end_s").alias("__e"))

    def inside(name: str, *columns: str) -> DataFrame:
        points = raw[name].select("creative_id", "t_start_s", *columns)
        return points_in_intervals(points, spans, ["creative_id"], "t_start_s", "__s", "__e", BUCKET_S).groupBy(*keys)

    tops = raw["shot_label_scores"].filter("is_top").groupBy(*keys).agg(*(F.max(F.when(F.col("axis") == a, F.col(c))).alias(f"{n}_{a}") for a in AXES for n, c in (("label", "label"), ("conf", "score"))))
    visual = inside("visual_frames", "brightness", "saturation", "contrast", "colourfulness", "edge_density", "motion_abs_diff", "dominant_hue_deg").agg(
        F.count("*").alias("n_sampled_frames"),
        *_means({"mean_brightness": ("brightness", 4), "mean_saturation": ("saturation", 4), "mean_contrast": ("contrast", 4), "mean_colourfulness": ("colourfulness", 3), "mean_edge_density": ("edge_density", 4), "mean_motion": ("motion_abs_diff", 5)}),
        rnd(F.max("motion_abs_diff"), 5).alias("peak_motion"),
        rnd(F.avg("dominant_hue_deg"), 1).alias("mean_dominant_hue_deg"),
    )
    audio = inside("audio_frames", "dbfs", "harmonic_ratio", "onset_strength").agg(*_means({"mean_dbfs": ("dbfs", 2), "mean_harmonic_ratio": ("harmonic_ratio", 4), "mean_onset_strength": ("onset_strength", 3)}))
    faces = inside("face_detections", "frame_index", "area_frac", "emotion_top", "is_largest").agg(
        F.countDistinct("frame_index").alias("n_frames_with_face"), rnd(F.avg("area_frac"), 5).alias("mean_face_area_frac"), rnd(F.max("area_frac"), 5).alias("max_face_area_frac"), most_frequent(F.when(F.col("is_largest"), F.col("emotion_top"))).alias("modal_face_emotion")
    )
    objects = inside("object_detections", "class_name").agg(F.countDistinct("class_name").alias("n_object_classes"), joined_distinct("class_name").alias("object_classes"))
    text = inside("screen_text_detections", "height_frac").agg(F.count("*").alias("n_text_detections"), rnd(F.max("height_frac"), 4).alias("max_text_height_frac"))
    n = raw["shot_boundaries"].groupBy("creative_id").agg(F.count("*").alias("__n"))
    whole = _with_length(raw["shot_boundaries"].select(*keys, "start_s", "end_s", "duration_s"), creative).join(n, "creative_id")
    whole = whole.withColumns({"position_in_ad": rnd(ratio("start_s", "__length"), 4), "is_first_shot": F.col("shot_index") == 0, "is_last_shot": F.col("shot_index") == F.col("__n") - 1}).drop("__length", "__n")
    for part in (tops, visual, audio, faces, objects, text):
        whole = whole.join(part, keys, "left")
    return whole.fillna(0, ["n_frames_with_face", "n_object_classes", "n_text_detections"])


def transcript_segments(raw: Raw, creative: DataFrame) -> DataFrame:
    rows = _with_length(raw["transcript_segments"], creative)
    doubtful = (F.col("avg_logprob") < -1.0) | (F.col("no_speech_prob") > 0.5)
    return rows.select(
        "creative_id", "segment_index", "start_s", "end_s", rnd(F.col("end_s") - F.col("start_s"), 3).alias("duration_s"), "text", "n_words", "words_per_s", _position("start_s"), "avg_logprob", "no_speech_prob", "compression_ratio", doubtful.alias("is_low_confidence")
    )


def transcript_words(raw: Raw, creative: DataFrame) -> DataFrame:
    rows = _with_length(raw["transcript_words"], creative)
    return rows.select("creative_id", "segment_index", "word_index", "word", word_norm("word").alias("word_norm"), "start_s", "end_s", "probability", _position("start_s"))


def screen_text(raw: Raw) -> DataFrame:
    """Spans of a text on screen: detections of a frame are merged, runs with a
    gap of at most two sampling periods are one span."""
    step = raw["sampling_config"].filter("extractor = 'ocr'").select("creative_id", ratio(F.lit(1.0), "sample_hz").alias("step_s"))
    norm = F.lower(F.trim(F.regexp_replace("text", r"\s+", " ")))
    per_frame = raw["screen_text_detections"].groupBy("creative_id", "t_start_s", norm.alias("text_norm")).agg(top_by("text", "score").alias("text"), F.max("score").alias("score"), F.max("height_frac").alias("height_frac"), F.avg("centre_y").alias("centre_y"))
    spans = islands(per_frame.join(step, "creative_id"), ["creative_id", "text_norm"], "t_start_s", 2 * F.col("step_s"))
    end, height, middle = F.max("t_start_s") + F.any_value("step_s"), F.max("height_frac"), F.avg("centre_y")
    found = spans.groupBy("creative_id", "text_norm", "span_id").agg(
        top_by("text", "score").alias("text"),
        F.min("t_start_s").alias("start_s"),
        rnd(end, 3).alias("end_s"),
        rnd(end - F.min("t_start_s"), 3).alias("duration_s"),
        F.count("*").alias("n_frames_present"),
        rnd(F.max("score"), 4).alias("max_score"),
        rnd(height, 4).alias("max_height_frac"),
        rnd(middle, 4).alias("mean_centre_y"),
        (height >= LARGE_TEXT).alias("is_large_text"),
        F.when(middle < UPPER, "upper_third").when(middle > LOWER, "lower_third").otherwise("middle_third").alias("vertical_position"),
    )
    numbered = global_number(found, ["creative_id", "start_s", "text_norm", "span_id"], "screen_text_id")
    return numbered.select("creative_id", "screen_text_id", "text", "text_norm", *found.columns[4:])


def creative_frames(raw: Raw, creative: DataFrame) -> DataFrame:
    """The 4 Hz spine. Counts of what is sampled more rarely are null on frames
    that weren't looked at, 0 where nothing was found."""
    keys = ["creative_id", "frame_index"]
    steps = raw["sampling_config"].groupBy("creative_id").agg(*(F.max(F.when(F.col("extractor") == e, F.col("step_frames"))).alias(f"__{e}_step") for e in ("objects", "ocr")))
    starts = raw["shot_boundaries"].select("creative_id", "shot_index", F.col("start_s").alias("__shot_s"))
    frames = asof_backward(raw["visual_frames"], starts, ["creative_id"], "t_start_s", "__shot_s", ["__shot_s", "shot_index"])
    frames = overlap_flag(frames, raw["transcript_segments"], ["creative_id"], ("t_start_s", "t_end_s"), ("start_s", "end_s"), BUCKET_S, "is_speech")
    audio = raw["audio_frames"].select(*keys, "dbfs", "rms", "spectral_centroid_hz", "spectral_flatness", "spectral_rolloff_hz", "zero_crossing_rate", "onset_strength", "harmonic_ratio", "is_silent")
    largest = lambda c: first_known(F.when(F.col("is_largest"), F.col(c)))
    faces = raw["face_detections"].groupBy(*keys).agg(
        F.count("*").alias("n_faces"), rnd(F.max("area_frac"), 5).alias("largest_face_area_frac"), largest("emotion_top").alias("largest_face_emotion"), largest("emotion_top_prob").alias("largest_face_emotion_prob"), *(rnd(F.avg(f"p_{e}"), 4).alias(f"mean_p_{e}") for e in ("neutral", "happiness", "surprise", "sadness"))
    )
    objects = raw["object_detections"].groupBy(*keys).agg(F.count("*").alias("n_objects"), F.count_if(F.col("class_name") == "person").alias("n_persons"), joined_distinct("class_name").alias("object_classes"), rnd(F.max("area_frac"), 5).alias("largest_object_area_frac"))
    lines = F.array_sort(F.collect_list(F.struct("detection_index", "text")))
    text = raw["screen_text_detections"].filter("text IS NOT NULL").groupBy(*keys).agg(F.array_join(F.transform(lines, lambda x: x["text"]), " | ").alias("screen_text"))
    counts = raw["screen_text_detections"].groupBy(*keys).agg(F.count("*").alias("n_text_detections"), rnd(F.max("height_frac"), 4).alias("max_text_height_frac"))
    whole = _with_length(frames, creative).join(steps, "creative_id")
    for part in (audio, faces, objects, counts, text):
        whole = whole.join(part, keys, "left")
    first = first_in(["creative_id", "shot_index"], "frame_index")
    seen = {"objects": sampled("frame_index", "__objects_step"), "ocr": sampled("frame_index", "__ocr_step")}
    looked = lambda e, c: F.when(seen[e], F.coalesce(F.col(c), F.lit(0))).alias(c)
    visual = ["brightness", "brightness_std", "saturation", "contrast", "colourfulness", "sharpness", "edge_density", "dominant_hue_deg", "motion_abs_diff", "hist_distance", "is_near_black"]
    return whole.select(
        *keys, "t_start_s", "t_end_s", _position("t_start_s", 5), "shot_index", rnd(F.col("t_start_s") - F.col("__shot_s"), 3).alias("t_in_shot_s"), first.alias("is_shot_start"), (first & (F.col("shot_index") > 0)).alias("is_cut"),
        *visual, *audio.columns[2:], "is_speech", F.coalesce("n_faces", F.lit(0)).alias("n_faces"), *faces.columns[3:],
        seen["objects"].alias("objects_sampled"), looked("objects", "n_objects"), looked("objects", "n_persons"), "object_classes", "largest_object_area_frac",
        seen["ocr"].alias("ocr_sampled"), looked("ocr", "n_text_detections"), "max_text_height_frac", "screen_text",
    )


def creative_seconds(frames: DataFrame, creative: DataFrame) -> DataFrame:
    """The 1 Hz spine: a tumbling second of frames, and its audio class."""
    second = frames.groupBy("creative_id", F.floor("t_start_s").cast("int").alias("second")).agg(
        F.count("*").alias("n_frames"),
        F.min("shot_index").alias("first_shot_index"),
        most_frequent("shot_index").alias("modal_shot_index"),
        F.count_if("is_cut").alias("n_cuts"),
        *_means({"brightness": ("brightness", 4), "saturation": ("saturation", 4), "contrast": ("contrast", 4), "colourfulness": ("colourfulness", 3), "edge_density": ("edge_density", 4), "motion": ("motion_abs_diff", 5)}),
        *_means({"peak_motion": ("motion_abs_diff", 5), "peak_hist_distance": ("hist_distance", 5)}, F.max),
        rnd(F.avg("dbfs"), 2).alias("dbfs"),
        rnd(F.max("dbfs"), 2).cast("float").alias("peak_dbfs"),
        *_means({"spectral_centroid_hz": ("spectral_centroid_hz", 1), "spectral_flatness": ("spectral_flatness", 5), "onset_strength": ("onset_strength", 3), "harmonic_ratio": ("harmonic_ratio", 4)}),
        F.bool_or("is_speech").alias("has_speech"),
        rnd(share("is_speech"), 3).alias("speech_share"),
        F.max("n_faces").alias("max_faces"),
        rnd(F.avg("n_faces"), 3).alias("mean_faces"),
        rnd(F.max("largest_face_area_frac"), 5).alias("largest_face_area_frac"),
        most_frequent("largest_face_emotion").alias("modal_face_emotion"),
        *_means({f"mean_p_{e}": (f"mean_p_{e}", 4) for e in ("happiness", "surprise", "sadness")}),
        F.max("n_objects").alias("max_objects"),
        F.max("n_persons").alias("max_persons"),
        joined_distinct("object_classes").alias("object_classes"),
        F.max("n_text_detections").alias("max_text_detections"),
        rnd(F.max("max_text_height_frac"), 4).alias("max_text_height_frac"),
        F.min_by("screen_text", F.when(F.col("screen_text").isNotNull(), F.col("frame_index"))).alias("screen_text"),
    )
    tonal = F.col("harmonic_ratio") >= MUSIC_HARMONIC_MIN
    audio = (
        F.when(F.col("dbfs").isNull(), "no_audio")
        .when(F.col("dbfs") < SILENCE_DBFS, "silence")
        .when(F.col("has_speech") & tonal, "speech_over_music")
        .when(F.col("has_speech"), "speech")
        .when(tonal & (F.col("spectral_flatness") <= MUSIC_FLATNESS_MAX), "music")
        .otherwise("ambient")
    )
    at = F.col("second").cast("double")
    names = second.columns[2:]
    cut_at = {n: names.index(n) + 1 for n in ("speech_share", "mean_p_sadness")}
    return _with_length(second, creative).select(
        "creative_id", "second", at.alias("t_start_s"), (at + 1).alias("t_end_s"), _position("second"), *names[: cut_at["speech_share"]], audio.alias("audio_class"), *names[cut_at["speech_share"] : cut_at["mean_p_sadness"]], (F.col("max_faces") > 0).alias("has_face"),
        *names[cut_at["mean_p_sadness"] :], (F.coalesce("max_text_detections", F.lit(0)) > 0).alias("has_screen_text"),
    )


def creative_summary(raw: Raw, creative: DataFrame, seconds: DataFrame, text: DataFrame) -> DataFrame:
    kind = F.col("audio_class")
    rolled = seconds.groupBy("creative_id").agg(
        F.count("*").alias("n_seconds"),
        *_means({"mean_brightness": ("brightness", 4), "mean_saturation": ("saturation", 4), "mean_motion": ("motion", 5), "mean_colourfulness": ("colourfulness", 2), "mean_faces_on_screen": ("mean_faces", 3)}),
        *(rnd(share(test), 4).alias(f"{n}_second_share") for n, test in (("face", "has_face"), ("text", "has_screen_text"), ("speech", kind.isin("speech", "speech_over_music")), ("music", kind == "music"), ("silence", kind == "silence"))),
        rnd(F.max("largest_face_area_frac"), 4).alias("max_face_area_frac"),
        most_frequent("modal_face_emotion").alias("modal_face_emotion"),
        most_frequent("audio_class").alias("modal_audio_class"),
        F.max("max_persons").alias("max_persons_on_screen"),
    )
    texts = text.groupBy("creative_id").agg(F.count("*").alias("n_text_spans"), rnd(F.sum("duration_s"), 2).alias("total_text_s"), top_by("text", "max_height_frac").alias("largest_text"))
    counts = raw["object_detections"].groupBy("creative_id", "class_name").agg(F.count("*").alias("n"))
    objects = counts.groupBy("creative_id").agg(F.count("class_name").alias("n_distinct_object_classes"), top_by(F.when(F.col("class_name") != "person", F.col("class_name")), "n").alias("top_non_person_object"))
    whole = creative
    for part in (rolled, texts, objects):
        whole = whole.join(part, "creative_id", "left")
    groups = [
        "creative_id title source_label display_name duration_s orientation",
        "n_shots mean_shot_s median_shot_s cuts_per_minute language n_spoken_words words_per_minute speech_share tempo_bpm mean_dbfs dynamic_range_db speech_second_share music_second_share silence_second_share modal_audio_class",
        "modal_shot_scale modal_setting modal_subject modal_style mean_brightness mean_saturation mean_colourfulness mean_motion face_second_share mean_faces_on_screen max_face_area_frac modal_face_emotion max_persons_on_screen",
        "text_second_share n_text_spans total_text_s largest_text n_distinct_object_classes top_non_person_object n_seconds n_sampled_frames file_sha256",
    ]
    head, *rest = (g.split() for g in groups)
    return whole.select(*head, F.format_string("%dx%d", "width", "height").alias("resolution"), *(c for g in rest for c in g))


def detail_tables(raw: Raw, creative: DataFrame) -> dict[str, DataFrame]:
    """Detections with their position; the rest as they are."""
    placed = {n: _with_length(raw[n], creative).select(*raw[n].columns, _position("t_start_s")) for n in ("face_detections", "object_detections")}
    return placed | {n.lstrip("_") if n != "_manifest" else "run_manifest": raw[n] for n in ("shot_label_scores", "screen_text_detections", "_manifest", "sampling_config")}


def all_marts(raw: Raw) -> dict[str, DataFrame]:
    """Every mart by name, frames and seconds cached for their many readers."""
    c, known = creatives(raw), raw["creative_metadata"]
    frames = creative_frames(raw, known).cache()
    seconds, text = creative_seconds(frames, known).cache(), screen_text(raw)
    return {
        "creatives": c,
        "shots": shots(raw, known),
        "transcript_segments": transcript_segments(raw, known),
        "transcript_words": transcript_words(raw, known),
        "screen_text": text,
        "creative_frames": frames,
        "creative_seconds": seconds,
        "creative_summary": creative_summary(raw, c, seconds, text),
        **detail_tables(raw, known),
    }
