"""Queries of the extractors' measures, over pictures, sound, speech and boxes that
are made of the driver's tables: numbers of an event or a part, or a document's text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import rnd, sigmoid
from ..registry import query
from . import extract, features, footage
from .base import table

#: Channels of pixel p (0 to 15) of an event's picture. One pixel alone has an odd red, so no
#: measure of the picture lies halfway between two rounded values or on the edge of a bin.
_RED = "CASE WHEN event_id % 13 = 0 THEN 2 ELSE 4 * ((event_id * 37 + p * 91) % 64) + 2 END - CASE WHEN p = 1 THEN 1 ELSE 0 END"
_GREEN = "CASE WHEN event_id % 13 = 0 THEN 0 ELSE 4 * ((event_id * 59 + p * p * 17) % 64) END"
_BLUE = "CASE WHEN event_id % 13 = 0 THEN 0 ELSE 2 * ((event_id * 23 + p * 29) % 128) END"
_FRAMES = "e AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS frame_index FROM events)"


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's events as numbered frames of a quarter of a second."""
    n = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id")).cast("long")
    frames = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("creative_id"), n.alias("frame_index"))
    return frames.withColumns({"t_start_s": (F.col("frame_index") - 1) / 4, "t_end_s": F.col("frame_index") / 4})


@query(f"""WITH {_FRAMES},
x AS (SELECT user_id, frame_index, p, p // 4 AS y, p % 4 AS x, {_RED} AS r, {_GREEN} AS g, {_BLUE} AS b FROM e, (SELECT unnest(range(16)) AS p)),
m AS (SELECT *, greatest(r, g, b)::DOUBLE AS high, least(r, g, b)::DOUBLE AS low, r * 0.299::DOUBLE + g * 0.587::DOUBLE + b * 0.114::DOUBLE AS gray FROM x),
h AS (SELECT *, 60 * CASE WHEN high = low THEN 0 WHEN high = r THEN (g - b) / (high - low) + CASE WHEN g < b THEN 6 ELSE 0 END WHEN high = g THEN (b - r) / (high - low) + 2 ELSE (r - g) / (high - low) + 4 END AS hue,
 lag(gray) OVER line AS l, lead(gray) OVER line AS rt, lag(gray) OVER col AS u, lead(gray) OVER col AS d FROM m
 WINDOW line AS (PARTITION BY user_id, frame_index, y ORDER BY x), col AS (PARTITION BY user_id, frame_index, x ORDER BY y)),
s AS (SELECT *, CASE WHEN x IN (1, 2) AND y IN (1, 2) THEN l + rt + u + d - 4 * gray END AS laplace,
 sqrt(CASE WHEN l IS NULL THEN rt - gray WHEN rt IS NULL THEN gray - l ELSE (rt - l) / 2 END ** 2 + CASE WHEN u IS NULL THEN d - gray WHEN d IS NULL THEN gray - u ELSE (d - u) / 2 END ** 2) AS slope FROM h),
f AS (SELECT user_id, frame_index, round(avg(high) / 255, 5) AS brightness, round(stddev_pop(high) / 255, 5) AS brightness_std, round(avg((high - low) / high), 5) AS saturation, round(stddev_pop(gray) / 255, 5) AS contrast,
 round(sqrt(var_pop(r - g) + var_pop((r + g) / 2 - b)) + 0.3 * sqrt(avg(r - g) ** 2 + avg((r + g) / 2 - b) ** 2), 4) AS colourfulness, round(var_pop(laplace), 4) AS sharpness, round(avg((slope > 50)::INTEGER), 5) AS edge_density,
 round((list_sort(list(hue))[8] + list_sort(list(hue))[9]) / 2, 2) AS dominant_hue_deg, avg(high) < 16 AS is_near_black FROM s GROUP BY 1, 2),
v AS (SELECT a.user_id, a.frame_index, round(avg(abs(a.gray::FLOAT - b.gray::FLOAT)::DOUBLE) / 255, 5) AS motion_abs_diff FROM m a JOIN m b ON a.user_id = b.user_id AND a.p = b.p AND a.frame_index = b.frame_index + 1 GROUP BY 1, 2),
n AS (SELECT user_id, frame_index, sum(c * c) - 4 AS own FROM (SELECT user_id, frame_index, floor(gray / 4) AS bin, count(*) AS c FROM m GROUP BY 1, 2, 3) GROUP BY 1, 2),
k AS (SELECT a.user_id, a.frame_index, count(*) AS both FROM m a JOIN m b ON a.user_id = b.user_id AND a.frame_index = b.frame_index + 1 AND floor(a.gray / 4) = floor(b.gray / 4) GROUP BY 1, 2)
SELECT f.user_id AS creative_id, f.frame_index, (f.frame_index - 1) / 4 AS t_start_s, f.frame_index / 4 AS t_end_s, f.* EXCLUDE (user_id, frame_index), motion_abs_diff,
round(1 - (coalesce(k.both, 0) - 4) / sqrt((n.own * b.own)::DOUBLE), 5) AS hist_distance
FROM f JOIN n USING (user_id, frame_index) LEFT JOIN v USING (user_id, frame_index) LEFT JOIN k USING (user_id, frame_index) LEFT JOIN n b ON b.user_id = f.user_id AND b.frame_index = f.frame_index - 1""")
def picture_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Light, colour, edges and motion of each event's picture of four by four pixels."""
    frames = _frames(spark, sf_dir).withColumn("pixel", F.expr(f"transform(sequence(0, 15), p -> lpad(hex({_RED}), 2, '0') || lpad(hex({_GREEN}), 2, '0') || lpad(hex({_BLUE}), 2, '0'))"))
    return features.visual_frames(frames.withColumns({"width": F.lit(4), "height": F.lit(4), "pixels": F.unhex(F.array_join("pixel", ""))}))


_SAMPLE = "((event_id * (7 * j + 3) + 5 * j * j) % 64 - 31.5D) / 64 * CASE WHEN event_id % 10 = 0 THEN 1 / 4096D ELSE 1 END"


@query(f"""WITH {_FRAMES},
y AS (SELECT user_id, frame_index, j, {_SAMPLE.replace("31.5D", "31.5::DOUBLE").replace("4096D", "4096::DOUBLE")} AS y FROM e, (SELECT unnest(range(16)) AS j)),
p AS (SELECT user_id, frame_index, k, sqrt(sum(y * (0.5 - 0.5 * cos(2 * pi() * j / 15)) * cos(2 * pi() * j * k / 16)) ** 2 + sum(y * (0.5 - 0.5 * cos(2 * pi() * j / 15)) * sin(2 * pi() * j * k / 16)) ** 2) + 1e-10 AS power
 FROM y, (SELECT unnest(range(9)) AS k) GROUP BY 1, 2, 3),
r AS (SELECT *, sum(power) OVER (PARTITION BY user_id, frame_index ORDER BY k) AS rolled, sum(power) OVER (PARTITION BY user_id, frame_index) AS whole FROM p),
q AS (SELECT user_id, frame_index, round(sum(4 * k * power) / sum(power), 2) AS spectral_centroid_hz, round(exp(avg(ln(power ** 2))) / avg(power ** 2), 6) AS spectral_flatness, 4.0::DOUBLE * min(CASE WHEN rolled >= 0.85 * whole THEN k END) AS spectral_rolloff_hz FROM r GROUP BY 1, 2),
z AS (SELECT user_id, frame_index, sqrt(avg(y * y)) AS level, round(sum(turn) / 15, 5) AS zero_crossing_rate FROM (SELECT *, ((y < 0) <> (lag(y) OVER (PARTITION BY user_id, frame_index ORDER BY j) < 0))::INTEGER AS turn FROM y) GROUP BY 1, 2)
SELECT user_id AS creative_id, frame_index, (frame_index - 1) / 4 AS t_start_s, frame_index / 4 AS t_end_s, round(level, 6) AS rms, round(20 * log10(level), 3) AS dbfs, spectral_centroid_hz, spectral_flatness, spectral_rolloff_hz, zero_crossing_rate,
0.0::DOUBLE AS onset_strength, 0.0::DOUBLE AS harmonic_ratio, 20 * log10(level) < -50 AS is_silent FROM z JOIN q USING (user_id, frame_index)""")
def sound_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level, spectrum and crossings of each event's sound of sixteen samples, too short for a rise."""
    samples = F.expr(f"transform(sequence(0, 15), j -> cast({_SAMPLE} AS FLOAT))")
    return features.audio_frames(_frames(spark, sf_dir).withColumns({"rate": F.lit(64.0), "samples": samples}))


@query(f"""{footage.WITH} SELECT creative_id, round(avg(dbfs::DOUBLE) FILTER (dbfs >= -50), 3) AS mean_dbfs, round(max(dbfs::DOUBLE), 3) AS peak_dbfs, round(max(dbfs::DOUBLE) FILTER (dbfs >= -50) - min(dbfs::DOUBLE) FILTER (dbfs >= -50), 3) AS dynamic_range_db,
round(avg((dbfs < -50)::INTEGER), 4) AS silence_share, round(avg(harmonic_ratio::DOUBLE), 5) AS mean_harmonic_ratio FROM raw_audio_frames GROUP BY 1""")
def sound_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loudness and silence of each creative."""
    return features.audio_summary(footage.raw_tables(spark, sf_dir)["audio_frames"])


#: A document as what a recogniser heard: its sentences are segments, what lies between blanks are words.
_SPOKEN_SQL = """t AS (SELECT doc_id, lang, string_split(text, '.') AS said FROM documents),
g AS (SELECT doc_id, i - 1 AS i, said[i] AS text, string_split(said[i], ' ') AS words FROM (SELECT doc_id, said, unnest(range(1, len(said) + 1)) AS i FROM t)),
s AS (SELECT doc_id AS creative_id, i AS segment_index, i * 2.0::DOUBLE AS start_s, i * 2 + 1 + i % 4 / 4.0::DOUBLE AS end_s, trim(text) AS text, len(words) AS n_words, round(len(words) / (1 + i % 4 / 4.0::DOUBLE), 3) AS words_per_s,
 round(-(i % 64) / 64.0::DOUBLE, 4) AS avg_logprob, round((i % 9) / 9.0::DOUBLE, 4) AS no_speech_prob, round(1 + (i % 7) / 7.0::DOUBLE, 4) AS compression_ratio FROM g)"""


def _spoken(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = "transform(split(text, ' '), (w, k) -> named_struct('start', i * 2 + k / 8D, 'end', i * 2 + (k + 1) / 8D, 'word', w, 'probability', (k % 7) / 7D))"
    numbers = "'avg_logprob', -(i % 64) / 64D, 'no_speech_prob', (i % 9) / 9D, 'compression_ratio', 1 + (i % 7) / 7D"
    segments = f"transform(split(text, '[.]'), (text, i) -> named_struct('start', i * 2D, 'end', i * 2 + 1 + i % 4 / 4D, 'text', text, {numbers}, 'words', {words}))"
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("creative_id"), F.expr(segments).alias("segments"))


@query(f"WITH {_SPOKEN_SQL} SELECT * FROM s")
def speech_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segments of each document's speech."""
    return extract.transcript_segments(_spoken(spark, sf_dir))


@query(f"""WITH {_SPOKEN_SQL}, w AS (SELECT doc_id, i, words, unnest(range(1, len(words) + 1)) AS k FROM g)
SELECT doc_id AS creative_id, i AS segment_index, k - 1 AS word_index, trim(words[k]) AS word, round(i * 2 + (k - 1) / 8.0::DOUBLE, 3) AS start_s, round(i * 2 + k / 8.0::DOUBLE, 3) AS end_s, round((k - 1) % 7 / 7.0::DOUBLE, 4) AS probability FROM w""")
def speech_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of each document's speech."""
    return extract.transcript_words(_spoken(spark, sf_dir))


@query(f"""WITH {_SPOKEN_SQL}, a AS (SELECT creative_id, count(*) AS n, sum(n_words)::BIGINT AS n_words, sum(end_s - start_s) AS speech_s FROM s GROUP BY 1)
SELECT doc_id AS creative_id, lang AS language, round((doc_id % 9) / 8.0::DOUBLE, 4) AS language_probability, 'plain' AS model, coalesce(n, 0) AS n_segments, coalesce(n_words, 0) AS n_words, round(coalesce(speech_s, 0), 3) AS speech_s,
round(coalesce(speech_s, 0) / nullif(doc_id % 50 * 8, 0), 4) AS speech_share, round(coalesce(n_words, 0) * 60.0::DOUBLE / nullif(doc_id % 50 * 8, 0), 2) AS words_per_minute FROM documents LEFT JOIN a ON creative_id = doc_id""")
def speech_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, speech time and pace of each document's speech; some have no duration."""
    creatives = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("creative_id"), (F.col("doc_id") % 50 * 8.0).alias("duration_s"), F.col("lang").alias("language"), (F.col("doc_id") % 9 / 8.0).alias("language_probability"))
    return extract.transcript_summary(extract.transcript_segments(_spoken(spark, sf_dir)), creatives, "plain")


@query("""WITH p AS (SELECT p_partkey AS creative_id, p_retailprice AS d, p_size * 30 AS w, (p_partkey % 5) * 400 AS h, [25, NULL, 24, round(30000 / 1001.0::DOUBLE, 3)][p_partkey % 4 + 1]::DOUBLE AS fps, p_partkey FROM part)
SELECT creative_id, d AS duration_s, w::BIGINT AS width, h AS height, round(w / nullif(h, 0)::DOUBLE, 4) AS aspect_ratio, fps, p_partkey * 777 // 1000 AS total_bitrate_kbps,
CASE WHEN round(w / nullif(h, 0)::DOUBLE, 4) < 0.95 THEN 'portrait' WHEN round(w / nullif(h, 0)::DOUBLE, 4) > 1.05 THEN 'landscape' WHEN h > 0 THEN 'square' END AS orientation FROM p""")
def probed_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed facts from what a media prober says of each part, as JSON."""
    video = "'avg_frame_rate', array('25/1', '0/0', '24', '30000/1001')[p_partkey % 4], 'width', p_size * 30, 'height', p_partkey % 5 * 400"
    probe = f"to_json(named_struct('format', named_struct('duration', cast(p_retailprice AS STRING), 'bit_rate', cast(p_partkey * 777 AS STRING)), 'video', named_struct({video})))"
    return extract.probe_row(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("creative_id"), F.expr(probe).alias("probe")))


#: Three boxes a frame, in pixels of a frame of 100 by 80; some reach over its edge.
_BOXES = "event_id % 100 - 10.0{d} AS x0, event_id * 7 % 80 * 1.0{d} AS y0, event_id % 100 - 10.0{d} + event_id * 11 % 60 AS x1, event_id * 7 % 80 * 1.0{d} + event_id * 3 % 50 AS y1"
_PLACED = f"""WITH {_FRAMES}, b AS (SELECT user_id AS creative_id, (frame_index - 1) // 3 AS frame_index, (frame_index - 1) % 3 AS n, event_id, {_BOXES.format(d="::DOUBLE")} FROM e),
c AS (SELECT creative_id, frame_index, n, event_id, least(x1 - x0, y1 - y0) AS side, greatest(least(x0, 100), 0) / 100 AS x0, greatest(least(y0, 80), 0) / 80 AS y0, greatest(least(x1, 100), 0) / 100 AS x1, greatest(least(y1, 80), 0) / 80 AS y1 FROM b)"""


def _boxes(spark: SparkSession, sf_dir: str, index: str, more: str) -> DataFrame:
    return _frames(spark, sf_dir).selectExpr("creative_id", "(frame_index - 1) div 3 AS frame_index", f"(frame_index - 1) % 3 AS {index}", "100 AS width", "80 AS height", *_BOXES.format(d="D").split(", "), more, "event_id")


@query(f"""{_PLACED} SELECT creative_id, frame_index, n AS detection_index, ['Buy', 'buy now', '50%'][event_id % 5 + 1] AS text, (event_id * 13 % 16) / 16.0::DOUBLE AS score, round(x0, 5) AS x0, round(y0, 5) AS y0, round(x1, 5) AS x1, round(y1, 5) AS y1,
round((x1 - x0) * (y1 - y0), 6) AS area_frac, round(y1 - y0, 5) AS height_frac, round((y0 + y1) / 2, 5) AS centre_y, len(['Buy', 'buy now', '50%'][event_id % 5 + 1]) AS n_chars FROM c WHERE event_id % 5 < 3 AND event_id * 13 % 16 >= 8""")
def text_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts read in each frame, placed; blank ones and doubtful ones go."""
    found = _boxes(spark, sf_dir, "detection_index", "array('Buy ', ' buy now', '50%', ' ', '')[event_id % 5] AS text").withColumn("score", F.expr("event_id * 13 % 16 / 16D"))
    return features.screen_text_detections(found).drop("event_id")


_NAMES = ", ".join(f"round(p[{i + 1}], 4) AS p_{e}" for i, e in enumerate(features.EMOTIONS))


@query(f"""{_PLACED}, p AS (SELECT creative_id, frame_index, n AS face_index, x0, y0, x1, y1, round((x1 - x0) * (y1 - y0), 6) AS area_frac, CASE WHEN side * 1.3 >= 24 THEN list_transform(range(3, 11), lambda k: (event_id * k % 17) / 16.0::DOUBLE) END AS p FROM c)
SELECT creative_id, frame_index, face_index, round(x0, 5) AS x0, round(y0, 5) AS y0, round(x1, 5) AS x1, round(y1, 5) AS y1, area_frac, round((x0 + x1) / 2, 5) AS centre_x, round((y0 + y1) / 2, 5) AS centre_y,
row_number() OVER (PARTITION BY creative_id, frame_index ORDER BY area_frac DESC, face_index) = 1 AS is_largest, {list(features.EMOTIONS)}[list_position(p, list_max(p))] AS emotion_top, round(list_max(p), 4) AS emotion_top_prob, {_NAMES} FROM p""")
def face_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faces of each frame, placed, with the likeliest emotion of those that are large enough."""
    return features.face_detections(_boxes(spark, sf_dir, "face_index", "transform(sequence(3, 10), k -> event_id * k % 17 / 16D) AS probabilities")).drop("event_id")


@query("SELECT event_id, round(1 / (1 + exp(-x)), 9) AS pull, round((exp(2 * x) - 1) / (exp(2 * x) + 1), 9) AS swing, least(greatest(x, -0.5), 0.75) AS clipped FROM (SELECT event_id, (value - 50) / 32 AS x FROM events)")
def squashed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values by sigmoid, hyperbolic tangent and limits."""
    x = (F.col("value") - 50) / 32
    return table(spark, sf_dir, "events").select("event_id", rnd(sigmoid(x), 9).alias("pull"), rnd(F.tanh(x), 9).alias("swing"), F.least(F.greatest(x, F.lit(-0.5)), F.lit(0.75)).alias("clipped"))
