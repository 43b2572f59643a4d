"""Windows over ordered rows: spans, firsts, differences, numbering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import rnd, sampled, top_by
from ..operators.sequences import autoregressive, first_crossing, global_number, in_ranges, islands, latest_per_key, previous, running
from ..registry import query
from .base import SIGNALS, signals, table

_STEP = 21600.0
_ISLANDS = f"""{SIGNALS}, flagged AS (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY user_id, event_type ORDER BY t) <= 2 * {_STEP} THEN 0 ELSE 1 END AS is_new FROM sig),
numbered AS (SELECT *, sum(is_new) OVER (PARTITION BY user_id, event_type ORDER BY t) AS span FROM flagged),
spans AS (SELECT user_id, event_type, CAST(span AS BIGINT) AS span, min(t) AS start_s, round(max(t) + {_STEP}, 3) AS end_s, count(*) AS n_points, round(max(value), 4) AS max_value,
 max(value) >= 200 AS is_large, CASE WHEN avg(value) < 33 THEN 'low' WHEN avg(value) > 66 THEN 'high' ELSE 'middle' END AS level FROM numbered GROUP BY 1, 2, span)"""


def spans(signal: DataFrame) -> DataFrame:
    numbered = islands(signal, ["user_id", "event_type"], "t", F.lit(2 * _STEP), "span")
    mean = F.avg("value")
    return numbered.groupBy("user_id", "event_type", "span").agg(
        F.min("t").alias("start_s"),
        rnd(F.max("t") + _STEP, 3).alias("end_s"),
        F.count("*").alias("n_points"),
        rnd(F.max("value"), 4).alias("max_value"),
        (F.max("value") >= 200).alias("is_large"),
        F.when(mean < 33, "low").when(mean > 66, "high").otherwise("middle").alias("level"),
    )


@query(f"WITH {_ISLANDS} SELECT * FROM spans")
def islands_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans(signals(spark, sf_dir))


@query(f"WITH {_ISLANDS} SELECT user_id, event_type, start_s, row_number() OVER (ORDER BY user_id, start_s, event_type) AS span_number FROM spans")
def global_span_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spans(signals(spark, sf_dir)).select("user_id", "event_type", "start_s")
    return global_number(rows, ["user_id", "start_s", "event_type"], "span_number")


@query(f"WITH {_ISLANDS} SELECT user_id, event_type, start_s, end_s, max_value FROM spans WHERE is_large ORDER BY max_value DESC, user_id, start_s, event_type LIMIT 10")
def topk_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spans(signals(spark, sf_dir)).filter("is_large").orderBy(F.desc("max_value"), "user_id", "start_s", "event_type")
    return rows.limit(10).select("user_id", "event_type", "start_s", "end_s", "max_value")


_FRAMES = f"{SIGNALS}, frames AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS frame_index FROM sig)"


_USER, _TIME = ["user_id"], ["t", "event_id"]


def frames(signal: DataFrame) -> DataFrame:
    """Numbers the events of each user; they stay in ranges, as a user may have a third of all."""
    return running(in_ranges(signal, _USER, _TIME), _USER, _TIME, F.lit(1), "frame_index")


@query(f"""WITH {_FRAMES} SELECT user_id, frame_index, ((frame_index - 1) % 4 = 0) AS is_sampled, CASE WHEN (frame_index - 1) % 4 = 0 THEN CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END END AS n_found FROM frames""")
def sampled_null_vs_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    on = sampled("frame_index", F.lit(4))
    return frames(signals(spark, sf_dir)).select("user_id", "frame_index", on.alias("is_sampled"), F.when(on, F.when(F.col("event_type") == "purchase", 1).otherwise(0)).alias("n_found"))


_SHOTS = f"""{_FRAMES}, shots AS (SELECT *, CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t, event_id) AS BIGINT) AS shot_index FROM frames)"""


def _shots(signal: DataFrame) -> DataFrame:
    return running(frames(signal), _USER, _TIME, F.when(F.col("event_type") == "signup", 1).otherwise(0), "shot_index")


@query(f"""WITH {_SHOTS} SELECT user_id, frame_index, shot_index, row_number() OVER (PARTITION BY user_id, shot_index ORDER BY frame_index) = 1 AS is_shot_start,
(row_number() OVER (PARTITION BY user_id, shot_index ORDER BY frame_index) = 1 AND shot_index > 0) AS is_cut FROM shots""")
def first_in_partition_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbered = running(_shots(signals(spark, sf_dir)), ["user_id", "shot_index"], ["frame_index"], F.lit(1), "in_shot")
    first = F.col("in_shot") == 1
    return numbered.select("user_id", "frame_index", "shot_index", first.alias("is_shot_start"), (first & (F.col("shot_index") > 0)).alias("is_cut"))


@query(f"""WITH {_SHOTS}, f AS (SELECT user_id, shot_index, row_number() OVER (PARTITION BY user_id, shot_index ORDER BY frame_index) = 1 AND shot_index > 0 AS is_cut FROM shots)
SELECT user_id, count(*) FILTER (WHERE is_cut) AS n_cuts, count(DISTINCT shot_index) AS n_shots FROM f GROUP BY 1""")
def cut_reconstruction(spark: SparkSession, sf_dir: str) -> DataFrame:
    cuts = first_in_partition_flag(spark, sf_dir)
    return cuts.groupBy("user_id").agg(F.count_if("is_cut").alias("n_cuts"), F.countDistinct("shot_index").alias("n_shots"))


@query(f"WITH {SIGNALS} SELECT event_id, round(abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY t, event_id)), 5) AS motion FROM sig")
def lag_diff_motion(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = previous(in_ranges(signals(spark, sf_dir), _USER, _TIME), _USER, _TIME, "value", "before")
    return timed.select("event_id", rnd(F.abs(F.col("value") - F.col("before")), 5).alias("motion"))


@query("""SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1""")
def latest_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_per_key(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


@query(f"""WITH {SIGNALS}, q AS (SELECT user_id, min(t) FILTER (WHERE value > 250) AS stopped_at FROM sig GROUP BY 1)
SELECT s.user_id, count(*) AS n_seen, bool_and(stopped_at IS NULL) AS completed FROM sig s JOIN q USING (user_id) WHERE stopped_at IS NULL OR t <= stopped_at GROUP BY 1""")
def hazard_first_crossing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sig = signals(spark, sf_dir)
    stops = first_crossing(sig, ["user_id"], "t", F.col("value") > 250)
    seen = sig.join(stops, "user_id").filter(F.col("stopped_at").isNull() | (F.col("t") <= F.col("stopped_at")))
    return seen.groupBy("user_id").agg(F.count("*").alias("n_seen"), F.bool_and(F.col("stopped_at").isNull()).alias("completed"))


@query(f"""WITH RECURSIVE {_FRAMES}, ar AS (SELECT user_id, frame_index, t, value / 100 AS x FROM frames WHERE frame_index = 1
UNION ALL SELECT f.user_id, f.frame_index, f.t, ar.x * 0.7 + f.value / 100 FROM ar JOIN frames f ON f.user_id = ar.user_id AND f.frame_index = ar.frame_index + 1)
SELECT user_id, t, round(x, 6) AS level FROM ar""")
def ar1_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    noise = signals(spark, sf_dir).select("user_id", "t", (F.col("value") / 100).alias("e"))
    return autoregressive(noise, ["user_id"], "t", "e", 0.7, "x").select("user_id", "t", rnd("x", 6).alias("level"))


@query(f"""WITH {SIGNALS}, s AS (SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id DESC) AS r FROM sig WHERE value IS NOT NULL)
SELECT user_id, event_type, value AS largest FROM s WHERE r = 1""")
def largest_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals(spark, sf_dir).groupBy("user_id", "event_type").agg(top_by("value", "value", "event_id").alias("largest")).filter("largest IS NOT NULL")
