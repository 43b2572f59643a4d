"""Statistics: standard scores, correlation, least squares, association scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import logit, rnd
from ..operators.statistics import d_scores, gram, z_score
from ..registry import query
from .base import SIGNALS, signals, table


@query(f"""WITH {SIGNALS} SELECT event_id, round((value - avg(value) OVER w) / CASE WHEN coalesce(stddev_samp(value) OVER w, 0) = 0 THEN 1.0 ELSE stddev_samp(value) OVER w END, 4) AS value_z FROM sig WINDOW w AS (PARTITION BY user_id)""")
def groupwise_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals(spark, sf_dir).select("event_id", rnd(z_score("value", ["user_id"]), 4).alias("value_z"))


@query(f"""WITH {SIGNALS}, v AS (SELECT user_id, round(avg(value) FILTER (WHERE event_type IN ('view', 'click')), 1) AS mean_rt_congruent_ms, round(avg(value) FILTER (WHERE event_type NOT IN ('view', 'click')), 1) AS mean_rt_incongruent_ms,
round(stddev_samp(value), 1) AS pooled_sd_ms, count(*) AS n_valid_trials FROM sig WHERE event_type <> 'error' GROUP BY 1)
SELECT *, round((mean_rt_incongruent_ms - mean_rt_congruent_ms) / nullif(pooled_sd_ms, 0), 4) AS d_score FROM v""")
def dscore_mean_sd(spark: SparkSession, sf_dir: str) -> DataFrame:
    trials = signals(spark, sf_dir).select("user_id", "event_id", "value", F.col("event_type").isin("view", "click").alias("congruent"), (F.col("event_type") == "error").alias("error"))
    return d_scores(trials, "user_id", "congruent", "value", "error", "event_id")


@query("SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 6) AS r, round(corr(l_discount, l_tax), 6) AS r_rates FROM lineitem GROUP BY 1")
def pearson_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(rnd(F.corr("l_quantity", "l_extendedprice"), 6).alias("r"), rnd(F.corr("l_discount", "l_tax"), 6).alias("r_rates"))


@query("""SELECT l_returnflag, CAST(count(*) AS DOUBLE) AS n, round(sum(l_quantity), 0) AS x, round(sum(l_quantity * l_quantity), 0) AS xx, round(sum(l_quantity * l_discount), 2) AS xz, round(sum(l_extendedprice), 0) AS y, round(sum(l_quantity * l_extendedprice), -1) AS xy FROM lineitem GROUP BY 1""")
def ols_gram_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = gram(table(spark, sf_dir, "lineitem"), "l_extendedprice", ["l_quantity", "l_discount"], ["l_returnflag"])
    return g.select(
        "l_returnflag", F.col("one__one").alias("n"), rnd("one__l_quantity", 0).alias("x"), rnd("l_quantity__l_quantity", 0).alias("xx"), rnd("l_quantity__l_discount", 2).alias("xz"), rnd("one__y", 0).alias("y"), (F.round(F.col("l_quantity__y") / 10, 0) * 10).alias("xy")
    )


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(ln(greatest(least(l_discount * 5, 1 - 1e-6), 1e-6) / (1 - greatest(least(l_discount * 5, 1 - 1e-6), 1e-6))), 4) AS logit_discount FROM lineitem")
def logit_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", rnd(logit(F.col("l_discount") * 5), 4).alias("logit_discount"))


@query("SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 3) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept FROM lineitem GROUP BY 1")
def least_squares_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = gram(table(spark, sf_dir, "lineitem"), "l_extendedprice", ["l_quantity"], ["l_returnflag"])
    n, x, y, xx, xy = (F.col(c) for c in ("one__one", "one__l_quantity", "one__y", "l_quantity__l_quantity", "l_quantity__y"))
    slope = F.try_divide(n * xy - x * y, n * xx - x * x)
    return g.select("l_returnflag", rnd(slope, 3).alias("slope"), rnd((y - slope * x) / n, 2).alias("intercept"))
