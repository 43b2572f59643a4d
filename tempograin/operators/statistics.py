"""Statistics over groups, in one pass where that is possible."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import rnd


def z_score(value: str, keys: list[str]) -> Column:
    """Distance from the group's mean in sample standard deviations; a group
    without spread divides by 1."""
    w = Window.partitionBy(*keys)
    sd = F.stddev_samp(value).over(w)
    return (F.col(value) - F.avg(value).over(w)) / F.when(sd.isNull() | (sd == 0), F.lit(1.0)).otherwise(sd)


def gram(rows: DataFrame, y: str, xs: list[str], keys: list[str] | None = None) -> DataFrame:
    """n and all products of 1, x..., y that least squares need: one aggregation."""
    terms = {"one": F.lit(1.0), **{x: F.col(x).cast("double") for x in xs}, "y": F.col(y).cast("double")}
    names = list(terms)
    whole = rows.dropna(subset=[y, *xs])
    products = [F.sum(terms[a] * terms[b]).alias(f"{a}__{b}") for i, a in enumerate(names) for b in names[i:]]
    return (whole.groupBy(*keys) if keys else whole.groupBy()).agg(*products)


def least_squares(rows: DataFrame, y: str, xs: list[str]) -> dict[str, float]:
    """Intercept and slopes; the driver solves a system as large as the number
    of predictors."""
    r = gram(rows, y, xs).first().asDict()
    names = ["one", *xs]
    at = lambda a, b: r.get(f"{a}__{b}") if f"{a}__{b}" in r else r[f"{b}__{a}"]
    if r["one__one"] is None:
        return dict.fromkeys(["intercept", *xs], float("nan"))
    left = np.array([[at(a, b) for b in names] for a in names])
    right = np.array([at(a, "y") for a in names])
    return dict(zip(["intercept", *xs], np.linalg.lstsq(left, right, rcond=None)[0].tolist(), strict=True))


def d_scores(trials: DataFrame, key: str, congruent: str, time: str, error: str, order: str | None = None) -> DataFrame:
    """Implicit-association scores: difference of the mean times of incongruent
    and congruent trials without errors, over their pooled deviation. Means and
    deviation are rounded to one digit before they are divided. With ``order`` the times
    of a key are added one by one in that order: a mean that lies between two roundings
    is decided by its sum's last bit, which else depends on how files are split."""
    t = F.col(time)
    counted = trials.filter(~F.col(error))
    if order:
        counted = counted.repartition(key).sortWithinPartitions(key, order)
    valid = counted.groupBy(key).agg(
        rnd(F.avg(F.when(F.col(congruent), t)), 1).alias("mean_rt_congruent_ms"),
        rnd(F.avg(F.when(~F.col(congruent), t)), 1).alias("mean_rt_incongruent_ms"),
        rnd(F.stddev_samp(time), 1).alias("pooled_sd_ms"),
        F.count("*").alias("n_valid_trials"),
    )
    return valid.withColumn("d_score", rnd(F.try_divide(F.col("mean_rt_incongruent_ms") - F.col("mean_rt_congruent_ms"), F.col("pooled_sd_ms")), 4))
