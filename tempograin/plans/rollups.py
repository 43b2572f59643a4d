"""Aggregations of a signal: tumbling windows, filtered, modal and ranked."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import display_name, joined_distinct, most_frequent, ratio, rnd, share, top_by
from ..registry import query
from .base import SIGNALS, signals, table

_ROLL = f"""{SIGNALS},
agg AS (SELECT user_id, CAST(floor(t / 3600) AS INTEGER) AS hour, count(*) AS n_events, round(avg(value), 4) AS mean_value,
  round(max(value), 4) AS peak_value, count(*) FILTER (WHERE event_type = 'purchase') AS n_purchases, bool_or(event_type = 'error') AS has_error
  FROM sig GROUP BY 1, 2),
kinds AS (SELECT user_id, CAST(floor(t / 3600) AS INTEGER) AS hour, event_type, count(*) AS n FROM sig GROUP BY 1, 2, 3),
modal AS (SELECT user_id, hour, first(event_type ORDER BY n DESC, event_type) AS modal_type FROM kinds GROUP BY 1, 2),
roll AS (SELECT *, CASE WHEN mean_value IS NULL THEN 'none' WHEN mean_value < 20 THEN 'quiet' WHEN has_error AND mean_value >= 100 THEN 'busy_with_errors'
  WHEN has_error THEN 'errors' WHEN mean_value >= 100 AND peak_value >= 200 THEN 'busy' ELSE 'steady' END AS activity_class FROM agg JOIN modal USING (user_id, hour))"""


def rollup(signal: DataFrame) -> DataFrame:
    """One row for each user and hour, with its class by a decision list."""
    hours = signal.groupBy("user_id", F.floor(F.col("t") / 3600).cast("int").alias("hour")).agg(
        F.count("*").alias("n_events"),
        rnd(F.avg("value"), 4).alias("mean_value"),
        rnd(F.max("value"), 4).alias("peak_value"),
        F.count_if(F.col("event_type") == "purchase").alias("n_purchases"),
        F.bool_or(F.col("event_type") == "error").alias("has_error"),
        most_frequent("event_type").alias("modal_type"),
    )
    level, peak, error = F.col("mean_value"), F.col("peak_value"), F.col("has_error")
    kind = F.when(level.isNull(), "none").when(level < 20, "quiet").when(error & (level >= 100), "busy_with_errors").when(error, "errors").when((level >= 100) & (peak >= 200), "busy").otherwise("steady")
    return hours.withColumn("activity_class", kind)


@query(f"WITH {_ROLL} SELECT user_id, hour, n_events, mean_value, peak_value, n_purchases, has_error, modal_type, activity_class FROM roll")
def tumbling_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup(signals(spark, sf_dir))


@query(f"WITH {_ROLL} SELECT activity_class, count(*) AS n_hours, count(DISTINCT user_id) AS n_users FROM roll GROUP BY 1")
def decision_list_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup(signals(spark, sf_dir)).groupBy("activity_class").agg(F.count("*").alias("n_hours"), F.countDistinct("user_id").alias("n_users"))


@query(f"""WITH {SIGNALS} SELECT user_id, count(*) AS n_events, count(*) FILTER (WHERE event_type = 'purchase') AS n_purchases,
count(DISTINCT event_type || '|' || CAST(CAST(floor(t / 86400) AS INTEGER) AS VARCHAR)) FILTER (WHERE event_type <> 'error') AS n_type_days,
round(sum(value) FILTER (WHERE event_type = 'view'), 2) AS view_value, round(avg(CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END), 4) AS high_share FROM sig GROUP BY user_id""")
def filtered_aggregates(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.floor(F.col("t") / 86400).cast("int").cast("string")
    kind = F.col("event_type")
    return signals(spark, sf_dir).groupBy("user_id").agg(
        F.count("*").alias("n_events"),
        F.count_if(kind == "purchase").alias("n_purchases"),
        F.countDistinct(F.when(kind != "error", F.concat(kind, F.lit("|"), day))).alias("n_type_days"),
        rnd(F.sum(F.when(kind == "view", F.col("value"))), 2).alias("view_value"),
        rnd(share(F.col("value") > 50), 4).alias("high_share"),
    )


@query("""WITH n AS (SELECT o_custkey, o_orderpriority AS p, count(*) AS n FROM orders GROUP BY 1, 2), s AS (SELECT o_custkey, o_orderstatus AS p, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT a.o_custkey, modal_priority, modal_status FROM (SELECT o_custkey, first(p ORDER BY n DESC, p) AS modal_priority FROM n GROUP BY 1) a
JOIN (SELECT o_custkey, first(p ORDER BY n DESC, p) AS modal_status FROM s GROUP BY 1) b USING (o_custkey)""")
def modal_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(most_frequent("o_orderpriority").alias("modal_priority"), most_frequent("o_orderstatus").alias("modal_status"))


@query("""SELECT l_suppkey, count(*) AS n_items, round(avg(l_quantity), 3) AS mean_quantity, round(median(l_quantity), 3) AS median_quantity, round(min(l_quantity), 3) AS min_quantity,
round(max(l_quantity), 3) AS max_quantity, round(60.0 * (count(*) - 1) / nullif(sum(l_quantity), 0), 2) AS items_per_sixty FROM lineitem GROUP BY 1""")
def median_minmax_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.count("*").alias("n_items"),
        rnd(F.avg(q), 3).alias("mean_quantity"),
        rnd(F.median(q), 3).alias("median_quantity"),
        rnd(F.min(q), 3).alias("min_quantity"),
        rnd(F.max(q), 3).alias("max_quantity"),
        rnd(ratio((F.count("*") - 1) * F.lit(60.0), F.sum(q)), 2).alias("items_per_sixty"),
    )


@query(f"""WITH {SIGNALS}, best AS (SELECT user_id, event_type, value, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id DESC) AS r FROM sig WHERE value IS NOT NULL),
n AS (SELECT user_id, event_type, count(*) AS n FROM sig WHERE event_type <> 'view' GROUP BY 1, 2), top AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type DESC) AS r FROM n)
SELECT b.user_id, b.event_type AS type_of_largest, t.event_type AS top_other_type FROM best b LEFT JOIN (SELECT * FROM top WHERE r = 1) t USING (user_id) WHERE b.r = 1""")
def argmax_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    sig = signals(spark, sf_dir)
    largest = sig.filter("value IS NOT NULL").groupBy("user_id").agg(top_by("event_type", "value", "event_id").alias("type_of_largest"))
    other = sig.filter("event_type <> 'view'").groupBy("user_id", "event_type").agg(F.count("*").alias("n")).groupBy("user_id").agg(top_by("event_type", "n").alias("top_other_type"))
    return largest.join(other, "user_id", "left")


@query("""SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ', ' ORDER BY o_orderpriority) AS priorities, count(DISTINCT o_orderpriority) AS n_priorities FROM orders GROUP BY 1""")
def string_agg_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(joined_distinct("o_orderpriority").alias("priorities"), F.countDistinct("o_orderpriority").alias("n_priorities"))


@query("""SELECT conv_id, string_agg(text, ' | ' ORDER BY turn, role, text) AS joined_text, count(*) AS n_turns FROM conversations GROUP BY 1""")
def string_agg_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(turns, lambda x: x["text"]), " | ").alias("joined_text"), F.count("*").alias("n_turns"))


@query(f"""WITH {SIGNALS} SELECT user_id, round(max(value) FILTER (WHERE event_type = 'click'), 4) AS click, round(max(value) FILTER (WHERE event_type = 'error'), 4) AS error,
round(max(value) FILTER (WHERE event_type = 'purchase'), 4) AS purchase, round(max(value) FILTER (WHERE event_type = 'signup'), 4) AS signup, round(max(value) FILTER (WHERE event_type = 'view'), 4) AS view FROM sig GROUP BY 1""")
def long_to_wide_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals(spark, sf_dir).groupBy("user_id").pivot("event_type", ["click", "error", "purchase", "signup", "view"]).agg(rnd(F.max("value"), 4))


@query("""SELECT o_custkey, round(avg(o_totalprice) FILTER (WHERE o_orderpriority = '1-URGENT'), 3) AS urgent, round(avg(o_totalprice) FILTER (WHERE o_orderpriority = '2-HIGH'), 3) AS high,
round(avg(o_totalprice) FILTER (WHERE o_orderpriority = '5-LOW'), 3) AS low FROM orders GROUP BY 1""")
def survey_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda p: rnd(F.avg(F.when(F.col("o_orderpriority") == p, F.col("o_totalprice"))), 3)
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(of("1-URGENT").alias("urgent"), of("2-HIGH").alias("high"), of("5-LOW").alias("low"))


@query("""SELECT o_orderstatus, count(*) AS n_orders, round(avg(CASE WHEN o_totalprice > 150000 THEN 1.0 ELSE 0 END), 4) AS large_rate, round(avg(o_totalprice / nullif(c_acctbal, 0)), 2) AS mean_share
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def completion_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return both.groupBy("o_orderstatus").agg(F.count("*").alias("n_orders"), rnd(share(F.col("o_totalprice") > 150000), 4).alias("large_rate"), rnd(F.avg(ratio("o_totalprice", "c_acctbal")), 2).alias("mean_share"))


_SHARE = "SELECT o_orderpriority, o_orderstatus, count(*) AS n_orders, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY o_orderpriority), 4) AS part FROM orders GROUP BY 1, 2"


def _shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    n = table(spark, sf_dir, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.count("*").alias("n_orders"))
    return n.withColumn("part", rnd(ratio("n_orders", F.sum("n_orders").over(Window.partitionBy("o_orderpriority"))), 4))


@query(_SHARE)
def share_of_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shares(spark, sf_dir)


@query(f"""SELECT o_orderpriority, coalesce(max(part) FILTER (WHERE o_orderstatus = 'F'), 0) AS "F", coalesce(max(part) FILTER (WHERE o_orderstatus = 'O'), 0) AS "O", coalesce(max(part) FILTER (WHERE o_orderstatus = 'P'), 0) AS "P" FROM ({_SHARE}) GROUP BY 1""")
def share_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shares(spark, sf_dir).groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.max("part")).fillna(0.0)


@query(f"WITH {SIGNALS} SELECT CAST(floor(t / 86400) AS INTEGER) AS day, round(value / 100, 1) AS value_bucket, count(*) AS n_events FROM sig GROUP BY 1, 2")
def group_by_rounded_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signals(spark, sf_dir).groupBy(F.floor(F.col("t") / 86400).cast("int").alias("day"), rnd(F.col("value") / 100, 1).alias("value_bucket")).agg(F.count("*").alias("n_events"))


@query("SELECT n_nationkey, CASE WHEN r_name IS NULL OR r_name = '' THEN n_name ELSE n_name || ' - ' || r_name END AS display_name, printf('%dx%d', n_nationkey, n_regionkey) AS resolution FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")
def display_name_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return both.select("n_nationkey", display_name("n_name", "r_name").alias("display_name"), F.format_string("%dx%d", "n_nationkey", "n_regionkey").alias("resolution"))
