"""Dimension, as-of, range and overlap joins, and presence tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import ratio, rnd
from ..operators.timejoin import asof_backward, asof_small, overlap_flag, points_in_intervals
from ..registry import query
from .base import SIGNALS, signals, table

_DAY = 86400.0


@query("SELECT o_orderkey, o_custkey, c_mktsegment, c_acctbal, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey")
def left_join_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", "o_custkey", "c_mktsegment", "c_acctbal", "n_name")


_ASOF = f"""WITH {SIGNALS}, starts AS (SELECT user_id, t AS start_s, value AS start_value FROM sig WHERE event_type = 'signup')
SELECT s.event_id, s.user_id, round(s.t - p.start_s, 3) AS t_since_start, p.start_value FROM sig s ASOF LEFT JOIN starts p ON p.user_id = s.user_id AND s.t >= p.start_s"""


def _starts(sig: DataFrame) -> DataFrame:
    return sig.filter("event_type = 'signup'").select("user_id", F.col("t").alias("start_s"), F.col("value").alias("start_value"))


@query(_ASOF)
def asof_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    sig = signals(spark, sf_dir)
    return asof_backward(sig, _starts(sig), ["user_id"], "t", "start_s", ["start_s", "start_value"]).select("event_id", "user_id", rnd(F.col("t") - F.col("start_s"), 3).alias("t_since_start"), "start_value")


@query(_ASOF)
def asof_join_small_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    sig = signals(spark, sf_dir)
    return asof_small(sig, _starts(sig), ["user_id"], "t", "start_s", ["start_s", "start_value"]).select("event_id", "user_id", rnd(F.col("t") - F.col("start_s"), 3).alias("t_since_start"), "start_value")


_SPANS = f"""{SIGNALS}, spans AS (SELECT event_id AS span_id, user_id, t AS start_s, t + 21600.0 AS end_s FROM sig WHERE event_type = 'purchase')"""


def spans(sig: DataFrame) -> DataFrame:
    """Six hours from each purchase."""
    return sig.filter("event_type = 'purchase'").select(F.col("event_id").alias("span_id"), "user_id", F.col("t").alias("start_s"), (F.col("t") + 21600.0).alias("end_s"))


@query(f"""WITH {_SPANS} SELECT p.span_id, count(*) AS n_points, round(avg(s.value), 4) AS mean_value, round(max(s.value), 5) AS peak_value,
count(DISTINCT s.event_type) AS n_types, string_agg(DISTINCT s.event_type, ', ' ORDER BY s.event_type) AS types
FROM spans p JOIN sig s ON s.user_id = p.user_id AND s.t >= p.start_s AND s.t < p.end_s GROUP BY 1""")
def range_join_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    sig = signals(spark, sf_dir)
    both = points_in_intervals(sig, spans(sig), ["user_id"], "t", "start_s", "end_s", _DAY)
    return both.groupBy("span_id").agg(
        F.count("*").alias("n_points"),
        rnd(F.avg("value"), 4).alias("mean_value"),
        rnd(F.max("value"), 5).alias("peak_value"),
        F.countDistinct("event_type").alias("n_types"),
        F.array_join(F.array_sort(F.collect_set("event_type")), ", ").alias("types"),
    )


@query(f"""WITH {_SPANS}, w AS (SELECT DISTINCT user_id, floor(t / 3600) * 3600.0 AS a FROM sig)
SELECT user_id, a AS from_s, EXISTS (SELECT 1 FROM spans p WHERE p.user_id = w.user_id AND w.a < p.end_s AND w.a + 3600.0 > p.start_s) AS is_active FROM w""")
def interval_overlap_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    sig = signals(spark, sf_dir)
    hours = sig.select("user_id", (F.floor(F.col("t") / 3600) * 3600.0).alias("from_s")).distinct().withColumn("to_s", F.col("from_s") + 3600.0)
    return overlap_flag(hours, spans(sig), ["user_id"], ("from_s", "to_s"), ("start_s", "end_s"), _DAY, "is_active").select("user_id", "from_s", "is_active")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, o_orderpriority, c_mktsegment, n_name, r_name, s_name, 'item=measured; order=given' AS data_source
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey LEFT JOIN supplier ON l_suppkey = s_suppkey""")
def star_join_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = {n: table(spark, sf_dir, n) for n in ("lineitem", "orders", "customer", "nation", "region", "supplier")}
    places = t["nation"].join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    buyers = t["customer"].join(places, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_mktsegment", "n_name", "r_name")
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_orderpriority").join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    items = t["lineitem"].join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t["supplier"].select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
    return items.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "o_orderpriority", "c_mktsegment", "n_name", "r_name", "s_name", F.lit("item=measured; order=given").alias("data_source"))


@query("""WITH item AS (SELECT c_mktsegment, count(DISTINCT l_orderkey) AS n_orders_with_items, round(avg(l_quantity), 4) AS mean_quantity, round(avg(CASE WHEN l_discount > 0.05 THEN 1.0 ELSE 0 END), 4) AS discount_share
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1),
done AS (SELECT c_mktsegment, count(*) AS n_orders, round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0 END), 4) AS completion_rate FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1),
base AS (SELECT c_mktsegment, count(*) AS n_customers FROM customer GROUP BY 1)
SELECT c_mktsegment, n_customers, n_orders, n_orders_with_items, completion_rate, mean_quantity, discount_share FROM base LEFT JOIN done USING (c_mktsegment) LEFT JOIN item USING (c_mktsegment)""")
def performance_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    orders = table(spark, sf_dir, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    items = table(spark, sf_dir, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    mean = lambda flag: rnd(F.avg(F.when(flag, 1.0).otherwise(0.0)), 4)
    item = items.groupBy("c_mktsegment").agg(F.countDistinct("l_orderkey").alias("n_orders_with_items"), rnd(F.avg("l_quantity"), 4).alias("mean_quantity"), mean(F.col("l_discount") > 0.05).alias("discount_share"))
    done = orders.groupBy("c_mktsegment").agg(F.count("*").alias("n_orders"), mean(F.col("o_orderstatus") == "F").alias("completion_rate"))
    return customers.groupBy("c_mktsegment").agg(F.count("*").alias("n_customers")).join(done, "c_mktsegment", "left").join(item, "c_mktsegment", "left")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def anti_join_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query("SELECT p_partkey, (EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_returnflag = 'R')) AS was_returned FROM part")
def presence_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_partkey").alias("p_partkey"), F.lit(True).alias("found")).distinct()
    return table(spark, sf_dir, "part").join(returned, "p_partkey", "left").select("p_partkey", F.col("found").isNotNull().alias("was_returned"))


@query(f"""WITH {SIGNALS}, p AS (SELECT 20.0 AS low, 100.0 AS high) SELECT event_id, CASE WHEN value < low THEN 'low' WHEN value < high THEN 'middle' ELSE 'high' END AS level FROM sig CROSS JOIN p""")
def cross_join_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    low, high = F.lit(20.0), F.lit(100.0)  # a one-row parameter table is a pair of literals
    return signals(spark, sf_dir).select("event_id", F.when(F.col("value") < low, "low").when(F.col("value") < high, "middle").otherwise("high").alias("level"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, round(l_extendedprice / nullif(o_totalprice, 0), 4) AS part_of_order FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def position_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return both.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", rnd(ratio("l_extendedprice", "o_totalprice"), 4).alias("part_of_order"))
