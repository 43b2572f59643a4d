"""Acceptance checks and coverage reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import rnd
from ..registry import query
from ..streaming.windows import tumbling_counts
from .base import report, table


_VIOLATIONS = [
    ("every order has a customer", "SELECT count(*) AS n FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)"),
    ("every item has an order", "SELECT count(*) AS n FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)"),
    ("discounts are rates", "SELECT count(*) AS n FROM lineitem WHERE l_discount < 0 OR l_discount > 1"),
    ("statuses are known", "SELECT count(*) AS n FROM orders WHERE o_orderstatus NOT IN ('F', 'O', 'P')"),
    ("every nation has a region", "SELECT count(*) AS n FROM nation WHERE NOT EXISTS (SELECT 1 FROM region WHERE r_regionkey = n_regionkey)"),
    ("events have a positive value", "SELECT count(*) AS n FROM events WHERE value IS NULL OR value <= 0"),
    ("every label has a document", "SELECT count(*) AS n FROM labels l WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = l.doc_id)"),
    ("labels are 0 or 1", "SELECT count(*) AS n FROM labels WHERE toxic NOT IN (0, 1) OR quality NOT IN (0, 1)"),
    ("n_chars counts code points", "SELECT count(*) AS n FROM documents WHERE n_chars <> length(text)"),
    ("every page has an address", "SELECT count(*) AS n FROM pages WHERE url IS NULL OR url NOT LIKE '%://%'"),
    ("turns have a role", "SELECT count(*) AS n FROM conversations WHERE role IS NULL"),
]


@query(" UNION ALL ".join(f"SELECT '{name}' AS check_name, CAST(n AS VARCHAR) || ' violations' AS detail, n = 0 AS passed FROM ({sql})" for name, sql in _VIOLATIONS))
def acceptance_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = {n: table(spark, sf_dir, n) for n in ("orders", "customer", "lineitem", "nation", "region", "events", "labels", "documents", "pages", "conversations")}
    orphans = lambda a, b, x, y: t[a].join(t[b], F.col(x) == F.col(y), "left_anti")
    yes = F.lit(True)
    rows = {
        "every order has a customer": (orphans("orders", "customer", "o_custkey", "c_custkey"), yes),
        "every item has an order": (orphans("lineitem", "orders", "l_orderkey", "o_orderkey"), yes),
        "discounts are rates": (t["lineitem"], ~F.col("l_discount").between(0, 1)),
        "statuses are known": (t["orders"], ~F.col("o_orderstatus").isin("F", "O", "P")),
        "every nation has a region": (orphans("nation", "region", "n_regionkey", "r_regionkey"), yes),
        "events have a positive value": (t["events"], F.col("value").isNull() | (F.col("value") <= 0)),
        "every label has a document": (t["labels"].join(t["documents"].select("doc_id"), "doc_id", "left_anti"), yes),
        "labels are 0 or 1": (t["labels"], ~F.col("toxic").isin(0, 1) | ~F.col("quality").isin(0, 1)),
        "n_chars counts code points": (t["documents"], F.col("n_chars") != F.length("text")),
        "every page has an address": (t["pages"], F.col("url").isNull() | ~F.col("url").contains("://")),
        "turns have a role": (t["conversations"], F.col("role").isNull()),
    }
    return report([(name, *rows[name]) for name, _ in _VIOLATIONS])


@query("""SELECT count(DISTINCT user_id || '|' || event_type) FILTER (WHERE value > 0) || ' of ' || count(DISTINCT user_id) * count(DISTINCT event_type) || ' pairs' AS detail,
count(DISTINCT user_id || '|' || event_type) FILTER (WHERE value > 0) = count(DISTINCT user_id) * count(DISTINCT event_type) AS passed FROM events""")
def distinct_pair_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.bool_or(F.col("value") > 0).alias("ok"))
    n = pairs.agg(F.count_if("ok").alias("found"), (F.countDistinct("user_id") * F.countDistinct("event_type")).alias("wanted"))
    return n.select(F.concat_ws(" of ", F.col("found").cast("string"), F.concat(F.col("wanted").cast("string"), F.lit(" pairs"))).alias("detail"), (F.col("found") == F.col("wanted")).alias("passed"))


@query("SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_done, count(*) FILTER (WHERE o_orderstatus <> 'F') AS n_open, strftime(max(o_orderdate), '%Y-%m-%d') AS latest FROM orders GROUP BY 1")
def run_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = F.col("o_orderstatus") == "F"
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count_if(done).alias("n_done"), F.count_if(~done).alias("n_open"), F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("latest"))


@query("SELECT event_type, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS hour, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def landing_stream_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a stream of files, counted in tumbling hours until all is read."""
    counts = tumbling_counts(spark, sf_dir, "events.parquet", "1 hour")
    return counts.select("event_type", F.date_format("start", "yyyy-MM-dd HH:mm").alias("hour"), "n", rnd("total", 2).alias("total"))
