"""Unions by name, nested values, freshness, binning, rankings of vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import band, ratio, rnd
from ..operators.sequences import latest_per_key
from ..operators.vectors import against, centroids, cosine, largest, softmax_ranks, suppressed_boxes
from ..registry import query
from ..sources.raw import union_by_name
from .base import SIGNALS, signals, table


@query("""SELECT c_custkey AS k, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS price FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL, NULL FROM supplier UNION ALL SELECT p_partkey, p_name, NULL, NULL, p_retailprice FROM part""")
def union_by_name_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("price"))
    return union_by_name([customers, suppliers, parts])


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(json_extract(props, '$.missing') AS BIGINT) AS missing FROM events")
def map_flatten_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.from_json("props", "map<string,bigint>")
    return table(spark, sf_dir, "events").select("event_id", F.try_element_at(props, F.lit("k")).alias("k"), F.try_element_at(props, F.lit("missing")).alias("missing"))


@query("""WITH done AS (SELECT o_custkey, max(o_orderdate) AS latest FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT c_custkey FROM customer LEFT JOIN done ON o_custkey = c_custkey WHERE latest IS NULL OR latest < TIMESTAMP '1997-01-01'""")
def freshness_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without a finished order since 1997: work still to do."""
    done = table(spark, sf_dir, "orders").filter((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") >= F.to_timestamp_ntz(F.lit("1997-01-01 00:00:00"))))
    return table(spark, sf_dir, "customer").join(done, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("SELECT p_partkey, CASE WHEN p_size <= 0 OR p_size > 50 THEN NULL WHEN p_size <= 10 THEN '1-10' WHEN p_size <= 25 THEN '11-25' WHEN p_size <= 40 THEN '26-40' ELSE '41-50' END AS size_band FROM part")
def age_band_binning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", band("p_size", [(10, "1-10"), (25, "11-25"), (40, "26-40"), (50, "41-50")], 0).alias("size_band"))


@query("""WITH e AS (SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT label AS centre, i, avg(CAST(v AS DOUBLE)) AS m FROM e GROUP BY 1, 2),
s AS (SELECT vec_id, centre, sum(CAST(v AS DOUBLE) * m) / (sqrt(sum(CAST(v AS DOUBLE) * v)) * sqrt(sum(m * m))) AS cs FROM e JOIN c USING (i) GROUP BY 1, 2),
p AS (SELECT vec_id, centre, exp(100 * cs) / sum(exp(100 * cs)) OVER (PARTITION BY vec_id) AS score, row_number() OVER (PARTITION BY vec_id ORDER BY cs DESC, centre) - 1 AS rank FROM s)
SELECT vec_id, centre, round(score, 4) AS score, rank, rank = 0 AS is_top FROM p""")
def cosine_softmax_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector against every label's centroid: cosine times 100, softmax, rank."""
    rows = table(spark, sf_dir, "embeddings")
    centres = centroids(rows, "label", "embedding").withColumnRenamed("label", "centre")
    pairs = against(rows.select("vec_id", "embedding"), centres, "centre")
    scored = pairs.select("vec_id", "centre", (cosine("embedding", "centroid") * 100).alias("logit"), F.lit("label").alias("axis"))
    return softmax_ranks(scored, ["vec_id"], "axis", "centre", "logit").select("vec_id", "centre", rnd("score", 4).alias("score"), "rank", "is_top")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_partkey) = 1 AS is_largest FROM lineitem")
def largest_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return largest(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_extendedprice", "l_partkey").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "is_largest")


@query("""WITH RECURSIVE b AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY score DESC, x0, y0, x1, y1) AS r FROM (SELECT l_orderkey, l_extendedprice % 1 AS x0, 0.0::DOUBLE AS y0, l_extendedprice % 1 + l_quantity / 50 AS x1, l_quantity / 50 AS y1, 1 - l_discount AS score FROM lineitem)),
k AS (SELECT l_orderkey, r, [{'x0': x0, 'y0': y0, 'x1': x1, 'y1': y1, 'score': score}] AS kept FROM b WHERE r = 1
UNION ALL SELECT k.l_orderkey, b.r, CASE WHEN len(list_filter(kept, lambda q: greatest(least(q.x1, b.x1) - greatest(q.x0, b.x0), 0) * least(q.y1, b.y1) > 0.5 * ((q.x1 - q.x0) * q.y1 + (b.x1 - b.x0) * b.y1 - greatest(least(q.x1, b.x1) - greatest(q.x0, b.x0), 0) * least(q.y1, b.y1)))) = 0
 THEN list_append(kept, {'x0': b.x0, 'y0': b.y0, 'x1': b.x1, 'y1': b.y1, 'score': b.score}) ELSE kept END FROM k JOIN b ON b.l_orderkey = k.l_orderkey AND b.r = k.r + 1),
last AS (SELECT l_orderkey, arg_max(kept, r) AS kept FROM k GROUP BY 1)
SELECT l_orderkey, q.x0 AS x0, q.y0 AS y0, q.x1 AS x1, q.y1 AS y1, q.score AS score FROM (SELECT l_orderkey, unnest(kept) AS q FROM last)""")
def nms_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes made of items (size from quantity, place from price), suppressed in each order."""
    side, at = F.col("l_quantity") / 50, F.col("l_extendedprice") % 1
    boxes = table(spark, sf_dir, "lineitem").select("l_orderkey", at.alias("x0"), F.lit(0.0).alias("y0"), (at + side).alias("x1"), side.alias("y1"), (1 - F.col("l_discount")).alias("score"))
    return suppressed_boxes(boxes, ["l_orderkey"])


@query(f"""WITH {SIGNALS}, n AS (SELECT user_id, event_type, count(*) AS n FROM sig GROUP BY 1, 2) SELECT DISTINCT ON (user_id) user_id, event_type AS last_type, n FROM n ORDER BY user_id, n DESC, event_type DESC""")
def latest_row_by_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = signals(spark, sf_dir).groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return latest_per_key(n, ["user_id"], ["n", "event_type"]).select("user_id", F.col("event_type").alias("last_type"), "n")


@query("""SELECT l_returnflag, l_linestatus, sum(CAST(l_quantity AS BIGINT))::BIGINT AS quantity, round(sum(l_extendedprice * (1 - l_discount)), 0) AS revenue, count(*) AS n,
round(count(*)::DOUBLE / sum(count(*)) OVER (), 4) AS part FROM lineitem GROUP BY 1, 2""")
def totals_with_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(F.sum(F.col("l_quantity").cast("long")).alias("quantity"), rnd(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 0).alias("revenue"), F.count("*").alias("n"))
    return n.withColumn("part", rnd(ratio("n", F.sum("n").over(Window.partitionBy(F.lit(0)))), 4))
