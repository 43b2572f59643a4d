"""Text normalisation on documents and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import orientation, rational, rnd, slug, squeezed, title_and_label, word_norm
from ..registry import query
from .base import table


@query("""WITH w AS (SELECT conv_id, turn, role, unnest(string_split(text, ' ')) AS word FROM conversations) SELECT conv_id, turn, role, lower(regexp_replace(word, '[^\\w'']', '', 'g')) AS word_norm, count(*) AS n FROM w GROUP BY 1, 2, 3, 4""")
def text_normalise_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.explode(F.split("text", " ")).alias("word"))
    return words.groupBy("conv_id", "turn", "role", word_norm("word").alias("word_norm")).agg(F.count("*").alias("n"))


@query("SELECT doc_id, lower(trim(regexp_replace(text, '[\\t\\n\\f\\r ]+', ' ', 'g'))) AS text_norm FROM documents")
def text_whitespace_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", squeezed("text").alias("text_norm"))


@query("""WITH p AS (SELECT p_partkey, p_name || ' - ' || p_brand || ' - ' || p_type AS full_name FROM part)
SELECT p_partkey, trim(regexp_extract(full_name, '^(.*) - (.*)$', 1)) AS title, trim(regexp_extract(full_name, '^(.*) - (.*)$', 2)) AS label,
trim(regexp_replace(regexp_replace(regexp_replace(lower(trim(p_name)), '[^a-z0-9\\s_-]', '', 'g'), '[\\s_-]+', '-', 'g'), '^-+|-+$', '', 'g')) AS slug FROM p JOIN part USING (p_partkey)""")
def slug_and_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    title, label = title_and_label(F.concat_ws(" - ", "p_name", "p_brand", "p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", title.alias("title"), label.alias("label"), slug("p_name").alias("slug"))


@query("""SELECT s_suppkey, round(s_suppkey * 1.0 / nullif(s_nationkey, 0), 4) AS rate, CASE WHEN s_suppkey * 1.0 / nullif(s_nationkey, 0) < 0.95 THEN 'portrait' WHEN s_suppkey * 1.0 / nullif(s_nationkey, 0) > 1.05 THEN 'landscape'
WHEN nullif(s_nationkey, 0) IS NOT NULL THEN 'square' END AS orientation FROM supplier""")
def rational_and_orientation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rate = rational(F.concat_ws("/", "s_suppkey", "s_nationkey"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", rnd(rate, 4).alias("rate"), orientation(rate).alias("orientation"))
