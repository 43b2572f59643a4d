"""The corpus pipeline: five stages from raw documents to a training mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next stage's documents. All stages
return the columns of documents; the last adds ``taken``, the words that the mix
takes from a document, repeats counted.

Defined cases are those of the operators: null texts pass the filters as empty
texts (they aren't toxic, duplicates or leaks) and the mix takes nothing of
them, so they go at the end; repeated rows are one document after the
near-duplicate stage if they have words; empty tables give an empty mix.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempograin.llm import decontaminate, lines, mixing, neardup, toxicity
from tempograin.llm.common import ensure_checkpoint_dir, gone_at_exit, guarded, mod_of_id, table

#: From this score on, a document is rejected as toxic.
TOXIC_FROM = 0.7
#: What run()'s rows depend on, a trained classifier, has no SQL.
ORACLE_SQL = None


def _measured(docs: DataFrame) -> DataFrame:
    """n_chars is that of the changed text."""
    return docs.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else docs


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(toxicity.training_rows(docs, table(spark, sf_dir, "labels"), "toxic", mod_of_id(F.col("doc_id"), 3) != 1))
    return guarded(docs, lambda d: toxicity.scored(d, model, "__toxicity").filter(F.col("__toxicity") < TOXIC_FROM).select(*d.columns))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(lines.lines_removed(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.duplicates_removed(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared checkpoint folder and read again."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    gone_at_exit(spark, folder)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
