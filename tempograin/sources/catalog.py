"""Documentation of tables from what they are: columns, types, row counts."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .raw import conform, opened
from .schemas import AUDIENCE

#: grain, key and purpose of the marts and of the audience tables.
CONTRACT: dict[str, tuple[str, str, str]] = {
    "creatives": ("one row per creative", "creative_id", "Identity, pacing, voice, sound and modal look of each creative."),
    "shots": ("one row per shot", "creative_id, shot_index", "Shots with the features of their frames."),
    "transcript_segments": ("one row per spoken segment", "creative_id, segment_index", "What is said, when, and how sure that is."),
    "transcript_words": ("one row per spoken word", "creative_id, segment_index, word_index", "Words with a normal form for counting."),
    "screen_text": ("one row per span of a text on screen", "screen_text_id", "Texts on screen from first to last sight."),
    "creative_frames": ("one row per sampled frame (4 Hz)", "creative_id, frame_index", "All features on the frame spine; null where a frame wasn't looked at."),
    "creative_seconds": ("one row per second", "creative_id, second", "The published spine that responses join to."),
    "creative_summary": ("one row per creative", "creative_id", "Rollup of seconds, texts and objects."),
    "viewers": ("one row per panelist", "viewer_id", "Demographics, device, consent, latent traits."),
    "sessions": ("one row per exposure", "session_id", "Who watched what, and whether to the end."),
    "biometric_seconds": ("one row per session and second", "session_id, second", "The response; rows stop when the viewer leaves."),
    "survey_questions": ("one row per question", "question_id", "The battery asked after an exposure."),
    "survey_responses": ("one row per session and question", "session_id, question_id", "The answers."),
    "iat_trials": ("one row per trial", "viewer_id, block, trial_index", "Reaction times of the association test."),
    "iat_scores": ("one row per viewer", "viewer_id", "D-scores of the association test."),
    "generator_params": ("one row per parameter", "component, parameter", "The effects that made the panel."),
    "generator_manifest": ("one row per run", "run_id", "Seed, version and sizes of a run."),
    "viewer_seconds": ("one row per session and second", "session_id, second", "Responses next to what was on screen and who watched."),
    "creative_performance": ("one row per creative", "creative_id", "Completion, response and survey of each creative."),
}


def describe(name: str, rows: DataFrame, n: int | None = None) -> str:
    """A Markdown section of one table; its size, if it isn't given, is counted."""
    grain, key, purpose = CONTRACT.get(name, ("?", "?", ""))
    lines = [f"### `{name}`", "", f"**Grain** {grain} | **Key** `{key}` | **Rows** {rows.count() if n is None else n:,}", "", *([purpose, ""] if purpose else []), "| Column | Type |", "|---|---|"]
    return "\n".join([*lines, *(f"| `{f.name}` | {f.dataType.simpleString()} |" for f in rows.schema), ""])


def document(tables: dict[str, DataFrame], title: str = "Tables", sizes: dict[str, int] | None = None) -> str:
    return "\n".join([f"# {title}", "", *(describe(n, t, (sizes or {}).get(n)) for n, t in tables.items())])


def analysed_rows(spark: SparkSession, table: str) -> int | None:
    """The number of rows in the table's statistics, if it was analysed."""
    for r in spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:t)", args={"t": table}).collect():
        if r["col_name"] == "Statistics" and (found := re.search(r"([0-9]+) rows", r["data_type"])):
            return int(found[1])
    return None


def document_catalog(spark: SparkSession, database: str) -> str:
    """All tables, with the sizes of their statistics: no table is scanned but one never analysed."""
    names = sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)
    sizes = {n: r for n in names if (r := analysed_rows(spark, f"{database}.{n}")) is not None}
    return document({n: spark.table(f"{database}.{n}") for n in names}, f"Tables of {database}", sizes)


def footer_rows(paths: DataFrame) -> int:
    """paths (path) of Parquet files -> rows in all, from the files' footers."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = 0
            for path in b.column("path").to_pylist():
                fs, name = opened(path)
                with fs.open_input_file(name) as f:
                    n += pq.read_metadata(f).num_rows
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return paths.select("path").mapInArrow(rows, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def save_marts(marts: dict[str, DataFrame], database: str) -> None:
    """Each mart as a table of a database, replaced whole."""
    spark = next(iter(marts.values())).sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, rows in marts.items():
        rows.write.mode("overwrite").format("parquet").saveAsTable(f"{database}.{name}")
        spark.sql("ANALYZE TABLE IDENTIFIER(:t) COMPUTE STATISTICS", args={"t": f"{database}.{name}"})


def load_audience(spark: SparkSession, folder: str, database: str = "audience") -> list[str]:
    """The audience's tables from a folder of <table>.parquet, each with its declared
    columns, replaced whole in a database of their own; returns those that were there."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    there = [n for n in AUDIENCE if path(f"{folder}/{n}.parquet").getFileSystem(spark._jsc.hadoopConfiguration()).exists(path(f"{folder}/{n}.parquet"))]
    if not there:
        raise FileNotFoundError(f"no table of the audience in {folder}")
    save_marts({n: conform(spark.read.parquet(f"{folder}/{n}.parquet"), AUDIENCE[n]) for n in there}, database)
    return there
