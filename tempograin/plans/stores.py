"""Queries that go through what the library keeps: landed batches, exported marts,
raw folders, the runs of extractors, catalog tables, ordered scripts. Each run
works in a new folder below the shared one."""

from __future__ import annotations

import uuid
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sequences import global_number
from ..registry import query
from ..sources import catalog, landing, manifest, raw, scripts, sinks, snapshot
from ..sources.lineage import shared_dir
from ..sources.schemas import EMOTIONS, LANDING
from . import extract, footage
from .base import table


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Twenty events of a user are a batch; some have no viewer, no rows, a value out of bounds or a strange emotion.
_BATCHES_SQL = """e AS (SELECT user_id, event_id, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) // 20 AS b, (row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) % 20 AS second FROM events),
r AS (SELECT user_id, b, CASE WHEN user_id % 17 = 0 THEN 'missing id' WHEN (user_id + b) % 19 = 0 THEN 'number of rows' WHEN count(*) FILTER (event_id % 97 = 0) > 0 THEN 'value out of bounds' WHEN count(*) FILTER (event_id % 101 = 0) > 0 THEN 'unknown emotion label' END AS reason FROM e GROUP BY 1, 2)"""


def _batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = "row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1"
    events = table(spark, sf_dir, "events").selectExpr("user_id", "event_id", f"({number}) div 20 AS b", f"({number}) % 20 AS second")
    emotions = "if(event_id % 101 = 0, map('neutral', 0.5D, 'boredom', 0.5D), map('neutral', event_id % 8 / 8D, 'fear', event_id % 4 / 8D))"
    row = f"struct(cast(second AS INT) AS second, if(event_id % 9 = 0, NULL, event_id * 7 % 64 / 64D) AS attention_index, event_id % 3 > 0 AS gaze_on_screen, event_id % 5 > 0 AS face_detected, if(event_id % 97 = 0, 1.5D, event_id % 17 / 8D - 1) AS valence, event_id % 33 / 32D AS arousal, {emotions} AS emotions)"
    grouped = events.groupBy("user_id", "b").agg(F.collect_list(F.expr(row)).alias("rows"))  # twenty rows at most
    return grouped.selectExpr("concat('s', user_id, '-', b) AS session_id", "if(user_id % 17 = 0, NULL, concat('v', user_id)) AS viewer_id", "concat('c', b) AS creative_id", "if((user_id + b) % 19 = 0, NULL, rows) AS rows")


@query(f"WITH {_BATCHES_SQL} SELECT 's' || user_id || '-' || b AS session_id, reason FROM r")
def batch_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which batches keep the contract, and why the others don't."""
    good, bad = landing.split_valid(_batches(spark, sf_dir))
    return good.select("session_id", F.lit(None).cast("string").alias("reason")).unionByName(bad.select("session_id", "reason"))


_OTHERS = ", ".join(f"NULL::DOUBLE AS p_{e}" for e in EMOTIONS if e not in ("neutral", "fear"))


@query(f"""WITH {_BATCHES_SQL} SELECT 's' || user_id || '-' || b AS session_id, 'v' || user_id AS viewer_id, 'c' || b AS creative_id, second::INTEGER AS second, CASE WHEN event_id % 9 > 0 THEN (event_id * 7 % 64) / 64.0::DOUBLE END AS attention_index,
event_id % 3 > 0 AS gaze_on_screen, event_id % 5 > 0 AS face_detected, (event_id % 17) / 8.0::DOUBLE - 1 AS valence, (event_id % 33) / 32.0::DOUBLE AS arousal, (event_id % 8) / 8.0::DOUBLE AS p_neutral, (event_id % 4) / 8.0::DOUBLE AS p_fear, {_OTHERS}, 'ingested' AS data_source
FROM e JOIN r USING (user_id, b) WHERE reason IS NULL""")
def landed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of valid batches, landed and loaded as a table that is replaced whole, twice."""
    folder = _folder(spark, "landing")
    landing.land(_batches(spark, sf_dir), f"{folder}/zone")
    for _ in range(2):
        landing.load_table(spark, f"{folder}/zone", f"{folder}/table")
    return snapshot.read(spark, f"{folder}/table", LANDING).drop("batch_id", "received_at")


#: Shots as they are exported; those of users whose number ends with 7 have no creative.
_SHOTS = "SELECT CASE WHEN substr(creative_id, 2, 6) NOT LIKE '%7' THEN creative_id END AS creative_id, shot_index, duration_s FROM raw_shot_boundaries"


@query(f"""{footage.WITH}, x AS ({_SHOTS}) SELECT 'parquet' AS sink, row_number() OVER (ORDER BY creative_id NULLS LAST, shot_index NULLS LAST) AS position, creative_id, shot_index FROM x
UNION ALL SELECT 'csv', NULL, creative_id, shot_index FROM x""")
def exported_shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart's rows as both sinks hold them, numbered as they lie in the Parquet files."""
    folder = _folder(spark, "marts")
    shots = spark.sql(_SHOTS.replace("raw_shot_boundaries", "{shots}"), shots=footage.raw_tables(spark, sf_dir)["shot_boundaries"])
    sinks.export_marts({"shots": shots}, folder)
    lying = spark.read.parquet(f"{folder}/shots.parquet").select("creative_id", "shot_index", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    numbered = global_number(lying, ["file", "at"], "position").select(F.lit("parquet").alias("sink"), "position", "creative_id", "shot_index")
    csv = spark.read.schema(shots.schema).option("header", True).csv(f"{folder}/shots.csv")
    return numbered.unionByName(csv.select(F.lit("csv").alias("sink"), F.lit(None).cast("long").alias("position"), "creative_id", "shot_index"))


#: What is asked of the views, in both engines.
_REPORT = """SELECT creative_id, count(*) AS n_shots, max(end_s) AS end_s, sum(n_texts) AS n_texts FROM (SELECT s.creative_id, s.shot_index, max(s.end_s) AS end_s, count(t.frame_index) AS n_texts
FROM raw_shot_boundaries s LEFT JOIN raw_screen_text_detections t ON t.creative_id = s.creative_id AND t.t_start_s >= s.start_s AND t.t_start_s < s.end_s GROUP BY s.creative_id, s.shot_index) GROUP BY creative_id"""


@query(f"{footage.WITH} SELECT creative_id, n_shots, end_s, n_texts::BIGINT AS n_texts FROM ({_REPORT})")
def raw_view_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shots and their texts from views of raw folders, whose files have different columns."""
    folder, tables = _folder(spark, "raw"), footage.raw_tables(spark, sf_dir)
    shots, texts = tables["shot_boundaries"], tables["screen_text_detections"]
    even = F.col("creative_id").rlike("[02468]$")
    shots.filter(~even).write.parquet(f"{folder}/shot_boundaries")
    shots.filter(even).select("end_s", "creative_id", "shot_index", F.col("start_s").cast("float").alias("start_s")).write.mode("append").parquet(f"{folder}/shot_boundaries")
    sinks.write_parquet(texts, f"{folder}/screen_text_detections")
    raw.raw_views(spark, folder)
    return spark.sql(_REPORT)


def _words(creative_id: str, content: bytes) -> dict[str, list[dict]]:
    words = content.decode().split(" ")
    if "BUILDING" in words:
        raise ValueError("not a word")
    return {"transcript_words": [{"segment_index": 0, "word_index": i, "word": w} for i, w in enumerate(words)]}


def _summary(creative_id: str, content: bytes, used: dict[str, pa.Table]) -> dict[str, list[dict]]:
    return {"transcript_summary": [{"n_words": used["transcript_words"].num_rows}]}


#: Words are found for every other customer, then for all, then they are summed up.
EXTRACTORS = [extract.Extractor("words", "1", ("transcript_words",), _words), extract.Extractor("summary", "1", ("transcript_summary",), _summary, ("words",), ("transcript_words",), arrow=True)]


def _extracted(spark: SparkSession, sf_dir: str) -> str:
    folder = _folder(spark, "extracted")
    texts = table(spark, sf_dir, "customer").selectExpr("c_custkey", "concat('c', c_custkey) AS creative_id", "encode(concat(c_name, ' ', c_mktsegment, repeat(' x', cast(c_custkey % 5 AS INT))), 'UTF-8') AS content")
    creatives = texts.withColumn("file_sha256", F.sha2("content", 256))
    words, summary = extract.resolve(EXTRACTORS, ["summary"])
    for run, (extractor, rows) in {"r1": (words, creatives.filter("c_custkey % 2 = 0")), "r2": (words, creatives), "r3": (summary, creatives)}.items():
        extract.run(rows, extractor, folder, run)
    return folder


@query("""WITH w AS (SELECT c_custkey, c_mktsegment = 'BUILDING' AS fails, 2 + c_custkey % 5 AS n FROM customer),
r AS (SELECT *, 'words' AS extractor, 'r1' AS run_id FROM w WHERE c_custkey % 2 = 0 UNION ALL SELECT *, 'words', 'r2' FROM w WHERE c_custkey % 2 = 1 OR fails UNION ALL SELECT *, 'summary', 'r3' FROM w)
SELECT 'c' || c_custkey AS creative_id, extractor, run_id, CASE WHEN fails AND extractor = 'words' THEN 'error' ELSE 'ok' END AS status, CASE WHEN fails AND extractor = 'words' THEN 'ValueError: not a word' END AS error,
CASE WHEN extractor = 'summary' THEN 1 WHEN fails THEN 0 ELSE n END AS rows_written FROM r""")
def extractor_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All runs of two extractors, one of which fails on some creatives: what was done isn't done again."""
    folder = _extracted(spark, sf_dir)
    manifest.compact(spark, folder)
    return manifest.history(spark, folder).select("creative_id", "extractor", "run_id", "status", "error", "rows_written")


@query("SELECT 'c' || c_custkey AS creative_id, CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE 2 + c_custkey % 5 END AS n_words FROM customer")
def extracted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an extractor made of the rows that another one wrote."""
    return raw.read_raw(spark, _extracted(spark, sf_dir), "transcript_summary").select("creative_id", "n_words")


@query(f"""{footage.WITH} SELECT 'shots' AS name, count(*) AS n_rows, 7 AS n_columns FROM raw_shot_boundaries UNION ALL SELECT 'sampling_config', count(*), 5 FROM raw_sampling_config""")
def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables saved in a database, with the sizes of their statistics."""
    database, tables = f"marts_{uuid.uuid4().hex}", footage.raw_tables(spark, sf_dir)
    spark.sql(f"CREATE DATABASE {database} LOCATION '{_folder(spark, database)}'")
    for _ in range(2):  # saving again replaces
        catalog.save_marts({"shots": tables["shot_boundaries"], "sampling_config": tables["sampling_config"]}, database)
    names = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    return spark.createDataFrame([(n, catalog.analysed_rows(spark, f"{database}.{n}"), len(spark.table(f"{database}.{n}").columns)) for n in names], "name string, n_rows long, n_columns int")


@query("""WITH f AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS frame FROM events), s AS (SELECT user_id, frame // 4 AS second, count(*) FILTER (event_type = 'click') AS clicks FROM f GROUP BY 1, 2)
SELECT user_id, count(*) AS seconds, sum(clicks)::BIGINT AS clicks, count(*) FILTER (clicks >= 2) AS busy_seconds FROM s GROUP BY 1""")
def scripted_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last result of a folder of scripts, run in order with arguments."""
    table(spark, sf_dir, "events").createOrReplaceTempView("scripted_events")
    results = scripts.run_scripts(spark, str(Path(__file__).parent / "scripts"), {"busy": 2, "source": "scripted_seconds"})
    return results["03_summary.sql"]
