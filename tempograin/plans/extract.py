"""Extractors: their registry, and a run over creatives as Spark tasks.

An extractor turns a creative's bytes into rows of its tables; the model inside
is the caller's. Extractors run only where the manifest has no success for the
same bytes and version, and one that fails costs its own rows only. One that
``uses`` tables gets the creative's rows of them beside its bytes: both sides are
sorted by creative, so no table is handed over whole.
"""

from __future__ import annotations

import contextlib
import json
import math
import numbers
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from ..functions.columns import orientation, rational, ratio, rnd, slug, title_and_label
from ..sources import manifest
from ..sources.raw import conform, read_raw, union_by_name
from ..sources.schemas import RAW

VIDEO_SUFFIXES = ("mp4", "mov", "m4v", "webm", "mkv")
FRAME_HZ = 4


@dataclass(frozen=True)
class Extractor:
    name: str
    version: str
    tables: tuple[str, ...]
    #: (creative_id, content), and with ``uses`` the rows of those tables -> rows of ``tables``:
    #: a data frame or, which costs far less for few rows, a list of dicts.
    extract: Callable[..., dict[str, pd.DataFrame | list[dict]]]
    requires: tuple[str, ...] = field(default=())
    uses: tuple[str, ...] = field(default=())
    #: Rows of ``uses`` come as Arrow tables, not as data frames.
    arrow: bool = False


def resolve(extractors: list[Extractor], only: list[str] | None = None) -> list[Extractor]:
    """Those named, or all, and what they require, in the order given. A name that
    nothing has, or one that runs behind what requires it, is an error."""
    place = {e.name: i for i, e in enumerate(extractors)}
    needed = set(only or place)
    for i, e in reversed(list(enumerate(extractors))):
        if e.name in needed:
            needed.update(e.requires)
            if behind := [r for r in e.requires if place.get(r, -1) > i]:
                raise ValueError(f"{e.name} requires {', '.join(behind)} before it")
    if missing := needed - set(place):
        raise ValueError(f"unknown names: {', '.join(sorted(missing))}")
    return [e for e in extractors if e.name in needed]


def describe(extractors: list[Extractor]) -> str:
    """A Markdown table of the extractors, in the order they run."""
    lines = ["| Extractor | Version | Fills | Requires |", "|---|---|---|---|"]
    return "\n".join([*lines, *(f"| {e.name} | {e.version} | {', '.join(e.tables)} | {', '.join(e.requires) or '-'} |" for e in resolve(extractors))])


def discover(spark: SparkSession, folder: str) -> DataFrame:
    """creative_id, title, source_label, file_name, file_sha256, file_size_bytes,
    content of each video below a folder, in order of its name; a folder without
    any is an error."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    stem = F.regexp_replace(F.url_decode(name), r"\.[^.]*$", "")
    title, label = title_and_label(stem)
    videos = files.filter(F.lower(F.element_at(F.split("path", "[.]"), -1)).isin(*VIDEO_SUFFIXES))
    if videos.select("path").isEmpty():
        raise ValueError(f"no video below {folder}: looked for {', '.join(VIDEO_SUFFIXES)}")
    return videos.select(slug(stem).alias("creative_id"), title.alias("title"), label.alias("source_label"), F.url_decode(name).alias("file_name"), F.sha2("content", 256).alias("file_sha256"), F.col("length").alias("file_size_bytes"), "content").orderBy("file_name")


def selected(creatives: DataFrame, text: str | None) -> DataFrame:
    """Creatives whose id or file name holds the text; none is an error."""
    if not text:
        return creatives
    found = creatives.filter(F.contains(F.lower("creative_id"), F.lit(text.lower())) | F.contains(F.lower("file_name"), F.lit(text.lower())))
    if found.isEmpty():
        raise ValueError(f"no creative matches {text!r}")
    return found


#: What a row's value may be to go into a column as it is.
_PLAIN = {"string": {str}, "bigint": {int}, "double": {float, int}, "float": {float, int}, "boolean": {bool}}
#: So many rows are handed over at once.
BLOCK = 10_000


def _fitting(v: object, kind: str) -> object:
    """A value of another type as a column's: any as text, whole numbers as such; null if it doesn't fit."""
    if kind == "string" and v is not None:
        return (v if isinstance(v, str) else json.dumps(v, default=str)).encode("utf-8", "replace").decode()
    if kind == "boolean":
        return bool(v) if type(v).__name__.startswith("bool") else None
    if not isinstance(v, numbers.Real) or isinstance(v, bool):
        return None
    if kind == "bigint":
        return int(v) if math.isfinite(v) and v == int(v) and -(2**63) <= v < 2**63 else None
    return float(v)


def _column(values: list, kind: str, to: pa.DataType) -> pa.Array:
    if {type(v) for v in values} - {type(None)} <= _PLAIN.get(kind, set()):
        with contextlib.suppress(pa.ArrowInvalid, OverflowError, UnicodeError):
            return pa.array(values, to)
    return pa.array([_fitting(v, kind) for v in values], to)


class _Made:
    """Runs and rows of creatives, as Arrow batches: a record is either a run or one
    row of one table, in a column of the table's name."""

    HEAD = StructType([RAW["_manifest"][c] for c in ("creative_id", "creative_sha256", "status", "error", "rows_written", "duration_s")])

    def __init__(self, extractor: Extractor):
        self.extractor, self.schema = extractor, StructType([*self.HEAD, *(StructField(t, RAW[t]) for t in extractor.tables)])
        self.types = to_arrow_schema(self.schema)
        self.heads, self.rows = [], {t: [] for t in extractor.tables}

    def __len__(self) -> int:
        return len(self.heads) + sum(map(len, self.rows.values()))

    def add(self, creative_id: str, sha: str, content: bytes, *used: dict) -> None:
        """Extracts; an error is in the run's record, other creatives go on."""
        began, made, n, status, error = time.time(), {}, 0, "ok", None
        try:
            for table, found in self.extractor.extract(creative_id, content, *used).items():
                rows = json.loads(found.to_json(orient="records")) if isinstance(found, pd.DataFrame) else [{**x} for x in found]
                made[table], n = rows, n + len(rows)
        except Exception as e:
            made, n, status, error = {}, 0, "error", f"{type(e).__name__}: {e}"
        self.heads.append((creative_id, sha, status, error, n, time.time() - began))
        for table, rows in made.items():
            if table in self.rows:
                for x in rows:
                    x.setdefault("creative_id", creative_id)
                self.rows[table] += rows

    def blocks(self) -> Iterator[pa.RecordBatch]:
        """All that was added since, in batches of bounded length."""
        yield from self._records([(self.heads, None)])
        for t, rows in self.rows.items():
            yield from self._records([(rows, t)])
        self.heads, self.rows = [], {t: [] for t in self.extractor.tables}

    def _records(self, parts: list) -> Iterator[pa.RecordBatch]:
        for records, table in parts:
            for at in range(0, len(records), BLOCK):
                some = records[at : at + BLOCK]
                columns = {f.name: pa.nulls(len(some), f.type) for f in self.types}
                if table is None:
                    for f, values in zip(self.HEAD, zip(*some, strict=True), strict=True):
                        columns[f.name] = _column(list(values), f.dataType.simpleString(), self.types.field(f.name).type)
                else:
                    to = self.types.field(table).type
                    fields = [_column([x.get(f.name) for x in some], f.dataType.simpleString(), to.field(f.name).type) for f in RAW[table]]
                    columns[table] = pa.StructArray.from_arrays(fields, fields=list(to))
                yield pa.RecordBatch.from_arrays(list(columns.values()), schema=self.types)


def run(creatives: DataFrame, extractor: Extractor, folder: str, run_id: str) -> DataFrame:
    """Extracts what is stale, writes the tables' partitions and the manifest;
    returns the runs. One task may fill several tables, so a record has a column for each.
    With ``uses``, a creative's rows come sorted before the creative, in one stream."""
    spark = creatives.sparkSession
    work = creatives.select("creative_id", F.col("file_sha256").alias("creative_sha256"), "content", F.lit(extractor.name).alias("extractor"), F.lit(extractor.version).alias("extractor_version"))
    todo = manifest.stale(work, manifest.latest_runs(spark, folder, manifest.STATE)).select("creative_id", "creative_sha256", "content")
    schema = _Made(extractor).schema

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = _Made(extractor)
        for b in batches:
            for creative_id, sha, content in zip(b.column("creative_id").to_pylist(), b.column("creative_sha256").to_pylist(), b.column("content"), strict=True):
                made.add(creative_id, sha, content.as_py())
                if len(made) >= BLOCK:
                    yield from made.blocks()
        yield from made.blocks()

    def with_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, of = _Made(extractor), object()
        for b in batches:
            ids, kinds = b.column("creative_id"), b.column("kind").to_numpy()
            tables = {t: pa.RecordBatch.from_struct_array(b.column(t)) for t in extractor.uses}
            other = pc.fill_null(pc.not_equal(ids[1:], ids[:-1]), True).to_numpy(zero_copy_only=False) | (kinds[1:] != kinds[:-1])
            ends = [*(np.flatnonzero(other) + 1).tolist(), b.num_rows]
            for start, end in zip([0, *ends], ends, strict=False):
                if start == end:
                    continue
                if (creative_id := ids[start].as_py()) != of:
                    of, used = creative_id, {t: [] for t in extractor.uses}
                if kinds[start] < len(tables):
                    table = extractor.uses[kinds[start]]
                    used[table].append(tables[table].slice(start, end - start))
                    continue
                for i in range(start, end):
                    given = {t: pa.Table.from_batches(used[t], tables[t].schema) for t in tables}
                    made.add(creative_id, b.column("creative_sha256")[i].as_py(), b.column("content")[i].as_py(), given if extractor.arrow else {t: x.to_pandas() for t, x in given.items()})
                if len(made) >= BLOCK:
                    yield from made.blocks()
        yield from made.blocks()

    if extractor.uses:
        given = [read_raw(spark, folder, t).select("creative_id", F.lit(i).alias("kind"), F.struct("*").alias(t)) for i, t in enumerate(extractor.uses)]
        together = union_by_name([todo.withColumn("kind", F.lit(len(given))), *given])
        made = together.repartition("creative_id").sortWithinPartitions("creative_id", "kind").mapInArrow(with_rows, schema).cache()
    else:
        made = todo.mapInArrow(each, schema).cache()
    for name in extractor.tables:
        conform(made.filter(F.col(name).isNotNull()).select(f"{name}.*"), RAW[name]).write.mode("append").option("compression", "zstd").parquet(f"{folder}/{name}")
    runs = made.filter("status IS NOT NULL").select(
        "creative_id", "creative_sha256", F.lit(extractor.name).alias("extractor"), F.lit(extractor.version).alias("extractor_version"), "status", "rows_written", F.lit(",".join(extractor.tables)).alias("tables"), F.lit(run_id).alias("run_id"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("finished_at"), rnd("duration_s", 2).alias("duration_s"), "error"
    )
    manifest.append(runs, folder)
    made.unpersist()
    return runs


# The relational parts of the extractors.


def probe_row(probes: DataFrame) -> DataFrame:
    """creative_id, probe (JSON of a media prober) -> typed columns."""
    get = lambda path: F.get_json_object("probe", path)
    fps, w, h = rational(get("$.video.avg_frame_rate")), get("$.video.width").cast("long"), get("$.video.height").cast("long")
    aspect = rnd(ratio(w, h), 4)
    return probes.select("creative_id", get("$.format.duration").cast("double").alias("duration_s"), w.alias("width"), h.alias("height"), aspect.alias("aspect_ratio"), orientation(aspect).alias("orientation"), rnd(fps, 3).alias("fps"), F.floor(get("$.format.bit_rate").cast("long") / 1000).alias("total_bitrate_kbps"))


def sampling_config(creatives: DataFrame, rates: dict[str, float]) -> DataFrame:
    """The sampling step of each extractor, in frames of the 4 Hz spine."""
    rows = F.explode(F.array(*(F.struct(F.lit(e).alias("extractor"), F.lit(float(hz)).alias("sample_hz"), F.lit(max(1, round(FRAME_HZ / hz))).cast("long").alias("step_frames")) for e, hz in rates.items())))
    return creatives.select("creative_id", rows.alias("r")).select("creative_id", "r.extractor", "r.sample_hz", F.lit(float(FRAME_HZ)).alias("frame_hz"), "r.step_frames")


def shots_from_cuts(frames: DataFrame, threshold: float = 27.0) -> DataFrame:
    """Shots from a per-frame content change: a change at or above the threshold
    starts one; without any, the creative is one shot."""
    w = Window.partitionBy("creative_id").orderBy("frame_index")
    start = (F.col("change") >= threshold) | (F.row_number().over(w) == 1)
    numbered = frames.withColumn("shot_index", F.sum(F.when(start, 1).otherwise(0)).over(w) - 1)
    shots = numbered.groupBy("creative_id", "shot_index").agg(F.min("t_start_s").alias("start_s"), F.max("t_end_s").alias("end_s"), F.min("frame_index").alias("start_frame"), F.max("frame_index").alias("end_frame"))
    return shots.select("creative_id", "shot_index", "start_s", "end_s", rnd(F.col("end_s") - F.col("start_s"), 3).alias("duration_s"), "start_frame", "end_frame")


def decibels(rms: Column | str) -> Column:
    return 20.0 * F.log10(F.greatest(F.col(rms) if isinstance(rms, str) else rms, F.lit(1e-9)))


#: A recogniser's segments of a creative, with their words.
SPOKEN = "creative_id string, segments array<struct<start: double, end: double, text: string, avg_logprob: double, no_speech_prob: double, compression_ratio: double, words: array<struct<start: double, end: double, word: string, probability: double>>>>"


def transcript_segments(spoken: DataFrame) -> DataFrame:
    """spoken (``SPOKEN``) -> a row for each segment, numbered from 0."""
    s = spoken.select("creative_id", F.posexplode("segments").alias("segment_index", "s"))
    n = F.coalesce(F.size(F.coalesce("s.words", F.array())), F.lit(0)).cast("long")
    pace = n / F.greatest(F.col("s.end") - F.col("s.start"), F.lit(1e-6))
    measures = [rnd(f"s.{c}", 4).alias(c) for c in ("avg_logprob", "no_speech_prob", "compression_ratio")]
    return s.select("creative_id", F.col("segment_index").cast("long").alias("segment_index"), rnd("s.start", 3).alias("start_s"), rnd("s.end", 3).alias("end_s"), F.trim(F.coalesce("s.text", F.lit(""))).alias("text"), n.alias("n_words"), rnd(pace, 3).alias("words_per_s"), *measures)


def transcript_words(spoken: DataFrame) -> DataFrame:
    """spoken (``SPOKEN``) -> a row for each word, numbered from 0 in its segment."""
    s = spoken.select("creative_id", F.posexplode("segments").alias("segment_index", "s")).select("creative_id", "segment_index", F.posexplode("s.words").alias("word_index", "w"))
    return s.select("creative_id", *(F.col(c).cast("long").alias(c) for c in ("segment_index", "word_index")), F.trim(F.coalesce("w.word", F.lit(""))).alias("word"), rnd("w.start", 3).alias("start_s"), rnd("w.end", 3).alias("end_s"), rnd("w.probability", 4).alias("probability"))


def transcript_summary(segments: DataFrame, creatives: DataFrame, model: str | None = None) -> DataFrame:
    """segments and creatives (creative_id, duration_s and, where known, language and
    language_probability) -> language, model, words, speech time and pace of each
    creative; zeros without speech, no share without a duration."""
    spoken = segments.groupBy("creative_id").agg(F.count("*").alias("n_segments"), F.sum("n_words").alias("n_words"), F.sum(F.col("end_s") - F.col("start_s")).alias("speech_s"))
    whole = creatives.join(spoken, "creative_id", "left").fillna(0, ["n_segments", "n_words", "speech_s"])
    known = lambda c, kind: F.col(c) if c in creatives.columns else F.lit(None).cast(kind)
    return whole.select(
        "creative_id", known("language", "string").alias("language"), rnd(known("language_probability", "double"), 4).alias("language_probability"), F.lit(model).cast("string").alias("model"), "n_segments", "n_words",
        rnd("speech_s", 3).alias("speech_s"), rnd(ratio("speech_s", "duration_s"), 4).alias("speech_share"), rnd(ratio(F.col("n_words") * 60.0, "duration_s"), 2).alias("words_per_minute"),
    )
