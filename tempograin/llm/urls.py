"""URL filter: a blocked Bloom filter passes possible hits to an exact join.

A listed entry is a host and a path prefix with a verdict. It fits a URL whose
host is the entry's or a subdomain of it, and whose path starts with the
entry's; of the entries that fit, those of the highest level count, and of these
the longest decides. Entries of level 0 (lists) are compared in canonical form:
without user, default port, ``www.`` and final dots of the host, the path decoded and
``/`` if empty. Those of higher levels (rules) are compared as they are written.
For each URL the keys that could be listed (host suffixes of the listed label
counts, path prefixes of the listed lengths) are probed in the filter; only
possible hits are joined with the list, by hash of the key, which removes false
positives.

Defined cases: a null URL or one without ``://`` has an empty host and path and
fits no rule; an unlisted URL gets the default verdict; repeated rows are
answered each; an empty table or list works; entries repeated in the list count
once; between entries with the same key ``block`` wins; very long URLs and hosts of
many labels are probed no more often than the list has shapes; further columns of
the pages are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bloom import BlockedBloom
from .common import stored

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """After the first ``://`` up to / ? # or the end, A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host, up to ? # or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_host(host: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"\.*(:80|:443)?$", "")
    return F.regexp_replace(F.regexp_replace(bare, r"\.+$", ""), r"^www\.(?=.)", "")


def canonical_path(path: Column) -> Column:
    return F.when(path == "", "/").otherwise(F.coalesce(F.try_url_decode(path), path))


def thin_hosts(pages: DataFrame, least_pages: int = 5, thin: int = 1_000, share: float = 0.25) -> DataFrame:
    """pages (url, html) -> a list of canonical hosts to block: those with so many
    pages of which at least the share is thin (html of fewer characters; null is none)."""
    found = pages.select(canonical_host(host(F.col("url"))).alias("host"), F.coalesce(F.length("html"), F.lit(0)).alias("n")).groupBy("host")
    found = found.agg(F.count("*").alias("n"), F.count_if(F.col("n") < thin).alias("thin")).filter((F.col("host") != "") & (F.col("n") >= least_pages) & (F.col("thin") >= share * F.col("n")))
    return found.select("host", F.lit("/").alias("path"), F.lit("block").alias("verdict"), F.lit(0).alias("level"))


def judge_urls(pages: DataFrame, listed: DataFrame, default: str = "allow") -> DataFrame:
    """pages (page_id, url), listed (host, path, verdict, level) ->
    page_id, url, host, path, rule (host and path of the entry, or null), level, verdict.
    """
    spark = pages.sparkSession
    low = F.translate("host", _UPPER, _LOWER)
    listed = listed.select(F.when(F.col("level") > 0, low).otherwise(canonical_host(low)).alias("host"), F.when(F.col("level") > 0, F.col("path")).otherwise(canonical_path(F.col("path"))).alias("path"), "verdict", "level")
    listed = listed.groupBy("host", "path", "level").agg(F.max("verdict").alias("verdict"))
    listed = stored(listed.select("host", "path", F.xxhash64("host", "path", "level").alias("hash"), "level", "verdict", F.size(F.split("host", "[.]")).alias("labels"), F.length("path").alias("prefix")))
    # Levels, counts of labels and lengths of paths: small whole numbers.
    shapes = listed.groupBy("level", "labels", "prefix").agg(F.count("*").alias("n")).collect()
    filter_ = spark.sparkContext.broadcast(BlockedBloom.build(listed, "hash", sum(r["n"] for r in shapes)))

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            probes = b.column("probes")
            flat = probes.flatten()
            hit = filter_.value.might_contain(flat.to_numpy(zero_copy_only=False)) if len(flat) else np.zeros(0, dtype=bool)
            before = np.concatenate([[0], np.cumsum(hit)])
            offsets = probes.offsets.to_numpy() - probes.offsets[0].as_py()
            kept = pa.ListArray.from_arrays(pa.array(before[offsets], pa.int32()), flat.filter(pa.array(hit)))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), kept], names=[*columns, "hits"])

    columns = ["rid", "page_id", "url", "host", "path", "at", "below"]
    keys = []
    for s in shapes:
        h, p = ("host", "path") if s["level"] > 0 else ("at", "below")
        keys.append(F.when((F.size(F.split(h, "[.]")) >= s["labels"]) & (F.length(p) >= s["prefix"]), F.xxhash64(F.substring_index(h, ".", -s["labels"]), F.substring(p, 1, s["prefix"]), F.lit(s["level"]).cast(dict(listed.dtypes)["level"]))))
    probes = F.array_compact(F.array(*keys)) if keys else F.array().cast("array<long>")
    rows = pages.select(F.monotonically_increasing_id().alias("rid"), "page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    rows = rows.withColumns({"at": canonical_host(F.col("host")), "below": F.when(F.col("host") == "", "").otherwise(canonical_path(F.col("path")))})
    kind = dict(rows.dtypes)
    hits = rows.withColumn("probes", probes).mapInArrow(possible, f"rid long, page_id {kind['page_id']}, url string, host string, path string, at string, below string, hits array<long>")
    # A row without possible hits gets a key of its own that no entry has, so such rows don't meet in one task.
    one = hits.withColumn("hit", F.explode_outer("hits")).withColumn("key", F.when(F.col("hit").isNull(), F.concat(F.lit("#"), F.col("rid"))).otherwise(F.col("hit").cast("string"))).drop("hits", "hit")
    entry = F.struct("level", F.length(F.concat("host", "path")).alias("n"), F.concat("host", "path").alias("rule"), F.col("verdict").alias("said"), F.col("host").alias("of"), F.col("path").alias("prefix"))
    found = one.join(listed.select(F.col("hash").cast("string").alias("key"), entry.alias("entry")), "key", "left")
    # The exact test of the texts behind the hashes.
    written = F.col("entry.level") > 0
    its_host, its_path = F.when(written, F.col("host")).otherwise(F.col("at")), F.when(written, F.col("path")).otherwise(F.col("below"))
    fits = ((its_host == F.col("entry.of")) | F.endswith(its_host, F.concat(F.lit("."), F.col("entry.of")))) & F.startswith(its_path, F.col("entry.prefix"))
    best = F.max(F.when(fits, F.col("entry")))
    return found.groupBy("rid").agg(*(F.any_value(c).alias(c) for c in ("page_id", "url", "host", "path")), best.alias("best")).select("page_id", "url", "host", "path", F.col("best.rule").alias("rule"), F.col("best.level").alias("level"), F.coalesce("best.said", F.lit(default)).alias("verdict"))
