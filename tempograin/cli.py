"""Commands: list, prepare, extract, compact, transform, scripts, docs, status,
all, and the audience's generate (audience), load, analysis and validate."""

from __future__ import annotations

import argparse
import importlib
import sys
import uuid

from pyspark.sql import SparkSession

from .plans import audience, extract, marts
from .sources import catalog, framecache, landing, manifest, raw, scripts, sinks


def session() -> SparkSession:
    return SparkSession.builder.appName("tempograin").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").getOrCreate()


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser("tempograin")
    p.add_argument("command", choices=["list", "extract", "transform", "docs", "status", "all", "audience", "analysis", "validate", "load", "prepare", "compact", "scripts"])
    p.add_argument("--videos", default="videos")
    p.add_argument("--extractors", help="module:name of a list of extractors")
    p.add_argument("--only", nargs="*", help="names of extractors; what they require runs too")
    p.add_argument("--creative", help="part of an id or a file name")
    p.add_argument("--raw", default="warehouse/raw")
    p.add_argument("--marts", default="warehouse/marts")
    p.add_argument("--audience", default="warehouse/audience")
    p.add_argument("--landing", default="landing/biometrics")
    p.add_argument("--database", help="load: the audience's tables into this database, in place of the landed rows")
    p.add_argument("--cache", help="module:name of a FrameCache, for prepare")
    p.add_argument("--scripts", default="transforms", help="a folder of SQL scripts")
    p.add_argument("--arg", nargs="*", default=[], metavar="NAME=VALUE", help="arguments of the scripts")
    p.add_argument("--viewers", type=int, default=audience.VIEWERS)
    p.add_argument("--seed", type=int, default=audience.SEED)
    a = p.parse_args(args)
    spark = session()
    mart = lambda n: spark.read.parquet(f"{a.marts}/{n}.parquet")
    panel = lambda: {n: spark.read.parquet(f"{a.audience}/{n}.parquet") for n in catalog_names()}
    if a.command in ("list", "extract", "all"):
        known = _named(a.extractors)
        if a.command == "list":
            print(extract.describe(known))
            extract.selected(extract.discover(spark, a.videos), a.creative).drop("content").show(1000, truncate=False)
            return 0
        run_id, failed = uuid.uuid4().hex[:12], 0
        for e in extract.resolve(known, a.only):
            runs = extract.run(extract.selected(extract.discover(spark, a.videos), a.creative), e, a.raw, run_id)
            failed += runs.filter("status <> 'ok'").count()
        if a.command == "extract":
            return int(failed > 0)
    if a.command in ("transform", "all"):
        made = marts.all_marts(raw.raw_views(spark, a.raw))
        sinks.export_marts(made, a.marts)
        for n in ("creative_frames", "creative_seconds"):
            made[n].unpersist()
    if a.command == "prepare":
        found = framecache.prepare(extract.selected(extract.discover(spark, a.videos), a.creative), _named(a.cache)[0]).collect()  # a row for each file, without its frames
        print(f"{sum(r['decoded'] for r in found)} decoded, {sum(not r['decoded'] and r['error'] is None for r in found)} known, {sum(r['error'] is not None for r in found)} failed")
        return int(any(r["error"] for r in found))
    if a.command == "compact":
        print(f"{manifest.compact(spark, a.raw)} files merged")
    elif a.command == "scripts":
        scripts.run_scripts(spark, a.scripts, dict(x.split("=", 1) for x in a.arg))
    if a.command in ("docs", "all"):
        print(catalog.document({n: mart(n) for n in ("creatives", "shots", "screen_text", "creative_frames", "creative_seconds", "creative_summary")}))
    elif a.command == "status":
        manifest.status(manifest.history(spark, a.raw)).show(truncate=False)
    elif a.command == "audience":
        for n, rows in audience.generate(spark, mart("creative_seconds"), a.viewers, a.seed).items():
            sinks.write_parquet(rows, f"{a.audience}/{n}.parquet")
    elif a.command == "analysis":
        t, seconds = panel(), mart("creative_seconds")
        rows = audience.viewer_seconds(t, seconds)
        sinks.export_marts({"viewer_seconds": rows, "creative_performance": audience.creative_performance(t, rows, mart("creative_summary"))}, a.marts)
    elif a.command == "validate":
        checks = audience.validate(panel(), mart("creative_seconds"))
        checks.show(50, truncate=False)
        return int(not checks.filter("NOT passed").isEmpty())
    elif a.command == "load":
        if a.database:
            print(", ".join(catalog.load_audience(spark, a.audience, a.database)))
        else:
            landing.load_table(spark, a.landing, f"{a.audience}/ingested_biometric_seconds")
    return 0


def _named(place: str | None) -> list:
    """What module:name says, as a list; none without it."""
    module, _, name = (place or "").partition(":")
    found = getattr(importlib.import_module(module), name) if name else []
    return list(found) if isinstance(found, (list, tuple)) else [found]


def catalog_names() -> list[str]:
    from .sources.schemas import AUDIENCE

    return list(AUDIENCE)


if __name__ == "__main__":
    sys.exit(main())
