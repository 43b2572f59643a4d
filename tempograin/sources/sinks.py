"""Writers: Parquet with zstd, CSV with a header, a folder of marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .catalog import CONTRACT

#: Marts that are written as CSV too.
CSV_MARTS = ("creative_summary", "shots", "creative_performance")


def write_parquet(rows: DataFrame, path: str, keys: list[str] | None = None) -> None:
    """Overwrites; with keys, only the partitions that the rows have."""
    out = rows.write.mode("overwrite").option("compression", "zstd")
    (out.option("partitionOverwriteMode", "dynamic").partitionBy(*keys) if keys else out).parquet(path)


def write_csv(rows: DataFrame, path: str) -> None:
    """With a header; null is an empty field, booleans true and false."""
    rows.write.mode("overwrite").option("header", True).csv(path)


def export_marts(marts: dict[str, DataFrame], folder: str) -> None:
    """Each mart in the order of its key, nulls last: sorted ranges, so no task has all rows."""
    for name, rows in marts.items():
        keys = [F.col(k).asc_nulls_last() for k in CONTRACT.get(name, ("", "", ""))[1].split(", ") if k in rows.columns]
        ordered = rows.orderBy(*keys) if keys else rows
        write_parquet(ordered, f"{folder}/{name}.parquet")
        if name in CSV_MARTS:
            write_csv(ordered, f"{folder}/{name}.csv")
