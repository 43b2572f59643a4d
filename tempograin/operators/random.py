"""Random draws that depend on a seed and a row's keys only, so neither on the
partitioning nor on the order of rows."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform(seed: int, section: str, *keys: Column | str) -> Column:
    """In (0, 1)."""
    h = F.xxhash64(F.lit(seed), F.lit(section), *keys)
    return (F.shiftrightunsigned(h, 11).cast("double") + 0.5) / F.lit(2.0**53)


def normal(seed: int, section: str, *keys: Column | str, mean: float | Column = 0.0, sd: float | Column = 1.0) -> Column:
    """Normal draws, by the polar form of two uniform ones."""
    u, v = uniform(seed, section + "/u", *keys), uniform(seed, section + "/v", *keys)
    return mean + sd * F.sqrt(-2.0 * F.ln(u)) * F.cos(2.0 * math.pi * v)


def choice(u: Column, shares: list[tuple[str, float]]) -> Column:
    """The value whose share of (0, 1) holds u."""
    out, below = None, 0.0
    for value, part in shares[:-1]:
        below += part
        out = F.when(u < below, F.lit(value)) if out is None else out.when(u < below, F.lit(value))
    return out.otherwise(F.lit(shares[-1][0])) if out is not None else F.lit(shares[-1][0])
