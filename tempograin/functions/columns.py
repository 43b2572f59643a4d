"""Column helpers whose results must equal those of the reference dialect."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rnd(c: Column | str, digits: int = 0) -> Column:
    """Rounds in binary floating point: scale, round half away from zero, scale
    back. (Spark's own round goes through decimal text and differs at 1.005.)"""
    scale = float(10**digits)
    return F.round(col(c) * F.lit(scale), 0) / F.lit(scale) if digits else F.round(col(c), 0)


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b, null where b is 0."""
    return F.try_divide(col(a).cast("double"), F.nullif(col(b).cast("double"), F.lit(0.0)))


def share(flag: Column | str) -> Column:
    """The mean of a boolean as 0 and 1; null counts as 0."""
    return F.avg(F.when(col(flag), F.lit(1.0)).otherwise(F.lit(0.0)))


def top_by(value: Column | str, order: Column | str, *ties: Column | str) -> Column:
    """The value at the highest order; null values are left out, ties go to the
    larger tie-breaker."""
    v = col(value)
    return F.max_by(v, F.when(v.isNotNull() & col(order).isNotNull(), F.struct(col(order), *map(col, ties), v)))


def most_frequent(c: Column | str) -> Column:
    """The most frequent value, the lowest of equally frequent ones; nulls don't count."""
    return F.mode(col(c), True)


def joined_distinct(c: Column | str, separator: str = ", ") -> Column:
    """Distinct values in order, as one text; null for none."""
    values = F.array_sort(F.collect_set(col(c)))
    return F.when(F.size(values) > 0, F.array_join(values, separator))


def first_known(c: Column | str) -> Column:
    return F.any_value(col(c), F.lit(True))


def display_name(title: Column | str, label: Column | str) -> Column:
    """The title, with the label behind it unless that is null or empty."""
    t, s = col(title), col(label)
    return F.when(s.isNull() | (s == ""), t).otherwise(F.concat(t, F.lit(" - "), s))


def word_norm(c: Column | str) -> Column:
    return F.lower(F.regexp_replace(col(c), r"[^\w']", ""))


def squeezed(c: Column | str) -> Column:
    """White space runs to one blank, trimmed, lower-cased."""
    return F.lower(F.trim(F.regexp_replace(col(c), r"[\t\n\f\r ]+", " ")))


#: Letters whose compatibility form is one plain letter and marks, and that letter.
_PLAIN = {x: p for x in map(chr, (*range(0xC0, 0x250), *range(0x1E00, 0x1F00))) if len(p := unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode()) == 1}


def slug(c: Column | str) -> Column:
    """Lower-case letters, digits and hyphens of a title; letters lose their marks."""
    folded = F.translate(col(c), "".join(_PLAIN), "".join(_PLAIN.values()))
    plain = F.regexp_replace(F.lower(F.trim(folded)), r"[^a-z0-9\s_-]", "")
    return F.regexp_replace(F.regexp_replace(plain, r"[\s_-]+", "-"), r"^-+|-+$", "")


def title_and_label(c: Column | str) -> tuple[Column, Column]:
    """Splits at the last ' - '; a text without one is all title."""
    text = col(c)
    has = text.rlike(r" - ")
    label = F.trim(F.regexp_extract(text, r"(?s)^.* - (.*)$", 1))
    return F.trim(F.when(has, F.regexp_extract(text, r"(?s)^(.*) - .*$", 1)).otherwise(text)), F.when(has & (label != ""), label)


def rational(c: Column | str) -> Column:
    """num/den as a double; null for a denominator of 0 or a text of another form."""
    parts = F.split(col(c), "/")
    return F.when(F.size(parts) == 1, parts[0].try_cast("double")).otherwise(ratio(F.get(parts, F.lit(0)).try_cast("double"), F.get(parts, F.lit(1)).try_cast("double")))


def orientation(aspect: Column | str) -> Column:
    a = col(aspect)
    return F.when(a < 0.95, "portrait").when(a > 1.05, "landscape").when(a.isNotNull(), "square")


def sampled(index: Column | str, step: Column | str) -> Column:
    """Whether the 1-based frame is on the grid of every ``step`` frames."""
    return (col(index) - 1) % col(step) == 0


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def logit(p: Column | str, eps: float = 1e-6) -> Column:
    q = F.least(F.greatest(col(p), F.lit(eps)), F.lit(1.0 - eps))
    return F.ln(q / (F.lit(1.0) - q))


def band(value: Column | str, edges: list[tuple[float, str]], low: float) -> Column:
    """The name of the first (low, edge] band that holds the value, else null."""
    v, out = col(value), None
    for edge, name in edges:
        test = (v > low) & (v <= edge)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out
