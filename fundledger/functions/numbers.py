"""Ratios, clipping, buckets and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundledger.functions.text import as_column


def safe_ratio(num: Column | str, den: Column | str, zero: str = "null") -> Column:
    """``num / den``; a zero denominator gives null, or 0 with ``zero='zero'``."""
    n, d = as_column(num), as_column(den)
    ratio = F.try_divide(n.cast("double"), d.cast("double"))
    if zero == "zero":
        return F.when(d == 0, F.lit(0.0)).otherwise(ratio)
    return ratio


def clip(c: Column | str, lo: float | None = None, hi: float | None = None) -> Column:
    """Bound a value; null stays null."""
    x = as_column(c)
    bounded = x
    if lo is not None:
        bounded = F.greatest(bounded, F.lit(lo))
    if hi is not None:
        bounded = F.least(bounded, F.lit(hi))
    return F.when(x.isNotNull(), bounded)


def log10_clip(c: Column | str, floor: float = 1e-6) -> Column:
    return F.log10(clip(as_column(c).cast("double"), lo=floor))


def bucket(c: Column | str, lo: float, hi: float, n: int) -> Column:
    """Equal-width bucket number 1..n; 0 below ``lo`` and n+1 from ``hi`` on."""
    return F.width_bucket(as_column(c).cast("double"), F.lit(float(lo)), F.lit(float(hi)), F.lit(n))


def range_label(c: Column | str, edges: list[float], labels: list[str]) -> Column:
    """Label of the range a value falls in; ``edges`` are inclusive upper bounds, the last label is open."""
    x = as_column(c)
    out = F.when(x <= F.lit(edges[0]), F.lit(labels[0]))
    for edge, label in zip(edges[1:], labels[1:]):
        out = out.when(x <= F.lit(edge), F.lit(label))
    return out.when(x.isNotNull(), F.lit(labels[-1]))


def half_up(c: Column | str, precision: int = 38, scale: int = 4) -> Column:
    """Decimal with ``scale`` places, rounded half up; unreadable input is null."""
    return as_column(c).try_cast(f"decimal({precision},{scale})")


def in_billions(c: Column | str) -> Column:
    return as_column(c).cast("double") / F.lit(1e9)


def in_millions(c: Column | str) -> Column:
    return as_column(c).cast("double") / F.lit(1e6)


def in_basis_points(c: Column | str) -> Column:
    return as_column(c).cast("double") * F.lit(100.0)
