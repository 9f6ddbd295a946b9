"""Joins on named keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be null (null meets null); the keys appear once, from the left side."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    match = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    )
    return left.join(renamed, match, how).drop(*[f"_r_{k}" for k in keys])


def semi_join(a: DataFrame, b: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``a`` whose key occurs in ``b``."""
    return a.join(b, on, "left_semi")


def anti_join(a: DataFrame, b: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``a`` whose key does not occur in ``b``."""
    return a.join(b, on, "left_anti")


def pending(targets: DataFrame, done: DataFrame, on: str | list[str]) -> DataFrame:
    """What a load that was interrupted still has to do: targets whose key is not done yet."""
    return anti_join(targets, done, on)


def changed_in_universe(changes: DataFrame, universe: DataFrame, on: str | list[str] = "cik") -> DataFrame:
    """Changed keys that belong to the universe."""
    return semi_join(changes, universe, on)


def load_keys(
    universe: DataFrame, changes: DataFrame, full: bool, on: str = "cik", limit: int | None = None
) -> DataFrame:
    """Keys one load has to process: all of the universe, or the changed ones, each once and in order."""
    keys = (universe if full else changes).select(on).distinct()
    return keys if limit is None else keys.orderBy(on).limit(limit)
