"""Checking rows while they are written: good and bad apart, counts and the gate, in one pass over the input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fundledger.sources.raw import broken_rules

ACCEPTED = "accepted"


def write_checked(df: DataFrame, rules: dict[str, Column], path: str, filled: tuple[str, ...] | list[str] = ()) -> dict[str, int]:
    """Write ``df`` below ``path``, rows that break a rule apart with the names of the rules, and return the figures.

    The figures are ``rows``, ``accepted``, ``rejected``, ``broken: <rule>`` for every rule and ``null: <column>``
    for every column of ``filled``. They are counted in the tasks that write, so the input is read once and by one
    job; only tasks that end well count, so a lost executor adds nothing. An existing table is an error.
    """
    checked = df.withColumn("broken", broken_rules(rules))
    good = F.size("broken") == 0
    counts = {
        "rows": F.count(F.lit(1)),
        "accepted": F.count_if(good),
        "rejected": F.count_if(~good),
        **{f"broken: {rule}": F.count_if(F.array_contains("broken", rule)) for rule in rules},
        **{f"null: {c}": F.count_if(F.col(c).isNull()) for c in filled},
    }
    seen = Observation()
    watched = checked.observe(seen, *[c.alias(name) for name, c in counts.items()])
    watched.withColumn(ACCEPTED, good).write.partitionBy(ACCEPTED).mode("errorifexists").parquet(path)
    return dict(seen.get)


def read_checked(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows of a checked table; only the files of the side that is used are read."""
    rows = spark.read.schema(f"{schema}, broken array<string>, {ACCEPTED} boolean").parquet(path)
    return rows.where(F.col(ACCEPTED)).drop(ACCEPTED, "broken"), rows.where(~F.col(ACCEPTED)).drop(ACCEPTED)


def gate_figures(figures: dict[str, dict[str, int]], rejected_share: float = 1.0) -> None:
    """Raise unless every dataset has accepted rows and no larger share of rejects than allowed.

    ``figures`` maps each dataset to what :func:`write_checked` returned; no data is read.
    """
    empty = sorted(name for name, f in figures.items() if not f["accepted"])
    if empty:
        raise RuntimeError(f"no accepted rows for {', '.join(empty)}")
    poor = sorted(name for name, f in figures.items() if f["rejected"] > rejected_share * f["rows"])
    if poor:
        raise RuntimeError(f"too many rejected rows for {', '.join(poor)}")
