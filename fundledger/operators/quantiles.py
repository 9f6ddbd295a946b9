"""Exact quantiles that never gather one group's values into one task.

Spark's ``median``/``percentile`` keep every distinct value of a group in one aggregation
buffer. Here the values are first counted in fine, value-ordered bins (a small result whatever
the input), the bins that hold the wanted ranks are picked, and only the rows of those bins are
ranked. Bins and ranks read the values one after the other, so a costly input is written out
once first, by the caller. A group that holds a third of all rows costs no more per task than any other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundledger.operators.joining import join_keys

BINS_PER_OCTAVE = 1024
_LOWEST_OCTAVE = 1100


def _value_bin(v: Column) -> Column:
    """A bin number that never decreases as ``v`` grows."""
    size = (F.floor(F.log2(F.abs(v)) * BINS_PER_OCTAVE) + _LOWEST_OCTAVE * BINS_PER_OCTAVE).cast("long")
    return F.when(v > 0, size).when(v < 0, -size).otherwise(F.lit(0).cast("long"))


def quantiles(df: DataFrame, by: list[str], wanted: dict[str, tuple[Column | str, float]]) -> DataFrame:
    """One row per group with an interpolated quantile per entry of ``wanted`` (name -> value, p).

    Nulls are skipped. A group without any value in any measure has no row.
    """
    values = list(dict.fromkeys(str(v) for v, _ in wanted.values()))
    columns = {str(v): (F.col(v) if isinstance(v, str) else v) for v, _ in wanted.values()}
    if len(values) == 1:
        long = df.select(*by, F.lit(0).alias("_m"), columns[values[0]].cast("double").alias("_v"))
    else:
        cells = [
            F.struct(F.lit(i).alias("_m"), columns[name].cast("double").alias("_v"))
            for i, name in enumerate(values)
        ]
        long = df.select(*by, F.inline(F.array(*cells)))
    long = long.where(F.col("_v").isNotNull()).withColumn("_bin", _value_bin(F.col("_v")))
    group = [*by, "_m"]
    ordered = Window.partitionBy(*group).orderBy("_bin")
    counts = (
        long.groupBy(*group, "_bin")
        .agg(F.count("*").alias("_n"))
        .withColumn("_upto", F.sum("_n").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_total", F.sum("_n").over(Window.partitionBy(*group)))
    )

    def spans(first: Column, last: Column) -> Column:
        """True where a run of ranks touches a rank that some wanted quantile needs."""
        tests = []
        for i, name in enumerate(values):
            for v, p in wanted.values():
                if str(v) == name:
                    at = F.lit(p) * (F.col("_total") - 1)
                    tests.append((F.col("_m") == i) & (first <= F.ceil(at)) & (last >= F.floor(at)))
        return reduce(lambda a, b: a | b, tests)

    bins = counts.where(spans(F.col("_upto") - F.col("_n"), F.col("_upto") - 1)).select(
        *group, "_bin", (F.col("_upto") - F.col("_n")).alias("_before"), "_total"
    )
    runs = (
        join_keys(long, bins, [*group, "_bin"])
        .groupBy(*group, "_bin", "_before", "_total", "_v")
        .agg(F.count("*").alias("_n"))
    )
    inside = Window.partitionBy(*group, "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = runs.withColumn("_last", F.col("_before") + F.sum("_n").over(inside) - 1).withColumn(
        "_first", F.col("_last") - F.col("_n") + 1
    )
    out = []
    for name, (v, p) in wanted.items():
        mine = F.col("_m") == values.index(str(v))
        at = F.lit(p) * (F.col("_total") - 1)

        def value_at(rank: Column) -> Column:
            return F.max(F.when(mine & rank.between(F.col("_first"), F.col("_last")), F.col("_v")))

        low, high = value_at(F.floor(at)), value_at(F.ceil(at))
        part = F.max(F.when(mine, at - F.floor(at)))
        out.append((low + (high - low) * part).alias(name))
    return ranked.groupBy(*by).agg(*out)


def with_quantiles(
    summary: DataFrame,
    df: DataFrame,
    by: list[str],
    wanted: dict[str, tuple[Column | str, float]],
) -> DataFrame:
    """Add quantiles of ``df`` to a summary of the same groups; groups without values get nulls."""
    found = quantiles(df, by, wanted)
    if by:
        return join_keys(summary, found, by, "left")
    row = found.select(F.struct(*wanted)).scalar()
    return summary.select("*", row.alias("_q")).select(*summary.columns, *[F.col(f"_q.{n}") for n in wanted])


def median_by(df: DataFrame, by: str, value: str, min_count: int = 1, n: int | None = None) -> DataFrame:
    """Count and median of a value per group, for groups of at least ``min_count``, highest first."""
    some = df.where(F.col(value).isNotNull())
    counted = some.groupBy(by).agg(F.count("*").alias("n")).where(F.col("n") >= min_count)
    out = with_quantiles(counted, some, [by], {"median": (value, 0.5)})
    if n is not None:
        out = out.orderBy(F.desc("median"), by).limit(n)
    return out


def quartiles_by(df: DataFrame, by: str, value: str) -> DataFrame:
    """Five-number summary per group over positive values."""
    some = df.where((F.col(value) > 0) & F.col(by).isNotNull())
    wanted = {"low": 0.0, "q1": 0.25, "median": 0.5, "q3": 0.75, "high": 1.0}
    return quantiles(some, [by], {name: (value, p) for name, p in wanted.items()})


def describe(df: DataFrame, value: str) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of a column, in one row."""
    x = F.col(value).cast("double")
    plain = df.agg(
        F.count(x).alias("count"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
    )
    return with_quantiles(
        plain, df, [], {"q25": (value, 0.25), "q50": (value, 0.5), "q75": (value, 0.75)}
    )


def metric_card(df: DataFrame, value: str, key: str) -> DataFrame:
    """Total, count, min, median, mean, max and the key of the largest value (first key on ties).

    Total and mean are decimals, of twelve and seven places, so they do not depend on the order of addition.
    """
    some = df.where(F.col(value).isNotNull())
    first_top = some.orderBy(F.desc(value), F.asc(key)).limit(1).select(key)
    total = F.sum(F.col(value).cast("decimal(28,12)"))
    card = some.agg(
        F.count("*").alias("n"),
        total.alias("total"),
        F.min(value).alias("min"),
        F.round(total / F.count("*"), 7).alias("mean"),
        F.max(value).alias("max"),
    )
    return with_quantiles(
        card.select("*", first_top.scalar().alias("top_key")), some, [], {"median": (value, 0.5)}
    )
