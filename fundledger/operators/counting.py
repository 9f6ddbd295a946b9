"""Counts, coverage, histograms and other column profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundledger.functions.numbers import bucket, clip, range_label
from fundledger.functions.text import as_column, blank_to_null, fill_unknown
from fundledger.operators.joining import semi_join


def value_counts(
    df: DataFrame, column: str, n: int | None = None, null_label: str | None = None
) -> DataFrame:
    """Rows per value, most first, ties by value. Nulls are left out, or counted under ``null_label``."""
    if null_label is None:
        values = df.where(F.col(column).isNotNull()).select(column)
    else:
        values = df.select(fill_unknown(column, null_label).alias(column))
    out = values.groupBy(column).agg(F.count("*").alias("n"))
    return out if n is None else out.orderBy(F.desc("n"), column).limit(n)


def mode_of(df: DataFrame, column: str) -> DataFrame:
    """Most common value; the first in order on ties."""
    return value_counts(df, column, n=1)


def cross_counts(df: DataFrame, a: str, b: str, top_a: int | None = None) -> DataFrame:
    """Rows per pair of values, for the ``top_a`` most common values of ``a``."""
    pairs = (
        df.where(F.col(a).isNotNull())
        .groupBy(a, fill_unknown(b).alias(b))
        .agg(F.count("*").alias("n"))
    )
    if top_a is None:
        return pairs
    leading = pairs.groupBy(a).agg(F.sum("n").alias("_all")).orderBy(F.desc("_all"), a).limit(top_a)
    return semi_join(pairs, leading.select(a), a)


def _per_column(df: DataFrame, columns: list[str], measures: dict[str, callable]) -> DataFrame:
    """One row per column with the given measures, all from one pass over ``df``."""
    wide = df.agg(
        *[make(c).alias(f"{c}__{name}") for c in columns for name, make in measures.items()]
    )
    rows = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{name}").alias(name) for name in measures])
        for c in columns
    ]
    return wide.select(F.inline(F.array(*rows)))


def missing_pct(df: DataFrame, columns: list[str]) -> DataFrame:
    """Percentage of nulls per column."""
    return _per_column(
        df,
        columns,
        {"missing_pct": lambda c: F.try_divide(F.count_if(F.col(c).isNull()) * 100.0, F.count("*"))},
    )


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """How many rows have a value in each column, how many have not, and the filled percentage."""
    return _per_column(
        df,
        columns,
        {
            "have": lambda c: F.count(c),
            "missing": lambda c: F.count_if(F.col(c).isNull()),
            "filled_pct": lambda c: F.try_divide(F.count(c) * 100.0, F.count("*")),
        },
    )


def null_profile(df: DataFrame, columns: list[str], blank: str | None = None) -> DataFrame:
    """Row count, nulls per column and blanks of one column, in one row."""
    parts = [F.count("*").alias("total_rows")]
    parts += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns]
    if blank:
        parts.append(F.count_if(F.trim(F.col(blank)) == "").alias(f"blank_{blank}"))
    return df.agg(*parts)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count; empty when the keys are unique."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def assert_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Return ``df`` unchanged, or raise when a key occurs twice."""
    repeated = duplicate_keys(df, keys)
    if not repeated.isEmpty():
        raise ValueError(f"duplicate keys {keys}, for example {repeated.first().asDict()}")
    return df


def uniqueness(df: DataFrame, key: str, present: list[str]) -> DataFrame:
    """Rows, distinct keys and filled columns of a loaded table, in one row."""
    return df.agg(
        F.count("*").alias("total_rows"),
        F.count_distinct(key).alias("unique_keys"),
        *[F.count(c).alias(f"with_{c}") for c in present],
    )


def distinct_counts(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column, in one row; ``approximate`` trades exactness for one pass."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(F.col(c)).alias(c) for c in columns])


def list_value_counts(df: DataFrame, column: str, sep: str = "|", n: int | None = None) -> DataFrame:
    """Rows per entry of a separated list column; entries are trimmed and upper-cased."""
    entries = df.select(F.explode(F.split(F.col(column), "[" + sep + "]")).alias("_e")).select(
        F.upper(F.trim("_e")).alias(column)
    )
    return value_counts(entries, column, n)


def filter_options(df: DataFrame, columns: list[str], min_count: int = 3) -> DataFrame:
    """Values worth offering as a filter: non-null, at least ``min_count`` rows."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return (
        df.select(F.inline(pairs))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_count)
    )


def histogram(
    df: DataFrame, value: Column | str, lo: float, hi: float, n: int, clip_to: tuple | None = None
) -> DataFrame:
    """Equal-width buckets: number, smallest and largest raw value, rows. ``clip_to`` bounds values first."""
    x = as_column(value).cast("double")
    placed = clip(x, *clip_to) if clip_to else x
    return (
        df.select(x.alias("_x"), bucket(placed, lo, hi, n).alias("bucket"))
        .where(F.col("_x").isNotNull())
        .groupBy("bucket")
        .agg(F.min("_x").alias("bucket_min"), F.max("_x").alias("bucket_max"), F.count("*").alias("n"))
    )


def data_histogram(df: DataFrame, value: Column | str, n: int) -> DataFrame:
    """``n`` equal-width buckets over the range the data covers; the largest value is in bucket n."""
    values = df.select(as_column(value).cast("double").alias("_x")).where(F.col("_x").isNotNull())
    lo = values.agg(F.min("_x")).scalar()
    hi = values.agg(F.max("_x")).scalar()
    place = F.floor((F.col("_x") - lo) * n / F.nullif(hi - lo, F.lit(0.0))) + 1
    return (
        values.withColumn("bucket", F.least(F.coalesce(place, F.lit(1)), F.lit(n)).cast("long"))
        .groupBy("bucket")
        .agg(F.min("_x").alias("bucket_min"), F.max("_x").alias("bucket_max"), F.count("*").alias("n"))
    )


def bin_counts(df: DataFrame, value: str, edges: list[float], labels: list[str]) -> DataFrame:
    """Rows per labelled range; each raw value is placed on its own."""
    return (
        df.select(range_label(value, edges, labels).alias("range"))
        .where(F.col("range").isNotNull())
        .groupBy("range")
        .agg(F.count("*").alias("n"))
    )


def threshold_counts(df: DataFrame, value: str, cuts: list[float]) -> DataFrame:
    """How many rows lie above each cut, in one row."""
    return df.agg(
        F.count(value).alias("n"),
        *[F.count_if(F.col(value) > cut).alias(f"above_{cut:g}".replace(".", "_")) for cut in cuts],
    )


def flag_counts(df: DataFrame, flag: str, when_true: str, when_false: str) -> DataFrame:
    """Rows per state of a flag, under display names; unknown state is left out."""
    label = F.when(F.col(flag), when_true).when(~F.col(flag), when_false)
    return value_counts(df.select(label.alias("label")), "label")


def delta_signs(df: DataFrame, delta: str) -> DataFrame:
    """How many rows went up, stayed or went down."""
    return df.agg(
        F.count_if(F.col(delta) > 0).alias("up"),
        F.count_if(F.col(delta) == 0).alias("same"),
        F.count_if(F.col(delta) < 0).alias("down"),
    )


def recency(df: DataFrame, date: str, n: int = 24) -> DataFrame:
    """Rows per month, for the last ``n`` months that occur."""
    month = F.date_format(F.col(date), "yyyy-MM")
    monthly = df.where(F.col(date).isNotNull()).groupBy(month.alias("month")).agg(F.count("*").alias("n"))
    return monthly.orderBy(F.desc("month")).limit(n)


def ratio_report(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """Rows for which each test holds, in one row."""
    return df.agg(F.count("*").alias("rows"), *[F.count_if(t).alias(k) for k, t in tests.items()])


def quality_report(
    df: DataFrame, name: str, required: list[str], keys: list[str]
) -> DataFrame:
    """One row per check of a table: its row count, nulls or blanks of required columns, repeated keys."""
    nulls = [
        F.count_if(blank_to_null(F.col(c).cast("string")).isNull()).alias(c) for c in required
    ]
    wide = df.agg(F.count("*").alias("_rows"), *nulls)
    checks = [F.struct(F.lit("rows").alias("check"), F.col("_rows").alias("n"))]
    checks += [F.struct(F.lit(f"null {c}").alias("check"), F.col(c).alias("n")) for c in required]
    repeated = duplicate_keys(df, keys).agg(F.count("*").alias("n"))
    return (
        wide.select(F.inline(F.array(*checks)))
        .unionByName(repeated.select(F.lit("repeated key").alias("check"), "n"))
        .select(F.lit(name).alias("table"), "check", "n")
    )
