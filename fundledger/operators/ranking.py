"""Latest rows, top rows, pages and running shares.

Filters of the form ``row_number() <= k`` are planned with a group limit on both sides of the
shuffle, so at most ``k`` rows of a group leave each task: a hot group stays small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundledger.session import cut_lineage


def top_per_group(df: DataFrame, by: list[str], order: list[Column], n: int, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of each group; ``order`` must end in a unique key."""
    name = rank or "_rank"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(
        F.col(name) <= n
    )
    return out if rank else out.drop(name)


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first in ``order``."""
    return top_per_group(df, keys, order, 1)


def page(df: DataFrame, sort_by: str, key: str, ascending: bool = False, number: int = 1, size: int = 50) -> DataFrame:
    """One page of a sorted table, nulls last, ties by key; at most 200 rows a page."""
    if not 0 < size <= 200 or number < 1:
        raise ValueError("a page has 1 to 200 rows, and pages count from 1")
    first = F.asc_nulls_last(sort_by) if ascending else F.desc_nulls_last(sort_by)
    return df.orderBy(first, F.asc(key)).offset((number - 1) * size).limit(size)


def page_after(df: DataFrame, sort_by: str, key: str, last: tuple, ascending: bool = False, size: int = 50) -> DataFrame:
    """The page behind the row ``last`` (its value and key), in the order of :func:`page`.

    What comes before is filtered out in the scan, so page ten thousand costs what page one does. The parts
    of ``last`` are plain values or scalar columns.
    """
    if not 0 < size <= 200:
        raise ValueError("a page has 1 to 200 rows")
    x, value, at = F.col(sort_by), F.lit(last[0]), F.lit(last[1])
    beyond = (x > value) if ascending else (x < value)
    rest = beyond | (x.eqNullSafe(value) & (F.col(key) > at)) | (x.isNull() & value.isNotNull())
    first = F.asc_nulls_last(sort_by) if ascending else F.desc_nulls_last(sort_by)
    return df.where(rest).orderBy(first, F.asc(key)).limit(size)


def ranked(df: DataFrame, order: list[Column], rank: str = "rank") -> DataFrame:
    """Rows numbered from one in a total order, without gathering them in one task.

    The sorted layout is written once; the offsets are one row per partition of it.
    """
    placed = cut_lineage(df.orderBy(*order).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("_part").orderBy(*order)
    numbered = placed.join(F.broadcast(offsets), "_part")
    return numbered.withColumn(rank, F.col("_before") + F.row_number().over(inside)).drop("_part", "_before")


def pages(df: DataFrame, sort_by: str, key: str, ascending: bool = False, size: int = 50) -> DataFrame:
    """Every row with the number of its page and its place there. Written by page, any page is one read."""
    first = F.asc_nulls_last(sort_by) if ascending else F.desc_nulls_last(sort_by)
    at = F.col("rank") - 1
    return ranked(df, [first, F.asc(key)]).withColumns(
        {"page": F.floor(at / size) + 1, "place": at % size + 1}
    ).drop("rank")


def top_n(df: DataFrame, value: str, key: str, n: int, largest: bool = True) -> DataFrame:
    """The ``n`` rows with the largest (or smallest) value, ties by key."""
    first = F.desc_nulls_last(value) if largest else F.asc_nulls_last(value)
    return df.orderBy(first, F.asc(key)).limit(n)


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """A repeatable random sample of ``n`` rows, chosen by a hash of the key."""
    return df.orderBy(F.md5(F.concat_ws("|", F.col(key), F.lit(seed))), key).limit(n)


def running_share(df: DataFrame, value: str, key: str) -> DataFrame:
    """Rank, running total and running percentage of a value, largest first, over the whole table.

    The rows are range-partitioned on (value, key), so equal values are spread too. The layout is
    written once; partition totals then give each partition its offset. No task sees more than its
    own partition, and the offsets are one row per partition.
    """
    placed = cut_lineage(
        df.where(F.col(value).isNotNull())
        .select(key, value)
        .orderBy(F.desc(value), F.asc(key))
        .withColumn("_part", F.spark_partition_id())
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_n"), F.sum(value).alias("_sum"))
        .select(
            "_part",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n_before"),
            F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_sum_before"),
        )
    )
    inside = Window.partitionBy("_part").orderBy(F.desc(value), F.asc(key))
    total = placed.agg(F.sum(value)).scalar()
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn("rank", F.col("_n_before") + F.row_number().over(inside))
        .withColumn(
            "running_total",
            F.col("_sum_before") + F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, 0)),
        )
        .select(
            key,
            value,
            "rank",
            "running_total",
            F.try_divide(F.col("running_total") * 100.0, total).alias("running_pct"),
        )
    )


def share_at(df: DataFrame, value: str, key: str, counts: list[int]) -> DataFrame:
    """Percentage of the total held by the ``n`` largest rows, for each ``n`` the table reaches.

    Only the largest ``max(counts)`` rows are ordered; the total is a plain sum.
    """
    some = df.where(F.col(value).isNotNull())
    total = some.agg(F.sum(value)).scalar()
    head = some.select(key, value).orderBy(F.desc(value), F.asc(key)).limit(max(counts))
    ranked = head.withColumn("_rank", F.row_number().over(Window.orderBy(F.desc(value), F.asc(key))))
    steps = F.explode(F.array(*[F.lit(n) for n in counts])).alias("top")
    return (
        ranked.select("_rank", value, steps)
        .where(F.col("_rank") <= F.col("top"))
        .groupBy("top")
        .agg(F.count("*").alias("_n"), F.sum(value).alias("_sum"))
        .where(F.col("_n") == F.col("top"))
        .select("top", F.try_divide(F.col("_sum") * 100.0, total).alias("share_pct"))
    )
