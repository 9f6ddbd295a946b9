"""Choosing snapshots of the holdings and comparing them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundledger.functions.numbers import bucket, clip
from fundledger.operators.joining import semi_join
from fundledger.operators.quantiles import quantiles, with_quantiles
from fundledger.operators.ranking import top_per_group
from fundledger.session import cut_lineage

POSITION = ["as_of_date", "composite_ticker", "constituent_ticker"]


def best_snapshot(holdings: DataFrame) -> DataFrame:
    """The date with the most rows (the later one on ties), as a one-cell table."""
    return (
        holdings.groupBy("as_of_date")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), F.desc("as_of_date"))
        .limit(1)
        .select("as_of_date")
    )


def latest_snapshot(table: DataFrame) -> DataFrame:
    """The latest date, as a one-cell table."""
    return table.agg(F.max("as_of_date").alias("as_of_date"))


def latest_per_fund(table: DataFrame) -> DataFrame:
    """The latest date of each fund."""
    return table.groupBy("composite_ticker").agg(F.max("as_of_date").alias("as_of_date"))


def at_snapshot(table: DataFrame, date: DataFrame) -> DataFrame:
    """Rows of one snapshot. The date stays in the plan as a scalar subquery; a table that is partitioned
    by it reads that partition alone, one that derives it filters after the scan."""
    return table.where(F.col("as_of_date") == date.scalar())


def at_best(holdings: DataFrame) -> DataFrame:
    return at_snapshot(holdings, best_snapshot(holdings))


def at_latest(table: DataFrame) -> DataFrame:
    return at_snapshot(table, latest_snapshot(table))


def snapshot_overview(holdings: DataFrame) -> DataFrame:
    """Funds, securities, rows, mean and median weight of every snapshot."""
    holdings = cut_lineage(holdings.select(*POSITION, "weight"))
    per_date = holdings.groupBy("as_of_date").agg(
        F.count_distinct("composite_ticker").alias("fund_count"),
        F.count_distinct("constituent_ticker").alias("security_count"),
        F.count("*").alias("total_holdings"),
        F.avg("weight").alias("avg_weight"),
    )
    return with_quantiles(per_date, holdings, ["as_of_date"], {"median_weight": ("weight", 0.5)})


def universe_totals(holdings: DataFrame, funds: DataFrame) -> DataFrame:
    """Funds, securities and rows of the best snapshot and the size of the fund table, in one row."""
    counts = at_best(holdings).agg(
        F.count_distinct("composite_ticker").alias("fund_count"),
        F.count_distinct("constituent_ticker").alias("security_count"),
        F.count("*").alias("holding_rows"),
        F.max("as_of_date").alias("as_of_date"),
    )
    totals = funds.agg(F.count("*").alias("n"), F.sum(F.col("aum") / 1e9).alias("aum_bn"))
    return counts.select(
        "*",
        totals.select("n").scalar().alias("fund_rows"),
        totals.select("aum_bn").scalar().alias("total_aum_bn"),
    )


def fund_rollup(holdings: DataFrame) -> DataFrame:
    """Rows, total and largest weight and total value per snapshot and fund."""
    return holdings.groupBy("as_of_date", "composite_ticker").agg(
        F.count("*").alias("num_holdings"),
        F.sum("weight").alias("total_weight"),
        F.max("weight").alias("max_weight"),
        F.sum("market_value").alias("total_market_value"),
    )


def stable_funds(rollup: DataFrame) -> DataFrame:
    """Funds present in every snapshot, from a per-snapshot rollup."""
    all_dates = rollup.agg(F.count_distinct("as_of_date")).scalar()
    return (
        rollup.groupBy("composite_ticker")
        .agg(F.count_distinct("as_of_date").alias("_dates"))
        .where(F.col("_dates") == all_dates)
        .select("composite_ticker")
    )


def snapshot_trend(holdings: DataFrame, row_weighted: bool = False) -> DataFrame:
    """Median holdings and median total weight of the stable funds per snapshot.

    Each fund counts once, or once per holding row with ``row_weighted``. The weighted form gives
    each fund's figures once per row they describe, made from the rollup instead of a join to the
    detail rows.
    """
    rollup = cut_lineage(fund_rollup(holdings))
    steady = semi_join(rollup, stable_funds(rollup), "composite_ticker")
    if row_weighted:
        steady = semi_join(holdings.select("as_of_date", "composite_ticker"), stable_funds(rollup), "composite_ticker")
        steady = steady.join(
            rollup.select("as_of_date", "composite_ticker", "num_holdings", "total_weight"),
            ["as_of_date", "composite_ticker"],
        )
    wanted = {"median_holdings": ("num_holdings", 0.5), "median_total_weight": ("total_weight", 0.5)}
    return quantiles(steady, ["as_of_date"], wanted)


def first_last_delta(holdings: DataFrame) -> DataFrame:
    """Holdings of each stable fund on the first and the best snapshot, and the difference."""
    rollup = cut_lineage(fund_rollup(holdings))
    steady = semi_join(rollup, stable_funds(rollup), "composite_ticker")
    first = rollup.agg(F.min("as_of_date")).scalar()
    last = (
        rollup.groupBy("as_of_date")
        .agg(F.sum("num_holdings").alias("n"))
        .orderBy(F.desc("n"), F.desc("as_of_date"))
        .limit(1)
        .select("as_of_date")
        .scalar()
    )
    return (
        steady.groupBy("composite_ticker")
        .agg(
            F.max(F.when(F.col("as_of_date") == first, F.col("num_holdings"))).alias("first_n"),
            F.max(F.when(F.col("as_of_date") == last, F.col("num_holdings"))).alias("last_n"),
        )
        .where(F.col("first_n").isNotNull() & F.col("last_n").isNotNull())
        .withColumn("delta", F.col("last_n") - F.col("first_n"))
    )


def delta_histogram(deltas: DataFrame, bound: int = 50, n: int = 50) -> DataFrame:
    """Funds per bucket of the change in holdings, clipped to +-``bound``."""
    return (
        deltas.groupBy(bucket(clip("delta", -bound, bound), -bound, bound, n).alias("bucket"))
        .agg(F.min("delta").alias("delta_min"), F.count("*").alias("fund_count"))
    )


def holdings_history(holdings: DataFrame, funds: DataFrame, n: int = 10) -> DataFrame:
    """Holding count, top-``n`` weight and fund assets for every fund and snapshot."""
    key = ["as_of_date", "composite_ticker"]
    top = (
        top_per_group(holdings.select(*POSITION, "weight"), key, [F.desc_nulls_last("weight"), F.asc("constituent_ticker")], n)
        .groupBy(*key)
        .agg(F.sum("weight").alias("top_weight"))
    )
    counts = holdings.groupBy(*key).agg(F.count("*").alias("holding_count"))
    return counts.join(top, key, "left").join(funds.select(*key, "aum"), key, "left")


def snapshot_calendar(holdings: DataFrame) -> DataFrame:
    """Every snapshot date with the one before it: one row per date, whatever the table's size."""
    dates = holdings.select("as_of_date").distinct()
    return dates.withColumn("previous_date", F.lag("as_of_date").over(Window.orderBy("as_of_date")))


def holding_changes(holdings: DataFrame) -> DataFrame:
    """Positions a fund took up or gave up between one snapshot and the next.

    Every position is marked as present at its own date and at the following one; what bears only one
    of the marks is a change, whatever its weight, null included. This is one aggregation on the position's key instead of a full join of two dates, and a
    fund missing from one of the two dates is not compared. The broadcast calendar has one row per
    date, so no more rows than the years covered have days.
    """
    calendar = snapshot_calendar(holdings)
    follow = calendar.where(F.col("previous_date").isNotNull()).select(
        F.col("previous_date").alias("as_of_date"), F.col("as_of_date").alias("_next")
    )
    none, no = F.lit(None).cast("double"), F.lit(0)
    rows = holdings.select(*POSITION, "weight")
    now = rows.select(*POSITION, F.col("weight").alias("_is"), none.alias("_was"), F.lit(1).alias("_now"), no.alias("_before"))
    before = rows.join(F.broadcast(follow), "as_of_date").select(
        F.col("_next").alias("as_of_date"), *POSITION[1:], none.alias("_is"), F.col("weight").alias("_was"), no.alias("_now"), F.lit(1).alias("_before")
    )
    both = now.unionByName(before)
    seen = holdings.select("as_of_date", "composite_ticker").distinct()
    compared = (
        seen.join(F.broadcast(follow), "as_of_date")
        .select(F.col("_next").alias("as_of_date"), "composite_ticker")
        .join(seen, ["as_of_date", "composite_ticker"], "left_semi")
    )
    changed = (
        both.groupBy(*POSITION)
        .agg(
            F.max("_is").alias("weight_now"),
            F.max("_was").alias("weight_before"),
            F.max("_now").alias("_now"),
            F.max("_before").alias("_before"),
        )
        .where(F.col("_now") != F.col("_before"))
        .withColumn("change", F.when(F.col("_now") == 1, "new_holding").otherwise("dropped_holding"))
        .drop("_now", "_before")
    )
    return semi_join(changed, compared, ["as_of_date", "composite_ticker"])
