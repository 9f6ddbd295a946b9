"""Alerts raised by comparing snapshots and by inactive securities."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundledger.operators.securities import fund_inactive, inactive_with_funds
from fundledger.operators.snapshots import at_latest, holding_changes

# Thresholds of our own: change of assets in percent, weight of a position in percent.
WARN_AUM_PCT, CRITICAL_AUM_PCT = 25.0, 75.0
WARN_WEIGHT, CRITICAL_WEIGHT = 1.0, 5.0


def aum_changes(funds: DataFrame, min_pct: float = WARN_AUM_PCT) -> DataFrame:
    """Funds whose assets moved by at least ``min_pct`` percent from one snapshot to the next.

    The window holds one fund's snapshots, at most one per day.
    """
    before = F.lag("aum").over(Window.partitionBy("composite_ticker").orderBy("as_of_date"))
    moved = funds.select("as_of_date", "composite_ticker", "aum", before.alias("previous_aum")).withColumn(
        "change_pct",
        F.try_divide((F.col("aum") - F.col("previous_aum")) * 100.0, F.abs("previous_aum")),
    )
    return moved.where(F.abs("change_pct") >= min_pct)


def _severity(value, warn: float, critical: float):
    return F.when(value >= critical, "critical").when(value >= warn, "warning").otherwise("info")


def alerts(holdings: DataFrame, funds: DataFrame, securities: DataFrame) -> DataFrame:
    """All alerts of all funds: type, severity, fund, security where there is one, date and size.

    An inactive security is one alert for each fund that holds it, beside each fund's total.
    """
    changed = holding_changes(holdings).select(
        F.col("change").alias("type"),
        _severity(F.coalesce("weight_now", "weight_before"), WARN_WEIGHT, CRITICAL_WEIGHT).alias("severity"),
        F.col("composite_ticker").alias("fund"),
        F.col("constituent_ticker").alias("security"),
        F.col("as_of_date").alias("detected_on"),
        F.coalesce("weight_now", "weight_before").alias("size"),
    )
    moved = aum_changes(funds).select(
        F.lit("aum_change").alias("type"),
        _severity(F.abs("change_pct"), WARN_AUM_PCT, CRITICAL_AUM_PCT).alias("severity"),
        F.col("composite_ticker").alias("fund"),
        F.lit(None).cast("string").alias("security"),
        F.col("as_of_date").alias("detected_on"),
        F.col("change_pct").alias("size"),
    )
    current = at_latest(holdings)
    held = inactive_with_funds(securities, holdings).where(F.col("composite_ticker").isNotNull())
    each = held.select(
        F.lit("inactive_security").alias("type"),
        _severity(F.col("weight"), WARN_WEIGHT, CRITICAL_WEIGHT).alias("severity"),
        F.col("composite_ticker").alias("fund"),
        F.col("constituent_ticker").alias("security"),
        current.agg(F.max("as_of_date")).scalar().alias("detected_on"),
        F.col("weight").alias("size"),
    )
    gone = fund_inactive(current, securities).select(
        F.lit("inactive_total").alias("type"),
        _severity(F.col("inactive_weight"), WARN_WEIGHT, CRITICAL_WEIGHT).alias("severity"),
        F.col("composite_ticker").alias("fund"),
        F.lit(None).cast("string").alias("security"),
        current.agg(F.max("as_of_date")).scalar().alias("detected_on"),
        F.col("inactive_weight").alias("size"),
    )
    return changed.unionByName(moved).unionByName(each).unionByName(gone)


def alert_counts(found: DataFrame) -> DataFrame:
    """Alerts, funds touched and largest size per type and severity."""
    return found.groupBy("type", "severity").agg(
        F.count("*").alias("n"),
        F.count_distinct("fund").alias("funds"),
        F.max(F.abs("size")).alias("largest"),
    )
