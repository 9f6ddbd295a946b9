"""Analysis of fund holdings: concentration, exposure, breadth and membership."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundledger.functions.text import fill_unknown
from fundledger.operators.joining import join_keys
from fundledger.operators.quantiles import with_quantiles
from fundledger.operators.ranking import top_n, top_per_group
from fundledger.operators.snapshots import at_best, at_latest
from fundledger.session import cut_lineage



def _largest_first() -> list:
    return [F.desc_nulls_last("weight"), F.asc("constituent_ticker")]


def concentration(holdings: DataFrame, n: int = 10) -> DataFrame:
    """Weight of the ``n`` largest positions of each fund of one snapshot."""
    rows = holdings.select("composite_ticker", "constituent_ticker", "weight")
    return (
        top_per_group(rows, ["composite_ticker"], _largest_first(), n)
        .groupBy("composite_ticker")
        .agg(F.sum("weight").alias(f"top{n}_weight"))
    )


def concentration_multi(holdings: DataFrame, sizes: list[int]) -> DataFrame:
    """Top-10, top-25, ... weight of each fund from one ranking."""
    rows = holdings.select("composite_ticker", "constituent_ticker", "weight")
    ranked = top_per_group(rows, ["composite_ticker"], _largest_first(), max(sizes), rank="_rank")
    return ranked.groupBy("composite_ticker").agg(
        *[F.sum(F.when(F.col("_rank") <= n, F.col("weight"))).alias(f"top{n}_weight") for n in sizes]
    )


def actual_holdings(holdings: DataFrame) -> DataFrame:
    """Position count, total weight and total value per fund of one snapshot."""
    return holdings.groupBy("composite_ticker").agg(
        F.count("*").alias("actual_holdings"),
        F.sum("weight").alias("total_weight"),
        F.sum("market_value").alias("total_market_value"),
    )


def fund_summary(funds: DataFrame, holdings: DataFrame, n: int = 10) -> DataFrame:
    """Fund rows joined to their position count and top-``n`` weight; funds without positions drop out.

    Both aggregates have one row per fund before they meet the fund table.
    """
    return (
        funds.join(actual_holdings(holdings), "composite_ticker")
        .join(concentration(holdings, n), "composite_ticker")
        .withColumn("aum_bn", F.col("aum") / 1e9)
        .withColumn("net_expenses_bps", F.col("net_expenses") * 100.0)
    )


def asset_class_summary(funds: DataFrame, holdings: DataFrame) -> DataFrame:
    """Funds, assets and four medians per asset class, over funds with assets and positions.

    The joined table has one row per fund and is written once, so that the totals and the two
    passes of the medians do not go back to the holdings.
    """
    joined = cut_lineage(
        fund_summary(funds, at_best(holdings))
        .where(F.col("aum_bn") > 0)
        .select("asset_class", "aum_bn", "actual_holdings", "net_expenses_bps", "top10_weight")
    )
    totals = joined.groupBy("asset_class").agg(
        F.count("*").alias("fund_count"), F.sum("aum_bn").alias("total_aum_bn")
    )
    return with_quantiles(
        totals,
        joined,
        ["asset_class"],
        {
            "median_aum_bn": ("aum_bn", 0.5),
            "median_holdings": ("actual_holdings", 0.5),
            "median_expense_bps": ("net_expenses_bps", 0.5),
            "median_top10_weight": ("top10_weight", 0.5),
        },
    )


def most_held(holdings: DataFrame, n: int = 25, by: tuple[str, ...] = ("constituent_ticker", "constituent_name")) -> DataFrame:
    """Securities held by the most funds of one snapshot."""
    held = holdings.groupBy(*by).agg(
        F.count_distinct("composite_ticker").alias("fund_count"),
        F.avg("weight").alias("avg_weight"),
        F.sum("market_value").alias("total_market_value"),
    )
    return top_n(held, "fund_count", by[0], n)


def top_by_market_value(holdings: DataFrame, n: int = 40) -> DataFrame:
    """Securities with the largest total value over positive positions of one snapshot."""
    held = (
        holdings.where(F.col("market_value") > 0)
        .groupBy("constituent_ticker", "constituent_name")
        .agg(F.sum("market_value").alias("total_market_value"))
        .withColumn("name_short", F.substring("constituent_name", 1, 25))
    )
    return top_n(held, "total_market_value", "constituent_ticker", n)


def security_exposure(holdings: DataFrame, securities: DataFrame, asset_class: str = "Equity") -> DataFrame:
    """How widely and heavily each security of a class is held in one snapshot.

    Positions are aggregated to one row per security before the join, so a security that many
    funds hold does not skew it.
    """
    per_security = holdings.groupBy("constituent_ticker").agg(
        F.count_distinct("composite_ticker").alias("fund_count"),
        F.max("weight").alias("max_weight"),
        F.avg("weight").alias("avg_weight"),
        F.sum("weight").alias("total_weight"),
        F.sum("market_value").alias("total_market_value"),
    )
    facts = securities.where(F.col("asset_class") == asset_class).select(
        "constituent_ticker", "constituent_name", "security_type", "country_of_exchange",
        "sic_description", "active_flag",
    )
    return per_security.join(facts, "constituent_ticker")


def country_slots(exposure: DataFrame, n: int = 15) -> DataFrame:
    """Fund slots, mean funds per security and securities per country, most slots first."""
    per_country = (
        exposure.where(F.col("country_of_exchange").isNotNull())
        .groupBy("country_of_exchange")
        .agg(
            F.sum("fund_count").alias("total_slots"),
            F.avg("fund_count").alias("avg_funds_per_security"),
            F.count("*").alias("securities"),
        )
    )
    return top_n(per_country, "total_slots", "country_of_exchange", n)


def sector_exposure(holdings: DataFrame, securities: DataFrame) -> DataFrame:
    """Weight of every fund by the industry of what it holds, as (fund, sector, weight)."""
    sectors = securities.select("constituent_ticker", fill_unknown("sic_description").alias("sector"))
    rows = holdings.select("composite_ticker", "constituent_ticker", "weight").join(sectors, "constituent_ticker", "left")
    return rows.groupBy("composite_ticker", F.coalesce("sector", F.lit("Unknown")).alias("sector")).agg(F.sum("weight").alias("weight"))


def exposure_breakdown(holdings: DataFrame, by: list[str]) -> DataFrame:
    """Weight of every fund by each of several dimensions, as (fund, dimension, label, weight)."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("dimension"), F.col(c).alias("label")) for c in by]
    )
    return (
        holdings.select("composite_ticker", "weight", F.inline(pairs))
        .groupBy("composite_ticker", "dimension", "label")
        .agg(F.sum("weight").alias("weight"))
    )


def fund_memberships(holdings: DataFrame, funds: DataFrame) -> DataFrame:
    """Positions with what is known of the fund at the fund table's latest date.

    A fund has one row at a date, so no position is repeated. A fund with a third of
    all positions is split over tasks by the adaptive skew join.
    """
    facts = at_latest(funds).select(
        "composite_ticker",
        F.col("description").alias("fund_name"),
        "issuer",
        F.col("asset_class").alias("fund_asset_class"),
        (F.col("aum") / 1e9).alias("aum_bn"),
        (F.col("net_expenses") * 100.0).alias("net_expenses_bps"),
    )
    rows = holdings.select(
        "composite_ticker", "constituent_ticker", "weight", "market_value", "shares_held"
    )
    return rows.join(facts, "composite_ticker", "left")


def security_total_exposure(holdings: DataFrame, funds: DataFrame) -> DataFrame:
    """Assets behind each security: weight times fund assets, summed; and the fund it weighs most in."""
    rows = fund_memberships(holdings, funds)
    return rows.groupBy("constituent_ticker").agg(
        F.count("*").alias("fund_count"),
        F.sum(F.col("weight") / 100.0 * F.col("aum_bn")).alias("total_exposure_bn"),
        F.avg("weight").alias("avg_weight"),
        F.max("weight").alias("max_weight"),
        F.max_by("composite_ticker", F.struct("weight", "composite_ticker")).alias("max_weight_fund"),
    )


def issuer_exposure(holdings: DataFrame, funds: DataFrame, n: int = 12) -> DataFrame:
    """For every security, the issuers whose funds hold it, by their funds' assets; first ``n`` each."""
    rows = fund_memberships(holdings, funds).where(F.col("aum_bn").isNotNull())
    per_issuer = rows.groupBy("constituent_ticker", "issuer").agg(
        F.count("*").alias("fund_count"), F.sum("aum_bn").alias("total_aum_bn")
    )
    return top_per_group(
        per_issuer, ["constituent_ticker"], [F.desc("total_aum_bn"), F.asc("issuer")], n
    )


def holdings_discrepancy(funds: DataFrame, holdings: DataFrame) -> DataFrame:
    """Counted minus reported positions of each fund that reports any."""
    reported = funds.where(F.col("num_holdings").isNotNull()).select("composite_ticker", "num_holdings")
    return (
        reported.join(actual_holdings(holdings), "composite_ticker")
        .select(
            "composite_ticker",
            F.col("num_holdings").alias("reported_holdings"),
            "actual_holdings",
            (F.col("actual_holdings") - F.col("num_holdings")).alias("delta"),
        )
    )


def combine(funds: DataFrame, holdings: DataFrame) -> DataFrame:
    """Fund table joined to the per-fund aggregate of a snapshot."""
    return join_keys(funds, actual_holdings(holdings), ["composite_ticker"])


def average_weight(holdings: DataFrame) -> DataFrame:
    """Mean weight of each security over the funds that hold it."""
    return holdings.groupBy("constituent_ticker").agg(
        F.count("*").alias("fund_count"), F.avg("weight").alias("avg_weight")
    )
