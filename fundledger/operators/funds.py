"""The fund table: screening, issuers, fees and key figures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundledger.functions.text import contains_text, fill_unknown
from fundledger.operators.counting import histogram, value_counts
from fundledger.operators.holdings import actual_holdings, concentration
from fundledger.operators.joining import semi_join
from fundledger.operators.quantiles import median_by, with_quantiles
from fundledger.operators.ranking import latest_per_key, page, top_n
from fundledger.operators.snapshots import at_latest
from fundledger.session import cut_lineage

# Screener filters and the column each one tests.
LIST_FILTERS = {
    "asset_class": "asset_class",
    "issuer": "issuer",
    "region": "region",
    "sector": "sector_exposure",
    "development_class": "development_class",
}
RANGE_FILTERS = {
    "min_expense_ratio": ("net_expenses_bps", ">="),
    "max_expense_ratio": ("net_expenses_bps", "<="),
    "min_aum": ("aum", ">="),
    "max_aum": ("aum", "<="),
    "min_holdings": ("num_holdings", ">="),
}
FLAG_FILTERS = ["is_leveraged", "is_etn", "is_active"]


def with_units(funds: DataFrame) -> DataFrame:
    """Assets in billions and expenses in basis points."""
    return funds.withColumns(
        {"aum_bn": F.col("aum") / 1e9, "net_expenses_bps": F.col("net_expenses") * 100.0}
    )


def latest_funds(funds: DataFrame) -> DataFrame:
    """Each fund's latest row; of several of one date the largest, then the first by description."""
    return latest_per_key(funds, ["composite_ticker"], [F.desc("as_of_date"), F.desc_nulls_last("aum"), F.asc_nulls_last("description")])


def screen(funds: DataFrame, q: str | None = None, **filters) -> DataFrame:
    """Latest row of each fund, then every given filter; a filter left out does not restrict."""
    rows = with_units(latest_funds(funds))
    tests = []
    for name, wanted in filters.items():
        if name in LIST_FILTERS:
            tests.append(F.col(LIST_FILTERS[name]).isin(list(wanted)))
        elif name in RANGE_FILTERS:
            column, sign = RANGE_FILTERS[name]
            tests.append(F.col(column) >= wanted if sign == ">=" else F.col(column) <= wanted)
        elif name in FLAG_FILTERS:
            tests.append(F.col(name) == wanted)
        else:
            raise ValueError(f"unknown filter {name}")
    if q:
        tests.append(contains_text("composite_ticker", q) | contains_text("description", q))
    return rows.where(reduce(lambda a, b: a & b, tests)) if tests else rows


def screener_page(funds: DataFrame, sort_by: str = "aum", ascending: bool = False, number: int = 1, size: int = 50, **filters) -> DataFrame:
    return page(screen(funds, **filters), sort_by, "composite_ticker", ascending, number, size)


def fee_funds(funds: DataFrame) -> DataFrame:
    return with_units(funds).where(F.col("net_expenses_bps") > 0)


def fund_points(funds: DataFrame, *also: str) -> DataFrame:
    """Funds with assets and a fee, and whatever else a chart needs present."""
    rows = fee_funds(funds).where(F.col("aum") > 0)
    return rows.dropna(subset=list(also)) if also else rows


def fee_by_class(funds: DataFrame) -> DataFrame:
    return median_by(fee_funds(funds), "asset_class", "net_expenses_bps")


def fee_by_category(funds: DataFrame, min_funds: int = 5, n: int = 15) -> DataFrame:
    """Dearest categories by median fee, among those with enough funds."""
    rows = fee_funds(funds).where(F.col("category").isNotNull())
    return median_by(rows, "category", "net_expenses_bps", min_funds, n)


def issuers(funds: DataFrame, n: int | None = None) -> DataFrame:
    """Fund count, assets and asset classes of each issuer, most assets first."""
    out = funds.groupBy("issuer").agg(
        F.count("*").alias("fund_count"),
        F.sum("aum").alias("total_aum"),
        F.sort_array(F.collect_set("asset_class")).alias("asset_classes"),
    )
    return out if n is None else top_n(out, "total_aum", "issuer", n)


def issuer_profiles(funds: DataFrame) -> DataFrame:
    """Assets, funds, mean expense and largest fund of every issuer."""
    return funds.groupBy("issuer").agg(
        F.count("*").alias("fund_count"),
        F.sum("aum").alias("total_aum"),
        F.avg(F.col("net_expenses") * 100.0).alias("avg_expense_bps"),
        F.max_by("composite_ticker", F.struct("aum", "composite_ticker")).alias("largest_fund"),
    )


def issuer_classes(funds: DataFrame) -> DataFrame:
    """Funds and assets of every issuer by asset class."""
    return funds.groupBy("issuer", fill_unknown("asset_class").alias("asset_class")).agg(
        F.count("*").alias("fund_count"), F.sum("aum").alias("total_aum")
    )


def breadth_histogram(funds: DataFrame, bound: int = 1000, n: int = 50) -> DataFrame:
    """Reported position counts in buckets, clipped at ``bound``."""
    return histogram(funds.where(F.col("num_holdings") > 0), "num_holdings", 0, bound, n, (None, bound))


def breadth_by_class(funds: DataFrame) -> DataFrame:
    return median_by(
        funds.where((F.col("num_holdings") > 0) & F.col("asset_class").isNotNull()),
        "asset_class",
        "num_holdings",
    )


def leverage_counts(funds: DataFrame, n: int = 10) -> DataFrame:
    """How many leveraged funds carry each leverage amount."""
    return value_counts(funds.where("is_leveraged"), "leveraged_amount", n)


def key_findings(funds: DataFrame, holdings: DataFrame) -> DataFrame:
    """The figures of the closing summary, in one row, for one snapshot of both tables."""
    top3 = issuers(funds, 3).agg(F.sum("total_aum")).scalar()
    card = funds.agg(
        F.count("*").alias("fund_rows"),
        F.sum("aum").alias("_assets"),
        F.sum(F.col("aum") / 1e12).alias("total_aum_trn"),
        (F.count_if(F.col("asset_class") == "Equity") * 100.0 / F.count("*")).alias("equity_pct"),
    )
    per_fund = cut_lineage(
        actual_holdings(holdings)
        .select("composite_ticker", "actual_holdings")
        .join(concentration(holdings), "composite_ticker")
    )
    facts = holdings.agg(
        F.count("*").alias("n"), F.count_distinct("constituent_ticker").alias("d")
    )
    card = card.select(
        "*",
        F.try_divide(top3 * 100.0, F.col("_assets")).alias("top3_issuer_pct"),
        facts.select("n").scalar().alias("holding_rows"),
        facts.select("d").scalar().alias("securities"),
        semi_join(funds, per_fund, "composite_ticker").agg(F.count("*")).scalar().alias("matched_funds"),
    ).drop("_assets")
    medians = {"median_holdings": ("actual_holdings", 0.5), "median_top10": ("top10_weight", 0.5)}
    return with_quantiles(card, per_fund, [], medians)


def current_funds(funds: DataFrame) -> DataFrame:
    """The fund table's latest snapshot."""
    return at_latest(funds)
