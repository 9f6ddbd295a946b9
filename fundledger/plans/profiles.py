"""Profiles of every fund and every security, looked up by a filter on the key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundledger.operators.funds import latest_funds, with_units
from fundledger.operators.holdings import actual_holdings, concentration_multi, security_total_exposure
from fundledger.operators.snapshots import at_latest


def fund_profiles(funds: DataFrame, holdings: DataFrame) -> DataFrame:
    """Latest row of each fund with its position count, total weight and top-10/25/50 weight."""
    current = at_latest(holdings)
    return (
        with_units(latest_funds(funds))
        .join(actual_holdings(current), "composite_ticker", "left")
        .join(concentration_multi(current, [10, 25, 50]), "composite_ticker", "left")
    )


def security_profiles(securities: DataFrame, holdings: DataFrame, funds: DataFrame) -> DataFrame:
    """Every security with the funds that hold it now counted, weighed and summed."""
    exposure = security_total_exposure(at_latest(holdings), funds)
    return securities.join(exposure, "constituent_ticker", "left").fillna(0, subset=["fund_count"])


def fund_positions(holdings: DataFrame) -> DataFrame:
    """Current positions of every fund as its page lists them."""
    return at_latest(holdings).select(
        "composite_ticker", "constituent_ticker",
        "constituent_name", "weight", "market_value", "shares_held",
    )
