"""The security master: cleaning, checking, searching and counting by status."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundledger.functions.codes import centroid_frame, country_frame, map_codes, region_frame
from fundledger.functions.status import with_status
from fundledger.functions.text import (
    blank_to_null,
    clean_ticker,
    contains_text,
    fill_unknown,
    mixed_case_or_odd,
)
from fundledger.operators.counting import cross_counts, value_counts
from fundledger.operators.ranking import latest_per_key, top_n
from fundledger.operators.snapshots import at_latest
from fundledger.session import cut_lineage

DESCRIBED = [
    "constituent_ticker", "constituent_name", "asset_class", "security_type",
    "country_of_exchange", "exchange", "currency_traded", "cusip", "isin",
]


def clean_securities(rows: DataFrame) -> DataFrame:
    """Upper-case trimmed tickers, trimmed text, blank identifiers as null; rows without a ticker drop out."""
    text = ["constituent_name", "asset_class", "security_type", "country_of_exchange", "exchange", "currency_traded"]
    return rows.where(blank_to_null("constituent_ticker").isNotNull()).withColumns(
        {
            "constituent_ticker": clean_ticker("constituent_ticker"),
            **{c: F.trim(c) for c in text},
            **{c: blank_to_null(c) for c in ("cusip", "isin")},
        }
    )


def newest_descriptions(rows: DataFrame) -> DataFrame:
    """The descriptions of each security at its latest date, with that date and their number ``_n``.

    Positions repeat a few descriptions, which a hash aggregation keeps with their last date as rows pass; a
    sort would hold all the wide rows of a task.
    """
    each = Window.partitionBy("constituent_ticker")
    described = rows.groupBy(*DESCRIBED).agg(F.max("as_of_date").alias("as_of_date"))
    newest = described.withColumn("_last", F.max("as_of_date").over(each)).where(F.col("as_of_date").eqNullSafe(F.col("_last")))
    return newest.drop("_last").withColumn("_n", F.count(F.lit(1)).over(each))


def securities(holdings: DataFrame) -> DataFrame:
    """One cleaned row per security: its latest appearance in any fund (first fund on ties).

    Funds are compared only for securities that have several descriptions at their latest date.
    """
    rows = clean_securities(holdings)
    newest = cut_lineage(newest_descriptions(rows))
    several = cut_lineage(newest.where("_n > 1").select("constituent_ticker", "as_of_date").distinct())
    if several.isEmpty():
        return newest.select(*DESCRIBED)
    same = (rows["constituent_ticker"] == several["constituent_ticker"]) & rows["as_of_date"].eqNullSafe(several["as_of_date"])
    first = latest_per_key(rows.join(several, same, "left_semi"), ["constituent_ticker"], [F.asc("composite_ticker")])
    return newest.where("_n = 1").select(*DESCRIBED).unionByName(first.select(*DESCRIBED))


def bad_tickers(rows: DataFrame, n: int | None = None) -> DataFrame:
    """Tickers that need cleaning, with their row counts."""
    return value_counts(rows.where(mixed_case_or_odd("constituent_ticker")), "constituent_ticker", n)


def search_securities(table: DataFrame, query: str, n: int = 10) -> DataFrame:
    """Securities whose ticker or name contains the query, in ticker order; at least two characters."""
    if len(query) < 2:
        raise ValueError("a search needs at least two characters")
    hits = table.where(contains_text("constituent_ticker", query) | contains_text("constituent_name", query))
    return (
        hits.orderBy("constituent_ticker")
        .limit(n)
        .select("constituent_ticker", "constituent_name", "asset_class")
    )


def filter_status(table: DataFrame, security_type: str = "All", statuses: list[str] | None = None) -> DataFrame:
    """Restrict to a security type and to statuses; 'All' or an empty list does not restrict."""
    out = with_status(table)
    if security_type != "All":
        out = out.where(F.col("security_type") == security_type)
    return out.where(F.col("active_label").isin(statuses)) if statuses else out


def us_only(table: DataFrame) -> DataFrame:
    return table.where(F.col("country_of_exchange") == "US")


def non_us(table: DataFrame) -> DataFrame:
    """Foreign securities; an unknown country is neither foreign nor domestic."""
    return table.where(F.col("country_of_exchange") != "US")


def equities(table: DataFrame) -> DataFrame:
    return with_status(table.where(F.col("asset_class") == "Equity"))


def country_activity(table: DataFrame) -> DataFrame:
    """Securities, active, inactive and active percentage of each country with a known code."""
    per_country = (
        table.where(F.col("country_of_exchange").isNotNull())
        .groupBy("country_of_exchange")
        .agg(
            F.count("constituent_ticker").alias("securities"),
            F.count_if("active_flag").alias("active"),
            F.count_if(~F.col("active_flag")).alias("inactive"),
        )
    )
    coded = map_codes(per_country, country_frame(table.sparkSession), "country_of_exchange")
    return coded.where(F.col("iso3").isNotNull()).withColumn(
        "active_pct", F.round(F.col("active") * 100.0 / F.col("securities"), 1)
    )


def active_by_country(table: DataFrame) -> DataFrame:
    """Active securities per country with the country's centre; countries without one drop out."""
    counts = (
        table.where(F.col("active_flag") & F.col("country_of_exchange").isNotNull())
        .groupBy("country_of_exchange")
        .agg(F.count("*").alias("n"))
    )
    placed = map_codes(counts, centroid_frame(table.sparkSession), "country_of_exchange")
    return placed.where(F.col("lon").isNotNull())


def region_types(table: DataFrame) -> DataFrame:
    """Foreign securities by world region and security type."""
    placed = map_codes(
        non_us(table).groupBy("country_of_exchange", "security_type").agg(F.count("*").alias("_n")),
        region_frame(table.sparkSession),
        "country_of_exchange",
        default="Other",
    )
    return placed.groupBy("world_region", fill_unknown("security_type").alias("security_type")).agg(
        F.sum("_n").alias("n")
    )


def status_by_type(table: DataFrame, n: int = 8) -> DataFrame:
    """Status counts of the most common security types among enriched securities."""
    return cross_counts(with_status(table).where("is_enriched"), "security_type", "active_label", n)


def deregistered(table: DataFrame, n: int = 20) -> DataFrame:
    """Inactive securities whose company gave up its registration, in ticker order."""
    rows = table.where(~F.col("active_flag") & F.col("inactive_reason").startswith("deregistration"))
    return (
        rows.select(
            "constituent_ticker", "constituent_name", "inactive_reason",
            "edgar_name", "sic_description", "state_of_inc",
        )
        .orderBy("constituent_ticker")
        .limit(n)
    )


def with_share_units(table: DataFrame) -> DataFrame:
    """Securities with a positive share count, also in billions and millions."""
    return table.where(F.col("shares_outstanding") > 0).withColumns(
        {
            "shares_bn": F.col("shares_outstanding") / 1e9,
            "shares_m": F.col("shares_outstanding") / 1e6,
        }
    )


def largest_by_shares(table: DataFrame, n: int = 25) -> DataFrame:
    return top_n(with_share_units(table), "shares_outstanding", "constituent_ticker", n)


def monitor_summary(table: DataFrame) -> DataFrame:
    """Inactive, active and unknown securities and the last enrichment, in one row."""
    return table.agg(
        F.count_if(~F.col("active_flag")).alias("total_inactive"),
        F.count_if("active_flag").alias("total_active"),
        F.count_if(F.col("active_flag").isNull()).alias("total_unknown"),
        F.max("edgar_enriched_at").alias("last_enriched_at"),
    )


def inactive_by_reason(table: DataFrame) -> DataFrame:
    return value_counts(table.where(~F.col("active_flag")), "inactive_reason", null_label="Unknown")


def _inactive_positions(table: DataFrame, holdings: DataFrame) -> tuple[DataFrame, DataFrame]:
    gone = table.where(~F.col("active_flag")).select(
        "constituent_ticker", "constituent_name", "inactive_reason", "asset_class", "security_type", "edgar_cik"
    )
    held = (
        at_latest(holdings)
        .select("constituent_ticker", "composite_ticker", "weight")
        .join(gone.select("constituent_ticker"), "constituent_ticker", "left_semi")
    )
    return gone, held


def inactive_with_funds(table: DataFrame, holdings: DataFrame) -> DataFrame:
    """Inactive securities with each fund that holds them at the latest snapshot, a row per fund.

    Rows instead of one list per security: a security held by very many funds stays spread out. An
    inactive security that no fund holds has one row without a fund.
    """
    gone, held = _inactive_positions(table, holdings)
    return gone.join(held, "constituent_ticker", "left")


def inactive_fund_counts(table: DataFrame, holdings: DataFrame) -> DataFrame:
    """Inactive securities with the number of funds that hold them at the latest snapshot."""
    gone, held = _inactive_positions(table, holdings)
    counts = held.groupBy("constituent_ticker").agg(F.count("*").alias("fund_count"))
    return gone.join(counts, "constituent_ticker", "left").fillna(0, subset=["fund_count"])


def fund_inactive(holdings: DataFrame, table: DataFrame) -> DataFrame:
    """Number and weight of inactive securities in each fund of one snapshot."""
    gone = table.where(~F.col("active_flag")).select("constituent_ticker")
    return (
        holdings.join(gone, "constituent_ticker", "left_semi")
        .groupBy("composite_ticker")
        .agg(F.count("*").alias("inactive_count"), F.sum("weight").alias("inactive_weight"))
    )
