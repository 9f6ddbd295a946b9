"""From bronze to silver to gold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundledger.functions.codes import LISTED_EXCHANGES
from fundledger.functions.keys import cik10, security_id
from fundledger.functions.text import class_place
from fundledger.operators.facts import (
    company_profile,
    silver_facts,
    statements_annual,
    statements_quarterly,
)
from fundledger.operators.filings import (
    corporate_actions,
    corporate_events,
    filing_catalog,
    silver_filings,
)
from fundledger.operators.ranking import top_per_group
from fundledger.session import scratch_path
from fundledger.sources.copartitioned import SALT, replicated, salted, write_bucketed
from fundledger.sources.layers import upsert

# Columns of the security dimension that a new day may change.
DIM_UPDATES = ["company_name", "exchange", "sic", "entity_type", "last_seen_date", "updated_at"]


def listed_only(tickers: DataFrame) -> DataFrame:
    """Tickers of the two exchanges silver covers."""
    return tickers.where(F.col("exchange").isin(LISTED_EXCHANGES))


def dim_security(
    tickers: DataFrame,
    date: str,
    previous: DataFrame | None = None,
    classes: bool = False,
    companies: DataFrame | None = None,
    stamp: str | None = None,
) -> DataFrame:
    """The security dimension as of a day: one row per company, or per company and share class.

    ``companies`` (flattened submissions) gives industry and entity type, ``stamp`` the time of the run.
    With the previous version given, names, exchanges, the last-seen date and the update stamp move on,
    the first-seen date and the creation stamp stay, and companies no longer listed are kept.
    """
    share_class = F.when(class_place("ticker").isNotNull(), F.element_at(F.split(F.upper("ticker"), r"[ .\-]"), -1))
    rows = listed_only(tickers).select(
        security_id("cik", share_class if classes else None).alias("security_id"),
        cik10("cik").alias("cik"),
        "ticker",
        (share_class if classes else F.lit(None).cast("string")).alias("ticker_class"),
        F.col("name").alias("company_name"),
        "exchange",
        F.lit(True).alias("active_flag"),
        F.lit(date).cast("date").alias("first_seen_date"),
        F.lit(date).cast("date").alias("last_seen_date"),
        F.lit(stamp).cast("timestamp_ntz").alias("created_at"),
        F.lit(stamp).cast("timestamp_ntz").alias("updated_at"),
    )
    order = [F.asc_nulls_last("ticker"), F.asc_nulls_last("company_name"), F.asc("exchange")]
    today = with_company(top_per_group(rows, ["security_id"], order, 1), companies)
    if previous is None:
        return today
    return upsert(previous, today, ["security_id"], DIM_UPDATES, keep=("first_seen_date", "created_at"))


def with_company(dim: DataFrame, companies: DataFrame | None) -> DataFrame:
    """The dimension with industry and entity type, null without ``companies``.

    This is the only step that reads company documents; what needs keys and names alone goes without it.
    A company that was submitted several times gives one row.
    """
    if companies is None:
        return dim.withColumns({"sic": F.lit(None).cast("string"), "entity_type": F.lit(None).cast("string")})
    known = companies.select("cik", "sic", F.col("entityType").alias("entity_type"))
    known = top_per_group(known, ["cik"], [F.asc_nulls_last("sic"), F.asc_nulls_last("entity_type")], 1)
    return dim.join(known, "cik", "left").select(*dim.columns, "sic", "entity_type")


def to_silver(
    tickers: DataFrame,
    filings: DataFrame,
    facts: DataFrame,
    date: str,
    previous: DataFrame | None = None,
    companies: DataFrame | None = None,
    stamp: str | None = None,
) -> dict[str, DataFrame]:
    """All silver tables of a day from its bronze tables."""
    keys = dim_security(tickers, date, previous, stamp=stamp)
    indexed = silver_filings(filings, keys)
    return {
        "dim_security": dim_security(tickers, date, previous, companies=companies, stamp=stamp),
        "filings_index": indexed,
        "financial_facts": silver_facts(facts, keys),
        "corporate_actions": corporate_actions(indexed),
    }


# What one filing's facts replace, and the columns of it that a later load may change.
FACT_KEY = ["security_id", "period_end", "form_type"]
FACT_UPDATES = ["filed_date", "revenues", "net_income", "total_assets", "stockholders_equity"]


def upsert_facts(target: DataFrame, source: DataFrame, update: list[str] | None = None) -> DataFrame:
    """Silver facts with the later load's figures: matched rows change some columns, new rows are added."""
    return upsert(target, source, FACT_KEY, FACT_UPDATES if update is None else update)


def to_gold(
    silver: dict[str, DataFrame], companies: DataFrame | None = None, flags: DataFrame | None = None, stamp: str | None = None
) -> dict[str, DataFrame]:
    """All gold tables from the silver tables, stamped with the time of the run."""
    dim, filings = silver["dim_security"], silver["filings_index"]
    facts, actions = silver["financial_facts"], silver["corporate_actions"]
    gold = {
        "financial_statements_annual": statements_annual(facts, dim),
        "financial_statements_quarterly": statements_quarterly(facts, dim),
        "company_profile": company_profile(dim, filings, facts, companies, flags),
        "filing_catalog": filing_catalog(filings, dim),
        "corporate_events": corporate_events(actions, dim),
    }
    refreshed = F.lit(stamp).cast("timestamp_ntz")
    return {name: table.withColumn("refreshed_at", refreshed) for name, table in gold.items()}


# What spreads the rows of one security over salts, in each silver table with many rows a security.
SALTED_BY = {
    "filings_index": ["accession_number"],
    "financial_facts": ["period_end", "form_type"],
    "corporate_actions": ["filed_date", "form_type", "event_type"],
}


def bucket_silver(silver: dict[str, DataFrame], buckets: int = 64, salts: int = 8, root: str | None = None) -> dict[str, DataFrame]:
    """The given silver tables, written in buckets of security and salt, so that ``to_gold`` joins them in place.

    Annual statements, the catalog and the events then need no exchange at all. Quarters are cut inside the
    buckets, and only the rows that are left, at most eight a security and salt, meet by security; the profile
    likewise moves one row a security and bucket. Without ``root`` the tables are of this run alone.
    """
    laid = {}
    for name, rows in silver.items():
        path = scratch_path(rows.sparkSession, name) if root is None else f"{root}/{name}"
        parts = replicated(rows, salts) if name == "dim_security" else salted(rows, SALTED_BY[name], salts)
        table = f"{name}_{path.rsplit('-', 1)[-1]}" if root is None else name
        laid[name] = write_bucketed(parts, table, path, ["security_id", SALT], buckets)
    return laid


# How gold files are clustered.
GOLD_SORT = {
    "financial_statements_annual": ["ticker", "fiscal_year"],
    "financial_statements_quarterly": ["ticker", "period_end"],
    "company_profile": ["ticker"],
    "filing_catalog": ["ticker", "filed_date"],
    "corporate_events": ["ticker", "event_date"],
}
