"""Gold tables from silver tables that are laid out in buckets of security and salt."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fundledger.catalog import filings as base
from fundledger.catalog import views as v
from fundledger.catalog.registry import CHECKS, register
from fundledger.operators import enrichment as en, facts as fa, filings as fi
from fundledger.plans import layers


def _silver(spark: SparkSession, sf: str, *names: str) -> dict[str, DataFrame]:
    """The dimension and the named silver tables, bucketed."""
    made = {
        "dim_security": lambda: base._keys(spark, sf),
        "filings_index": lambda: base._silver_filings(spark, sf),
        "financial_facts": lambda: base._silver_facts(spark, sf),
        "corporate_actions": lambda: fi.corporate_actions(base._silver_filings(spark, sf)),
    }
    return layers.bucket_silver({name: made[name]() for name in ("dim_security", *names)})


def _annual(spark: SparkSession, sf: str) -> DataFrame:
    silver = _silver(spark, sf, "financial_facts")
    return fa.statements_annual(silver["financial_facts"], silver["dim_security"])


def _quarterly(spark: SparkSession, sf: str) -> DataFrame:
    silver = _silver(spark, sf, "financial_facts")
    return fa.statements_quarterly(silver["financial_facts"], silver["dim_security"], 8)


def _catalog(spark: SparkSession, sf: str) -> DataFrame:
    silver = _silver(spark, sf, "filings_index")
    return fi.filing_catalog(silver["filings_index"], silver["dim_security"])


def _events(spark: SparkSession, sf: str) -> DataFrame:
    silver = _silver(spark, sf, "corporate_actions")
    return fi.corporate_events(silver["corporate_actions"], silver["dim_security"])


def _profile(spark: SparkSession, sf: str) -> DataFrame:
    silver = _silver(spark, sf, "filings_index", "financial_facts")
    flags = en.active_flags(v.filings(spark, sf), base.AS_OF)
    return fa.company_profile(silver["dim_security"], silver["filings_index"], silver["financial_facts"], base._companies(spark, sf), flags)


# The layout changes no row, so each has the check of the plain form.
for _plain, _run in (
    ("statements_annual", _annual),
    ("statements_quarterly", _quarterly),
    ("filing_catalog", _catalog),
    ("corporate_events", _events),
    ("company_profile", _profile),
):
    register(f"bucketed_{_plain}", _run, check=CHECKS[_plain])
