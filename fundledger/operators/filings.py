"""Company filings: change lists, silver index and corporate events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundledger.functions.codes import event_frame
from fundledger.functions.dates import iso_date
from fundledger.functions.keys import filing_url
from fundledger.sources.copartitioned import join_keys


def daily_changes(index: DataFrame) -> DataFrame:
    """One row per company of a day's index: first-seen name, distinct forms in first-seen order.

    Each (company, form) first collapses to its earliest line on the map side, so what is collected
    per company is its distinct forms, not its lines.
    """
    firsts = index.groupBy("ingestion_date", "cik", "form").agg(
        F.min(F.struct("path", "line", "company_name")).alias("_first")
    )
    seen = F.struct(F.col("_first.path").alias("path"), F.col("_first.line").alias("line"), "form")
    forms = F.sort_array(F.collect_list(F.when(F.col("form") != "", seen)))
    return firsts.groupBy("ingestion_date", "cik").agg(
        F.min("_first").getField("company_name").alias("company_name"),
        F.to_json(F.transform(forms, lambda x: x["form"])).alias("forms_filed"),
    )


def change_list(index: DataFrame, universe: DataFrame, full_refresh: bool = False) -> DataFrame:
    """Companies to load on a day: those in the index and the universe, or the whole universe."""
    if full_refresh:
        return universe.groupBy("cik").agg(F.min("name").alias("company_name")).select(
            "cik", "company_name", F.lit("[]").alias("forms_filed"), F.lit(True).alias("full_refresh")
        )
    return (
        daily_changes(index)
        .join(universe.select("cik"), "cik", "left_semi")
        .withColumn("full_refresh", F.lit(False))
    )


def silver_filings(filings: DataFrame, dim: DataFrame) -> DataFrame:
    """Typed filing index keyed by security; a company with several securities has a row for each."""
    typed = filings.select(
        "cik",
        F.col("accessionNumber").alias("accession_number"),
        F.col("form").alias("form_type"),
        iso_date("filingDate").alias("filed_date"),
        iso_date("reportDate").alias("period_of_report"),
        filing_url("cik", "accessionNumber").alias("filing_url"),
        F.col("primaryDocument").alias("primary_document"),
        (F.col("isXBRL") == 1).alias("is_xbrl"),
        "items",
    )
    return typed.join(dim.select("cik", "security_id"), "cik")


def corporate_actions(filings: DataFrame) -> DataFrame:
    """Events announced by form, or by the item of an 8-K; one filing may announce several.

    ``filings`` are silver rows. The rule table has ten rows and is broadcast.
    """
    rules = event_frame(filings.sparkSession)
    items = F.split(F.coalesce(F.col("items"), F.lit("")), ",")
    match = (F.col("form_type") == F.col("rule_form")) & (
        F.col("rule_item").isNull() | F.array_contains(items, F.col("rule_item"))
    )
    return filings.join(F.broadcast(rules), match).select(
        "security_id",
        "cik",
        "event_type",
        F.coalesce("period_of_report", "filed_date").alias("event_date"),
        F.lit(None).cast("date").alias("effective_date"),
        "accession_number",
        "form_type",
        "filed_date",
        # The filing index doesn't say who the other party is, nor a split's ratio.
        F.lit(None).cast("bigint").alias("counterparty_cik"),
        F.lit(None).cast("string").alias("counterparty_name"),
        F.lit(None).cast("int").alias("split_ratio_numerator"),
        F.lit(None).cast("int").alias("split_ratio_denominator"),
        F.concat_ws(" ", "form_type", "items").alias("description"),
    )


def filing_catalog(filings: DataFrame, dim: DataFrame) -> DataFrame:
    """Silver filings with ticker and company name."""
    on = join_keys(filings, dim, ["security_id"])
    names = dim.select(*on, "ticker", "company_name")
    return filings.join(names, on).select(
        "security_id", "cik", "ticker", "company_name", "accession_number", "form_type",
        "filed_date", "period_of_report", "filing_url", "primary_document",
    )


def corporate_events(actions: DataFrame, dim: DataFrame) -> DataFrame:
    """Corporate actions with ticker and company name."""
    on = join_keys(actions, dim, ["security_id"])
    names = dim.select(*on, "ticker", "company_name")
    return actions.join(names, on).select(
        "security_id", "cik", "ticker", "company_name", "event_type", "event_date",
        "effective_date", "form_type", "filed_date", "description",
    )
