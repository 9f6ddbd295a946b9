"""Dates kept as ISO text in bronze, and reporting periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundledger.functions.text import as_column

# Day counts of a reporting year and a reporting quarter.
ANNUAL_DAYS = (355, 375)
QUARTER_DAYS = (85, 100)


def iso_date(c: Column | str) -> Column:
    """Date of a whole ISO text (``YYYY-MM-DD``), null when it is not one; dates pass through."""
    text = as_column(c).cast("string")
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text).try_cast("date")


def period_days(start: Column | str, end: Column | str) -> Column:
    return F.datediff(iso_date(end), iso_date(start))


def period_type(start: Column | str, end: Column | str) -> Column:
    """instant (no start), annual, quarterly, or other (also for unreadable dates)."""
    days = period_days(start, end)
    return (
        F.when(as_column(start).isNull(), "instant")
        .when(_within(days, ANNUAL_DAYS), "annual")
        .when(_within(days, QUARTER_DAYS), "quarterly")
        .otherwise("other")
    )


def _within(days: Column, bounds: tuple[int, int]) -> Column:
    """``days`` inside inclusive bounds, naming ``days`` once: a filter repeats what it names twice."""
    low, high = bounds
    return F.abs(days * 2 - (low + high)) <= high - low


def fiscal_period(kind: Column | str, end: Column | str, form: Column | str) -> Column:
    """FY for yearly reports, else Q1..Q4 by the month the period ends in."""
    quarter = F.concat(F.lit("Q"), F.quarter(as_column(end)).cast("string"))
    yearly = (as_column(kind) == "annual") | as_column(form).isin("10-K", "10-K/A")
    return F.when(yearly, F.lit("FY")).otherwise(quarter)
