"""Labels for the three-state active flag and its reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundledger.functions.text import as_column

# Reason codes and the words shown for them, per screen.
REASON_WORDS = {
    "overview": {
        "deregistration": "Formally Deregistered",
        "not_in_edgar_tickers": "Not in SEC EDGAR",
        "no_recent_10k_10q": "Stale Filer (no 10-K/10-Q)",
        None: "Unknown",
    },
    "lookup": {
        "deregistration": "Deregistered",
        "not_in_edgar_tickers": "Not in EDGAR",
        "no_recent_10k_10q": "Stale Filer",
        None: "Inactive",
    },
}


def active_label(flag: Column | str = "active_flag") -> Column:
    f = as_column(flag)
    return F.when(f, "Active").when(~f, "Inactive").otherwise("Not Enriched")


def reason_label(reason: Column | str = "inactive_reason", screen: str = "overview") -> Column:
    """Words for a reason code; an unlisted code stands for itself."""
    r, words = as_column(reason), REASON_WORDS[screen]
    return (
        F.when(r.isNull(), words[None])
        .when(r.startswith("deregistration"), words["deregistration"])
        .when(r == "not_in_edgar_tickers", words["not_in_edgar_tickers"])
        .when(r == "no_recent_10k_10q", words["no_recent_10k_10q"])
        .otherwise(r)
    )


def with_status(securities: DataFrame) -> DataFrame:
    return securities.withColumns(
        {
            "is_enriched": F.col("edgar_enriched_at").isNotNull(),
            "has_cik": F.col("edgar_cik").isNotNull(),
            "has_shares": F.col("shares_outstanding").isNotNull(),
            "active_label": active_label(),
        }
    )
