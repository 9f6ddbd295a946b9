"""Company and security keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundledger.functions.text import as_column, blank_to_null, pad_zeros


def cik10(c: Column | str) -> Column:
    """Company number with leading zeros up to ten digits; longer ones stay whole."""
    return pad_zeros(c, 10)


def cik_plain(c: Column | str) -> Column:
    """Company number without leading zeros."""
    return F.ltrim(as_column(c), F.lit("0"))


def security_id(cik: Column | str, ticker_class: Column | str | None = None) -> Column:
    """First 16 hex digits of the SHA-256 of ``<padded cik>|<CLASS>``; no class is PRIMARY."""
    share_class = (
        F.lit("PRIMARY")
        if ticker_class is None
        else F.coalesce(F.upper(blank_to_null(ticker_class)), F.lit("PRIMARY"))
    )
    return F.left(F.sha2(F.concat_ws("|", cik10(cik), share_class), 256), F.lit(16))


def filing_url(cik: Column | str, accession: Column | str) -> Column:
    return F.concat(
        F.lit("https://www.sec.gov/Archives/edgar/data/"),
        cik_plain(as_column(cik).cast("string")),
        F.lit("/"),
        as_column(accession),
        F.lit("/"),
    )
