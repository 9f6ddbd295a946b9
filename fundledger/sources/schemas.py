"""Declared schemas of raw documents and bronze tables."""

from __future__ import annotations

# Field names of the raw documents and of the bronze tables.
FILING_FIELDS = [
    "accessionNumber",
    "filingDate",
    "reportDate",
    "acceptanceDateTime",
    "act",
    "form",
    "fileNumber",
    "filmNumber",
    "items",
    "core_type",
    "size",
    "isXBRL",
    "isXBRLNumeric",
    "isInlineXBRL",
    "primaryDocument",
    "primaryDocDescription",
]
WHOLE_NUMBERS = ["size", "isXBRL", "isXBRLNumeric", "isInlineXBRL"]
SUBMISSION_SCALARS = [
    "name",
    "entityType",
    "sic",
    "sicDescription",
    "ownerOrg",
    "insiderTransactionForOwnerExists",
    "insiderTransactionForIssuerExists",
    "ein",
    "lei",
    "description",
    "website",
    "investorWebsite",
    "category",
    "fiscalYearEnd",
    "stateOfIncorporation",
    "stateOfIncorporationDescription",
    "phone",
    "flags",
]
ADDRESS_FIELDS = [
    "street1",
    "street2",
    "city",
    "stateOrCountry",
    "zipCode",
    "stateOrCountryDescription",
]


def filing_type(field: str) -> str:
    return "bigint" if field in WHOLE_NUMBERS else "string"


def _scalar_type(field: str) -> str:
    return "bigint" if field.startswith("insider") else "string"


TICKERS = "cik bigint, name string, ticker string, exchange string"
TICKER_MAP = "map<string, struct<cik_str: string, ticker: string, title: string>>"
INDEX_ROWS = "path string, line bigint, cik string, company_name string, form string, date_filed string, filename string"
FILINGS = ", ".join(f"{f} {filing_type(f)}" for f in FILING_FIELDS)
_RECENT = ", ".join(f"{f}: array<{filing_type(f)}>" for f in FILING_FIELDS)
_ADDRESS = ", ".join(f"{f}: string" for f in ADDRESS_FIELDS)
SUBMISSION = ", ".join(
    [
        "cik string",
        *[f"{f} {_scalar_type(f)}" for f in SUBMISSION_SCALARS],
        "tickers array<string>",
        "exchanges array<string>",
        "formerNames array<struct<name: string, `from`: string, `to`: string, `date`: string>>",
        f"addresses map<string, struct<{_ADDRESS}>>",
        f"filings struct<recent: struct<{_RECENT}>, files: array<struct<name: string, filingCount: bigint, filingFrom: string, filingTo: string>>>",
    ]
)
_ENTRY = "accn: string, `end`: string, start: string, val: double, fy: int, fp: string, form: string, filed: string, frame: string"
COMPANY_FACTS = (
    "cik bigint, entityName string, facts map<string, map<string, struct<label: string, "
    f"description: string, units: map<string, array<struct<{_ENTRY}>>>>>>"
)
COMPANY_CONCEPT = (
    "cik bigint, taxonomy string, tag string, "
    f"units map<string, array<struct<{_ENTRY}>>>"
)
