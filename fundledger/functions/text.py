"""Text cleaning, labels and list columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Share class letters and digits, and their place in the class order.
CLASS_PLACES = {"A": 0, "B": 1, "C": 2, "D": 3, "E": 4, "1": 0, "2": 1, "3": 2, "4": 3}


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(F.trim(as_column(c)), F.lit(""))


def pad_zeros(c: Column | str, n: int) -> Column:
    """Text of a number with leading zeros up to ``n`` characters; longer text is never cut."""
    text = as_column(c).cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(n)), F.lit("0"))


def clean_ticker(c: Column | str) -> Column:
    return F.upper(F.trim(as_column(c)))


def fill_unknown(c: Column | str, label: str = "Unknown", blank_too: bool = True) -> Column:
    """A label in place of null, and of blank text when ``blank_too``."""
    value = blank_to_null(c) if blank_too else as_column(c)
    return F.coalesce(value, F.lit(label))


def strip_markup(c: Column | str) -> Column:
    """Tags become ' / '; slashes and blanks at both ends go; nothing left is null."""
    spaced = F.regexp_replace(as_column(c), "<[^>]+>", " / ")
    return F.nullif(F.btrim(spaced, F.lit(" /")), F.lit(""))


def class_place(ticker: Column | str) -> Column:
    """Place of the share class named by the last part of a ticker, null without a separator."""
    parts = F.split(F.upper(as_column(ticker)), r"[ .\-]")
    places = F.create_map(*[F.lit(x) for pair in CLASS_PLACES.items() for x in pair])
    return F.when(F.size(parts) > 1, F.element_at(places, F.element_at(parts, -1)))


def ticker_spellings(ticker: Column | str) -> Column:
    """Spellings of a ticker under which a registry may list it, in the order to try them."""
    t = as_column(ticker)
    return F.transform(
        F.array(
            t,
            F.replace(t, F.lit(" "), F.lit("-")),
            F.replace(t, F.lit("."), F.lit("-")),
            F.replace(t, F.lit(" "), F.lit("")),
            F.replace(t, F.lit("."), F.lit("")),
            F.replace(t, F.lit(" "), F.lit(".")),
        ),
        F.upper,
    )


def join_distinct(items: Column | str, sep: str = "|") -> Column:
    """Array to text: empty entries dropped, first occurrence kept in order, nothing left is null."""
    kept = F.filter(as_column(items), lambda x: x.isNotNull() & (x != ""))
    return F.nullif(F.array_join(F.array_distinct(kept), sep), F.lit(""))


def contains_text(c: Column | str, query: str) -> Column:
    """Case-insensitive substring test that takes the query literally."""
    return F.contains(F.lower(as_column(c)), F.lit(query.lower()))


def mixed_case_or_odd(ticker: Column | str) -> Column:
    """True for a ticker that is not upper-case and trimmed, or has characters outside A-Z 0-9 . -"""
    t = as_column(ticker)
    return (t != clean_ticker(t)) | t.rlike(r"[^A-Z0-9.\-]")
