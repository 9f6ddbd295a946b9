from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fundledger.functions import dates, keys, numbers, status, text
from fundledger.functions.codes import centroid_frame, concept_frame, country_frame, map_codes, region_frame


def values(spark, column, rows, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(v,) if not isinstance(v, tuple) else v for v in rows], schema).select(column).collect()]


def test_markup_becomes_slashes(spark):
    rows = ["Large accelerated filer<br>Smaller reporting company", "<b></b>", "", None, "plain"]
    assert values(spark, text.strip_markup("x"), rows) == [
        "Large accelerated filer / Smaller reporting company", None, None, None, "plain",
    ]


def test_class_place(spark):
    assert values(spark, text.class_place("x"), ["BRK B", "MOG.A", "AAPL", "X Z", "c-2"]) == [1, 0, None, None, 1]


def test_spellings_keep_their_order(spark):
    assert values(spark, text.ticker_spellings("x"), ["brk b", "BF.B"]) == [
        ["BRK B", "BRK-B", "BRK B", "BRKB", "BRK B", "BRK.B"],
        ["BF.B", "BF.B", "BF-B", "BF.B", "BFB", "BF.B"],
    ]


def test_join_distinct(spark):
    rows = [(["NYSE", "NYSE", None, "Nasdaq"],), ([],), (None,)]
    assert values(spark, text.join_distinct("x"), rows, "x array<string>") == ["NYSE|Nasdaq", None, None]


def test_unknown_and_search(spark):
    assert values(spark, text.fill_unknown("x"), ["a", " ", None]) == ["a", "Unknown", "Unknown"]
    assert values(spark, text.fill_unknown("x", "Broad", blank_too=False), ["", None]) == ["", "Broad"]
    assert values(spark, text.contains_text("x", "%"), ["50%", "abc"]) == [True, False]
    assert values(spark, text.mixed_case_or_odd("x"), ["AAPL", "aapl", " A", "BRK.B", "BRK B"]) == [False, True, True, False, True]


@pytest.mark.parametrize(
    "days, kind",
    [(354, "other"), (355, "annual"), (375, "annual"), (376, "other"), (84, "other"), (85, "quarterly"), (100, "quarterly"), (101, "other"), (270, "other")],
)
def test_period_bounds(spark, days, kind):
    row = spark.createDataFrame([("2020-01-01", days)], "s string, d int").select(
        "s", F.date_add(F.col("s").cast("date"), F.col("d")).cast("string").alias("e")
    )
    assert row.select(dates.period_type("s", "e")).first()[0] == kind


def test_period_without_start_or_with_bad_dates(spark):
    rows = [(None, "2020-01-01"), ("x", "2020-01-01"), ("2020-13-45", "2020-01-01"), ("2019", "2020"), ("2019-03", "2020-03-01")]
    assert values(spark, dates.period_type("s", "e"), rows, "s string, e string") == ["instant", "other", "other", "other", "other"]


def test_half_up(spark):
    assert values(spark, numbers.half_up("x"), ["0.00005", "1.00004", "bad"]) == [Decimal("0.0001"), Decimal("1.0000"), None]


def test_buckets_at_the_bounds(spark):
    assert values(spark, numbers.bucket("x", 0, 10, 5), [-0.1, 0.0, 1.9, 2.0, 10.0, None], "x double") == [0, 1, 1, 2, 6, None]


def test_clip_and_ranges(spark):
    assert values(spark, numbers.clip("x", -1.0, 1.0), [-5.0, 0.5, 9.0, None], "x double") == [-1.0, 0.5, 1.0, None]
    labels = numbers.range_label("x", [20.0, 40.0], ["low", "mid", "high"])
    assert values(spark, labels, [20.0, 20.5, 41.0, None], "x double") == ["low", "mid", "high", None]


def test_ratio_of_zero(spark):
    rows, schema = [(1.0, 2.0), (1.0, 0.0), (None, 1.0), (1.0, None)], "n double, d double"
    assert values(spark, numbers.safe_ratio("n", "d"), rows, schema) == [0.5, None, None, None]
    assert values(spark, numbers.safe_ratio("n", "d", zero="zero"), rows, schema) == [0.5, 0.0, None, None]


def test_security_id(spark):
    rows = [(320193, None), (320193, " "), (320193, "b"), (320193, " B ")]
    got = values(spark, keys.security_id("c", "k"), rows, "c long, k string")
    assert got[0] == got[1] == "87d7778334b67576"
    assert got[2] == got[3] != got[0]
    assert values(spark, keys.security_id("c"), [(320193,)], "c long") == ["87d7778334b67576"]


def test_filing_url(spark):
    rows = [("0000320193", "a-1")]
    assert values(spark, keys.filing_url("c", "a"), rows, "c string, a string") == ["https://www.sec.gov/Archives/edgar/data/320193/a-1/"]


def test_reason_words(spark):
    rows = ["deregistration_15-12G", "not_in_edgar_tickers", "other", None]
    assert values(spark, status.reason_label("x"), rows) == ["Formally Deregistered", "Not in SEC EDGAR", "other", "Unknown"]
    assert values(spark, status.reason_label("x", "lookup"), rows)[3] == "Inactive"


def test_code_tables_are_keyed_once(spark):
    for frame in (country_frame(spark), region_frame(spark), centroid_frame(spark)):
        assert frame.count() == frame.select("iso2").distinct().count()
    concepts = concept_frame(spark)
    assert concepts.select("statement_column").distinct().count() == 12
    assert concepts.count() == concepts.select("namespace", "concept").distinct().count()


def test_map_codes_keeps_unmatched_rows(spark):
    rows = spark.createDataFrame([("US",), ("??",), (None,)], "country string")
    got = {r.country: r.iso3 for r in map_codes(rows, country_frame(spark), "country", default="none").collect()}
    assert got == {"US": "USA", "??": "none", None: "none"}


def test_long_numbers_are_never_cut(spark):
    rows = [(15000000001,), (15000000009,), (7,)]
    assert values(spark, keys.cik10("c"), rows, "c long") == ["15000000001", "15000000009", "0000000007"]
    assert len(set(values(spark, keys.security_id("c"), rows, "c long"))) == 3


def test_code_tables_by_literal_values(spark):
    rows = spark.createDataFrame([("BE",), ("US",), ("JP",)], "country string")
    centre = {r.country: (r.lon, r.lat) for r in map_codes(rows, centroid_frame(spark), "country").collect()}
    assert centre == {"BE": (4.0, 51.0), "US": (-95.0, 38.0), "JP": (138.0, 36.0)}
    region = {r.country: r.world_region for r in map_codes(rows, region_frame(spark), "country").collect()}
    assert region == {"BE": "Europe", "US": None, "JP": "Asia"}
