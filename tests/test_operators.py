import itertools
import random
from datetime import date
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundledger.operators import counting, enrichment, facts, filings, overlap, ranking, semantic, snapshots
from fundledger.operators.alerts import aum_changes
from fundledger.operators.funds import screen
from fundledger.operators.quantiles import describe, median_by, quantiles
from fundledger.operators.ranking import running_share, share_at
from fundledger.operators.securities import DESCRIBED, clean_securities, newest_descriptions, non_us, securities


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_quantiles_against_numpy_with_one_hot_group(spark):
    random.seed(1)
    rows = [("hot", random.choice([0.0, 5.0, -3.5, random.uniform(-1e6, 1e6)])) for _ in range(4000)]
    rows += [(None, random.uniform(0, 1)) for _ in range(101)] + [("one", 7.0), ("two", 1.0), ("two", 2.0), ("gone", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    ps = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0}
    got = {r.g: r for r in quantiles(df, ["g"], {k: ("v", p) for k, p in ps.items()}).collect()}
    assert set(got) == {"hot", None, "one", "two"}
    for group in got:
        values = [v for g, v in rows if g == group and v is not None]
        for name, p in ps.items():
            assert got[group][name] == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_quantiles_of_several_measures_and_whole_table(spark):
    df = spark.createDataFrame([(1.0, 10.0), (2.0, None), (4.0, 30.0)], "a double, b double")
    row = quantiles(df, [], {"ma": ("a", 0.5), "mb": ("b", 0.5)}).first()
    assert (row.ma, row.mb) == (2.0, 20.0)
    got = describe(df, "b").first()
    assert (got["count"], got.q25, got.q50, got.max) == (2, 15.0, 20.0, 30.0)


def test_median_by_needs_enough_rows(spark):
    df = spark.createDataFrame([("a", 1.0)] * 4 + [("b", float(i)) for i in range(5)], "g string, v double")
    assert rows_of(median_by(df, "g", "v", min_count=5, n=3)) == [("b", 5, 2.0)]


def test_running_share_against_brute_force_with_ties(spark):
    random.seed(2)
    data = [(f"k{i:04d}", float(random.choice([1, 1, 1, 2, 50, i]))) for i in range(500)]
    got = sorted(running_share(spark.createDataFrame(data, "k string, v double").repartition(7), "v", "k").collect(), key=lambda r: r["rank"])
    total, run = sum(v for _, v in data), 0.0
    for place, (k, v) in enumerate(sorted(data, key=lambda x: (-x[1], x[0])), 1):
        run += v
        row = got[place - 1]
        assert (row.k, row["rank"], row.running_total) == (k, place, run)
        assert row.running_pct == pytest.approx(run * 100 / total)


def test_share_at_skips_counts_beyond_the_table(spark):
    df = spark.createDataFrame([("a", 6.0), ("b", 3.0), ("c", 1.0)], "k string, v double")
    assert rows_of(share_at(df, "v", "k", [1, 2, 10])) == [(1, 60.0), (2, 90.0)]


D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


@pytest.fixture(scope="module")
def positions(spark):
    rows = [
        (D1, "F1", "A", 60.0), (D1, "F1", "B", 40.0), (D1, "F2", "A", 100.0),
        (D2, "F1", "A", 50.0), (D2, "F1", "C", 50.0), (D2, "F2", "A", 70.0), (D2, "F2", "B", 30.0),
        (D3, "F1", "A", 100.0),
    ]
    return spark.createDataFrame(rows, "as_of_date date, composite_ticker string, constituent_ticker string, weight double").withColumn(
        "market_value", F.col("weight") * 2
    )


def test_best_snapshot_is_not_the_latest(positions):
    assert snapshots.best_snapshot(positions).first()[0] == D2
    assert snapshots.latest_snapshot(positions).first()[0] == D3


def test_changes_compare_only_funds_present_on_both_dates(positions):
    got = rows_of(snapshots.holding_changes(positions).select("as_of_date", "composite_ticker", "constituent_ticker", "change"))
    assert got == [
        (D2, "F1", "B", "dropped_holding"), (D2, "F1", "C", "new_holding"), (D2, "F2", "B", "new_holding"),
        (D3, "F1", "C", "dropped_holding"),
    ]


def test_stable_funds_and_both_trends(positions):
    two = positions.where(F.col("as_of_date") < F.lit(D3))
    assert rows_of(snapshots.stable_funds(snapshots.fund_rollup(two))) == [("F1",), ("F2",)]
    once = {r.as_of_date: r.median_holdings for r in snapshots.snapshot_trend(two).collect()}
    weighted = {r.as_of_date: r.median_holdings for r in snapshots.snapshot_trend(two, row_weighted=True).collect()}
    assert once[D1] == 1.5 and weighted[D1] == 2.0


def test_fund_weights_sum_to_100(positions):
    assert {round(r.total_weight, 9) for r in snapshots.fund_rollup(positions).collect()} == {100.0}


def test_overlap_is_symmetric_and_counts_the_rest(positions):
    two = positions.where(F.col("as_of_date") == F.lit(D2))
    row = overlap.overlap(two, ["F2", "F1"]).first()
    assert (row.fund_a, row.fund_b, row.overlap_count, row.overlap_by_weight, row.only_in_a, row.only_in_b) == ("F1", "F2", 1, 50.0, 1, 1)
    assert rows_of(overlap.common_holdings(two, ["F1", "F2"])) == [("A", 50.0)]
    assert rows_of(overlap.only_in(two, "F1", "F2")) == [("C", 50.0)]
    anchor = two.where("composite_ticker = 'F1'").select("composite_ticker").distinct()
    assert rows_of(overlap.overlap_against(two, anchor)) == [("F2", 1, 70.0, 50.0, 50.0)]
    with pytest.raises(ValueError):
        overlap.overlap(two, ["F1"])


def test_funds_without_common_securities_overlap_by_nothing(spark):
    rows = [(D1, "F1", "A", 100.0), (D1, "F2", "B", 100.0)]
    df = spark.createDataFrame(rows, "as_of_date date, composite_ticker string, constituent_ticker string, weight double")
    row = overlap.overlap(df, ["F1", "F2"]).first()
    assert (row.overlap_count, row.overlap_by_weight) == (0, 0.0)


def test_screener_picks_the_latest_row_before_filtering(spark):
    rows = [(D1, "F1", "One", "Equity", 5e9, 0.5), (D2, "F1", "One", "Bond", 5e9, 0.5), (D2, "F2", "Two", "Equity", 1e9, 0.2)]
    funds = spark.createDataFrame(rows, "as_of_date date, composite_ticker string, description string, asset_class string, aum double, net_expenses double")
    assert [r.composite_ticker for r in screen(funds, asset_class=["Equity"]).collect()] == ["F2"]
    assert [r.composite_ticker for r in screen(funds, q="ONE").collect()] == ["F1"]
    assert screen(funds).count() == 2
    with pytest.raises(ValueError):
        screen(funds, colour="red")


def test_large_moves_of_assets(spark):
    rows = [(D1, "F1", 100.0), (D2, "F1", 130.0), (D3, "F1", 131.0), (D1, "F2", 0.0), (D2, "F2", 5.0)]
    funds = spark.createDataFrame(rows, "as_of_date date, composite_ticker string, aum double")
    assert rows_of(aum_changes(funds).select("composite_ticker", "as_of_date", "change_pct")) == [("F1", D2, 30.0)]


def test_master_cleans_and_keeps_the_latest(spark):
    text = "constituent_name asset_class security_type country_of_exchange exchange currency_traded cusip isin".split()
    rows = [
        (D1, "F1", " aapl ", " Old ", "Equity", "Common", "US", "NYSE", "USD", "1", "2"),
        (D2, "F1", "AAPL", " New", "Equity", "Common", "US", "NYSE", "USD", " ", None),
        (D2, "F1", " ", "x", "Equity", "Common", "US", "NYSE", "USD", "1", "2"),
        (D2, "F1", None, "x", "Equity", "Common", "US", "NYSE", "USD", "1", "2"),
    ]
    df = spark.createDataFrame(rows, "as_of_date date, composite_ticker string, constituent_ticker string, " + ", ".join(f"{c} string" for c in text))
    got = securities(df).collect()
    assert len(got) == 1 and (got[0].constituent_ticker, got[0].constituent_name, got[0].cusip, got[0].isin) == ("AAPL", "New", None, None)


def _described(spark, rows):
    """Positions from (date, fund, ticker, name); the other columns follow from the name."""
    other = {c: F.concat("constituent_name", F.lit(f" {c}")) for c in DESCRIBED[2:]}
    df = spark.createDataFrame(rows, "as_of_date date, composite_ticker string, constituent_ticker string, constituent_name string")
    return df.withColumns(other)


def test_master_sorts_no_positions_where_funds_agree(spark):
    df = _described(spark, [(d, f"F{i}", f" p{i % 3}", f"Name {i % 3}") for d in (D1, D2) for i in range(300)])
    assert newest_descriptions(clean_securities(df)).count() == 3
    got = securities(df)
    # One description a security: no window over positions is left, and what is read is three rows.
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan
    assert sorted((r.constituent_ticker, r.constituent_name) for r in got.collect()) == [("P0", "Name 0"), ("P1", "Name 1"), ("P2", "Name 2")]


def test_master_asks_funds_where_descriptions_differ(spark):
    random.seed(3)
    keys = [(d, f, t) for d in (None, D1, D2, D3) for f in (None, "F1", "F10", "F2") for t in [*(f"T{i}" for i in range(40))] if random.random() < 0.3]
    rows = [(*k, random.choice([None, "One", " One ", "Two"])) for k in keys]
    rows += [(None, "F2", "lone", "b"), (None, "F1", "LONE ", "a"), (D1, None, "N", "x"), (D1, "F1", "N", "y"), (D3, "F1", None, "z"), (D3, "F1", " ", "z")]
    order = lambda r: (-(r[0] or date(1, 1, 1)).toordinal(), r[1] is not None, r[1] or "")
    want = {}
    for r in sorted((r for r in rows if (r[2] or "").strip()), key=order):
        want.setdefault(r[2].strip().upper(), r[3].strip() if r[3] else None)
    got = securities(_described(spark, [*rows, *rows[:50]]))
    assert got.columns == DESCRIBED
    assert sorted((r.constituent_ticker, r.constituent_name) for r in got.collect()) == sorted(want.items())
    assert (want["LONE"], want["N"]) == ("a", "x")


def test_unknown_country_is_not_foreign(spark):
    df = spark.createDataFrame([("US",), ("DE",), (None,)], "country_of_exchange string")
    assert rows_of(non_us(df)) == [("DE",)]


def test_resolution_takes_the_first_spelling_that_hits(spark):
    names = spark.createDataFrame([("BRK B",), ("BF.B",), ("MOG.A",), ("NONE",)], "constituent_ticker string")
    known = spark.createDataFrame([("BRK-B", "1"), ("BRKB", "9"), ("BF-B", "2"), ("MOGA", "3")], "ticker string, cik string")
    assert {r.constituent_ticker: r.cik for r in enrichment.resolve_cik(names, known).collect()} == {"BRK B": "1", "BF.B": "2", "MOG.A": "3", "NONE": None}


def test_active_flags(spark):
    rows = [
        ("1", "15-12G", "2019-01-01", "a"), ("1", "10-K", "2023-12-01", "b"),
        ("2", "10-K", "2015-01-01", "c"), ("3", "10-Q", "2023-12-01", "d"), ("4", "8-K", "2023-12-01", "e"),
        ("5", "10-Q", "2022-01-01", "f"),
    ]
    df = spark.createDataFrame(rows, "cik string, form string, filingDate string, accessionNumber string")
    got = {r.cik: (r.active_flag, r.inactive_reason) for r in enrichment.active_flags(df, "2024-01-01").collect()}
    stale = (False, "no_recent_10k_10q")
    assert got == {"1": (False, "deregistration_15-12G"), "2": stale, "3": (True, None), "4": stale, "5": (True, None)}
    assert enrichment.active_flags(df, "2024-01-01", wording="pilot").where("cik = '2'").first().inactive_reason.startswith("No recent")


def test_activity_of_unresolved_and_unfetched_companies(spark):
    resolved = spark.createDataFrame([("A", None), ("B", "7"), ("C", "8")], "constituent_ticker string, cik string")
    companies = spark.createDataFrame([("8",)], "cik string")
    flags = spark.createDataFrame([("8", True, None)], "cik string, active_flag boolean, inactive_reason string")
    got = {r.constituent_ticker: (r.active_flag, r.inactive_reason) for r in enrichment.label_activity(resolved, companies, flags).collect()}
    assert got == {"A": (False, "not_in_edgar_tickers"), "B": (True, None), "C": (True, None)}


def test_share_classes_fall_through_to_the_next_concept(spark):
    rows = [
        ("1", "first", 9, "2023-01-01", "10-K", "2023-02-01", "a"), ("1", "first", 5, "2023-01-01", "10-K", "2023-02-01", "a"),
        ("1", "first", 1, "2022-01-01", "10-K", "2022-02-01", "z"), ("1", "second", 77, "2022-12-01", "10-Q", "2022-12-31", "b"),
        ("2", "first", 0, "2023-01-01", "10-K", "2023-02-01", "c"), ("2", "second", 4, "2023-01-01", "8-K", "2023-02-01", "d"),
    ]
    points = spark.createDataFrame(rows, "cik string, concept string, val long, end string, form string, filed string, accn string")
    resolved = spark.createDataFrame([("X B", "1"), ("X", "1"), ("X.C", "1"), ("Y", "2"), ("Z", None)], "constituent_ticker string, cik string")
    got = rows_of(enrichment.shares_outstanding(points, resolved, ["first", "second"]))
    assert got == [("X", 77, date(2022, 12, 1)), ("X B", 9, date(2023, 1, 1)), ("X.C", 77, date(2022, 12, 1))]


def test_first_source_wins_per_key(spark):
    a = spark.createDataFrame([(1, "a")], "k int, v string")
    b = spark.createDataFrame([(1, "b"), (2, "b")], "k int, v string")
    assert rows_of(enrichment.first_source([a, b], ["k"])) == [(1, "a"), (2, "b")]


def test_first_source_breaks_ties_inside_a_source(spark):
    a = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (1, None, 0)], "k int, v string, n int")
    for rows in (a, a.orderBy(F.desc("n")), a.repartition(3)):
        assert rows_of(enrichment.first_source([rows], ["k"])) == [(1, "a", 2)]


def test_pages_by_seeking_and_by_rank_equal_pages_by_offset(spark):
    df = spark.createDataFrame([(i, None if i % 7 == 0 else float(i % 5)) for i in range(60)], "k int, v double").repartition(5)
    for up in (False, True):
        whole = [tuple(r) for r in df.orderBy(F.asc_nulls_last("v") if up else F.desc_nulls_last("v"), "k").collect()]
        last, met = None, []
        for number in range(1, 8):
            got = ranking.page(df, "v", "k", up, 1, 9) if last is None else ranking.page_after(df, "v", "k", last, up, 9)
            rows = [tuple(r) for r in got.collect()]
            assert rows == whole[(number - 1) * 9 : number * 9]
            met += rows
            last = (rows[-1][1], rows[-1][0]) if rows else last
        assert met == whole
        numbered = {(r["page"], r["place"]): (r["k"], r["v"]) for r in ranking.pages(df, "v", "k", up, 9).collect()}
        assert numbered == {(i // 9 + 1, i % 9 + 1): row for i, row in enumerate(whole)}


def test_joins_by_the_dimension_leave_company_documents_unread(spark):
    from fundledger.catalog import all_queries

    def parsed(name):
        return "from_json" in all_queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()

    assert parsed("dim_security")
    assert not any(parsed(n) for n in ("filing_catalog", "corporate_actions", "statements_annual", "silver_facts"))


def test_daily_changes_keep_first_seen_order(spark):
    rows = [("f", 9, "1", "late name", "10-K"), ("f", 3, "1", "first name", "8-K"), ("f", 5, "1", "x", "10-K"), ("f", 6, "1", "x", "")]
    df = spark.createDataFrame(rows, "path string, line long, cik string, company_name string, form string").withColumn("ingestion_date", F.lit("d"))
    row = filings.daily_changes(df).first()
    assert (row.company_name, row.forms_filed) == ("first name", '["8-K","10-K"]')


def test_one_filing_may_announce_two_events(spark):
    schema = "security_id string, cik string, form_type string, items string, filed_date date, period_of_report date, accession_number string"
    rows = [("s", "1", "SC 13E-3", "", D1, None, "a"), ("s", "1", "8-K", "5.03,9.01", D2, D1, "b"), ("s", "1", "8-K", "1.03", D2, None, "c"), ("s", "1", "10-K", None, D2, None, "d")]
    got = rows_of(filings.corporate_actions(spark.createDataFrame(rows, schema)).select("accession_number", "event_type", "event_date"))
    assert got == [("a", "going_private", D1), ("a", "merger_acquisition", D1), ("b", "stock_split", D1), ("c", "bankruptcy_filing", D2)]


FACTS = "cik string, namespace string, concept string, unit string, start string, `end` string, val decimal(22,2), form string, filed string, accn string"


def fact(concept, val, filed, start=None, form="10-K", namespace="us-gaap", accn=None):
    return ("1", namespace, concept, "USD", start, "2023-12-31", Decimal(val), form, filed, accn or filed)


def test_wide_facts_prefer_first_choice_then_latest_filing(spark):
    year = "2023-01-01"
    rows = [
        fact("Revenues", 10, "2024-02-01", year), fact("Revenues", 11, "2024-05-01", year, accn="amended"),
        fact("RevenueFromContractWithCustomerExcludingAssessedTax", 99, "2024-06-01", year),
        fact("Assets", 500, "2024-02-01"), fact("NetIncomeLoss", 3, "2024-02-01", "2023-06-01"),
        fact("Unmapped", 1, "2024-09-01", year),
    ]
    row = facts.financial_facts(spark.createDataFrame(rows, FACTS)).collect()
    assert len(row) == 1
    assert (row[0].revenues, row[0].total_assets, row[0].net_income) == (Decimal("11.00"), Decimal("500.00"), None)
    assert (row[0].filed_date, row[0].fiscal_period, row[0].taxonomy) == (date(2024, 6, 1), "FY", "us-gaap")


def test_foreign_taxonomy_only_when_nothing_else(spark):
    rows = [fact("Assets", 5, "2024-02-01", namespace="ifrs-full")]
    assert facts.financial_facts(spark.createDataFrame(rows, FACTS)).first().taxonomy == "ifrs-full"
    both = rows + [fact("Liabilities", 5, "2024-02-01")]
    assert facts.financial_facts(spark.createDataFrame(both, FACTS)).first().taxonomy == "us-gaap"


def test_pilot_reads_foreign_facts_only_without_domestic_ones(spark):
    rows = [fact("Assets", 5, "2024-02-01", namespace="ifrs-full"), fact("Liabilities", 6, "2024-02-01")]
    df = spark.createDataFrame(rows, FACTS).withColumn("label", F.lit("x"))
    assert [r.concept for r in facts.pilot_facts(df).collect()] == ["Liabilities"]
    assert [r.concept for r in facts.pilot_facts(df.where("namespace = 'ifrs-full'")).collect()] == ["Assets"]


def test_amended_fact_replaces_the_first(spark):
    rows = [fact("Assets", 5, "2024-02-01"), fact("Assets", 6, "2024-03-01"), fact("Assets", 7, "2024-01-01", form="10-Q")]
    got = rows_of(facts.dedup_amendments(spark.createDataFrame(rows, FACTS)).select("form", "val"))
    assert got == [("10-K", Decimal("6.00")), ("10-Q", Decimal("7.00"))]


def test_counts_with_and_without_nulls(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,), (" ",)], "x string")
    assert rows_of(counting.value_counts(df, "x", null_label="Unknown")) == [("Unknown", 2), ("a", 1), ("b", 2)]
    assert [tuple(r) for r in counting.mode_of(df.where("x in ('a', 'b')"), "x").collect()] == [("b", 2)]


def test_list_counts_and_bins(spark):
    df = spark.createDataFrame([("NYSE| nasdaq", 100.0), ("NASDAQ", 100.5)], "x string, v double")
    assert rows_of(counting.list_value_counts(df, "x")) == [("NASDAQ", 2), ("NYSE", 1)]
    assert rows_of(counting.bin_counts(df, "v", [100.0], ["low", "high"])) == [("high", 1), ("low", 1)]


def test_histogram_over_data_range_puts_the_largest_in_the_last(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "v double")
    got = rows_of(counting.data_histogram(df, "v", 10))
    assert got[0] == (1, 0.0, 0.0, 1) and got[-1] == (10, 9.0, 10.0, 2)
    same = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    assert rows_of(counting.data_histogram(same, "v", 10)) == [(1, 5.0, 5.0, 2)]


def test_duplicates_are_reported(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows_of(counting.duplicate_keys(df, ["k"])) == [(1, 2)]
    with pytest.raises(ValueError):
        counting.assert_unique(df, ["k"])


def test_null_weights_are_holdings_too(spark):
    rows = [("2024-01-01", "F.A", "X", None), ("2024-01-01", "F.A", "Y", 1.0), ("2024-01-01", "F B", "X", 2.0), ("2024-01-01", "F B", "Z", None),
            ("2023-01-01", "F.A", "X", None), ("2023-01-01", "F B", "X", 1.0)]
    df = spark.createDataFrame(rows, "as_of_date string, composite_ticker string, constituent_ticker string, weight double")
    row = overlap.overlap(df, ["F.A", "F B"]).first()
    assert (row.fund_a, row.overlap_count, row.overlap_by_weight, row.only_in_a, row.only_in_b) == ("F B", 1, 0.0, 1, 1)
    assert rows_of(overlap.only_in(df, "F B", "F.A")) == [("Z", None)]
    assert rows_of(overlap.shared_holdings(df, "F.A", "F B")) == [("X", None, 2.0, None)]
    found = {(r.composite_ticker, r.constituent_ticker): r.change for r in snapshots.holding_changes(df).collect()}
    assert found == {("F.A", "Y"): "new_holding", ("F B", "Z"): "new_holding"}


def test_one_third_equal_values_do_not_change_the_median(spark):
    df = spark.range(3000).select(F.lit("g").alias("g"), F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id").cast("double")).alias("v"))
    expected = np.median(np.array([r.v for r in df.collect()]))
    assert quantiles(df, ["g"], {"m": ("v", 0.5)}).first().m == expected


def test_sixth_value_of_a_filing_changes_no_class(spark):
    from fundledger.functions.text import CLASS_PLACES

    assert max(CLASS_PLACES.values()) < 5


def test_pages_have_a_size(spark):
    from fundledger.operators.ranking import page

    with pytest.raises(ValueError, match="200"):
        page(spark.range(3), "id", "id", size=201)


def test_reported_fiscal_period_comes_before_the_calendar(spark):
    rows = [("1", "us-gaap", "Assets", "2023-06-30", None, 5.0, "a1", "10-Q", "2023-08-01", 2023, "Q4"), ("2", "us-gaap", "Assets", "2023-06-30", None, 5.0, "a2", "10-Q", "2023-08-01", None, None)]
    df = spark.createDataFrame(rows, "cik string, namespace string, concept string, end string, start string, val double, accn string, form string, filed string, fy int, fp string")
    got = {r.cik: (r.fiscal_year, r.fiscal_period) for r in facts.financial_facts(df).collect()}
    assert got == {"1": (2023, "Q4"), "2": (2023, "Q2")}


def test_measures_across_tables_count_rows_once(spark):
    funds = spark.createDataFrame([("A", 100.0, 0.1, "x"), ("B", 10.0, 0.3, "x"), ("C", 1.0, None, None)], "composite_ticker string, aum double, net_expenses double, issuer string")
    securities = spark.createDataFrame([("p", "s1", "US"), ("q", "s1", "DE"), ("r", "s2", "US"), ("z", None, "US")], "constituent_ticker string, sector_name string, country_of_exchange string")
    rows = [("A", "p", 60.0), ("A", "q", 30.0), ("A", "r", 10.0), ("B", "p", 99.0), ("B", "gone", 1.0)]
    tables = {"holdings": spark.createDataFrame(rows, "composite_ticker string, constituent_ticker string, weight double"), "funds": funds, "securities": securities}
    got = {r["sector_name"]: (r["aum"], r["weight"], r["security_count"]) for r in semantic.measures_across(tables, ["fund size", "allocation", "security_count"], ["sector_name"]).collect()}
    # Fund A holds two securities of s1 and counts once there; C holds nothing.
    assert got == {"s1": (110.0, 189.0, 2), "s2": (100.0, 10.0, 1), None: (11.0, 1.0, 1)}
    whole = semantic.measures_across(tables, ["AUM", "position_count", "expense ratio"], []).collect()
    assert [tuple(r) for r in whole] == [(111.0, 5, pytest.approx(0.2))]
    only = semantic.measures_across(tables, ["aum", "weight"], ["issuer"], {"country": lambda c: c == "US"}).collect()
    assert {tuple(r) for r in only} == {("x", 110.0, 169.0)}
    both = semantic.measures_across(tables, ["aum"], ["issuer", "sector_name"]).collect()
    assert {tuple(r) for r in both} == {("x", "s1", 110.0), ("x", "s2", 100.0), ("x", None, 10.0), (None, None, 1.0)}
    assert semantic.resolve("funds.fund family", tables, []) == ("funds", "issuer")
    assert sum(len(w) for t in semantic.DECLARED.values() for w in t.values()) > 150
    for bad in ("no such thing", "funds.country_of_exchange"):
        with pytest.raises(ValueError):
            semantic.resolve(bad, tables, [])
    with pytest.raises(ValueError):
        semantic.resolve_measure("issuer")


def _weights(seed, funds, securities, most):
    """Positions whose weights sum to 100 a fund; low security numbers are common, and some funds are alike."""
    rng, rows = random.Random(seed), []
    for f in range(funds):
        if f % 7 == 6:
            rows += [("2024-01-01", f"F{f}", s, w * rng.uniform(0.8, 1)) for _, g, s, w in list(rows) if g == f"F{f - 1}"]
            continue
        held = {int(securities * rng.random() ** 3) for _ in range(rng.randint(1, most))}
        raw = {s: rng.random() for s in held}
        rows += [("2024-01-01", f"F{f}", f"S{s}", 100 * w / sum(raw.values())) for s, w in raw.items()]
    return rows


@pytest.mark.parametrize("least", [3, 5])
def test_overlap_above_compares_what_pairs_did_not_meet_in(spark, least):
    """Most pairs share one security, so a pair must not bring all positions of a fund."""
    rows = _weights(least, 150, 600, 40)
    df = spark.createDataFrame([*rows, *rows[:40]], "as_of_date string, composite_ticker string, constituent_ticker string, weight double")
    placed, part = overlap.rare_parts(df, least)
    met = overlap.met_pairs(part)
    sizes = placed.groupBy("fund").agg(F.count("*").alias("size"))
    whole = met.join(sizes, met.fund_a == sizes.fund).agg(F.sum("size")).first()[0]
    assert 0 < overlap.rest_of_pairs(placed, met).count() < whole / 4
    # Rows that come twice count as often as they meet.
    a, b = overlap._sides(placed)
    every = a.join(b, "security").where("fund_a < fund_b").groupBy("fund_a", "fund_b").agg(F.count("*").alias("n"), F.round(F.sum(F.least("wa", "wb")), 6).alias("w"))
    got = overlap.overlap_above(df, least).select("fund_a", "fund_b", "overlap_count", F.round("overlap_by_weight", 6))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, every.join(met, ["fund_a", "fund_b"], "left_semi").where(F.col("w") >= least).collect()))


@pytest.mark.parametrize("least", [0.5, 30, 80])
def test_overlap_above_equals_brute_force(spark, least):
    rows = [*_weights(int(least), 120, 3000, 60), ("2024-01-01", "F0", "S-none", None), ("2023-01-01", "F1", "S0", 100.0)]
    df = spark.createDataFrame(rows, "as_of_date string, composite_ticker string, constituent_ticker string, weight double")
    own = {}
    for day, f, s, w in rows:
        if w and day == "2024-01-01":
            own.setdefault(f, {})[s] = w
    brute = {}
    for a, b in itertools.combinations(sorted(own), 2):
        common = [min(w, own[b][s]) for s, w in own[a].items() if s in own[b]]
        if sum(common) >= least:
            brute[a, b] = (len(common), pytest.approx(sum(common)))
    got = {(r["fund_a"], r["fund_b"]): (r["overlap_count"], r["overlap_by_weight"]) for r in overlap.overlap_above(df, least).collect()}
    assert got == brute and len(brute) > 10
    if least == 80:
        sharing = sum(bool(own[a].keys() & own[b].keys()) for a, b in itertools.combinations(own, 2))
        assert overlap.candidate_pairs(overlap.rare_parts(df, least)[1]).count() < sharing / 5
    with pytest.raises(ValueError):
        overlap.overlap_above(df, 0)


def test_tickers_are_spelled_once_each(spark):
    df = spark.createDataFrame([("AB",), ("A.B",), ("A B",), (None,)], "constituent_ticker string")
    got = {}
    for r in enrichment.spelled_tickers(df).orderBy("_place").collect():
        got.setdefault(r["constituent_ticker"], []).append(r["ticker"])
    assert got == {"AB": ["AB"], "A.B": ["A.B", "A-B", "AB"], "A B": ["A B", "A-B", "AB", "A.B"], None: [None]}
