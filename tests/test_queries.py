"""Registered queries against their SQL: every one, or with FUNDLEDGER_SOME=1 a selection."""

import os

import pytest
from check import compare, connect

import __spark_entry__ as registered
from fundledger.catalog import all_checks, all_queries

SF = "/root/testdata/sf0.001"
SELECTION = """best_snapshot snapshot_overview holding_changes concentration_multi asset_class_summary fund_memberships
overlap_pairs overlap_against_largest screener aum_running_share key_findings security_master country_activity alerts
daily_changes corporate_actions financial_facts company_profile enriched_securities submission_filings fact_documents
bronze_write_once load_new_files stream_once_per_accession measures_by_issuer""".split()
NAMES = SELECTION if os.environ.get("FUNDLEDGER_SOME") else sorted(all_queries())


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_its_sql(spark, duck, name):
    outcome, detail, _ = compare(spark, duck, SF, name, registered.queries()[name], registered.oracle_sql().get(name))
    assert outcome in ("same", "rows only"), f"{outcome}: {detail}"


def test_entry_runs(spark):
    assert registered.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(all_checks()) == set(all_queries()) <= set(registered.queries())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_positions_are_limited_before_the_shuffle(spark):
    text = plan(registered.queries()["concentration_top10"](spark, SF))
    assert text.count("WindowGroupLimit") == 2


def test_scans_read_only_needed_columns(spark):
    text = plan(registered.queries()["fund_rollup"](spark, SF))
    assert "l_comment" not in text and "l_tax" not in text and "CartesianProduct" not in text
