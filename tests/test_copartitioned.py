from datetime import date

import pytest
from pyspark.sql import functions as F

from fundledger.operators import facts, filings
from fundledger.plans import layers
from fundledger.sources import copartitioned
from fundledger.sources.copartitioned import SALT

BUCKETS, SALTS = 6, 4


@pytest.fixture
def silver(spark):
    """Security 0 owns over a third of all rows; 7 files but is not in the dimension; one row has no key."""
    dim = spark.range(5).select(
        F.concat(F.lit("S"), "id").alias("security_id"), F.col("id").cast("string").alias("cik"), F.concat(F.lit("T"), "id").alias("ticker"),
        F.lit("n").alias("company_name"), F.lit("NYSE").alias("exchange"), F.lit(True).alias("active_flag"),
    )
    n = F.col("id")
    owner = F.when(n % 5 < 2, 0).when(n % 11 == 3, 7).otherwise(n % 5)
    keys = [F.when(n != 13, F.concat(F.lit("S"), owner)).alias("security_id"), owner.cast("string").alias("cik")]
    day = F.date_add(F.lit(date(2000, 1, 1)), n.cast("int"))
    form = F.when(n % 2 == 0, "10-Q").otherwise("10-K")
    rows = spark.range(300)
    money = [F.when(n % 7 != 0, n).cast("decimal(22,2)").alias(c) for c in (*facts._STATEMENT, "shares_outstanding")]
    index = rows.select(
        *keys, n.cast("string").alias("accession_number"), form.alias("form_type"), day.alias("filed_date"), day.alias("period_of_report"),
        F.lit("u").alias("filing_url"), F.lit("d").alias("primary_document"), F.lit("8.01").alias("items"),
    )
    events = index.select("security_id", "cik", F.lit("x").alias("event_type"), F.col("filed_date").alias("event_date"), F.lit(None).cast("date").alias("effective_date"), "form_type", "filed_date", F.col("accession_number").alias("description"))
    return {
        "dim_security": dim,
        "filings_index": index,
        "financial_facts": rows.select(
            *keys, day.alias("period_end"), form.alias("form_type"), day.alias("filed_date"), F.lit(2000).alias("fiscal_year"), F.lit("Q1").alias("fiscal_period"),
            F.lit("us-gaap").alias("taxonomy"), *money,
        ),
        "corporate_actions": events,
    }


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_gold_of_bucketed_silver_is_the_same_and_moves_nothing(spark, silver, no_broadcast):
    plain, laid = layers.to_gold(silver, stamp="2024-01-01 00:00:00"), layers.bucket_silver(silver, BUCKETS, SALTS)
    gold = layers.to_gold(laid, stamp="2024-01-01 00:00:00")
    for name, df in gold.items():
        assert df.columns == plain[name].columns and as_rows(df) == as_rows(plain[name]) != [], name
    for name in ("financial_statements_annual", "filing_catalog", "corporate_events"):
        assert "Exchange" not in plan_of(gold[name]) and "Exchange" in plan_of(plain[name]), name
    # Quarters: the cut inside the buckets stands below the only exchange of facts.
    quarters = plan_of(facts.last_quarters(laid["financial_facts"]))
    assert quarters.count("Exchange") == 1 and "Window" in quarters.split("Exchange")[1]


def test_a_hot_security_is_spread_over_buckets(spark, silver):
    laid = layers.bucket_silver(silver, BUCKETS, SALTS)
    rows = laid["financial_facts"]
    assert rows.where("security_id = 'S0'").select(SALT).distinct().count() == SALTS
    files = rows.groupBy(F.input_file_name()).agg(F.countDistinct("security_id", SALT).alias("n")).collect()
    assert 1 < len(files) <= BUCKETS and sum(r.n for r in files) == rows.select("security_id", SALT).distinct().count() - rows.where("security_id is null").select(SALT).distinct().count()
    assert laid["dim_security"].count() == SALTS * silver["dim_security"].count()
    assert as_rows(copartitioned.one_copy(laid["dim_security"])) == as_rows(silver["dim_security"])
    assert as_rows(rows.drop(SALT)) == as_rows(silver["financial_facts"])


def test_empty_tables_and_misuse(spark, silver):
    empty = layers.to_gold(layers.bucket_silver({k: df.where("false") for k, df in silver.items()}, BUCKETS, SALTS))
    assert all(df.count() == 0 for df in empty.values())
    laid = layers.bucket_silver({"dim_security": silver["dim_security"]}, BUCKETS, SALTS)
    with pytest.raises(ValueError, match="multiply"):
        filings.filing_catalog(silver["filings_index"], laid["dim_security"])
    with pytest.raises(ValueError, match="already"):
        copartitioned.salted(laid["dim_security"], ["ticker"], SALTS)


def test_tables_are_declared_again_over_their_files(spark, silver, no_broadcast, tmp_path):
    keys, made = ["security_id", SALT], {}
    for name in ("dim_security", "filings_index"):
        rows = silver[name]
        laid = copartitioned.replicated(rows, SALTS) if name == "dim_security" else copartitioned.salted(rows, ["accession_number"], SALTS)
        copartitioned.write_bucketed(laid, f"first_{name}", f"{tmp_path}/{name}", keys, BUCKETS)
        made[name] = copartitioned.declare_bucketed(spark, f"again_{name}", f"{tmp_path}/{name}", laid.schema.toDDL(), keys, BUCKETS)
    got = filings.filing_catalog(made["filings_index"], made["dim_security"])
    assert "Exchange" not in plan_of(got)
    assert as_rows(got) == as_rows(filings.filing_catalog(silver["filings_index"], silver["dim_security"]))
    (tmp_path / "dim_security" / "_SUCCESS").unlink()
    with pytest.raises(ValueError, match="whole"):
        copartitioned.declare_bucketed(spark, "third", f"{tmp_path}/dim_security", "security_id string", keys, BUCKETS)
