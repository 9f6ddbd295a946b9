"""Tagged financial facts: selection, de-duplication and statements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundledger.functions.codes import (
    ANNUAL_FORMS,
    CONCEPT_COLUMNS,
    PILOT_CONCEPTS,
    QUARTERLY_FORMS,
    concept_frame,
)
from fundledger.functions.dates import ANNUAL_DAYS, fiscal_period, iso_date, period_days, period_type
from fundledger.functions.numbers import half_up, safe_ratio
from fundledger.operators.ranking import latest_per_key, top_per_group
from fundledger.sources.copartitioned import SALT, join_keys, one_copy
from fundledger.sources.layers import ensure_columns

MONEY = "decimal(22,2)"
PER_SHARE = "decimal(14,4)"
COUNT = "decimal(20,0)"


def _column_type(name: str) -> str:
    if name.startswith("eps_"):
        return PER_SHARE
    return COUNT if name == "shares_outstanding" else MONEY


def facts_profile(facts: DataFrame) -> DataFrame:
    """Rows, companies and distinct concepts of each namespace."""
    return facts.groupBy("namespace").agg(
        F.count("*").alias("rows"),
        F.count_distinct("concept").alias("concepts"),
        F.count_distinct("cik").alias("companies"),
    )


def dedup_amendments(
    facts: DataFrame,
    keys: tuple[str, ...] = ("cik", "namespace", "concept", "unit", "start", "end", "form"),
) -> DataFrame:
    """The value filed last for each key (highest accession, then value, on ties)."""
    return latest_per_key(facts, list(keys), [F.desc("filed"), F.desc("accn"), F.desc("val")])


def annual_revenue(facts: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` latest yearly revenues of each company, in billions."""
    rows = facts.where(
        (F.col("namespace") == "us-gaap")
        & F.col("concept").isin("Revenues", "RevenueFromContractWithCustomerExcludingAssessedTax")
        & (F.col("unit") == "USD")
        & F.col("form").isin(ANNUAL_FORMS)
        & period_days("start", "end").between(*ANNUAL_DAYS)
    ).select("cik", "end", "val", "form", "filed", "frame", "accn")
    latest = top_per_group(
        rows, ["cik"], [F.desc("end"), F.desc("filed"), F.desc("accn"), F.desc("val")], n
    )
    return latest.drop("accn").withColumn("revenue_bn", F.col("val").cast("double") / 1e9)


def first_per(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """First row of each key in the given order."""
    return top_per_group(df, keys, order, 1)


def pivot_years(revenue: DataFrame, value: str = "revenue_bn") -> DataFrame:
    """One row per company, one column per year that occurs (first row of a year wins by latest end).

    Spark looks the years up first, and refuses more than ``spark.sql.pivotMaxValues`` of them.
    """
    rows = first_per(
        revenue.withColumn("_year", F.year(iso_date("end"))),
        ["cik", "_year"],
        [F.desc("end"), F.desc("filed"), F.desc(value)],
    )
    return rows.groupBy("cik").pivot("_year").agg(F.first(value))


def pilot_facts(facts: DataFrame) -> DataFrame:
    """Annual and instant values of twelve concepts: us-gaap, and ifrs-full only where us-gaap has none."""
    rows = facts.where(
        F.col("namespace").isin("us-gaap", "ifrs-full") & F.col("concept").isin(PILOT_CONCEPTS)
    ).withColumn("period_type", period_type("start", "end"))
    rows = rows.where(F.col("period_type").isin("annual", "instant"))
    domestic = rows.where(F.col("namespace") == "us-gaap").select("cik").distinct()
    foreign = rows.where(F.col("namespace") == "ifrs-full").join(domestic, "cik", "left_anti")
    return (
        rows.where(F.col("namespace") == "us-gaap")
        .unionByName(foreign)
        .select(
            "cik", "concept", "label", "unit", F.col("end").alias("end_date"),
            half_up("val").alias("value"), "accn", "form", "filed", "period_type",
        )
    )


def mapped_facts(facts: DataFrame) -> DataFrame:
    """Facts that feed a statement column, of a period that fits their form.

    Yearly forms keep yearly and instant values, quarterly forms quarterly and instant ones;
    year-to-date sums drop out. The mapping has 24 rows and is broadcast, before any shuffle.
    """
    mapping = concept_frame(facts.sparkSession)
    own = F.when(F.col("form").isin(ANNUAL_FORMS), "annual").when(F.col("form").isin(QUARTERLY_FORMS), "quarterly")
    rows = facts.where(own.isNotNull() & period_type("start", "end").isin(own, F.lit("instant")))
    return rows.join(F.broadcast(mapping), ["namespace", "concept"])


def financial_facts(facts: DataFrame) -> DataFrame:
    """Wide facts per company, period end and form: the first-choice concept's last filed value.

    Two aggregations with map-side combine: one per statement column, then the pivot over the fixed
    twelve columns. An amendment replaces the values it states and leaves the others. Fiscal year and
    period are those the last filing reports; only where none does, the calendar's.
    """
    facts = ensure_columns(facts, {"fy": "int", "fp": "string"})
    key = ["cik", "end", "form"]
    best = F.struct(-F.col("priority"), F.col("filed"), F.col("accn"), F.col("val"))
    chosen = (
        mapped_facts(facts)
        .groupBy(*key, "statement_column")
        .agg(
            F.max(
                F.struct(
                    best.alias("order"), F.col("namespace"), F.col("start"), F.col("val"),
                )
            ).alias("_top"),
            F.max("filed").alias("_filed"),
            F.max(F.when(F.col("fp").isNotNull(), F.struct("filed", "fy", "fp"))).alias("_said"),
        )
    )
    columns = [
        F.max(F.when(F.col("statement_column") == c, F.col("_top.val"))).cast(_column_type(c)).alias(c)
        for c in CONCEPT_COLUMNS
    ]
    foreign = F.min(F.when(F.col("_top.namespace") == "ifrs-full", 1).otherwise(0))
    wide = chosen.groupBy(*key).agg(
        F.max("_filed").alias("_filed"), F.max("_said").alias("_said"), F.max("_top.start").alias("_start"), foreign.alias("_foreign"), *columns
    )
    end = iso_date("end")
    return wide.select(
        "cik",
        end.alias("period_end"),
        iso_date("_start").alias("period_start"),
        F.col("form").alias("form_type"),
        iso_date("_filed").alias("filed_date"),
        F.coalesce("_said.fy", F.year(end)).alias("fiscal_year"),
        F.coalesce("_said.fp", fiscal_period(F.lit(None).cast("string"), end, "form")).alias("fiscal_period"),
        F.when(F.col("_foreign") == 1, "ifrs-full").otherwise("us-gaap").alias("taxonomy"),
        *CONCEPT_COLUMNS,
    )


def silver_facts(facts: DataFrame, dim: DataFrame) -> DataFrame:
    """Wide facts keyed by security."""
    return financial_facts(facts).join(dim.select("cik", "security_id"), "cik")


_STATEMENT = [c for c in CONCEPT_COLUMNS if c != "shares_outstanding"]


def statements_annual(silver: DataFrame, dim: DataFrame, zero: str = "null") -> DataFrame:
    """Yearly statements with ticker, name and three ratios; a zero denominator gives null or 0."""
    on = join_keys(silver, dim, ["security_id"])
    names = dim.select(*on, "ticker", "company_name", "exchange")
    rows = silver.where(F.col("form_type").isin(ANNUAL_FORMS)).join(names, on)
    ratio = "decimal(10,6)"
    return rows.select(
        "security_id", "cik", "ticker", "company_name", "exchange", "fiscal_year", "period_end",
        "form_type", "filed_date", "taxonomy", *_STATEMENT,
        safe_ratio("net_income", "revenues", zero).try_cast(ratio).alias("net_margin"),
        safe_ratio("net_income", "stockholders_equity", zero).try_cast(ratio).alias("return_on_equity"),
        safe_ratio("long_term_debt", "stockholders_equity", zero).try_cast(ratio).alias("debt_to_equity"),
    )


def last_quarters(silver: DataFrame, n: int = 8) -> DataFrame:
    """The ``n`` latest quarterly rows of each security; salted tables are cut inside their buckets first."""
    rows, order = silver.where(F.col("form_type").isin(QUARTERLY_FORMS)), [F.desc("period_end"), F.asc("form_type")]
    if SALT in rows.columns:
        rows = top_per_group(rows, ["security_id", SALT], order, n)
    return top_per_group(rows, ["security_id"], order, n)


def statements_quarterly(silver: DataFrame, dim: DataFrame, n: int = 8) -> DataFrame:
    """The ``n`` latest quarters of each security with ticker and name."""
    names = one_copy(dim).select("security_id", "ticker", "company_name", "exchange")
    return last_quarters(silver, n).join(names, "security_id").select(
        "security_id", "cik", "ticker", "company_name", "exchange", "fiscal_year", "fiscal_period",
        "period_end", "form_type", "filed_date", "taxonomy", *_STATEMENT,
    )


def company_profile(
    dim: DataFrame, filings: DataFrame, silver: DataFrame, companies: DataFrame | None = None, flags: DataFrame | None = None
) -> DataFrame:
    """One row per security: what the company is, whether it is active, its last reports and key figures.

    Filings and facts are reduced to one row per security before the join. ``companies`` are flattened
    submissions and ``flags`` activity flags, one row per company each; without them their columns are
    null, and the dimension's flag stands.
    """
    dates = filings.groupBy("security_id").agg(
        F.max(F.when(F.col("form_type") == "10-K", F.col("filed_date"))).alias("latest_10k_date"),
        F.max(F.when(F.col("form_type") == "10-Q", F.col("filed_date"))).alias("latest_10q_date"),
    )

    def last(column: str):
        known = F.col(column).isNotNull()
        return F.max_by(
            F.when(known, F.col(column)),
            F.when(known, F.struct("period_end", "filed_date", "form_type")),
        )

    figures = silver.groupBy("security_id").agg(
        last("revenues").alias("latest_revenues"),
        last("total_assets").alias("latest_total_assets"),
        last("shares_outstanding").alias("latest_shares_outstanding"),
        last("eps_diluted").alias("latest_eps_diluted"),
    )
    base = one_copy(dim).select("security_id", "cik", "ticker", "company_name", "exchange", F.col("active_flag").alias("_known"))
    named = {"sic": "sic", "sicDescription": "sic_description", "stateOfIncorporation": "state_of_incorporation", "fiscalYearEnd": "fiscal_year_end"}
    if companies is None:
        base = base.withColumns({name: F.lit(None).cast("string") for name in named.values()})
    else:
        base = base.join(companies.select("cik", *[F.col(c).alias(n) for c, n in named.items()]), "cik", "left")
    if flags is None:
        base = base.withColumns({"active_flag": F.col("_known"), "inactive_reason": F.lit(None).cast("string")})
    else:
        base = base.join(flags.select("cik", "active_flag", "inactive_reason"), "cik", "left").withColumn("active_flag", F.coalesce("active_flag", "_known"))
    return base.drop("_known").join(dates, "security_id", "left").join(figures, "security_id", "left")


def concept_points(facts: DataFrame, unit: str = "shares") -> DataFrame:
    """Values of one unit, as the share-count selection reads them."""
    return facts.where(F.col("unit") == unit).select("cik", "concept", "val", "end", "form", "filed", "accn")

