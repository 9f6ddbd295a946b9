"""Joining registry data (company numbers, submissions, share counts) onto the security master."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundledger.functions.codes import DEREGISTRATION_FORMS, REPORT_FORMS
from fundledger.functions.dates import iso_date
from fundledger.functions.keys import cik_plain
from fundledger.functions.text import CLASS_PLACES, class_place, join_distinct, strip_markup, ticker_spellings
from fundledger.operators.ranking import top_per_group

# Enrichment columns of the security master and their types.
ENRICHMENT_COLUMNS = {
    "edgar_cik": "string",
    "edgar_name": "string",
    "sic_code": "string",
    "sic_description": "string",
    "state_of_inc": "string",
    "ein": "string",
    "entity_type": "string",
    "listed_exchanges": "string",
    "filer_category": "string",
    "active_flag": "boolean",
    "inactive_reason": "string",
    "shares_outstanding": "bigint",
    "shares_as_of_date": "date",
    "edgar_enriched_at": "timestamp_ntz",
}

# Wordings of the two reasons, as the loader and as the pilot report them.
REASONS = {
    "loader": ("deregistration_", "no_recent_10k_10q"),
    "pilot": ("Filed form ", "No recent 10-K/10-Q within 2 years"),
}


def enrichment_targets(securities: DataFrame) -> DataFrame:
    """Domestic (or unplaced) equities that were not enriched yet."""
    here = F.col("country_of_exchange").isNull() | (F.col("country_of_exchange") == "US")
    return securities.where(
        (F.col("asset_class") == "Equity") & here & F.col("edgar_enriched_at").isNull()
    )


def spelled_tickers(securities: DataFrame) -> DataFrame:
    """constituent_ticker, _place, ticker: a short row for each different spelling of a security's ticker.

    The rows are dealt out first: the master may be one file that one task reads.
    """
    different = F.array_distinct(ticker_spellings("constituent_ticker"))
    return securities.select("constituent_ticker").hint("rebalance").select(
        "constituent_ticker", F.posexplode(different).alias("_place", "ticker")
    )


def resolve_cik(securities: DataFrame, ticker_map: DataFrame) -> DataFrame:
    """Ten-digit company number of each security: the first of six spellings the registry lists.

    Both sides are keyed by spelling, so the registry may be of any size.
    """
    spelled = spelled_tickers(securities)
    found = (
        spelled.join(ticker_map.select("ticker", "cik"), "ticker")
        .groupBy("constituent_ticker")
        .agg(F.min_by("cik", "_place").alias("cik"))
    )
    return securities.join(found, "constituent_ticker", "left")


def active_flags(
    filings: DataFrame,
    as_of: str,
    dereg_forms: list[str] = DEREGISTRATION_FORMS,
    days: int = 730,
    wording: str = "loader",
) -> DataFrame:
    """Per company with submissions: is it active on ``as_of``, and if not, why.

    The newest deregistration form decides; without one, a report within ``days`` keeps it active.
    """
    gone, stale = REASONS[wording]
    newest = F.struct(F.col("filingDate"), F.col("accessionNumber"))
    cutoff = F.date_sub(F.lit(as_of).cast("date"), days)
    facts = filings.groupBy("cik").agg(
        F.max_by(
            F.when(F.col("form").isin(dereg_forms), F.col("form")),
            F.when(F.col("form").isin(dereg_forms), newest),
        ).alias("_dereg"),
        F.max(F.when(F.col("form").isin(REPORT_FORMS), iso_date("filingDate"))).alias("_report"),
    )
    recent = F.coalesce(F.col("_report") >= cutoff, F.lit(False))
    return facts.select(
        "cik",
        (F.col("_dereg").isNull() & recent).alias("active_flag"),
        F.when(F.col("_dereg").isNotNull(), F.concat(F.lit(gone), F.col("_dereg")))
        .when(~recent, F.lit(stale))
        .alias("inactive_reason"),
    )


def label_activity(resolved: DataFrame, companies: DataFrame, flags: DataFrame) -> DataFrame:
    """Active flag of every security: no number, number without submission, or the company's flag."""
    known = companies.select("cik", F.lit(True).alias("_known"))
    rows = resolved.join(known, "cik", "left").join(
        flags.withColumnsRenamed({"active_flag": "_flag", "inactive_reason": "_reason"}), "cik", "left"
    )
    no_number, no_submission = F.col("cik").isNull(), F.col("_known").isNull()
    return rows.withColumns(
        {
            "active_flag": F.when(no_number, False)
            .when(no_submission, True)
            .otherwise(F.coalesce(F.col("_flag"), F.lit(False))),
            "inactive_reason": F.when(no_number, "not_in_edgar_tickers")
            .when(no_submission, F.lit(None))
            .when(F.col("_flag").isNull(), "no_recent_10k_10q")
            .otherwise(F.col("_reason")),
        }
    ).drop("_known", "_flag", "_reason")


def _latest_points(points: DataFrame) -> DataFrame:
    """The five smallest values of each company's and concept's latest filing, ranked, with their number.

    Five places cover every share class, and whether a filing has one value or several shows in
    those rows too, so nothing beyond them is needed.
    """
    usable = points.where(
        F.col("form").isin(REPORT_FORMS) & (F.col("val") != 0) & F.col("filed").isNotNull()
    )
    key = ["cik", "concept"]
    # Only the last day's rows leave a task; the filing's form is that of the day's highest accession.
    newest = usable.withColumn("_day", F.rank().over(Window.partitionBy(*key).orderBy(F.desc("filed")))).where("_day = 1")
    last = Window.partitionBy(*key).orderBy(F.desc("accn"), F.desc("form"))
    same = newest.withColumn("_form", F.first("form").over(last)).where(F.col("form") == F.col("_form"))
    ranked = top_per_group(
        same.select(*key, "val", "end", "accn"),
        key,
        [F.asc("val"), F.asc("end"), F.asc("accn")],
        max(CLASS_PLACES.values()) + 1,
        rank="_place",
    )
    return ranked.withColumn("_points", F.count("*").over(Window.partitionBy(*key)))


def shares_outstanding(points: DataFrame, resolved: DataFrame, concepts: list[str]) -> DataFrame:
    """Share count of each security from its company's latest filing, by concept in order of choice.

    One value in the filing is taken as it is. Several are share classes in rising order, and the
    ticker's suffix picks one. What neither settles goes to the next concept.
    """
    concept = F.col("concept")
    order = F.array_position(F.array(*[F.lit(c) for c in concepts]), concept)
    latest = _latest_points(points.where(concept.isin(concepts))).withColumn("_order", order)
    wanted = resolved.where(F.col("cik").isNotNull()).select(
        "constituent_ticker", "cik", class_place("constituent_ticker").alias("_class")
    )
    fits = F.when(F.col("_points") == 1, F.col("_place") == 1).otherwise(
        F.col("_place") == F.col("_class") + 1
    )
    chosen = (
        wanted.join(latest, "cik")
        .where(fits)
        .groupBy("constituent_ticker")
        .agg(F.min_by(F.struct(F.col("val"), F.col("end")), "_order").alias("_hit"))
    )
    return chosen.select(
        "constituent_ticker",
        F.col("_hit.val").cast("bigint").alias("shares_outstanding"),
        iso_date("_hit.end").alias("shares_as_of_date"),
    )


def company_facts(companies: DataFrame) -> DataFrame:
    """Submission rows as enrichment columns: category without markup, exchanges as a list text."""
    exchanges = F.from_json("exchanges", "array<string>")
    return companies.select(
        "cik",
        F.col("name").alias("edgar_name"),
        F.col("sic").alias("sic_code"),
        F.col("sicDescription").alias("sic_description"),
        F.col("stateOfIncorporation").alias("state_of_inc"),
        "ein",
        F.col("entityType").alias("entity_type"),
        join_distinct(exchanges).alias("listed_exchanges"),
        strip_markup("category").alias("filer_category"),
    )


def enrich_securities(
    securities: DataFrame,
    ticker_map: DataFrame,
    companies: DataFrame,
    filings: DataFrame,
    points: DataFrame,
    as_of: str,
    concepts: list[str] = ("EntityCommonStockSharesOutstanding", "CommonStockSharesOutstanding"),
) -> DataFrame:
    """Enrichment columns of every given security, in one plan of joins."""
    resolved = resolve_cik(securities.select("constituent_ticker"), ticker_map)
    labelled = label_activity(resolved, companies, active_flags(filings, as_of))
    shares = shares_outstanding(points, resolved, list(concepts))
    return (
        labelled.join(company_facts(companies), "cik", "left")
        .join(shares, "constituent_ticker", "left")
        .withColumn("edgar_cik", cik_plain("cik"))
        .drop("cik")
    )


def apply_enrichment(securities: DataFrame, enriched: DataFrame, stamp: Column) -> DataFrame:
    """Overwrite the enrichment columns of the securities that were enriched; others stay as they were."""
    columns = [c for c in ENRICHMENT_COLUMNS if c != "edgar_enriched_at"]
    new = enriched.select(
        "constituent_ticker",
        F.lit(True).alias("_hit"),
        *[F.col(c).alias(f"_new_{c}") for c in columns],
    )
    joined = securities.join(new, "constituent_ticker", "left")
    hit = F.col("_hit").isNotNull()
    return joined.withColumns(
        {
            **{c: F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns},
            "edgar_enriched_at": F.when(hit, stamp).otherwise(F.col("edgar_enriched_at")),
        }
    ).drop("_hit", *[f"_new_{c}" for c in columns])


def enrichment_report(enriched: DataFrame) -> DataFrame:
    """Outcome counters of an enrichment run, in one row."""
    return enriched.agg(
        F.count("*").alias("ok"),
        F.count_if("active_flag").alias("active"),
        F.count_if(~F.col("active_flag")).alias("inactive"),
        F.count("shares_outstanding").alias("shares"),
        F.count_if(F.col("edgar_cik").isNull()).alias("no_cik"),
    )


def first_source(sources: list[DataFrame], keys: list[str]) -> DataFrame:
    """Union of sources in order of preference; each key keeps the row of its first source.

    Of several rows in that source the smallest stays, by all columns in order, nulls last.
    """
    tagged = [s.withColumn("_source", F.lit(i)) for i, s in enumerate(sources)]
    together = tagged[0]
    for other in tagged[1:]:
        together = together.unionByName(other, allowMissingColumns=True)
    order = [F.asc("_source"), *[F.asc_nulls_last(c) for c in together.columns if c not in (*keys, "_source")]]
    return top_per_group(together, keys, order, 1).drop("_source")
