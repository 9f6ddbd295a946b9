"""Queries over the security master, its enrichment and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundledger.catalog import views as v
from fundledger.catalog.registry import d, r, register
from fundledger.functions.codes import COUNTRY_CODES, REGIONS, CENTROIDS, country_frame, map_codes
from fundledger.functions.status import reason_label, with_status
from fundledger.operators import counting, searching, securities as sec, snapshots as s
from fundledger.operators.alerts import alert_counts, alerts
from fundledger.operators.quantiles import median_by
from fundledger.operators.ranking import top_n
from fundledger.plans.profiles import security_profiles
from fundledger.session import scratch_path
from fundledger.catalog.holdings import _CHANGES

_STATUS = "CASE WHEN active_flag THEN 'Active' WHEN NOT active_flag THEN 'Inactive' ELSE 'Not Enriched' END"

# --- building and checking the master

_MASTER = """clean AS (SELECT as_of_date, composite_ticker, upper(trim(constituent_ticker)) AS constituent_ticker, trim(constituent_name) AS constituent_name,
  trim(asset_class) AS asset_class, trim(security_type) AS security_type, trim(country_of_exchange) AS country_of_exchange, trim(exchange) AS exchange,
  trim(currency_traded) AS currency_traded, NULLIF(trim(cusip), '') AS cusip, NULLIF(trim(isin), '') AS isin FROM dirty_holdings
  WHERE constituent_ticker IS NOT NULL AND trim(constituent_ticker) <> ''),
master AS (SELECT * EXCLUDE (as_of_date, composite_ticker) FROM clean
  QUALIFY ROW_NUMBER() OVER (PARTITION BY constituent_ticker ORDER BY as_of_date DESC, composite_ticker) = 1)"""


def _master(spark, sf):
    return sec.securities(v.dirty_identities(spark, sf))


register("security_master", _master, "dirty_holdings", f"WITH {_MASTER} SELECT * FROM master")
register(
    "master_checks",
    lambda spark, sf: counting.uniqueness(_master(spark, sf), "constituent_ticker", ["isin", "cusip"]),
    "dirty_holdings",
    f"WITH {_MASTER} SELECT COUNT(*) AS total_rows, COUNT(DISTINCT constituent_ticker) AS unique_keys, COUNT(isin) AS with_isin, COUNT(cusip) AS with_cusip FROM master",
)
register(
    "duplicate_positions",
    lambda spark, sf: counting.duplicate_keys(v.dirty_holdings(spark, sf), ["as_of_date", "composite_ticker", "constituent_ticker"]),
    "dirty_holdings",
    f"""SELECT {d('as_of_date')} AS as_of_date, composite_ticker, constituent_ticker, COUNT(*) AS n FROM dirty_holdings
    GROUP BY dirty_holdings.as_of_date, composite_ticker, constituent_ticker HAVING COUNT(*) > 1""",
)
register(
    "odd_tickers",
    lambda spark, sf: sec.bad_tickers(v.dirty_holdings(spark, sf)),
    "dirty_holdings",
    r"""SELECT constituent_ticker, COUNT(*) AS n FROM dirty_holdings WHERE constituent_ticker <> upper(trim(constituent_ticker))
    OR regexp_matches(constituent_ticker, '[^A-Z0-9.\-]') GROUP BY 1""",
)
_PROFILED = ["constituent_ticker", "constituent_name", "asset_class", "security_type", "exchange", "currency_traded", "cusip", "isin"]
register(
    "null_profile",
    lambda spark, sf: counting.null_profile(v.dirty_holdings(spark, sf), _PROFILED, "constituent_ticker"),
    "dirty_holdings",
    "SELECT COUNT(*) AS total_rows, " + ", ".join(f"COUNT(*) FILTER ({c} IS NULL) AS null_{c}" for c in _PROFILED)
    + ", COUNT(*) FILTER (trim(constituent_ticker) = '') AS blank_constituent_ticker FROM dirty_holdings",
)
register(
    "quality_report",
    lambda spark, sf: counting.quality_report(
        v.dirty_holdings(spark, sf), "holdings", ["constituent_ticker", "cusip", "weight"], ["as_of_date", "composite_ticker", "constituent_ticker"]
    ),
    "dirty_holdings",
    """SELECT 'holdings' AS "table", 'rows' AS "check", COUNT(*) AS n FROM dirty_holdings
    UNION ALL SELECT 'holdings', 'null constituent_ticker', COUNT(*) FILTER (NULLIF(trim(constituent_ticker), '') IS NULL) FROM dirty_holdings
    UNION ALL SELECT 'holdings', 'null cusip', COUNT(*) FILTER (NULLIF(trim(cusip), '') IS NULL) FROM dirty_holdings
    UNION ALL SELECT 'holdings', 'null weight', COUNT(*) FILTER (weight IS NULL) FROM dirty_holdings
    UNION ALL SELECT 'holdings', 'repeated key', COUNT(*) FROM (SELECT 1 FROM dirty_holdings GROUP BY as_of_date, composite_ticker, constituent_ticker HAVING COUNT(*) > 1)""",
)
register(
    "trimmed_value_counts",
    lambda spark, sf: counting.value_counts(v.dirty_holdings(spark, sf).select(F.trim("constituent_name").alias("constituent_name")), "constituent_name", 20),
    "dirty_holdings",
    "SELECT trim(constituent_name) AS constituent_name, COUNT(*) AS n FROM dirty_holdings GROUP BY 1 ORDER BY n DESC, 1 LIMIT 20",
)

# --- status, coverage and search

register(
    "security_status",
    lambda spark, sf: with_status(v.securities(spark, sf)).select("constituent_ticker", "is_enriched", "has_cik", "has_shares", "active_label"),
    "securities",
    f"""SELECT constituent_ticker, edgar_enriched_at IS NOT NULL AS is_enriched, edgar_cik IS NOT NULL AS has_cik,
    shares_outstanding IS NOT NULL AS has_shares, {_STATUS} AS active_label FROM securities""",
)
register(
    "status_counts",
    lambda spark, sf: counting.value_counts(with_status(v.securities(spark, sf)), "active_label"),
    "securities",
    f"SELECT {_STATUS} AS active_label, COUNT(*) AS n FROM securities GROUP BY 1",
)
register(
    "filtered_by_status",
    lambda spark, sf: sec.filter_status(v.securities(spark, sf), "ECONOMY", ["Active", "Not Enriched"]).select("constituent_ticker", "active_label"),
    "securities",
    f"SELECT constituent_ticker, {_STATUS} AS active_label FROM securities WHERE security_type = 'ECONOMY' AND active_flag IS DISTINCT FROM FALSE",
)
register(
    "security_search",
    lambda spark, sf: sec.search_securities(v.securities(spark, sf), "Blue", 10),
    "securities",
    """SELECT constituent_ticker, constituent_name, asset_class FROM securities WHERE constituent_ticker ILIKE '%blue%' OR constituent_name ILIKE '%blue%'
    ORDER BY constituent_ticker LIMIT 10""",
)


def _searched(spark, sf):
    """Terms from the names and tickers themselves, two of them of two characters, all in one plan."""
    table = v.securities(spark, sf)
    index = searching.write_postings(searching.postings(table, "constituent_ticker", ["constituent_ticker", "constituent_name"]), scratch_path(spark, "postings"))
    word = F.split("constituent_name", " ")
    first = table.select(F.explode(F.array(F.lower(F.get(word, F.lit(0))), F.upper(F.get(word, F.lit(1))), F.substring("constituent_ticker", -4, 4), F.lit("B"))).alias("term"))
    terms = first.unionByName(spark.createDataFrame([("en",), ("zz",), ("100%",), ("no such text",)], "term string"))
    return searching.search(terms, table, "constituent_ticker", ["constituent_ticker", "constituent_name"], index)


register(
    "security_terms",
    _searched,
    "securities",
    """WITH terms AS (SELECT DISTINCT term FROM (SELECT lower(split_part(constituent_name, ' ', 1)) AS term FROM securities UNION ALL
      SELECT upper(split_part(constituent_name, ' ', 2)) FROM securities UNION ALL SELECT right(constituent_ticker, 4) FROM securities UNION ALL SELECT 'en'))
    SELECT term, constituent_ticker FROM terms JOIN securities ON contains(lower(constituent_ticker), lower(term)) OR contains(lower(constituent_name), lower(term))
    WHERE length(term) >= 2""",
)
_COVERED = ["isin", "cusip", "edgar_cik", "shares_outstanding"]
register(
    "identifier_coverage",
    lambda spark, sf: counting.coverage(v.securities(spark, sf), _COVERED),
    "securities",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", COUNT({c}) AS have, COUNT(*) - COUNT({c}) AS missing, {r(f'COUNT({c}) * 100.0 / COUNT(*)')} AS filled_pct FROM securities" for c in _COVERED
    ),
)
register(
    "security_missing_pct",
    lambda spark, sf: counting.missing_pct(sec.equities(v.securities(spark, sf)), ["country_of_exchange", "sic_code", "state_of_inc", "filer_category", "active_flag"]),
    "securities",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {r(f'COUNT(*) FILTER ({c} IS NULL) * 100.0 / COUNT(*)')} AS missing_pct FROM securities WHERE asset_class = 'Equity'"
        for c in ("country_of_exchange", "sic_code", "state_of_inc", "filer_category", "active_flag")
    ),
)
register(
    "sic_distinct",
    lambda spark, sf: counting.distinct_counts(v.securities(spark, sf), ["sic_code", "sic_description", "country_of_exchange"]),
    "securities",
    "SELECT COUNT(DISTINCT sic_code) AS sic_code, COUNT(DISTINCT sic_description) AS sic_description, COUNT(DISTINCT country_of_exchange) AS country_of_exchange FROM securities",
)
for _column, _n in (("security_type", 12), ("filer_category", None), ("state_of_inc", 15), ("entity_type", None), ("country_of_exchange", 20), ("currency_traded", 15)):
    register(
        f"securities_by_{_column}",
        lambda spark, sf, c=_column, n=_n: counting.value_counts(v.securities(spark, sf), c, n, "Unknown"),
        "securities",
        f"SELECT COALESCE({_column}, 'Unknown') AS {_column}, COUNT(*) AS n FROM securities GROUP BY 1 " + (f"ORDER BY n DESC, 1 LIMIT {_n}" if _n else ""),
    )
register(
    "industries_of_active",
    lambda spark, sf: counting.value_counts(v.securities(spark, sf).where("active_flag"), "sic_description", 20),
    "securities",
    "SELECT sic_description, COUNT(*) AS n FROM securities WHERE active_flag AND sic_description IS NOT NULL GROUP BY 1 ORDER BY n DESC, 1 LIMIT 20",
)
register(
    "listed_exchange_counts",
    lambda spark, sf: counting.list_value_counts(v.securities(spark, sf), "listed_exchanges", "|", 15),
    "securities",
    """SELECT upper(trim(e)) AS listed_exchanges, COUNT(*) AS n FROM (SELECT unnest(string_split(listed_exchanges, '|')) AS e FROM securities
    WHERE listed_exchanges IS NOT NULL) GROUP BY 1 ORDER BY n DESC, 1 LIMIT 15""",
)
register(
    "reason_counts",
    lambda spark, sf: counting.value_counts(
        v.securities(spark, sf).where("NOT active_flag").select(reason_label().alias("reason")), "reason"
    ),
    "securities",
    """SELECT CASE WHEN inactive_reason IS NULL THEN 'Unknown' WHEN starts_with(inactive_reason, 'deregistration') THEN 'Formally Deregistered'
    WHEN inactive_reason = 'not_in_edgar_tickers' THEN 'Not in SEC EDGAR' WHEN inactive_reason = 'no_recent_10k_10q' THEN 'Stale Filer (no 10-K/10-Q)'
    ELSE inactive_reason END AS reason, COUNT(*) AS n FROM securities WHERE NOT active_flag GROUP BY 1""",
)
register(
    "reason_words_for_lookup",
    lambda spark, sf: v.securities(spark, sf).where("NOT active_flag").select("constituent_ticker", reason_label(screen="lookup").alias("reason")),
    "securities",
    """SELECT constituent_ticker, CASE WHEN inactive_reason IS NULL THEN 'Inactive' WHEN starts_with(inactive_reason, 'deregistration') THEN 'Deregistered'
    WHEN inactive_reason = 'not_in_edgar_tickers' THEN 'Not in EDGAR' WHEN inactive_reason = 'no_recent_10k_10q' THEN 'Stale Filer' ELSE inactive_reason END AS reason
    FROM securities WHERE NOT active_flag""",
)
register(
    "deregistered",
    lambda spark, sf: sec.deregistered(v.securities(spark, sf), 20),
    "securities",
    """SELECT constituent_ticker, constituent_name, inactive_reason, edgar_name, sic_description, state_of_inc FROM securities
    WHERE NOT active_flag AND starts_with(inactive_reason, 'deregistration') ORDER BY constituent_ticker LIMIT 20""",
)

# --- places

_ISO = ", ".join(f"('{a}', '{b}')" for a, b in COUNTRY_CODES.items())
_REGION = ", ".join(f"('{c}', '{name}')" for c, name in REGIONS.items())
_CENTRE = ", ".join(f"('{c}', {lon}, {lat})" for c, (lon, lat) in CENTROIDS.items())
register(
    "country_codes",
    lambda spark, sf: map_codes(v.securities(spark, sf).select("constituent_ticker", "country_of_exchange"), country_frame(spark), "country_of_exchange", default="Other"),
    "securities",
    f"""SELECT constituent_ticker, country_of_exchange, COALESCE(iso3, 'Other') AS iso3 FROM securities
    LEFT JOIN (VALUES {_ISO}) t(iso2, iso3) ON country_of_exchange = iso2""",
)
_ACTIVITY = """SELECT country_of_exchange, COUNT(*) AS securities, COUNT(*) FILTER (active_flag) AS active, COUNT(*) FILTER (NOT active_flag) AS inactive,
    iso3, ROUND(COUNT(*) FILTER (active_flag) * 100.0 / COUNT(*), 1) AS active_pct FROM securities JOIN (VALUES {iso}) t(iso2, iso3)
    ON country_of_exchange = iso2 WHERE asset_class = 'Equity' {more} GROUP BY 1, 5"""
register(
    "country_activity",
    lambda spark, sf: sec.country_activity(sec.equities(v.securities(spark, sf))),
    "securities",
    _ACTIVITY.format(iso=_ISO, more=""),
)
register(
    "foreign_activity",
    lambda spark, sf: sec.country_activity(sec.non_us(sec.equities(v.securities(spark, sf)))),
    "securities",
    _ACTIVITY.format(iso=_ISO, more="AND country_of_exchange <> 'US'"),
)
register(
    "active_by_country",
    lambda spark, sf: sec.active_by_country(sec.equities(v.securities(spark, sf))),
    "securities",
    f"""SELECT country_of_exchange, COUNT(*) AS n, CAST(lon AS DOUBLE) AS lon, CAST(lat AS DOUBLE) AS lat FROM securities
    JOIN (VALUES {_CENTRE}) t(iso2, lon, lat) ON country_of_exchange = iso2 WHERE asset_class = 'Equity' AND active_flag GROUP BY 1, 3, 4""",
)
register(
    "region_types",
    lambda spark, sf: sec.region_types(sec.equities(v.securities(spark, sf))),
    "securities",
    f"""SELECT COALESCE(t.reg, 'Other') AS world_region, security_type, COUNT(*) AS n FROM securities LEFT JOIN (VALUES {_REGION}) t(iso2, reg)
    ON country_of_exchange = iso2 WHERE asset_class = 'Equity' AND country_of_exchange <> 'US' GROUP BY 1, 2""",
)
register(
    "most_common_foreign_country",
    lambda spark, sf: counting.mode_of(sec.non_us(sec.equities(v.securities(spark, sf))), "country_of_exchange"),
    "securities",
    """SELECT country_of_exchange, COUNT(*) AS n FROM securities WHERE asset_class = 'Equity' AND country_of_exchange <> 'US'
    GROUP BY 1 ORDER BY n DESC, 1 LIMIT 1""",
)
_CROSS = """WITH top AS (SELECT {a} FROM {t} WHERE {a} IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT {n})
    SELECT {a}, COALESCE({b}, 'Unknown') AS {b}, COUNT(*) AS n FROM {t} WHERE {a} IN (SELECT {a} FROM top) GROUP BY 1, 2"""
register(
    "types_by_country",
    lambda spark, sf: counting.cross_counts(v.securities(spark, sf), "country_of_exchange", "security_type", 12),
    "securities",
    _CROSS.format(a="country_of_exchange", b="security_type", t="securities", n=12),
)
register(
    "classes_by_country",
    lambda spark, sf: counting.cross_counts(v.securities(spark, sf), "country_of_exchange", "asset_class", 5),
    "securities",
    _CROSS.format(a="country_of_exchange", b="asset_class", t="securities", n=5),
)
register(
    "status_by_type",
    lambda spark, sf: sec.status_by_type(v.securities(spark, sf), 8),
    "securities",
    f"SELECT security_type, {_STATUS} AS active_label, COUNT(*) AS n FROM securities WHERE edgar_enriched_at IS NOT NULL GROUP BY 1, 2",
)
register(
    "status_by_industry",
    lambda spark, sf: counting.cross_counts(
        with_status(sec.us_only(sec.equities(v.securities(spark, sf)))).where("is_enriched"), "sic_description", "active_label", 15
    ),
    "securities",
    f"""SELECT sic_description, {_STATUS} AS active_label, COUNT(*) AS n FROM securities WHERE asset_class = 'Equity' AND country_of_exchange = 'US'
    AND edgar_enriched_at IS NOT NULL AND sic_description IS NOT NULL GROUP BY 1, 2""",
)

# --- share counts

register(
    "largest_by_shares",
    lambda spark, sf: sec.largest_by_shares(v.securities(spark, sf), 25).select("constituent_ticker", "shares_outstanding", "shares_bn", "shares_m", "shares_as_of_date"),
    "securities",
    f"""SELECT constituent_ticker, shares_outstanding, {r('shares_outstanding / 1e9')} AS shares_bn, {r('shares_outstanding / 1e6')} AS shares_m,
    {d('shares_as_of_date')} AS shares_as_of_date FROM securities WHERE shares_outstanding > 0 ORDER BY shares_outstanding DESC, constituent_ticker LIMIT 25""",
)
register(
    "shares_by_category",
    lambda spark, sf: median_by(sec.with_share_units(v.securities(spark, sf)).where("filer_category IS NOT NULL"), "filer_category", "shares_outstanding"),
    "securities",
    f"""SELECT filer_category, COUNT(*) AS n, {r('MEDIAN(shares_outstanding)')} AS median FROM securities
    WHERE shares_outstanding > 0 AND filer_category IS NOT NULL GROUP BY 1""",
)
register(
    "shares_recency",
    lambda spark, sf: counting.recency(v.securities(spark, sf), "shares_as_of_date", 24),
    "securities",
    "SELECT strftime(shares_as_of_date, '%Y-%m') AS month, COUNT(*) AS n FROM securities WHERE shares_as_of_date IS NOT NULL GROUP BY 1 ORDER BY 1 DESC LIMIT 24",
)
register(
    "shares_histogram",
    lambda spark, sf: counting.data_histogram(sec.with_share_units(v.securities(spark, sf)), F.log10("shares_outstanding"), 60),
    "securities",
    f"""WITH x AS (SELECT log10(shares_outstanding) AS a FROM securities WHERE shares_outstanding > 0), b AS (SELECT MIN(a) AS lo, MAX(a) AS hi FROM x)
    SELECT CAST(LEAST(COALESCE(floor((a - lo) * 60 / NULLIF(hi - lo, 0)) + 1, 1), 60) AS BIGINT) AS bucket, {r('MIN(a)')} AS bucket_min, {r('MAX(a)')} AS bucket_max,
    COUNT(*) AS n FROM x, b GROUP BY 1""",
)

# --- monitoring

register(
    "monitor_summary",
    lambda spark, sf: sec.monitor_summary(v.securities(spark, sf)),
    "securities",
    """SELECT COUNT(*) FILTER (NOT active_flag) AS total_inactive, COUNT(*) FILTER (active_flag) AS total_active, COUNT(*) FILTER (active_flag IS NULL) AS total_unknown,
    strftime(MAX(edgar_enriched_at), '%Y-%m-%d %H:%M:%S') AS last_enriched_at FROM securities""",
)
register(
    "inactive_by_reason",
    lambda spark, sf: sec.inactive_by_reason(v.securities(spark, sf)),
    "securities",
    "SELECT COALESCE(inactive_reason, 'Unknown') AS inactive_reason, COUNT(*) AS n FROM securities WHERE NOT active_flag GROUP BY 1",
)
_GONE = "s.constituent_ticker, s.constituent_name, s.inactive_reason, s.asset_class, s.security_type, s.edgar_cik"
register(
    "inactive_with_funds",
    lambda spark, sf: sec.inactive_with_funds(v.securities(spark, sf), v.holdings(spark, sf)),
    "securities newest",
    f"""SELECT {_GONE}, n.composite_ticker, {r('n.weight')} AS weight FROM securities s LEFT JOIN newest n ON n.constituent_ticker = s.constituent_ticker
    WHERE NOT s.active_flag""",
)
register(
    "inactive_fund_counts",
    lambda spark, sf: sec.inactive_fund_counts(v.securities(spark, sf), v.holdings(spark, sf)),
    "securities newest",
    f"""SELECT {_GONE}, COUNT(n.composite_ticker) AS fund_count FROM securities s LEFT JOIN newest n ON n.constituent_ticker = s.constituent_ticker
    WHERE NOT s.active_flag GROUP BY ALL""",
)
register(
    "fund_inactive",
    lambda spark, sf: sec.fund_inactive(s.at_latest(v.holdings(spark, sf)), v.securities(spark, sf)),
    "securities newest",
    f"""SELECT composite_ticker, COUNT(*) AS inactive_count, {r('SUM(weight)')} AS inactive_weight FROM newest
    WHERE constituent_ticker IN (SELECT constituent_ticker FROM securities WHERE NOT active_flag) GROUP BY 1""",
)
register(
    "security_profiles",
    lambda spark, sf: security_profiles(v.securities(spark, sf), v.holdings(spark, sf), v.funds(spark, sf)).select(
        "constituent_ticker", "constituent_name", "active_flag", "fund_count", "total_exposure_bn", "avg_weight", "max_weight", "max_weight_fund"
    ),
    "securities newest last_funds",
    f"""WITH m AS (SELECT constituent_ticker, COUNT(*) AS n, SUM(weight / 100 * CAST(aum AS DOUBLE) / 1e9) AS e, AVG(weight) AS a, MAX(weight) AS w,
      (list(n.composite_ticker ORDER BY weight DESC, n.composite_ticker DESC))[1] AS f FROM newest n LEFT JOIN last_funds l ON n.composite_ticker = l.composite_ticker GROUP BY 1)
    SELECT s.constituent_ticker, constituent_name, active_flag, COALESCE(n, 0) AS fund_count, {r('e')} AS total_exposure_bn, {r('a')} AS avg_weight,
    {r('w')} AS max_weight, f AS max_weight_fund FROM securities s LEFT JOIN m ON s.constituent_ticker = m.constituent_ticker""",
)
_ALERTS = f"""{_CHANGES}, sized AS (
  SELECT change AS type, composite_ticker AS fund, constituent_ticker AS security, as_of_date AS detected_on, COALESCE(weight_now, weight_before) AS size, 1.0 AS warn, 5.0 AS crit FROM changes
  UNION ALL SELECT 'aum_change', composite_ticker, NULL, as_of_date, pct, 25.0, 75.0 FROM (SELECT composite_ticker, as_of_date, CAST(aum - p AS DOUBLE) * 100 / NULLIF(CAST(ABS(p) AS DOUBLE), 0) AS pct
    FROM (SELECT *, LAG(aum) OVER (PARTITION BY composite_ticker ORDER BY as_of_date) AS p FROM funds)) WHERE ABS(pct) >= 25
  UNION ALL SELECT 'inactive_security', composite_ticker, constituent_ticker, as_of_date, weight, 1.0, 5.0 FROM newest
    SEMI JOIN (FROM securities WHERE NOT active_flag) USING (constituent_ticker)
  UNION ALL SELECT 'inactive_total', composite_ticker, NULL, ANY_VALUE(as_of_date), SUM(weight), 1.0, 5.0 FROM newest
    WHERE constituent_ticker IN (SELECT constituent_ticker FROM securities WHERE NOT active_flag) GROUP BY 2),
found AS (SELECT type, CASE WHEN ABS(size) >= crit THEN 'critical' WHEN ABS(size) >= warn THEN 'warning' ELSE 'info' END AS severity, fund, security, detected_on, size FROM sized)"""


def _alerts(spark, sf):
    return alerts(v.holdings(spark, sf), v.funds(spark, sf), v.securities(spark, sf))


register(
    "alerts",
    _alerts,
    "holdings newest funds securities",
    f"WITH {_ALERTS} SELECT type, severity, fund, security, {d('detected_on')} AS detected_on, {r('size')} AS size FROM found",
)
register(
    "alert_counts",
    lambda spark, sf: alert_counts(_alerts(spark, sf)),
    "holdings newest funds securities",
    f"WITH {_ALERTS} SELECT type, severity, COUNT(*) AS n, COUNT(DISTINCT fund) AS funds, {r('MAX(ABS(size))')} AS largest FROM found GROUP BY 1, 2",
)
register(
    "inactive_largest_positions",
    lambda spark, sf: top_n(
        sec.fund_inactive(s.at_best(v.holdings(spark, sf)), v.securities(spark, sf)), "inactive_weight", "composite_ticker", 20
    ),
    "securities current",
    f"""SELECT composite_ticker, COUNT(*) AS inactive_count, {r('SUM(weight)')} AS inactive_weight FROM current
    WHERE constituent_ticker IN (SELECT constituent_ticker FROM securities WHERE NOT active_flag) GROUP BY 1 ORDER BY SUM(weight) DESC, 1 LIMIT 20""",
)
