"""Queries over filings, facts, the layers' products and enrichment."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundledger.catalog import views as v
from fundledger.catalog.registry import d, r, register
from fundledger.functions.codes import CONCEPT_COLUMNS, EVENT_RULES, PILOT_CONCEPTS
from fundledger.functions.dates import period_type
from fundledger.functions.keys import cik10, filing_url, security_id
from fundledger.operators import enrichment as en, facts as fa, filings as fi
from fundledger.operators.counting import ratio_report, recency, value_counts
from fundledger.operators.joining import anti_join, changed_in_universe, load_keys, pending
from fundledger.plans import layers
from fundledger.sources import raw
from fundledger.sources.layers import ensure_columns, upsert

DAY, NEXT_DAY, AS_OF = "2024-01-25", "2024-01-26", "2003-01-01"
STAMP, NEXT_STAMP = f"{DAY} 06:30:00", f"{NEXT_DAY} 06:30:00"

# --- security dimension

_ID = "left(sha256({cik} || '|{cls}'), 16)"
_DIM = f"""dim AS (SELECT {_ID.format(cik="lpad(CAST(cik AS VARCHAR), CAST(greatest(length(CAST(cik AS VARCHAR)), 10) AS INTEGER), '0')", cls='PRIMARY')} AS security_id, lpad(CAST(cik AS VARCHAR), CAST(greatest(length(CAST(cik AS VARCHAR)), 10) AS INTEGER), '0') AS cik, ticker,
  name AS company_name, exchange FROM tickers WHERE exchange IN ('NYSE', 'Nasdaq'))"""


def _companies(spark, sf):
    parsed = raw.submission_faults(raw.parse_submissions(v.company_docs(spark, sf)))
    return raw.flatten_submissions(parsed.where("fault IS NULL"))


_SENT = """sent AS (SELECT c_custkey AS k, CAST(1000 + c_custkey % 12 * 100 AS VARCHAR) AS sic, 'Industry ' || CAST(c_custkey % 12 AS VARCHAR) AS sic_description,
  CASE WHEN c_custkey % 2 = 0 THEN 'operating' ELSE 'other' END AS entity_type, list_extract(['DE', 'NY', 'CA', 'TX', 'NV'], c_custkey % 5 + 1) AS state_of_incorporation,
  lpad(CAST(c_custkey % 12 + 1 AS VARCHAR), 2, '0') || '28' AS fiscal_year_end FROM customer WHERE c_custkey % 211 <> 7)"""


def _dim(spark, sf):
    return layers.dim_security(v.tickers(spark, sf), DAY, companies=_companies(spark, sf), stamp=STAMP)


def _keys(spark, sf):
    """The dimension for joins: keys and names, without the company documents."""
    return layers.dim_security(v.tickers(spark, sf), DAY, stamp=STAMP)


register("listed_tickers", lambda spark, sf: layers.listed_only(v.tickers(spark, sf)), "tickers", "SELECT * FROM tickers WHERE exchange IN ('NYSE', 'Nasdaq')")
register(
    "security_ids",
    lambda spark, sf: v.tickers(spark, sf).select("cik", security_id("cik").alias("security_id"), security_id("cik", F.lit(" b ")).alias("class_b_id")),
    "tickers",
    f"""SELECT cik, {_ID.format(cik="lpad(CAST(cik AS VARCHAR), CAST(greatest(length(CAST(cik AS VARCHAR)), 10) AS INTEGER), '0')", cls='PRIMARY')} AS security_id,
    {_ID.format(cik="lpad(CAST(cik AS VARCHAR), CAST(greatest(length(CAST(cik AS VARCHAR)), 10) AS INTEGER), '0')", cls='B')} AS class_b_id FROM tickers""",
)
register(
    "dim_security",
    _dim,
    "tickers",
    f"""WITH {_DIM}, {_SENT} SELECT dim.*, CAST(NULL AS VARCHAR) AS ticker_class, TRUE AS active_flag, '{DAY}' AS first_seen_date, '{DAY}' AS last_seen_date,
    sic, entity_type, '{STAMP}' AS created_at, '{STAMP}' AS updated_at FROM dim LEFT JOIN sent ON k = CAST(cik AS BIGINT)""",
)
register(
    "dim_security_classes",
    lambda spark, sf: layers.dim_security(v.tickers(spark, sf), DAY, classes=True).select("security_id", "cik", "ticker", "ticker_class"),
    "tickers",
    """SELECT left(sha256(lpad(CAST(cik AS VARCHAR), CAST(greatest(length(CAST(cik AS VARCHAR)), 10) AS INTEGER), '0') || '|' || CASE WHEN ticker LIKE '%-B' THEN 'B' ELSE 'PRIMARY' END), 16) AS security_id,
    lpad(CAST(cik AS VARCHAR), CAST(greatest(length(CAST(cik AS VARCHAR)), 10) AS INTEGER), '0') AS cik, ticker, CASE WHEN ticker LIKE '%-B' THEN 'B' END AS ticker_class FROM tickers WHERE exchange IN ('NYSE', 'Nasdaq')""",
)


def _dim_next(spark, sf):
    """A first day that listed one exchange, then a day that lists both."""
    everyone = v.tickers(spark, sf)
    first = layers.dim_security(everyone.where("exchange = 'NYSE'"), DAY, stamp=STAMP)
    return layers.dim_security(everyone.withColumn("name", F.upper("name")), NEXT_DAY, first, companies=_companies(spark, sf), stamp=NEXT_STAMP)


register(
    "dim_security_upsert",
    lambda spark, sf: _dim_next(spark, sf).drop("ticker_class", "active_flag"),
    "tickers",
    f"""WITH {_DIM}, {_SENT} SELECT security_id, cik, ticker, upper(company_name) AS company_name, exchange,
    CASE WHEN exchange = 'NYSE' THEN '{DAY}' ELSE '{NEXT_DAY}' END AS first_seen_date, '{NEXT_DAY}' AS last_seen_date, sic, entity_type,
    CASE WHEN exchange = 'NYSE' THEN '{STAMP}' ELSE '{NEXT_STAMP}' END AS created_at, '{NEXT_STAMP}' AS updated_at FROM dim LEFT JOIN sent ON k = CAST(cik AS BIGINT)""",
)

# --- index files and change lists

_INDEX = """idx AS (SELECT cik, filing_date, o_orderkey, form, entity FROM (SELECT *, 'Customer ' || cik AS entity FROM filings) WHERE o_orderkey % 50 NOT IN (7, 9))"""


def index_lines(spark, sf):
    """Index files as lines: one file per filing day, header, dashes, and some lines to be dropped."""
    rows = v.filings(spark, sf)
    k = F.col("_orderkey")
    number = F.when(k % 50 == 9, F.concat(F.lit("x"), "cik")).otherwise(F.ltrim("cik", F.lit("0")))
    cells = [F.when(number == "", "0").otherwise(number), F.concat(F.lit("Customer "), "cik"), F.col("form"), F.col("filingDate")]
    body = rows.select(
        F.col("filingDate").alias("path"),
        (k + 10).alias("line"),
        F.concat_ws("|", *cells, F.when(k % 50 != 7, F.col("primaryDocument"))).alias("value"),
    )
    heads = rows.select("filingDate").distinct().select(
        F.col("filingDate").alias("path"),
        F.posexplode(F.array(F.lit("Description: daily index"), F.lit("CIK|Company Name|Form Type|Date Filed|Filename"), F.lit("---|---|---"))).alias("line", "value"),
    )
    return heads.select("path", F.col("line").cast("long").alias("line"), "value").unionByName(body)


def _index(spark, sf):
    return raw.parse_index(index_lines(spark, sf)).withColumn("ingestion_date", F.col("date_filed"))


register(
    "index_rows",
    lambda spark, sf: raw.parse_index(index_lines(spark, sf)),
    "filings",
    f"""WITH {_INDEX} SELECT {d('filing_date')} AS path, o_orderkey + 10 AS line, cik, entity AS company_name, form, {d('filing_date')} AS date_filed,
    'doc' || CAST(o_orderkey AS VARCHAR) || '.htm' AS filename FROM idx""",
)
_DAILY = f"""{_INDEX}, firsts AS (SELECT filing_date AS y, cik, form, MIN({{'a': filing_date, 'b': o_orderkey}}) AS k, MIN(entity) AS entity FROM idx GROUP BY 1, 2, 3),
daily AS (SELECT CAST(y AS VARCHAR) AS ingestion_date, cik, MIN(entity) AS company_name, '["' || string_agg(form, '","' ORDER BY k) || '"]' AS forms_filed FROM firsts GROUP BY 1, 2)"""
register("daily_changes", lambda spark, sf: fi.daily_changes(_index(spark, sf)), "filings", f"WITH {_DAILY} SELECT * FROM daily")


def _universe(spark, sf):
    return layers.listed_only(v.tickers(spark, sf)).select(cik10("cik").alias("cik"), "name")


_UNIVERSE = "universe AS (SELECT lpad(CAST(cik AS VARCHAR), CAST(greatest(length(CAST(cik AS VARCHAR)), 10) AS INTEGER), '0') AS cik, name FROM tickers WHERE exchange IN ('NYSE', 'Nasdaq'))"
register(
    "change_list",
    lambda spark, sf: fi.change_list(_index(spark, sf), _universe(spark, sf)),
    "filings tickers",
    f"WITH {_DAILY}, {_UNIVERSE} SELECT daily.*, FALSE AS full_refresh FROM daily WHERE cik IN (SELECT cik FROM universe)",
)
register(
    "change_list_full",
    lambda spark, sf: fi.change_list(_index(spark, sf), _universe(spark, sf), full_refresh=True),
    "tickers",
    f"WITH {_UNIVERSE} SELECT cik, name AS company_name, '[]' AS forms_filed, TRUE AS full_refresh FROM universe",
)
register(
    "changed_in_universe",
    lambda spark, sf: changed_in_universe(v.filings(spark, sf).select("cik").distinct(), _universe(spark, sf)),
    "filings tickers",
    f"WITH {_UNIVERSE} SELECT DISTINCT cik FROM filings WHERE cik IN (SELECT cik FROM universe)",
)
register(
    "companies_without_merger",
    lambda spark, sf: anti_join(_universe(spark, sf), v.filings(spark, sf).where("form = 'SC 13E-3'"), "cik"),
    "filings tickers",
    f"WITH {_UNIVERSE} SELECT cik, name FROM universe WHERE cik NOT IN (SELECT cik FROM filings WHERE form = 'SC 13E-3')",
)
register(
    "pending_companies",
    lambda spark, sf: pending(v.facts(spark, sf).select("cik").distinct(), v.filings(spark, sf).where("form = '10-K'"), "cik"),
    "facts filings",
    "SELECT DISTINCT cik FROM facts WHERE cik NOT IN (SELECT cik FROM filings WHERE form = '10-K')",
)
register(
    "load_keys",
    lambda spark, sf: load_keys(_universe(spark, sf), _index(spark, sf), full=False),
    "filings",
    f"WITH {_INDEX} SELECT DISTINCT cik FROM idx",
)

# --- filings

register(
    "filing_urls",
    lambda spark, sf: v.filings(spark, sf).select("accessionNumber", filing_url("cik", "accessionNumber").alias("url")),
    "filings",
    "SELECT accession AS \"accessionNumber\", 'https://www.sec.gov/Archives/edgar/data/' || ltrim(cik, '0') || '/' || accession || '/' AS url FROM filings",
)
_SILVER = f"""{_DIM}, silver AS (SELECT dim.security_id, f.cik, accession AS accession_number, form AS form_type, filing_date AS filed_date, report_date AS period_of_report,
  'https://www.sec.gov/Archives/edgar/data/' || ltrim(f.cik, '0') || '/' || accession || '/' AS filing_url, primary_document, is_xbrl = 1 AS is_xbrl, items
  FROM filings f JOIN dim ON f.cik = dim.cik)"""


def _silver_filings(spark, sf):
    return fi.silver_filings(v.filings(spark, sf), _keys(spark, sf))


register(
    "silver_filings",
    _silver_filings,
    "filings tickers",
    f"""WITH {_SILVER} SELECT security_id, cik, accession_number, form_type, {d('filed_date')} AS filed_date, {d('period_of_report')} AS period_of_report, filing_url,
    primary_document, is_xbrl, items FROM silver""",
)
_RULES = ", ".join(f"('{e}', '{f}', {'NULL' if i is None else repr(i)})" for e, f, i in EVENT_RULES)
_EVENTS = f"""{_SILVER}, events AS (SELECT security_id, cik, event_type, COALESCE(period_of_report, filed_date) AS event_date, CAST(NULL AS VARCHAR) AS effective_date,
  accession_number, form_type, filed_date, form_type || ' ' || items AS description FROM silver JOIN (VALUES {_RULES}) t(event_type, f, i)
  ON form_type = f AND (i IS NULL OR list_contains(string_split(items, ','), i)))"""
register(
    "corporate_actions",
    lambda spark, sf: fi.corporate_actions(_silver_filings(spark, sf)),
    "filings tickers",
    f"""WITH {_EVENTS} SELECT security_id, cik, event_type, {d('event_date')} AS event_date, effective_date, accession_number, form_type, {d('filed_date')} AS filed_date,
    CAST(NULL AS BIGINT) AS counterparty_cik, CAST(NULL AS VARCHAR) AS counterparty_name, CAST(NULL AS BIGINT) AS split_ratio_numerator,
    CAST(NULL AS BIGINT) AS split_ratio_denominator, description FROM events""",
)
register(
    "corporate_events",
    lambda spark, sf: fi.corporate_events(fi.corporate_actions(_silver_filings(spark, sf)), _keys(spark, sf)),
    "filings tickers",
    f"""WITH {_EVENTS} SELECT e.security_id, e.cik, ticker, company_name, event_type, {d('event_date')} AS event_date, effective_date, form_type, {d('filed_date')} AS filed_date,
    description FROM events e JOIN dim ON e.security_id = dim.security_id""",
)
register(
    "filing_catalog",
    lambda spark, sf: fi.filing_catalog(_silver_filings(spark, sf), _keys(spark, sf)),
    "filings tickers",
    f"""WITH {_SILVER} SELECT s.security_id, s.cik, ticker, company_name, accession_number, form_type, {d('filed_date')} AS filed_date, {d('period_of_report')} AS period_of_report,
    filing_url, primary_document FROM silver s JOIN dim ON s.security_id = dim.security_id""",
)
register(
    "filing_recency",
    lambda spark, sf: recency(_silver_filings(spark, sf), "filed_date", 24),
    "filings tickers",
    f"WITH {_SILVER} SELECT strftime(filed_date, '%Y-%m') AS month, COUNT(*) AS n FROM silver GROUP BY 1 ORDER BY 1 DESC LIMIT 24",
)
register("filings_by_form", lambda spark, sf: value_counts(v.filings(spark, sf), "form"), "filings", "SELECT form, COUNT(*) AS n FROM filings GROUP BY 1")

# --- facts

register(
    "facts_profile",
    lambda spark, sf: fa.facts_profile(v.facts(spark, sf)),
    "facts",
    "SELECT namespace, COUNT(*) AS rows, COUNT(DISTINCT concept) AS concepts, COUNT(DISTINCT cik) AS companies FROM facts GROUP BY 1",
)
_KIND = """CASE WHEN period_start IS NULL THEN 'instant' WHEN period_end - period_start BETWEEN 355 AND 375 THEN 'annual'
  WHEN period_end - period_start BETWEEN 85 AND 100 THEN 'quarterly' ELSE 'other' END"""
register(
    "period_types",
    lambda spark, sf: value_counts(v.facts(spark, sf).select(period_type("start", "end").alias("period_type")), "period_type"),
    "facts",
    f"SELECT {_KIND} AS period_type, COUNT(*) AS n FROM facts GROUP BY 1",
)
register(
    "facts_report",
    lambda spark, sf: ratio_report(v.facts(spark, sf), {"framed": F.col("frame").isNotNull(), "usd": F.col("unit") == "USD"}),
    "facts",
    "SELECT COUNT(*) AS rows, COUNT(frame) AS framed, COUNT(*) FILTER (unit = 'USD') AS usd FROM facts",
)
register(
    "facts_without_amendments",
    lambda spark, sf: fa.dedup_amendments(v.facts(spark, sf)).select("cik", "concept", "end", "start", "form", "val", "accn", "filed"),
    "facts",
    f"""SELECT cik, concept, {d('period_end')} AS "end", {d('period_start')} AS start, form, {r('val')} AS val, accn, {d('filed')} AS filed FROM facts
    QUALIFY ROW_NUMBER() OVER (PARTITION BY cik, namespace, concept, unit, period_start, period_end, form ORDER BY facts.filed DESC, accn DESC, facts.val DESC) = 1""",
)
# The years of the test data: a view needs its columns named.
YEARS = range(1995, 2002)
_REVENUE = f"""revenue AS (SELECT *, CAST(val AS DOUBLE) / 1e9 AS bn FROM facts WHERE namespace = 'us-gaap'
  AND concept IN ('Revenues', 'RevenueFromContractWithCustomerExcludingAssessedTax') AND unit = 'USD' AND form IN ('10-K', '10-K/A') AND {_KIND} = 'annual'
  QUALIFY ROW_NUMBER() OVER (PARTITION BY cik ORDER BY period_end DESC, filed DESC, accn DESC, val DESC) <= 5)"""
register(
    "annual_revenue",
    lambda spark, sf: fa.annual_revenue(v.facts(spark, sf), 5),
    "facts",
    f"""WITH {_REVENUE} SELECT cik, {d('period_end')} AS "end", {r('val')} AS val, form, {d('filed')} AS filed, frame, {r('bn')} AS revenue_bn FROM revenue""",
)
register(
    "revenue_by_year",
    lambda spark, sf: fa.pivot_years(fa.annual_revenue(v.facts(spark, sf), 5).withColumn("revenue_k", F.col("revenue_bn") * 1e6), "revenue_k"),
    "facts",
    f"""WITH {_REVENUE}, one AS (SELECT * FROM revenue QUALIFY ROW_NUMBER() OVER (PARTITION BY cik, period_end ORDER BY filed DESC, bn DESC) = 1),
    k AS (SELECT cik, year(period_end) AS y, {r('bn * 1e6')} AS k FROM one)
    SELECT cik, {', '.join(f'MAX(k) FILTER (y = {y}) AS "{y}"' for y in YEARS)} FROM k GROUP BY cik""",
)
register(
    "revenue_first_per_year",
    lambda spark, sf: fa.first_per(
        fa.annual_revenue(v.facts(spark, sf), 5).withColumn("year", F.year(F.col("end"))), ["cik", "year"], [F.desc("end"), F.desc("filed"), F.desc("revenue_bn")]
    ).select("cik", "year", "form", "filed", "revenue_bn"),
    "facts",
    f"""WITH {_REVENUE} SELECT cik, year(period_end) AS "year", form, {d('filed')} AS filed, {r('bn')} AS revenue_bn FROM revenue
    QUALIFY ROW_NUMBER() OVER (PARTITION BY cik, year(period_end) ORDER BY period_end DESC, filed DESC, bn DESC) = 1""",
)
register(
    "pilot_facts",
    lambda spark, sf: fa.pilot_facts(v.facts(spark, sf)),
    "facts",
    f"""WITH x AS (SELECT *, {_KIND} AS kind FROM facts WHERE namespace IN ('us-gaap', 'ifrs-full') AND concept IN ({', '.join(repr(c) for c in PILOT_CONCEPTS)}))
    SELECT cik, concept, concept AS label, unit, {d('period_end')} AS end_date, {r('CAST(val AS DECIMAL(38,4))')} AS value, accn, form, {d('filed')} AS filed, kind AS period_type FROM x
    WHERE kind IN ('annual', 'instant') AND (namespace = 'us-gaap' OR cik NOT IN (SELECT cik FROM x WHERE namespace = 'us-gaap' AND kind IN ('annual', 'instant')))""",
)
_MAPPING = ", ".join(f"('{n}', '{c}', '{col}', {i})" for col, choices in CONCEPT_COLUMNS.items() for i, (n, c) in enumerate(choices))


def _sql_column(c: str) -> str:
    kind = "DECIMAL(14,4)" if c.startswith("eps_") else "DECIMAL(20,0)" if c == "shares_outstanding" else "DECIMAL(22,2)"
    return f"CAST(MAX(val) FILTER (col = '{c}') AS {kind}) AS {c}"


_WIDE = f"""picked AS (SELECT f.*, col FROM facts f JOIN (VALUES {_MAPPING}) m(ns, co, col, prio) ON namespace = ns AND concept = co
  WHERE ({_KIND} = 'instant' AND form IN ('10-K', '10-K/A', '10-Q', '10-Q/A')) OR ({_KIND} = 'annual' AND form IN ('10-K', '10-K/A')) OR ({_KIND} = 'quarterly' AND form IN ('10-Q', '10-Q/A'))
  QUALIFY ROW_NUMBER() OVER (PARTITION BY cik, period_end, form, col ORDER BY prio, filed DESC, accn DESC, val DESC, period_start DESC NULLS LAST) = 1),
latest AS (SELECT cik, period_end, form, MAX(filed) AS filed_date, MAX({{'filed': filed, 'fy': fy, 'fp': fp}}) FILTER (fp IS NOT NULL) AS said FROM facts JOIN (VALUES {_MAPPING}) m(ns, co, col, prio) ON namespace = ns AND concept = co
  WHERE ({_KIND} = 'instant' AND form IN ('10-K', '10-K/A', '10-Q', '10-Q/A')) OR ({_KIND} = 'annual' AND form IN ('10-K', '10-K/A')) OR ({_KIND} = 'quarterly' AND form IN ('10-Q', '10-Q/A'))
  GROUP BY 1, 2, 3),
wide AS (SELECT p.cik, p.period_end, MAX(period_start) AS period_start, p.form AS form_type, ANY_VALUE(l.filed_date) AS filed_date, COALESCE(ANY_VALUE(l.said).fy, year(p.period_end)) AS fiscal_year,
  COALESCE(ANY_VALUE(l.said).fp, CASE WHEN p.form IN ('10-K', '10-K/A') THEN 'FY' ELSE 'Q' || CAST(quarter(p.period_end) AS VARCHAR) END) AS fiscal_period,
  CASE WHEN MIN(CASE WHEN namespace = 'ifrs-full' THEN 1 ELSE 0 END) = 1 THEN 'ifrs-full' ELSE 'us-gaap' END AS taxonomy,
  {', '.join(_sql_column(c) for c in CONCEPT_COLUMNS)}
  FROM picked p JOIN latest l ON p.cik = l.cik AND p.period_end = l.period_end AND p.form = l.form GROUP BY p.cik, p.period_end, p.form)"""
_WIDE_HEAD = f"""cik, {d('period_end')} AS period_end, {d('period_start')} AS period_start, form_type, {d('filed_date')} AS filed_date, fiscal_year, fiscal_period, taxonomy,
  {', '.join(f'{r(c)} AS {c}' for c in CONCEPT_COLUMNS)}"""
register("financial_facts", lambda spark, sf: fa.financial_facts(v.facts(spark, sf)), "facts", f"WITH {_WIDE} SELECT {_WIDE_HEAD} FROM wide")


def _silver_facts(spark, sf):
    return fa.silver_facts(v.facts(spark, sf), _keys(spark, sf))


_SILVER_FACTS = f"{_DIM}, {_WIDE}, sf AS (SELECT wide.*, dim.security_id, ticker, company_name, exchange FROM wide JOIN dim ON wide.cik = dim.cik)"
register("silver_facts", _silver_facts, "facts tickers", f"WITH {_SILVER_FACTS} SELECT security_id, {_WIDE_HEAD} FROM sf")
_STATEMENT = [c for c in CONCEPT_COLUMNS if c != "shares_outstanding"]
_STATEMENT_HEAD = f"""security_id, cik, ticker, company_name, exchange, fiscal_year, {d('period_end')} AS period_end, form_type, {d('filed_date')} AS filed_date, taxonomy,
  {', '.join(f'{r(c)} AS {c}' for c in _STATEMENT)}"""


def _sql_ratio(n: str, m: str, zero: str) -> str:
    exact = f"ROUND(CAST({n} AS DOUBLE) / NULLIF(CAST({m} AS DOUBLE), 0), 6)"
    plain = f"CASE WHEN ABS({exact}) < 10000 THEN {exact} END"  # what the declared type can hold
    return plain if zero == "null" else f"CASE WHEN {m} = 0 THEN 0 ELSE {plain} END"


for _name, _zero in (("statements_annual", "null"), ("statements_annual_zero_ratio", "zero")):
    register(
        _name,
        lambda spark, sf, zero=_zero: fa.statements_annual(_silver_facts(spark, sf), _keys(spark, sf), zero),
        "facts tickers",
        f"""WITH {_SILVER_FACTS} SELECT {_STATEMENT_HEAD}, {_sql_ratio('net_income', 'revenues', _zero)} AS net_margin,
        {_sql_ratio('net_income', 'stockholders_equity', _zero)} AS return_on_equity, {_sql_ratio('long_term_debt', 'stockholders_equity', _zero)} AS debt_to_equity
        FROM sf WHERE form_type IN ('10-K', '10-K/A')""",
    )
register(
    "statements_quarterly",
    lambda spark, sf: fa.statements_quarterly(_silver_facts(spark, sf), _keys(spark, sf), 8),
    "facts tickers",
    f"""WITH {_SILVER_FACTS} SELECT {_STATEMENT_HEAD}, fiscal_period FROM sf WHERE form_type IN ('10-Q', '10-Q/A')
    QUALIFY ROW_NUMBER() OVER (PARTITION BY security_id ORDER BY sf.period_end DESC, form_type) <= 8""",
)
def _flags_sql(gone: str, stale: str) -> str:
    return f"""flags AS (SELECT cik, dereg IS NULL AND COALESCE(report >= DATE '2001-01-01', FALSE) AS active_flag,
      CASE WHEN dereg IS NOT NULL THEN '{gone}' || dereg WHEN NOT COALESCE(report >= DATE '2001-01-01', FALSE) THEN '{stale}' END AS inactive_reason
      FROM (SELECT cik, (list(form ORDER BY filing_date DESC, accession DESC) FILTER (form IN ('15', '15-12G', '15-12B', '15F-12G', '15F-12B')))[1] AS dereg,
      MAX(filing_date) FILTER (form IN ('10-K', '10-Q', '10-K/A', '10-Q/A')) AS report FROM filings GROUP BY 1))"""


_FLAGS = _flags_sql("deregistration_", "no_recent_10k_10q")
_LAST = "(list({c} ORDER BY period_end DESC, filed_date DESC, form_type DESC) FILTER ({c} IS NOT NULL))[1]"
register(
    "company_profile",
    lambda spark, sf: fa.company_profile(
        _keys(spark, sf), _silver_filings(spark, sf), _silver_facts(spark, sf), _companies(spark, sf), en.active_flags(v.filings(spark, sf), AS_OF)
    ),
    "facts filings tickers",
    f"""WITH {_SILVER_FACTS}, {_SENT}, {_FLAGS}, d10 AS (SELECT cik, MAX(filing_date) FILTER (form = '10-K') AS k, MAX(filing_date) FILTER (form = '10-Q') AS q FROM filings GROUP BY 1),
    fig AS (SELECT security_id, {', '.join(f'{_LAST.format(c=c)} AS {c}' for c in ('revenues', 'total_assets', 'shares_outstanding', 'eps_diluted'))} FROM sf GROUP BY 1)
    SELECT dim.security_id, dim.cik, ticker, company_name, exchange, sic, sic_description, state_of_incorporation, fiscal_year_end,
    COALESCE(flags.active_flag, TRUE) AS active_flag, inactive_reason, {d('d10.k')} AS latest_10k_date, {d('q')} AS latest_10q_date,
    {r('revenues')} AS latest_revenues, {r('total_assets')} AS latest_total_assets, {r('shares_outstanding')} AS latest_shares_outstanding, {r('eps_diluted')} AS latest_eps_diluted
    FROM dim LEFT JOIN d10 ON dim.cik = d10.cik LEFT JOIN fig ON dim.security_id = fig.security_id LEFT JOIN sent ON sent.k = CAST(dim.cik AS BIGINT)
    LEFT JOIN flags ON flags.cik = dim.cik""",
)


def _facts_upsert(spark, sf):
    """Facts of the first form letters are loaded, then all facts come with doubled figures."""
    facts = _silver_facts(spark, sf)
    later = facts.withColumns({"revenues": F.col("revenues") * 2, "eps_diluted": F.lit(0).cast("decimal(14,4)")})
    merged = layers.upsert_facts(facts.where("form_type like '10-K%'"), later)
    return merged.select("security_id", "period_end", "form_type", "filed_date", "revenues", "total_assets", "eps_diluted")


register(
    "facts_upsert",
    _facts_upsert,
    "facts tickers",
    f"""WITH {_SILVER_FACTS} SELECT security_id, {d('period_end')} AS period_end, form_type, {d('filed_date')} AS filed_date, {r('revenues * 2')} AS revenues,
    {r('total_assets')} AS total_assets, CASE WHEN form_type LIKE '10-K%' THEN COALESCE({r('eps_diluted')}, 0) ELSE 0 END AS eps_diluted FROM sf""",
)

# --- enrichment

CONCEPTS = ["EntityCommonStockSharesOutstanding", "CommonStockSharesOutstanding"]
_RESOLVED = """spelled AS (SELECT constituent_ticker, unnest([constituent_ticker, replace(constituent_ticker, ' ', '-'), replace(constituent_ticker, '.', '-'),
  replace(constituent_ticker, ' ', ''), replace(constituent_ticker, '.', ''), replace(constituent_ticker, ' ', '.')]) AS t, unnest([1, 2, 3, 4, 5, 6]) AS p FROM securities),
hits AS (SELECT constituent_ticker, arg_min(lpad(CAST(cik AS VARCHAR), CAST(greatest(length(CAST(cik AS VARCHAR)), 10) AS INTEGER), '0'), p) AS cik FROM spelled JOIN tickers ON ticker = t GROUP BY 1),
resolved AS (SELECT s.constituent_ticker, hits.cik FROM securities s LEFT JOIN hits ON s.constituent_ticker = hits.constituent_ticker)"""


def _map(spark, sf):
    return v.tickers(spark, sf).select("ticker", cik10("cik").alias("cik"))


def _resolved(spark, sf):
    return en.resolve_cik(v.securities(spark, sf).select("constituent_ticker"), _map(spark, sf))


register(
    "enrichment_targets",
    lambda spark, sf: en.enrichment_targets(v.securities(spark, sf)).select("constituent_ticker"),
    "securities",
    """SELECT constituent_ticker FROM securities WHERE asset_class = 'Equity' AND (country_of_exchange = 'US' OR country_of_exchange IS NULL)
    AND edgar_enriched_at IS NULL""",
)
register("resolved_companies", _resolved, "securities tickers", f"WITH {_RESOLVED} SELECT * FROM resolved")
register("active_flags", lambda spark, sf: en.active_flags(v.filings(spark, sf), AS_OF), "filings", f"WITH {_FLAGS} SELECT * FROM flags")
register(
    "active_flags_pilot",
    lambda spark, sf: en.active_flags(v.filings(spark, sf), AS_OF, wording="pilot"),
    "filings",
    f"WITH {_flags_sql('Filed form ', 'No recent 10-K/10-Q within 2 years')} SELECT * FROM flags",
)
_SHARES = """usable AS (SELECT * FROM facts WHERE unit = 'shares' AND val <> 0),
newest_point AS (SELECT cik, concept, filed, form FROM usable QUALIFY ROW_NUMBER() OVER (PARTITION BY cik, concept ORDER BY filed DESC, accn DESC, form DESC) = 1),
same AS (SELECT u.cik, u.concept, u.val, u.period_end, COUNT(*) OVER w AS points, ROW_NUMBER() OVER (PARTITION BY u.cik, u.concept ORDER BY u.val, u.period_end, u.accn) AS place
  FROM usable u JOIN newest_point n ON u.cik = n.cik AND u.concept = n.concept AND u.filed = n.filed AND u.form = n.form WINDOW w AS (PARTITION BY u.cik, u.concept)),
wanted AS (SELECT constituent_ticker, cik, CASE WHEN constituent_ticker LIKE '% B' THEN 1 WHEN constituent_ticker LIKE '%.A' THEN 0 END AS class FROM resolved WHERE cik IS NOT NULL),
shares AS (SELECT constituent_ticker, CAST(trunc(val) AS BIGINT) AS shares_outstanding, period_end AS shares_as_of_date FROM wanted JOIN same ON wanted.cik = same.cik
  WHERE CASE WHEN points = 1 THEN place = 1 ELSE place = class + 1 END
  QUALIFY ROW_NUMBER() OVER (PARTITION BY constituent_ticker ORDER BY CASE WHEN concept = 'EntityCommonStockSharesOutstanding' THEN 1 ELSE 2 END) = 1)"""
register("share_points", lambda spark, sf: fa.concept_points(v.facts(spark, sf)), "facts", f"""SELECT cik, concept, {r('val')} AS val, {d('period_end')} AS "end", form, {d('filed')} AS filed, accn FROM facts WHERE unit = 'shares'""")
register(
    "shares_outstanding",
    lambda spark, sf: en.shares_outstanding(fa.concept_points(v.facts(spark, sf)), _resolved(spark, sf), CONCEPTS),
    "facts securities tickers",
    f"WITH {_RESOLVED}, {_SHARES} SELECT constituent_ticker, shares_outstanding, {d('shares_as_of_date')} AS shares_as_of_date FROM shares",
)
_COMPANIES = f"""companies AS (SELECT lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(length(CAST(c_custkey AS VARCHAR)), 10) AS INTEGER), '0') AS cik, c_name AS edgar_name, CAST(1000 + c_custkey % 12 * 100 AS VARCHAR) AS sic_code,
  'Industry ' || CAST(c_custkey % 12 AS VARCHAR) AS sic_description, list_extract(['DE', 'NY', 'CA', 'TX', 'NV'], c_custkey % 5 + 1) AS state_of_inc,
  lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(length(CAST(c_custkey AS VARCHAR)), 9) AS INTEGER), '0') AS ein, CASE WHEN c_custkey % 2 = 0 THEN 'operating' ELSE 'other' END AS entity_type,
  CASE WHEN t.exchange IS NULL OR t.exchange = 'CBOE' THEN 'CBOE' ELSE t.exchange || '|CBOE' END AS listed_exchanges,
  list_extract(['Large accelerated filer', 'Accelerated filer / Smaller reporting company', 'Non-accelerated filer'], c_custkey % 3 + 1) AS filer_category
  FROM customer JOIN tickers t ON t.cik = c_custkey WHERE c_custkey % 211 <> 7)"""
_ENRICHED = f"""{_RESOLVED}, {_FLAGS}, {_SHARES}, {_COMPANIES}, enriched AS (SELECT x.constituent_ticker, ltrim(x.cik, '0') AS edgar_cik,
  c.edgar_name, c.sic_code, c.sic_description, c.state_of_inc, c.ein, c.entity_type, c.listed_exchanges, c.filer_category,
  CASE WHEN x.cik IS NULL THEN FALSE WHEN c.cik IS NULL THEN TRUE ELSE COALESCE(f.active_flag, FALSE) END AS active_flag,
  CASE WHEN x.cik IS NULL THEN 'not_in_edgar_tickers' WHEN c.cik IS NULL THEN NULL WHEN f.active_flag IS NULL THEN 'no_recent_10k_10q' ELSE f.inactive_reason END AS inactive_reason,
  s.shares_outstanding, s.shares_as_of_date FROM resolved x LEFT JOIN companies c ON x.cik = c.cik LEFT JOIN flags f ON x.cik = f.cik
  LEFT JOIN shares s ON x.constituent_ticker = s.constituent_ticker)"""


def _enriched(spark, sf, rows=None):
    rows = v.securities(spark, sf) if rows is None else rows
    return en.enrich_securities(
        rows, _map(spark, sf), _companies(spark, sf), v.filings(spark, sf), fa.concept_points(v.facts(spark, sf)), AS_OF
    )


register(
    "enriched_securities",
    _enriched,
    "securities tickers filings facts",
    f"WITH {_ENRICHED} SELECT * REPLACE ({d('shares_as_of_date')} AS shares_as_of_date) FROM enriched",
)
register(
    "enrichment_report",
    lambda spark, sf: en.enrichment_report(_enriched(spark, sf)),
    "securities tickers filings facts",
    f"""WITH {_ENRICHED} SELECT COUNT(*) AS ok, COUNT(*) FILTER (active_flag) AS active, COUNT(*) FILTER (NOT active_flag) AS inactive,
    COUNT(shares_outstanding) AS shares, COUNT(*) FILTER (edgar_cik IS NULL) AS no_cik FROM enriched""",
)


def _applied(spark, sf):
    master = ensure_columns(v.securities(spark, sf), en.ENRICHMENT_COLUMNS)
    done = _enriched(spark, sf, en.enrichment_targets(master))
    return en.apply_enrichment(master, done, F.lit("2024-02-01").cast("timestamp_ntz"))


register(
    "applied_enrichment",
    lambda spark, sf: _applied(spark, sf).select(
        "constituent_ticker", "edgar_cik", "edgar_name", "filer_category", "listed_exchanges", "active_flag", "inactive_reason", "shares_outstanding", "edgar_enriched_at"
    ),
    "securities tickers filings facts",
    f"""WITH {_ENRICHED}, target AS (SELECT constituent_ticker FROM securities WHERE asset_class = 'Equity'
      AND (country_of_exchange = 'US' OR country_of_exchange IS NULL) AND edgar_enriched_at IS NULL)
    SELECT constituent_ticker, edgar_cik, edgar_name, filer_category, listed_exchanges, active_flag, inactive_reason, shares_outstanding,
    '2024-02-01 00:00:00' AS edgar_enriched_at FROM enriched WHERE constituent_ticker IN (SELECT * FROM target)
    UNION ALL SELECT constituent_ticker, edgar_cik, edgar_name, filer_category, listed_exchanges, active_flag, inactive_reason, shares_outstanding,
    strftime(edgar_enriched_at, '%Y-%m-%d %H:%M:%S') FROM securities WHERE constituent_ticker NOT IN (SELECT * FROM target)""",
)
register(
    "first_source_values",
    lambda spark, sf: en.first_source(
        [
            fa.dedup_amendments(v.facts(spark, sf).where(F.col("concept") == c), ("cik", "end")).select("cik", "end", "concept", "val")
            for c in CONCEPTS
        ],
        ["cik", "end"],
    ),
    "facts",
    f"""WITH one AS (SELECT cik, period_end, concept, val FROM facts WHERE unit = 'shares'
      QUALIFY ROW_NUMBER() OVER (PARTITION BY cik, period_end, concept ORDER BY filed DESC, accn DESC, val DESC) = 1)
    SELECT cik, {d('period_end')} AS "end", concept, {r('val')} AS val FROM one
    QUALIFY ROW_NUMBER() OVER (PARTITION BY cik, period_end ORDER BY CASE WHEN concept = 'EntityCommonStockSharesOutstanding' THEN 1 ELSE 2 END) = 1""",
)
register(
    "fund_upsert",
    lambda spark, sf: upsert(
        v.funds(spark, sf).where("region = 'ASIA'").select("as_of_date", "composite_ticker", "issuer", "aum", "num_holdings"),
        v.funds(spark, sf).select("as_of_date", "composite_ticker", "issuer", (F.col("aum") + 1).cast("decimal(22,2)").alias("aum"), F.lit(1).alias("num_holdings")),
        ["as_of_date", "composite_ticker"],
        ["aum"],
    ),
    "funds",
    f"""SELECT {d('as_of_date')} AS as_of_date, composite_ticker, issuer, {r('aum + 1')} AS aum,
    CASE WHEN region = 'ASIA' THEN COALESCE(num_holdings, 1) ELSE 1 END AS num_holdings FROM funds""",
)
