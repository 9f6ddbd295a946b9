"""Queries over the fund table and the named measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from fundledger.catalog import views as v
from fundledger.catalog.registry import d, r, register
from fundledger.functions.numbers import log10_clip
from fundledger.operators import counting, funds as f, holdings as h, snapshots as s
from fundledger.operators.alerts import aum_changes
from fundledger.operators.overlap import overlap_against
from fundledger.operators.quantiles import metric_card, quartiles_by
from fundledger.operators.ranking import latest_per_key, page, page_after, pages, running_share, sample_rows, share_at, top_n
from fundledger.operators.semantic import measure_by, measures_across
from fundledger.plans.profiles import fund_profiles


def _now(spark, sf):
    return f.current_funds(v.funds(spark, sf))


_AUM = "CAST(aum AS DOUBLE) / 1e9"


def _dec(x: str) -> str:
    return f"SUM(CAST({x} AS DECIMAL(28,12)))"


def _mean(x: str) -> str:
    """SQL: a mean of positive numbers to seven places, rounded half up in whole numbers."""
    return f"(2 * CAST({_dec(x)} * 1000000000000 AS HUGEINT) + COUNT(*) * 100000) // (COUNT(*) * 200000) / 1e7"



register(
    "fund_units",
    lambda spark, sf: f.with_units(v.funds(spark, sf)).select("as_of_date", "composite_ticker", "aum_bn", "net_expenses_bps"),
    "funds",
    f"SELECT {d('as_of_date')} AS as_of_date, composite_ticker, {r(_AUM)} AS aum_bn, {r('net_expenses * 100')} AS net_expenses_bps FROM funds",
)
register(
    "fund_latest_rows",
    lambda spark, sf: latest_per_key(v.funds(spark, sf), ["composite_ticker"], [F.desc("as_of_date")]).select("composite_ticker", "as_of_date", "aum"),
    "own_last_funds",
    f"SELECT composite_ticker, {d('as_of_date')} AS as_of_date, {r('aum')} AS aum FROM own_last_funds",
)
register(
    "fund_page",
    lambda spark, sf: page(_now(spark, sf).select("composite_ticker", "aum", "num_holdings"), "num_holdings", "composite_ticker", number=2, size=25),
    "last_funds",
    f"SELECT composite_ticker, {r('aum')} AS aum, num_holdings FROM last_funds ORDER BY last_funds.num_holdings DESC NULLS LAST, composite_ticker LIMIT 25 OFFSET 25",
)


def _next_page(spark, sf):
    """The page behind the last row of the first page, found by that row's value and key."""
    rows = _now(spark, sf).select("composite_ticker", "aum", "num_holdings")
    end = page(rows, "num_holdings", "composite_ticker", size=25).orderBy(F.asc_nulls_first("num_holdings"), F.desc("composite_ticker")).limit(1)
    last = (end.select("num_holdings").scalar(), end.select("composite_ticker").scalar())
    return page_after(rows, "num_holdings", "composite_ticker", last, size=25)


register(
    "fund_page_next",
    _next_page,
    "last_funds",
    f"SELECT composite_ticker, {r('aum')} AS aum, num_holdings FROM last_funds ORDER BY last_funds.num_holdings DESC NULLS LAST, composite_ticker LIMIT 25 OFFSET 25",
)
register(
    "fund_pages",
    lambda spark, sf: pages(_now(spark, sf).select("composite_ticker", "aum"), "aum", "composite_ticker", size=40),
    "last_funds",
    f"""SELECT composite_ticker, {r('aum')} AS aum, (place - 1) // 40 + 1 AS page, (place - 1) % 40 + 1 AS place
    FROM (SELECT composite_ticker, aum, ROW_NUMBER() OVER (ORDER BY last_funds.aum DESC NULLS LAST, composite_ticker) AS place FROM last_funds)""",
)
register(
    "screener",
    lambda spark, sf: f.screen(
        v.funds(spark, sf), q="supplier", asset_class=["Equity", "Fixed Income"], min_aum=1e8, max_expense_ratio=120.0, is_etn=False
    ).select("composite_ticker", "asset_class", "aum", "net_expenses_bps"),
    "own_last_funds",
    f"""SELECT composite_ticker, asset_class, {r('aum')} AS aum, {r('net_expenses * 100')} AS net_expenses_bps FROM own_last_funds
    WHERE asset_class IN ('Equity', 'Fixed Income') AND aum >= 1e8 AND net_expenses * 100 <= 120 AND NOT is_etn
    AND (composite_ticker ILIKE '%supplier%' OR description ILIKE '%supplier%')""",
)
register(
    "screener_page",
    lambda spark, sf: f.screener_page(v.funds(spark, sf), "aum", number=1, size=20, region=["ASIA", "EUROPE", "AMERICA"]).select(
        "composite_ticker", "region", "aum"
    ),
    "own_last_funds",
    f"""SELECT composite_ticker, region, {r('aum')} AS aum FROM own_last_funds WHERE region IN ('ASIA', 'EUROPE', 'AMERICA')
    ORDER BY own_last_funds.aum DESC NULLS LAST, composite_ticker LIMIT 20""",
)
register(
    "screener_large_and_broad",
    lambda spark, sf: f.screen(v.funds(spark, sf), min_aum=1e9, min_holdings=85).select("composite_ticker", "aum", "num_holdings"),
    "own_last_funds",
    f"SELECT composite_ticker, {r('aum')} AS aum, num_holdings FROM own_last_funds WHERE aum >= 1e9 AND num_holdings >= 85",
)
_OPTIONS = ["asset_class", "issuer", "region", "sector_exposure", "development_class"]
register(
    "filter_options",
    lambda spark, sf: counting.filter_options(f.latest_funds(v.funds(spark, sf)), _OPTIONS),
    "own_last_funds",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS value, COUNT(*) AS n FROM own_last_funds WHERE {c} IS NOT NULL GROUP BY 2 HAVING COUNT(*) >= 3" for c in _OPTIONS
    ),
)
for _column, _label, _n in (
    ("asset_class", "Unknown", None),
    ("region", "Unknown", 15),
    ("development_class", "Unknown", None),
    ("sector_exposure", "Broad", 20),
    ("distribution_frequency", "Unknown", 6),
):
    register(
        f"funds_by_{_column}",
        lambda spark, sf, c=_column, n=_n, label=_label: counting.value_counts(_now(spark, sf), c, n, label),
        "last_funds",
        f"SELECT COALESCE({_column}, '{_label}') AS {_column}, COUNT(*) AS n FROM last_funds GROUP BY 1 "
        + (f"ORDER BY n DESC, 1 LIMIT {_n}" if _n else ""),
    )
register(
    "fund_flags",
    lambda spark, sf: counting.flag_counts(_now(spark, sf), "is_leveraged", "Leveraged", "Non-Leveraged").unionByName(
        counting.flag_counts(_now(spark, sf), "is_etn", "ETN", "ETF")
    ),
    "last_funds",
    """SELECT CASE WHEN is_leveraged THEN 'Leveraged' ELSE 'Non-Leveraged' END AS label, COUNT(*) AS n FROM last_funds GROUP BY 1
    UNION ALL SELECT CASE WHEN is_etn THEN 'ETN' ELSE 'ETF' END, COUNT(*) FROM last_funds GROUP BY 1""",
)
register(
    "leverage_counts",
    lambda spark, sf: f.leverage_counts(_now(spark, sf)),
    "last_funds",
    "SELECT CAST(leveraged_amount AS DOUBLE) AS leveraged_amount, COUNT(*) AS n FROM last_funds WHERE is_leveraged GROUP BY 1",
)
register(
    "fund_missing_pct",
    lambda spark, sf: counting.missing_pct(v.funds(spark, sf), ["asset_class", "development_class", "sector_exposure", "net_expenses", "num_holdings"]),
    "funds",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {r(f'COUNT(*) FILTER ({c} IS NULL) * 100.0 / COUNT(*)')} AS missing_pct FROM funds"
        for c in ("asset_class", "development_class", "sector_exposure", "net_expenses", "num_holdings")
    ),
)
register(
    "largest_funds",
    lambda spark, sf: top_n(_now(spark, sf).select("composite_ticker", "description", "issuer", "aum"), "aum", "composite_ticker", 15),
    "last_funds",
    f"SELECT composite_ticker, description, issuer, {r('aum')} AS aum FROM last_funds ORDER BY last_funds.aum DESC, composite_ticker LIMIT 15",
)
register(
    "aum_card",
    lambda spark, sf: metric_card(f.with_units(_now(spark, sf)).where("aum > 0"), "aum_bn", "composite_ticker"),
    "last_funds",
    f"""SELECT COUNT(*) AS n, {r(_dec(_AUM))} AS total, {r(f'MIN({_AUM})')} AS min, {r(_mean(_AUM))} AS mean, {r(f'MAX({_AUM})')} AS max,
    (SELECT composite_ticker FROM last_funds WHERE aum > 0 ORDER BY aum DESC, composite_ticker LIMIT 1) AS top_key, {r(f'MEDIAN({_AUM})')} AS median FROM last_funds WHERE aum > 0""",
)
register(
    "fee_card",
    lambda spark, sf: metric_card(f.fee_funds(_now(spark, sf)), "net_expenses_bps", "composite_ticker"),
    "last_funds",
    f"""WITH x AS (SELECT composite_ticker, net_expenses * 100 AS b FROM last_funds WHERE net_expenses > 0)
    SELECT COUNT(*) AS n, {r(_dec('b'))} AS total, {r('MIN(b)')} AS min, {r(_mean('b'))} AS mean, {r('MAX(b)')} AS max,
    (SELECT composite_ticker FROM x ORDER BY b DESC, composite_ticker LIMIT 1) AS top_key, {r('MEDIAN(b)')} AS median FROM x""",
)
register(
    "aum_histogram",
    lambda spark, sf: counting.data_histogram(f.with_units(_now(spark, sf)).where("aum > 0"), "aum_bn", 60),
    "last_funds",
    f"""WITH x AS (SELECT {_AUM} AS a FROM last_funds WHERE aum > 0), b AS (SELECT MIN(a) AS lo, MAX(a) AS hi FROM x)
    SELECT CAST(LEAST(COALESCE(floor((a - lo) * 60 / NULLIF(hi - lo, 0)) + 1, 1), 60) AS BIGINT) AS bucket, {r('MIN(a)')} AS bucket_min, {r('MAX(a)')} AS bucket_max,
    COUNT(*) AS n FROM x, b GROUP BY 1""",
)
register(
    "log_aum_histogram",
    lambda spark, sf: counting.histogram(f.with_units(_now(spark, sf)).where(F.col("aum").isNotNull()), log10_clip("aum_bn"), -6, 3, 36),
    "last_funds",
    f"""WITH x AS (SELECT log10(GREATEST({_AUM}, 1e-6)) AS a FROM last_funds)
    SELECT CAST(CASE WHEN a < -6 THEN 0 WHEN a >= 3 THEN 37 ELSE floor(36 * (a + 6) / 9) + 1 END AS BIGINT) AS bucket, {r('MIN(a)')} AS bucket_min, {r('MAX(a)')} AS bucket_max,
    COUNT(*) AS n FROM x GROUP BY 1""",
)
register(
    "fee_histogram",
    lambda spark, sf: counting.histogram(f.fee_funds(_now(spark, sf)), F.round("net_expenses_bps", 6), 0, 200, 60, (None, 200.0)),
    "last_funds",
    f"""WITH x AS (SELECT ROUND(net_expenses * 100, 6) AS b FROM last_funds WHERE net_expenses > 0)
    SELECT CAST(CASE WHEN b >= 200 THEN 61 ELSE floor(60 * b / 200) + 1 END AS BIGINT) AS bucket, {r('MIN(b)')} AS bucket_min, {r('MAX(b)')} AS bucket_max, COUNT(*) AS n FROM x GROUP BY 1""",
)
register(
    "fee_by_class",
    lambda spark, sf: f.fee_by_class(_now(spark, sf)),
    "last_funds",
    f"SELECT asset_class, COUNT(*) AS n, {r('MEDIAN(net_expenses * 100)')} AS median FROM last_funds WHERE net_expenses > 0 GROUP BY 1",
)
register(
    "fee_by_category",
    lambda spark, sf: f.fee_by_category(_now(spark, sf)),
    "last_funds",
    f"""SELECT category, COUNT(*) AS n, {r('MEDIAN(net_expenses * 100)')} AS median FROM last_funds WHERE net_expenses > 0 GROUP BY 1
    HAVING COUNT(*) >= 5 ORDER BY MEDIAN(net_expenses * 100) DESC, category LIMIT 15""",
)
register(
    "fee_quartiles",
    lambda spark, sf: quartiles_by(f.fee_funds(v.funds(spark, sf)), "asset_class", "net_expenses_bps"),
    "funds",
    "SELECT asset_class, " + ", ".join(
        f"{r(f'QUANTILE_CONT(net_expenses * 100, {p})')} AS {name}" for name, p in (("low", 0), ("q1", 0.25), ("median", 0.5), ("q3", 0.75), ("high", 1))
    ) + " FROM funds WHERE net_expenses > 0 AND asset_class IS NOT NULL GROUP BY 1",
)
register(
    "fund_points",
    lambda spark, sf: f.fund_points(_now(spark, sf), "num_holdings").select("composite_ticker", "asset_class", "aum_bn", "net_expenses_bps", "num_holdings"),
    "last_funds",
    f"""SELECT composite_ticker, asset_class, {r(_AUM)} AS aum_bn, {r('net_expenses * 100')} AS net_expenses_bps, num_holdings FROM last_funds
    WHERE aum > 0 AND net_expenses > 0 AND num_holdings IS NOT NULL""",
)
register(
    "breadth_histogram",
    lambda spark, sf: f.breadth_histogram(_now(spark, sf)),
    "last_funds",
    f"""SELECT CAST(CASE WHEN num_holdings >= 1000 THEN 51 ELSE floor(50 * num_holdings / CAST(1000 AS DOUBLE)) + 1 END AS BIGINT) AS bucket,
    {r('MIN(num_holdings)')} AS bucket_min, {r('MAX(num_holdings)')} AS bucket_max, COUNT(*) AS n FROM last_funds WHERE num_holdings > 0 GROUP BY 1""",
)
register(
    "breadth_by_class",
    lambda spark, sf: f.breadth_by_class(_now(spark, sf)),
    "last_funds",
    f"""SELECT asset_class, COUNT(*) AS n, {r('MEDIAN(num_holdings)')} AS median FROM last_funds
    WHERE num_holdings > 0 AND asset_class IS NOT NULL GROUP BY 1""",
)
register(
    "issuers",
    lambda spark, sf: f.issuers(_now(spark, sf), 12),
    "last_funds",
    f"""SELECT issuer, COUNT(*) AS fund_count, {r('SUM(aum)')} AS total_aum, COALESCE(string_agg(DISTINCT asset_class, '|' ORDER BY asset_class), '') AS asset_classes
    FROM last_funds GROUP BY 1 ORDER BY SUM(aum) DESC, issuer LIMIT 12""",
)
register(
    "issuer_profiles",
    lambda spark, sf: f.issuer_profiles(_now(spark, sf)),
    "last_funds",
    f"""SELECT issuer, COUNT(*) AS fund_count, {r('SUM(aum)')} AS total_aum, {r('AVG(net_expenses * 100)')} AS avg_expense_bps,
    (list(composite_ticker ORDER BY aum DESC, composite_ticker DESC))[1] AS largest_fund FROM last_funds GROUP BY 1""",
)
register(
    "issuer_classes",
    lambda spark, sf: f.issuer_classes(_now(spark, sf)),
    "last_funds",
    f"SELECT issuer, COALESCE(asset_class, 'Unknown') AS asset_class, COUNT(*) AS fund_count, {r('SUM(aum)')} AS total_aum FROM last_funds GROUP BY 1, 2",
)
register(
    "aum_running_share",
    lambda spark, sf: running_share(_now(spark, sf).where("aum > 0"), "aum", "composite_ticker"),
    "last_funds",
    f"""SELECT composite_ticker, {r('aum')} AS aum, ROW_NUMBER() OVER w AS rank, {r('SUM(aum) OVER w')} AS running_total,
    {r('SUM(aum) OVER w * 100.0 / (SELECT CAST(SUM(aum) AS DOUBLE) FROM last_funds WHERE aum > 0)')} AS running_pct
    FROM last_funds WHERE aum > 0 WINDOW w AS (ORDER BY last_funds.aum DESC, composite_ticker ROWS UNBOUNDED PRECEDING)""",
)
register(
    "aum_share_at",
    lambda spark, sf: share_at(_now(spark, sf).where("aum > 0"), "aum", "composite_ticker", [10, 50, 100, 200]),
    "last_funds",
    f"""WITH x AS (SELECT aum, ROW_NUMBER() OVER (ORDER BY aum DESC, composite_ticker) AS rn FROM last_funds WHERE aum > 0)
    SELECT t.top, {r('SUM(aum) * 100.0 / (SELECT CAST(SUM(aum) AS DOUBLE) FROM x)')} AS share_pct FROM x JOIN (VALUES (10), (50), (100), (200)) t(top) ON rn <= t.top
    GROUP BY 1 HAVING COUNT(*) = t.top""",
)
register(
    "aum_changes",
    lambda spark, sf: aum_changes(v.funds(spark, sf)),
    "funds",
    f"""WITH x AS (SELECT as_of_date, composite_ticker, aum, LAG(aum) OVER (PARTITION BY composite_ticker ORDER BY as_of_date) AS previous_aum FROM funds),
    y AS (SELECT *, CAST(aum - previous_aum AS DOUBLE) * 100 / NULLIF(CAST(ABS(previous_aum) AS DOUBLE), 0) AS change_pct FROM x)
    SELECT {d('as_of_date')} AS as_of_date, composite_ticker, {r('aum')} AS aum, {r('previous_aum')} AS previous_aum, {r('change_pct')} AS change_pct
    FROM y WHERE ABS(change_pct) >= 25""",
)
register(
    "key_findings",
    lambda spark, sf: f.key_findings(_now(spark, sf), s.at_latest(v.holdings(spark, sf))),
    "last_funds newest",
    f"""WITH per AS (SELECT composite_ticker, COUNT(*) AS n FROM newest GROUP BY 1),
    conc AS (SELECT composite_ticker, SUM(weight) AS w FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY composite_ticker ORDER BY weight DESC, constituent_ticker) AS rn FROM newest)
      WHERE rn <= 10 GROUP BY 1),
    top3 AS (SELECT SUM(a) AS a FROM (SELECT SUM(aum) AS a FROM last_funds GROUP BY issuer ORDER BY 1 DESC LIMIT 3))
    SELECT COUNT(*) AS fund_rows, {r('SUM(CAST(aum AS DOUBLE) / 1e12)')} AS total_aum_trn, {r("COUNT(*) FILTER (asset_class = 'Equity') * 100.0 / COUNT(*)")} AS equity_pct,
    {r('(SELECT a FROM top3) * 100.0 / CAST(SUM(aum) AS DOUBLE)')} AS top3_issuer_pct, (SELECT COUNT(*) FROM newest) AS holding_rows,
    (SELECT COUNT(DISTINCT constituent_ticker) FROM newest) AS securities,
    (SELECT COUNT(*) FROM last_funds WHERE composite_ticker IN (SELECT composite_ticker FROM per)) AS matched_funds,
    (SELECT {r('MEDIAN(n)')} FROM per) AS median_holdings, (SELECT {r('MEDIAN(w)')} FROM conc) AS median_top10 FROM last_funds""",
)
register(
    "fund_profiles",
    lambda spark, sf: fund_profiles(v.funds(spark, sf), v.holdings(spark, sf)).select(
        "composite_ticker", "issuer", "aum_bn", "actual_holdings", "total_weight", "top10_weight", "top25_weight", "top50_weight"
    ),
    "own_last_funds newest",
    f"""WITH x AS (SELECT composite_ticker, weight, ROW_NUMBER() OVER (PARTITION BY composite_ticker ORDER BY weight DESC, constituent_ticker) AS rn FROM newest),
    y AS (SELECT composite_ticker, COUNT(*) AS n, SUM(weight) AS w, SUM(weight) FILTER (rn <= 10) AS t10, SUM(weight) FILTER (rn <= 25) AS t25,
      SUM(weight) FILTER (rn <= 50) AS t50 FROM x GROUP BY 1)
    SELECT f.composite_ticker, issuer, {r(_AUM)} AS aum_bn, n AS actual_holdings, {r('w')} AS total_weight, {r('t10')} AS top10_weight, {r('t25')} AS top25_weight,
    {r('t50')} AS top50_weight FROM own_last_funds f LEFT JOIN y ON f.composite_ticker = y.composite_ticker""",
)
register(
    "random_funds",
    lambda spark, sf: sample_rows(_now(spark, sf).select("composite_ticker", "issuer"), "composite_ticker", 10),
    "last_funds",
    "SELECT composite_ticker, issuer FROM last_funds ORDER BY md5(composite_ticker || '|42'), composite_ticker LIMIT 10",
)

# --- named measures and the standing questions


def _model(spark, sf):
    return {
        "holdings": s.at_latest(v.holdings(spark, sf)),
        "funds": _now(spark, sf),
        "securities": v.securities(spark, sf),
    }


register(
    "measures_by_issuer",
    lambda spark, sf: measure_by(_model(spark, sf), ["weight", "market_value"], ["issuer"]),
    "newest last_funds",
    f"""SELECT issuer, {r('SUM(weight)')} AS weight, {r('SUM(market_value)')} AS market_value FROM newest n
    LEFT JOIN last_funds f ON n.composite_ticker = f.composite_ticker GROUP BY 1""",
)
register(
    "measures_by_security_type",
    lambda spark, sf: measure_by(_model(spark, sf), ["market_value"], ["security_type", "country"], F.col("country_of_exchange").isNotNull()),
    "newest securities",
    f"""SELECT s.security_type, n.country_of_exchange, {r('SUM(market_value)')} AS market_value FROM newest n
    LEFT JOIN securities s ON n.constituent_ticker = s.constituent_ticker WHERE n.country_of_exchange IS NOT NULL GROUP BY 1, 2""",
)
# Each table is summed on its own; a fund counts once for each value that its positions reach.
register(
    "measures_across_industries",
    lambda spark, sf: measures_across(_model(spark, sf), ["assets under management", "fund_count", "portfolio weight", "expense ratio"], ["sic_description"]),
    "newest last_funds securities",
    f"""WITH reached AS (SELECT DISTINCT composite_ticker, sic_description FROM newest LEFT JOIN securities USING (constituent_ticker)),
    a AS (SELECT sic_description, SUM(aum) AS aum, COUNT(*) AS fund_count, AVG(net_expenses) AS net_expenses FROM last_funds LEFT JOIN reached USING (composite_ticker) GROUP BY 1),
    b AS (SELECT sic_description, SUM(weight) AS weight FROM newest LEFT JOIN securities USING (constituent_ticker) GROUP BY 1)
    SELECT COALESCE(a.sic_description, b.sic_description) AS sic_description, {r('aum')} AS aum, fund_count, {r('weight')} AS weight, {r('net_expenses')} AS net_expenses
    FROM a FULL JOIN b ON a.sic_description IS NOT DISTINCT FROM b.sic_description""",
)
register(
    "measures_across_issuers",
    lambda spark, sf: measures_across(_model(spark, sf), ["security_count", "position value", "AUM"], ["provider", "securities.exchange"]),
    "newest last_funds securities",
    f"""WITH links AS (SELECT n.composite_ticker, n.constituent_ticker, n.market_value, f.issuer, s.exchange FROM newest n
      LEFT JOIN last_funds f ON n.composite_ticker = f.composite_ticker LEFT JOIN securities s ON n.constituent_ticker = s.constituent_ticker),
    counted AS (SELECT issuer, s.exchange, COUNT(*) AS security_count FROM securities s
      LEFT JOIN (SELECT DISTINCT constituent_ticker, issuer FROM links) l ON s.constituent_ticker = l.constituent_ticker GROUP BY ALL),
    summed AS (SELECT issuer, exchange, SUM(market_value) AS market_value FROM links GROUP BY ALL),
    owned AS (SELECT f.issuer, l.exchange, SUM(aum) AS aum FROM last_funds f
      LEFT JOIN (SELECT DISTINCT composite_ticker, exchange FROM links) l ON f.composite_ticker = l.composite_ticker GROUP BY ALL),
    every AS (SELECT issuer, exchange, security_count, NULL AS mv, NULL AS aum FROM counted UNION ALL SELECT issuer, exchange, NULL, market_value, NULL FROM summed
      UNION ALL SELECT issuer, exchange, NULL, NULL, aum FROM owned)
    SELECT issuer, exchange, MAX(security_count) AS security_count, {r('MAX(mv)')} AS market_value, {r('MAX(aum)')} AS aum FROM every GROUP BY ALL""",
)
register(
    "measures_across_filtered",
    lambda spark, sf: measures_across(
        _model(spark, sf), ["fund size", "position_count", "dollar value"], ["fund asset class"], {"securities.state_of_inc": lambda c: c.isin("DE", "NY")}
    ),
    "newest last_funds securities",
    f"""WITH hit AS (SELECT n.* FROM newest n JOIN securities s ON n.constituent_ticker = s.constituent_ticker WHERE s.state_of_inc IN ('DE', 'NY')),
    a AS (SELECT asset_class, SUM(aum) AS aum FROM last_funds WHERE composite_ticker IN (SELECT composite_ticker FROM hit) GROUP BY 1),
    b AS (SELECT f.asset_class, COUNT(*) AS position_count, SUM(market_value) AS market_value FROM hit LEFT JOIN last_funds f ON hit.composite_ticker = f.composite_ticker GROUP BY 1)
    SELECT COALESCE(a.asset_class, b.asset_class) AS asset_class, {r('aum')} AS aum, position_count, {r('market_value')} AS market_value
    FROM a FULL JOIN b ON a.asset_class IS NOT DISTINCT FROM b.asset_class""",
)
register(
    "question_aum_by_sector",
    lambda spark, sf: measure_by(_model(spark, sf), ["assets"], ["sector"]),
    "last_funds",
    f"SELECT sector_exposure, {r('SUM(aum)')} AS aum FROM last_funds GROUP BY 1",
)
register(
    "question_expense_by_category",
    lambda spark, sf: measure_by(_model(spark, sf), ["expense_ratio"], ["category"]),
    "last_funds",
    f"SELECT category, {r('AVG(net_expenses)')} AS net_expenses FROM last_funds GROUP BY 1",
)
register(
    "question_top_positions",
    lambda spark, sf: s.at_latest(v.named_holdings(spark, sf))
    .select("composite_ticker", "constituent_ticker", "constituent_name", "weight")
    .orderBy(F.desc("weight"), "composite_ticker", "constituent_ticker")
    .limit(10),
    "newest",
    f"SELECT composite_ticker, constituent_ticker, constituent_name, {r('weight')} AS weight FROM newest ORDER BY newest.weight DESC, composite_ticker, constituent_ticker LIMIT 10",
)
register(
    "question_most_constituents",
    lambda spark, sf: top_n(h.actual_holdings(s.at_latest(v.holdings(spark, sf))).select("composite_ticker", "actual_holdings"), "actual_holdings", "composite_ticker", 5),
    "newest",
    "SELECT composite_ticker, COUNT(*) AS actual_holdings FROM newest GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
)
register(
    "question_cheapest_issuers",
    lambda spark, sf: top_n(f.issuer_profiles(_now(spark, sf)).select("issuer", "avg_expense_bps"), "avg_expense_bps", "issuer", 10, largest=False),
    "last_funds",
    f"SELECT issuer, {r('AVG(net_expenses * 100)')} AS avg_expense_bps FROM last_funds GROUP BY 1 ORDER BY AVG(net_expenses * 100) NULLS LAST, issuer LIMIT 10",
)
register(
    "question_sector_exposure",
    lambda spark, sf: top_n(
        h.sector_exposure(s.at_latest(v.holdings(spark, sf)), v.securities(spark, sf)).where("sector = 'Industry 3'").select("composite_ticker", "weight"),
        "weight", "composite_ticker", 10,
    ),
    "newest securities",
    f"""SELECT composite_ticker, {r('SUM(weight)')} AS weight FROM newest SEMI JOIN (FROM securities WHERE sic_description = 'Industry 3') USING (constituent_ticker)
    GROUP BY 1 ORDER BY SUM(weight) DESC NULLS LAST, composite_ticker LIMIT 10""",
)
register(
    "question_overlap_above",
    lambda spark, sf: overlap_against(
        s.at_latest(v.holdings(spark, sf)), f.current_funds(v.funds(spark, sf)).orderBy(F.desc("aum"), "composite_ticker").limit(1).select("composite_ticker")
    )
    .where("overlap_by_weight > 3")
    .select("composite_ticker", "overlap_by_weight"),
    "newest last_funds",
    f"""WITH a AS (SELECT * FROM newest WHERE composite_ticker = (SELECT composite_ticker FROM last_funds ORDER BY aum DESC, composite_ticker LIMIT 1))
    SELECT b.composite_ticker, {r('SUM(LEAST(a.weight, b.weight))')} AS overlap_by_weight FROM a JOIN newest b ON a.constituent_ticker = b.constituent_ticker
    AND a.composite_ticker <> b.composite_ticker GROUP BY 1 HAVING SUM(LEAST(a.weight, b.weight)) > 3""",
)
