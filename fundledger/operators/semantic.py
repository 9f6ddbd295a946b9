"""Named measures and dimensions of the fund tables, with each measure's default aggregation.

:func:`measure_by` answers with the measures of one table. :func:`measures_across` drills across: it
aggregates every table with a wanted measure on its own, and joins only the aggregates. Where a dimension
lies behind a link from one to many (assets of funds by the sector of what they hold), a row of the
table counts once for each value that it reaches, however many rows lie in between.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Measures of the fund tables, by table, with their default aggregation.
MEASURES = {
    "holdings": {"weight": "sum", "market_value": "sum", "shares_held": "sum"},
    "funds": {
        "aum": "sum",
        "num_holdings": "avg",
        "management_fee": "avg",
        "net_expenses": "avg",
        "total_expenses": "avg",
        "bid_ask_spread": "avg",
        "short_interest": "sum",
        "discount_premium": "avg",
    },
}

# Counts of rows, which every table offers under a name of its own.
COUNTS = {"position_count": "holdings", "fund_count": "funds", "security_count": "securities"}

# Which column joins each table to the holdings, many to one from the holdings' side. It is
# also the key of that table at one snapshot.
LINKS = {"funds": "composite_ticker", "securities": "constituent_ticker"}

# Other words for names people use, where no table is meant in particular.
SYNONYMS = {
    "etf_ticker": "composite_ticker",
    "fund": "composite_ticker",
    "ticker": "constituent_ticker",
    "security": "constituent_ticker",
    "etf_name": "description",
    "assets": "aum",
    "expense_ratio": "net_expenses",
    "sector": "sector_exposure",
    "country": "country_of_exchange",
    "currency": "currency_traded",
}

# The declared synonyms of each table's columns. The same words may stand for a column of
# several tables; a name may then be written with its table, as in "funds.asset_class".
DECLARED = {
    "holdings": {
        "as_of_date": ["data date", "reporting date", "holding date", "as of"],
        "composite_ticker": ["etf_ticker", "ETF ticker", "fund ticker", "composite ticker", "ETF symbol"],
        "constituent_ticker": ["holding ticker", "stock ticker", "security ticker", "position ticker"],
        "constituent_name": ["holding name", "security name", "company name", "stock name"],
        "asset_class": ["holding asset class", "security class", "asset type"],
        "security_type": ["security classification", "instrument type"],
        "country_of_exchange": ["country", "listing country", "exchange country"],
        "exchange": ["stock exchange", "trading venue"],
        "currency_traded": ["currency", "trading currency"],
        "cusip": ["CUSIP code", "security identifier"],
        "isin": ["ISIN code", "international security identifier"],
        "weight": ["holding weight", "portfolio weight", "allocation", "position weight", "percentage weight"],
        "market_value": ["market value", "position value", "holding value", "dollar value"],
        "shares_held": ["shares", "number of shares", "share count"],
    },
    "funds": {
        "as_of_date": ["data date", "reporting date", "as of"],
        "inception_date": ["fund inception", "launch date", "start date"],
        "composite_ticker": ["etf_ticker", "ETF ticker", "fund ticker", "composite ticker", "ETF symbol"],
        "description": ["etf_name", "fund name", "ETF description", "fund description", "ETF full name"],
        "issuer": ["ETF issuer", "fund company", "fund family", "provider", "sponsor"],
        "asset_class": ["fund asset class", "ETF asset class", "investment type"],
        "category": ["ETF category", "fund category", "morningstar category"],
        "focus": ["ETF focus", "fund focus", "investment focus"],
        "development_class": ["market classification", "developed emerging", "market type"],
        "region": ["geographic region", "investment region", "target region"],
        "geographic_exposure": ["country exposure", "geographic focus"],
        "sector_exposure": ["sector", "sector focus", "industry sector"],
        "industry_exposure": ["industry", "industry focus"],
        "industry_group_exposure": ["industry group", "GICS industry group"],
        "currency_exposure": ["currency", "forex exposure"],
        "listing_exchange": ["exchange", "listed on", "trading exchange"],
        "tax_classification": ["tax type", "tax treatment"],
        "is_leveraged": ["leveraged", "uses leverage"],
        "is_active": ["active", "currently trading", "live fund"],
        "is_etn": ["ETN", "exchange traded note"],
        "distribution_frequency": ["dividend frequency", "payout frequency"],
        "primary_benchmark": ["benchmark", "index", "tracks index"],
        "aum": ["assets under management", "fund size", "total assets", "AUM"],
        "num_holdings": ["number of holdings", "number of constituents", "portfolio size", "holding count"],
        "management_fee": ["management fee", "advisory fee"],
        "net_expenses": ["expense ratio", "net expense ratio", "annual cost", "total cost", "fee"],
        "total_expenses": ["gross expense ratio", "total expense ratio", "gross expenses"],
        "bid_ask_spread": ["spread", "bid ask spread", "liquidity spread"],
        "short_interest": ["short interest", "shares sold short"],
        "discount_premium": ["premium discount", "NAV premium", "NAV discount", "price vs NAV"],
    },
    "securities": {
        "constituent_ticker": ["security ticker", "stock ticker", "holding ticker", "ticker symbol"],
        "constituent_name": ["security name", "company name", "full name"],
        "asset_class": ["security asset class", "asset type"],
        "security_type": ["instrument type", "security classification"],
        "country_of_exchange": ["country", "listing country", "exchange country"],
        "exchange": ["stock exchange", "trading venue", "listed exchange"],
        "currency_traded": ["currency", "trading currency"],
        "cusip": ["CUSIP code", "security identifier"],
        "isin": ["ISIN code", "international identifier"],
    },
}


def measure_by(
    tables: dict[str, DataFrame],
    measures: list[str],
    dimensions: list[str],
    where: Column | None = None,
) -> DataFrame:
    """Measures of one table by dimensions of it or of a table it links to.

    A dimension of another table joins that table once, on its declared column, before grouping.
    The other table must have one row per key at the chosen snapshot.
    """
    measures = [SYNONYMS.get(m, m) for m in measures]
    dimensions = [SYNONYMS.get(d, d) for d in dimensions]
    home = next(t for t, known in MEASURES.items() if all(m in known for m in measures))
    rows = tables[home]
    for other, key in LINKS.items():
        extra = [d for d in dimensions if d not in rows.columns and d in tables[other].columns]
        if extra and key in rows.columns:
            rows = rows.join(tables[other].select(key, *extra), key, "left")
    if where is not None:
        rows = rows.where(where)
    return rows.groupBy(*dimensions).agg(
        *[getattr(F, MEASURES[home][m])(m).alias(m) for m in measures]
    )


def resolve(name: str, tables: dict[str, DataFrame], near: list[str]) -> tuple[str, str]:
    """(table, column) of a dimension: by its own name or a synonym, of the tables in ``near`` before others.

    ``table.name`` asks for one table's column.
    """
    home, _, own = name.rpartition(".")
    order = [home] if home else [*near, *(t for t in tables if t not in near)]
    for match in (str, str.lower):
        for t in order:
            known = {**{c: c for c in tables[t].columns}, **{w: c for c, words in DECLARED[t].items() for w in words}}
            found = {match(k): c for k, c in known.items()}.get(match(own))
            if found in tables[t].columns:
                return t, found
    if own in SYNONYMS and SYNONYMS[own] != own:
        return resolve(f"{home}.{SYNONYMS[own]}" if home else SYNONYMS[own], tables, near)
    raise ValueError(f"no table has a column {name}")


def resolve_measure(name: str) -> tuple[str, str]:
    """(table, measure) of a measure's name or synonym."""
    if name in COUNTS:
        return COUNTS[name], name
    for t, known in MEASURES.items():
        for m in known:
            if name.lower() in (m, *(w.lower() for w in DECLARED[t].get(m, ()))) or SYNONYMS.get(name) == m:
                return t, m
    raise ValueError(f"no table has a measure {name}")


def path_between(start: str, end: str) -> list[str]:
    """The tables from one to another along the declared links; holdings is linked to all others."""
    if start == end:
        return [start]
    return [start, end] if "holdings" in (start, end) else [start, "holdings", end]


def _attached(rows: DataFrame, home: str, tables: dict[str, DataFrame], wanted: list[tuple[str, str, str]]) -> DataFrame:
    """``rows`` of ``home`` with the dimensions (table, column, alias), one row for each value that a row reaches.

    A table that one row of holdings has at most one row of is joined as it is. From funds or securities
    the way leads through their holdings: there the distinct pairs of key and values are found first, from
    two columns of the holdings, and only they are joined.
    """
    own = [(c, alias) for t, c, alias in wanted if t == home]
    out = rows.withColumns({alias: F.col(c) for c, alias in own}) if own else rows
    if home == "holdings":
        for t in dict.fromkeys(t for t, _, _ in wanted if t != home):
            more = [F.col(c).alias(alias) for k, c, alias in wanted if k == t]
            out = out.join(tables[t].select(F.col(LINKS[t]).alias("_key"), *more), F.col(LINKS[t]) == F.col("_key"), "left").drop("_key")
        return out
    far = [x for x in wanted if x[0] != home]
    if not far:
        return out
    key = LINKS[home]
    columns = {key, *(LINKS[t] for t, _, _ in far if t != "holdings"), *(c for t, c, _ in far if t == "holdings")}
    between = _attached(tables["holdings"].select(*sorted(columns)), "holdings", tables, far)
    values = between.select(F.col(key).alias("_key"), *[alias for _, _, alias in far]).distinct()
    return out.join(values, F.col(key) == F.col("_key"), "left").drop("_key")


def measures_across(
    tables: dict[str, DataFrame],
    measures: list[str],
    dimensions: list[str],
    where: dict[str, Callable[[Column], Column]] | None = None,
) -> DataFrame:
    """Measures of any tables by dimensions of any tables.

    ``tables`` has holdings, funds and securities at one snapshot: funds and securities one row per key.
    Each measure is aggregated over its own table by its default; a row counts once for each combination
    of dimension values that the links lead it to, and for none twice. ``where`` maps dimensions to
    conditions; a row counts if it reaches a value that meets them. Values that a row doesn't reach are null.
    A combination that one table lacks has nulls for its measures. Without dimensions there is one row.
    """
    resolved = [resolve_measure(m) for m in measures]
    homes = list(dict.fromkeys(t for t, _ in resolved))
    near = [*homes, "holdings"]
    found = [resolve(d, tables, near) for d in dimensions]
    plain = [c for _, c in found]
    names = [c if plain.count(c) == 1 else f"{t}_{c}" for t, c in found]
    kept = [(t, c, f"_d{i}") for i, (t, c) in enumerate(found)]
    tests = [(*resolve(d, tables, near), f"_w{i}") for i, d in enumerate(where or {})]
    parts = []
    for home in homes:
        rows = _attached(tables[home], home, tables, kept + tests)
        for (_, _, alias), test in zip(tests, (where or {}).values()):
            rows = rows.where(test(F.col(alias)))
        if home != "holdings" and any(t != home for t, _, _ in tests):
            # Values tested but not shown may be reached more than once.
            rows = rows.drop(*[alias for _, _, alias in tests]).dropDuplicates([LINKS[home], *[a for _, _, a in kept]])
        mine = [m for t, m in resolved if t == home]
        sums = [(F.count(F.lit(1)) if m in COUNTS else getattr(F, MEASURES[home][m])(m)).alias(m) for m in mine]
        parts.append(rows.groupBy(*[alias for _, _, alias in kept]).agg(*sums))
    # Few rows: one for each combination and table. Nulls are values like others here.
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    one = every.groupBy(*[alias for _, _, alias in kept]).agg(*[F.max(m).alias(m) for _, m in resolved])
    return one.select(*[F.col(alias).alias(n) for (_, _, alias), n in zip(kept, names)], *[m for _, m in resolved])
