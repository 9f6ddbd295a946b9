"""The fund and filing tables as views of the provided star schema, in Spark and in SQL.

The SQL texts serve the check only. Both sides state the same rules: keys become tickers and
company numbers, order lines become positions and tagged facts, orders become filings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundledger.functions.codes import COUNTRY_CODES
from fundledger.functions.text import pad_zeros

# Values of the views, shared by both sides.
# Some countries with a code, the home country, and one without a code.
_CODED = [c for c in sorted(COUNTRY_CODES) if c != "US"]
COUNTRIES = [*_CODED[:: len(_CODED) // 23][:23], "US", "ZW"]
EXCHANGES = ["NYSE", "Nasdaq", "LSE", "TSE"]
CURRENCIES = ["USD", "EUR", "JPY", "GBP", "CNY"]
SECTORS = ["Technology", "Health Care", "Financials", "Energy", "Utilities"]
STATES = ["DE", "NY", "CA", "TX", "NV"]
CATEGORIES = [
    "Large accelerated filer",
    "Accelerated filer<br>Smaller reporting company",
    "Non-accelerated filer",
]
FORMS = (
    ["10-Q"] * 6 + ["10-K"] * 2 + ["10-K/A", "10-Q/A"] + ["8-K"] * 6 + ["S-4", "SC 13E-3", "4", "4"]
)
FACT_FORMS = ["10-K", "10-Q", "10-K/A", "10-Q/A"]
CONCEPTS = [
    ("us-gaap", "Revenues", "USD"),
    ("us-gaap", "RevenueFromContractWithCustomerExcludingAssessedTax", "USD"),
    ("ifrs-full", "Revenue", "USD"),
    ("us-gaap", "NetIncomeLoss", "USD"),
    ("us-gaap", "ProfitLoss", "USD"),
    ("us-gaap", "Assets", "USD"),
    ("ifrs-full", "Assets", "USD"),
    ("us-gaap", "StockholdersEquity", "USD"),
    ("us-gaap", "LongTermDebt", "USD"),
    ("us-gaap", "EarningsPerShareDiluted", "USD/shares"),
    ("dei", "EntityCommonStockSharesOutstanding", "shares"),
    ("us-gaap", "CommonStockSharesOutstanding", "shares"),
    ("us-gaap", "OperatingIncomeLoss", "USD"),
    ("us-gaap", "CashAndCashEquivalentsAtCarryingValue", "USD"),
]
PAGE_ORDERS = 1000


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Rows dealt out to all tasks: a short table is one row group, which one task reads, however much work a row brings."""
    return rows.hint("rebalance")


def _pick(values: list[str], place: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (place + 1).cast("int"))


def _digits(c: str, n: int) -> Column:
    return pad_zeros(c, n)


def _fund(c: str) -> Column:
    suffix = F.when(F.col(c) % 7 == 3, ".A").when(F.col(c) % 7 == 5, " B").otherwise("")
    return F.concat(F.lit("F"), _digits(c, 10), suffix)


def _security(c: str) -> Column:
    suffix = F.when(F.col(c) % 5 == 0, " B").when(F.col(c) % 5 == 1, ".A").otherwise("")
    return F.concat(F.lit("P"), _digits(c, 12), suffix)


def _identity(k: str) -> dict[str, Column]:
    key = F.col(k)
    return {
        "constituent_ticker": _security(k),
        "asset_class": F.when(key % 7 < 5, "Equity").when(key % 7 == 5, "Fixed Income"),
        "country_of_exchange": F.when(key % 17 != 0, _pick(COUNTRIES, key % 25)),
        "exchange": _pick(EXCHANGES, key % 4),
        "currency_traded": _pick(CURRENCIES, key % 5),
        "cusip": F.when(key % 3 == 0, "").otherwise(F.concat(F.lit("C"), key.cast("string"))),
        "isin": F.when(key % 4 != 0, F.concat(F.lit("I"), _digits(k, 12))),
    }


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.trunc(F.to_date("l_shipdate"), "year").alias("as_of_date"),
        "l_suppkey",
        "l_partkey",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        "l_quantity",
    )


def _positions(spark: SparkSession, sf: str) -> DataFrame:
    lines = _lines(spark, sf)
    positions = lines.groupBy("as_of_date", "l_suppkey", "l_partkey").agg(
        F.sum("price").alias("market_value"), F.sum("l_quantity").alias("shares_held")
    )
    # Totals come from the positions, whose aggregation both sides share. Queries that take no weight
    # need no totals: the left join on a unique key then drops out of their plan.
    totals = positions.groupBy("as_of_date", "l_suppkey").agg(F.sum("market_value").alias("fund_value"))
    return positions.join(totals, ["as_of_date", "l_suppkey"], "left").withColumns(
        {
            "composite_ticker": _fund("l_suppkey"),
            **_identity("l_partkey"),
            "weight": F.when(
                F.col("l_partkey") % 71 != 3,
                F.lit(100.0) * F.col("market_value").cast("double") / F.col("fund_value").cast("double"),
            ),
        }
    )


HOLDING_COLUMNS = [
    "as_of_date", "composite_ticker", "constituent_ticker", "asset_class", "country_of_exchange",
    "exchange", "currency_traded", "cusip", "isin", "weight", "market_value", "shares_held",
]


def holdings(spark: SparkSession, sf: str) -> DataFrame:
    """Positions without the two columns that need the part table."""
    return _positions(spark, sf).select(*HOLDING_COLUMNS)


def named_holdings(spark: SparkSession, sf: str) -> DataFrame:
    """Positions with security name and type."""
    parts = table(spark, sf, "part").select(
        "p_partkey", F.col("p_name").alias("constituent_name"), F.col("p_type").alias("security_type")
    )
    rows = _positions(spark, sf)
    return rows.join(parts, rows.l_partkey == parts.p_partkey).select(
        *HOLDING_COLUMNS, "constituent_name", "security_type"
    )


def _carelessly(spark: SparkSession, sf: str, rows: DataFrame) -> DataFrame:
    """Identities and names as a careless source delivers them: odd case, blanks, missing tickers."""
    parts = table(spark, sf, "part").select(
        "p_partkey",
        F.concat(F.lit(" "), "p_name").alias("constituent_name"),
        F.col("p_type").alias("security_type"),
    )
    key, t = F.col("l_partkey"), F.col("constituent_ticker")
    odd = (
        F.when(key % 97 == 0, F.lower(t))
        .when(key % 89 == 0, F.concat(F.lit(" "), t, F.lit(" ")))
        .when(key % 83 == 0, F.lit(" "))
        .when(key % 79 != 0, t)
    )
    return rows.join(parts, rows.l_partkey == parts.p_partkey).withColumn("constituent_ticker", odd)


def dirty_holdings(spark: SparkSession, sf: str) -> DataFrame:
    """Positions as a careless source delivers them."""
    return _carelessly(spark, sf, _positions(spark, sf)).select(*HOLDING_COLUMNS, "constituent_name", "security_type")


def dirty_identities(spark: SparkSession, sf: str) -> DataFrame:
    """Who held what when, of ``dirty_holdings``: a row for each order line, as nothing here is a sum.

    Keys move before they become wide rows, and into all shuffle tasks: they pack so well that adaptive merging
    would give a task more of them than it can hold as text. The rows of a security meet.
    """
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lines = _lines(spark, sf).select("as_of_date", "l_suppkey", "l_partkey").repartition(tasks, "l_partkey")
    rows = lines.withColumns({"composite_ticker": _fund("l_suppkey"), **_identity("l_partkey")})
    measures = ["weight", "market_value", "shares_held"]
    columns = [c for c in HOLDING_COLUMNS if c not in measures]
    return _carelessly(spark, sf, rows).select(*columns, "constituent_name", "security_type")


def funds(spark: SparkSession, sf: str) -> DataFrame:
    """One row per fund and snapshot in which it has positions."""
    seen = _lines(spark, sf).select("as_of_date", "l_suppkey").distinct()
    s = table(spark, sf, "supplier")
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    key, year = F.col("s_suppkey"), F.year("as_of_date")
    swing = F.lit(1.0) + ((key * 7 + year) % 11 - 5) / F.lit(20.0)
    return (
        seen.join(s, seen.l_suppkey == s.s_suppkey)
        .join(n, s.s_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(
            "as_of_date",
            _fund("s_suppkey").alias("composite_ticker"),
            F.col("s_name").alias("description"),
            F.col("n_name").alias("issuer"),
            F.when(key % 4 == 0, "Fixed Income")
            .when(key % 4 == 1, "Alternatives")
            .when(key % 13 != 2, "Equity")
            .alias("asset_class"),
            F.concat(F.lit("CAT"), (key % 12).cast("string")).alias("category"),
            F.col("r_name").alias("region"),
            F.when(key % 3 == 0, "Developed").when(key % 3 == 1, "Emerging").alias("development_class"),
            F.when(key % 6 < 5, _pick(SECTORS, F.pmod(key, F.lit(5)))).alias("sector_exposure"),
            F.when(key % 8 == 0, "Monthly").when(key % 8 < 6, "Quarterly").alias("distribution_frequency"),
            (key % 10 == 0).alias("is_leveraged"),
            F.when(key % 10 == 0, F.when(key % 20 == 0, 2.0).otherwise(3.0)).alias("leveraged_amount"),
            (key % 50 != 0).alias("is_active"),
            (key % 20 == 0).alias("is_etn"),
            F.round(F.col("s_acctbal") * 1e6 * swing, 2).cast("decimal(22,2)").alias("aum"),
            F.when(key % 11 != 0, (key % 150) / F.lit(100.0)).alias("net_expenses"),
            F.when(key % 9 != 0, (F.lit(80) + key % 10).cast("int")).alias("num_holdings"),
        )
    )


def securities(spark: SparkSession, sf: str) -> DataFrame:
    """The enriched security master, one row per part."""
    key = F.col("p_partkey")
    done = key % 10 != 0
    with_cik = key % 10 >= 2
    return table(spark, sf, "part").select(
        *[c.alias(name) for name, c in _identity("p_partkey").items() if name != "cusip"],
        F.when(key % 3 != 0, F.concat(F.lit("C"), key.cast("string"))).alias("cusip"),
        F.col("p_name").alias("constituent_name"),
        F.col("p_type").alias("security_type"),
        F.when(with_cik, key.cast("string")).alias("edgar_cik"),
        F.when(with_cik, F.concat(F.lit("Company "), key.cast("string"))).alias("edgar_name"),
        F.when(with_cik & (key % 13 != 0), (F.lit(1000) + key % 12 * 100).cast("string")).alias("sic_code"),
        F.when(with_cik & (key % 13 != 0), F.concat(F.lit("Industry "), (key % 12).cast("string"))).alias("sic_description"),
        F.when(with_cik & (key % 6 != 5), _pick(STATES, key % 5)).alias("state_of_inc"),
        F.when(with_cik, F.when(key % 2 == 0, "operating").otherwise("investment")).alias("entity_type"),
        F.when(with_cik, F.when(key % 3 == 0, "NYSE|Nasdaq").when(key % 3 == 1, "Nasdaq").otherwise(" nyse |OTC")).alias("listed_exchanges"),
        F.when(with_cik & (key % 9 != 0), _pick(["Large accelerated filer", "Accelerated filer", "Non-accelerated filer"], key % 3)).alias("filer_category"),
        F.when(done, key % 10 > 3).alias("active_flag"),
        F.when(key % 10 == 1, "not_in_edgar_tickers")
        .when(key % 10 == 2, "deregistration_15-12G")
        .when(key % 10 == 3, F.when(key % 4 != 1, "no_recent_10k_10q"))
        .alias("inactive_reason"),
        F.when(with_cik & (key % 5 != 2), key * 7919 % 1000003 * 1000 + 1).alias("shares_outstanding"),
        F.when(with_cik & (key % 5 != 2), F.date_add(F.lit("2000-01-01").cast("date"), (key % 900).cast("int"))).alias("shares_as_of_date"),
        F.when(done, F.date_add(F.lit("2024-01-01").cast("date"), (key % 365).cast("int")).cast("timestamp_ntz")).alias("edgar_enriched_at"),
    )


def tickers(spark: SparkSession, sf: str) -> DataFrame:
    """Registered companies with ticker and exchange, one row per customer."""
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    return table(spark, sf, "customer").select(
        key.alias("cik"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("P"), _digits("c_custkey", 12), F.when(key % 5 == 0, "-B").when(key % 5 == 1, "A").otherwise("")).alias("ticker"),
        F.when(segment == "AUTOMOBILE", "NYSE")
        .when(segment == "BUILDING", "Nasdaq")
        .when(segment == "FURNITURE", "OTC")
        .when(segment == "MACHINERY", "CBOE")
        .alias("exchange"),
    )


def filings(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze filing rows, one per order."""
    key = F.col("o_orderkey")
    form = F.when(key % 400 == 18, "15-12G").otherwise(_pick(FORMS, key % 20))
    item = F.when(key % 3 == 0, "1.03").when(key % 3 == 1, "5.03,9.01").otherwise("2.01,9.01")
    return table(spark, sf, "orders").select(
        _digits("o_custkey", 10).alias("cik"),
        F.concat(_digits("o_custkey", 10), F.lit("-"), _digits("o_orderkey", 12)).alias("accessionNumber"),
        F.to_date("o_orderdate").cast("string").alias("filingDate"),
        F.when(key % 20 < 18, F.date_sub(F.to_date("o_orderdate"), 30).cast("string")).alias("reportDate"),
        form.alias("form"),
        F.when((key % 20).between(10, 15), item).otherwise("").alias("items"),
        (key % 2).alias("isXBRL"),
        F.concat(F.lit("doc"), key.cast("string"), F.lit(".htm")).alias("primaryDocument"),
        key.alias("_orderkey"),
        F.col("o_custkey").alias("_custkey"),
    )


def _fact_rows(spark: SparkSession, sf: str, by: list[str] | None = None) -> DataFrame:
    """Tagged values with the keys they come from; ``by`` names the keys whose rows are to lie in one task."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"
    )
    rows = li.join(o, li.l_orderkey == o.o_orderkey).withColumns(
        {"_custkey": F.col("o_custkey"), "page": F.floor(F.col("o_orderkey") / PAGE_ORDERS)}
    )
    rows = rows.repartition(*by) if by else rows
    concept, span = F.col("l_partkey") % 14, F.col("l_suppkey") % 5
    end = F.trunc(F.to_date("l_shipdate"), "year")
    days = F.when(span == 1, 90).when(span == 2, 270).otherwise(365)
    return rows.select(
        _digits("o_custkey", 10).alias("cik"),
        F.concat(F.lit("Customer#"), _digits("o_custkey", 9)).alias("entity_name"),
        _pick([c[0] for c in CONCEPTS], concept).alias("namespace"),
        _pick([c[1] for c in CONCEPTS], concept).alias("concept"),
        _pick([c[1] for c in CONCEPTS], concept).alias("label"),
        _pick([c[2] for c in CONCEPTS], concept).alias("unit"),
        end.cast("string").alias("end"),
        F.when(span != 0, F.date_sub(end, days).cast("string")).alias("start"),
        (F.col("l_extendedprice").cast("double") / F.when(F.col("l_partkey") % 29 == 5, 1e5).otherwise(1.0)).alias("val"),
        F.concat(_digits("o_custkey", 10), F.lit("-"), _digits("o_orderkey", 12)).alias("accn"),
        _pick(FACT_FORMS, F.col("l_orderkey") % 4).alias("form"),
        F.to_date("o_orderdate").cast("string").alias("filed"),
        F.when(span >= 3, F.concat(F.lit("CY"), F.year(end).cast("string"))).alias("frame"),
        F.when(F.col("l_suppkey") % 11 != 0, F.year(end) + (F.col("o_custkey") % 3 == 0).cast("int")).alias("fy"),
        F.when(F.col("l_suppkey") % 11 != 0, F.when(F.col("l_orderkey") % 4 % 2 == 0, "FY").otherwise(F.concat(F.lit("Q"), (F.col("o_custkey") % 4 + 1).cast("string")))).alias("fp"),
        "_custkey",
        "page",
    )


def facts(spark: SparkSession, sf: str) -> DataFrame:
    """Tagged values, one per order line."""
    return _fact_rows(spark, sf).drop("_custkey", "page")


# Raw documents. A company's rows are cut into pages of PAGE_ORDERS consecutive order keys, so no
# document, and no group that makes one, grows with the company.


def company_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Submission documents without filings, one per company."""
    key = F.col("c_custkey")
    address = F.struct(
        F.concat(key.cast("string"), F.lit(" Main St")).alias("street1"),
        F.lit(None).cast("string").alias("street2"),
        F.lit("Springfield").alias("city"),
        _pick(STATES, key % 5).alias("stateOrCountry"),
        _digits("c_custkey", 5).alias("zipCode"),
        F.lit("X").alias("countryCode"),
    )
    named = tickers(spark, sf).select(F.col("cik").alias("_k"), "ticker", "exchange")
    rows = spread(table(spark, sf, "customer"))
    rows = rows.join(named, rows.c_custkey == named._k)
    doc = F.struct(
        key.cast("string").alias("cik"),
        F.when(key % 211 != 7, F.col("c_name")).alias("name"),
        F.when(key % 2 == 0, "operating").otherwise("other").alias("entityType"),
        (F.lit(1000) + key % 12 * 100).cast("string").alias("sic"),
        F.concat(F.lit("Industry "), (key % 12).cast("string")).alias("sicDescription"),
        _pick(STATES, key % 5).alias("stateOfIncorporation"),
        F.concat(F.lpad((key % 12 + 1).cast("string"), 2, "0"), F.lit("28")).alias("fiscalYearEnd"),
        _digits("c_custkey", 9).alias("ein"),
        _pick(CATEGORIES, key % 3).alias("category"),
        F.array("ticker").alias("tickers"),
        F.array("exchange", "exchange", F.lit("CBOE")).alias("exchanges"),
        F.create_map(F.lit("business"), address).alias("addresses"),
        F.struct(
            F.when(key % 4 == 0, F.array(F.struct(F.lit("older.json").alias("name"), F.lit(40).alias("filingCount")))).alias("files")
        ).alias("filings"),
    )
    return rows.select(F.lit("companies").alias("path"), F.to_json(doc).alias("raw"))


def paged_filings(spark: SparkSession, sf: str) -> DataFrame:
    """Filings with the page of their company that lists them."""
    return filings(spark, sf).withColumn("page", F.floor(F.col("_orderkey") / PAGE_ORDERS))


def filing_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Submission documents with parallel filing arrays, newest first; one per company and page."""
    fields = ["accessionNumber", "filingDate", "reportDate", "form", "items", "isXBRL", "primaryDocument"]
    pages = (
        paged_filings(spark, sf)
        .groupBy("cik", "page")
        .agg(
            F.sort_array(F.collect_list(F.struct("filingDate", "accessionNumber", *fields[2:])), asc=False).alias("f")
        )
    )
    # Some companies send one item list too many: their arrays differ in length.
    odd = F.col("cik").cast("bigint") % 97 == 11
    columns = {n: F.col(f"f.{n}") for n in fields}
    columns["items"] = F.when(odd, F.concat("f.items", F.array(F.lit("x")))).otherwise(F.col("f.items"))
    recent = F.struct(*[c.alias(n) for n, c in columns.items()])
    doc = F.struct(
        F.col("cik"),
        F.concat(F.lit("Company "), "cik").alias("name"),
        F.struct(recent.alias("recent")).alias("filings"),
    )
    keep_nulls = {"ignoreNullFields": "false"}
    return pages.select("cik", "page", F.lit("filings").alias("path"), F.to_json(doc, keep_nulls).alias("raw"))


def fact_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Company-facts documents of nested maps; one per company and page."""
    entry = ["accn", "end", "start", "val", "fy", "fp", "form", "filed", "frame"]
    # Keys and numbers move to their document's task, and become text there. All levels are then grouped in place.
    key = ["_custkey", "page", "cik", "entity_name"]
    rows = _fact_rows(spark, sf, ["_custkey", "page"])
    units = rows.groupBy(*key, "namespace", "concept", "label", "unit").agg(
        F.collect_list(F.struct(*entry)).alias("entries")
    )
    concepts = units.groupBy(*key, "namespace", "concept", "label").agg(
        F.map_from_entries(F.collect_list(F.struct("unit", "entries"))).alias("units")
    )
    spaces = concepts.groupBy(*key, "namespace").agg(
        F.map_from_entries(F.collect_list(F.struct("concept", F.struct("label", "units")))).alias("concepts")
    )
    docs = spaces.groupBy(*key).agg(
        F.map_from_entries(F.collect_list(F.struct("namespace", "concepts"))).alias("facts")
    )
    doc = F.struct(F.col("cik").cast("bigint").alias("cik"), F.col("entity_name").alias("entityName"), "facts")
    return docs.select(F.lit("facts").alias("path"), F.to_json(doc).alias("raw"))


def concept_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Company-concept documents of share counts; one per company, concept and page."""
    rows = _fact_rows(spark, sf).where("unit = 'shares'")
    docs = rows.groupBy("cik", "namespace", "concept", "page").agg(
        F.collect_list(F.struct("accn", "end", "val", "form", "filed")).alias("points")
    )
    doc = F.struct(
        F.col("cik").cast("bigint").alias("cik"),
        F.col("namespace").alias("taxonomy"),
        F.col("concept").alias("tag"),
        F.create_map(F.lit("shares"), "points").alias("units"),
    )
    return docs.select(F.lit("concepts").alias("path"), F.to_json(doc).alias("raw"))


def ticker_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Fields-and-rows documents of tickers, a thousand companies each."""
    page = F.floor(F.col("cik") / PAGE_ORDERS)
    row = F.array(F.col("cik").cast("string"), "name", "ticker", "exchange")
    docs = tickers(spark, sf).groupBy(page.alias("page")).agg(F.collect_list(row).alias("data"))
    fields = F.array(*[F.lit(f) for f in ("cik", "name", "ticker", "exchange")])
    doc = F.struct(fields.alias("fields"), "data")
    return docs.select(F.lit("tickers").alias("path"), F.to_json(doc).alias("raw"))


def ticker_map_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Dict-of-records documents of tickers, a thousand companies each; tickers in mixed case."""
    rows = tickers(spark, sf).withColumn("page", F.floor(F.col("cik") / PAGE_ORDERS))
    entry = F.struct(
        F.col("cik").alias("cik_str"),
        F.concat(F.lit(" "), F.lower("ticker")).alias("ticker"),
        F.col("name").alias("title"),
    )
    docs = rows.groupBy("page").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("cik").cast("string"), entry))).alias("m")
    )
    return docs.select(F.lit("map").alias("path"), F.to_json("m").alias("raw"))


# The same views for the check.


def _list(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _sql_pad(c: str, n: int) -> str:
    return f"lpad(CAST({c} AS VARCHAR), CAST(greatest(length(CAST({c} AS VARCHAR)), {n}) AS INTEGER), '0')"


def _sql_fund(k: str) -> str:
    return f"'F' || {_sql_pad(k, 10)} || CASE {k} % 7 WHEN 3 THEN '.A' WHEN 5 THEN ' B' ELSE '' END"


def _sql_identity(k: str) -> str:
    return f"""'P' || {_sql_pad(k, 12)} || CASE {k} % 5 WHEN 0 THEN ' B' WHEN 1 THEN '.A' ELSE '' END AS constituent_ticker,
    CASE WHEN {k} % 7 < 5 THEN 'Equity' WHEN {k} % 7 = 5 THEN 'Fixed Income' END AS asset_class,
    CASE WHEN {k} % 17 <> 0 THEN list_extract({_list(COUNTRIES)}, {k} % 25 + 1) END AS country_of_exchange,
    list_extract({_list(EXCHANGES)}, {k} % 4 + 1) AS exchange,
    list_extract({_list(CURRENCIES)}, {k} % 5 + 1) AS currency_traded,
    CASE WHEN {k} % 4 <> 0 THEN 'I' || {_sql_pad(k, 12)} END AS isin"""


_CUSIP = "CASE WHEN {k} % 3 = 0 THEN '' ELSE 'C' || CAST({k} AS VARCHAR) END AS cusip"

SQL_VIEWS = {
    "lines": ((), """SELECT CAST(date_trunc('year', l_shipdate) AS DATE) AS as_of_date, l_suppkey, l_partkey,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS price, l_quantity FROM lineitem"""),
    "positions": (("lines",), f"""SELECT p.*, t.fund_value, {_sql_fund('p.l_suppkey')} AS composite_ticker,
    {_sql_identity('p.l_partkey')}, {_CUSIP.format(k='p.l_partkey')},
    CASE WHEN p.l_partkey % 71 <> 3 THEN 100.0 * CAST(market_value AS DOUBLE) / CAST(fund_value AS DOUBLE) END AS weight
    FROM (SELECT as_of_date, l_suppkey, l_partkey, SUM(price) AS market_value, SUM(l_quantity) AS shares_held FROM lines GROUP BY ALL) p
    JOIN (SELECT as_of_date, l_suppkey, SUM(price) AS fund_value FROM lines GROUP BY ALL) t
    ON p.as_of_date = t.as_of_date AND p.l_suppkey = t.l_suppkey"""),
    "holdings": (("positions",), "SELECT positions.*, p_name AS constituent_name, p_type AS security_type FROM positions JOIN part ON l_partkey = p_partkey"),
    "dirty_holdings": (("positions",), """SELECT positions.* REPLACE (CASE WHEN l_partkey % 97 = 0 THEN lower(constituent_ticker)
    WHEN l_partkey % 89 = 0 THEN ' ' || constituent_ticker || ' ' WHEN l_partkey % 83 = 0 THEN ' '
    WHEN l_partkey % 79 <> 0 THEN constituent_ticker END AS constituent_ticker),
    ' ' || p_name AS constituent_name, p_type AS security_type FROM positions JOIN part ON l_partkey = p_partkey"""),
    "best": (("holdings",), "SELECT as_of_date FROM holdings GROUP BY 1 ORDER BY COUNT(*) DESC, as_of_date DESC LIMIT 1"),
    "current": (("holdings", "best"), "SELECT * FROM holdings WHERE as_of_date = (SELECT as_of_date FROM best)"),
    "newest": (("holdings",), "SELECT * FROM holdings WHERE as_of_date = (SELECT MAX(as_of_date) FROM holdings)"),
    "funds": (("lines",), f"""SELECT as_of_date, {_sql_fund('s_suppkey')} AS composite_ticker, s_name AS description, n_name AS issuer,
    CASE WHEN s_suppkey % 4 = 0 THEN 'Fixed Income' WHEN s_suppkey % 4 = 1 THEN 'Alternatives' WHEN s_suppkey % 13 <> 2 THEN 'Equity' END AS asset_class,
    'CAT' || CAST(s_suppkey % 12 AS VARCHAR) AS category, r_name AS region,
    CASE s_suppkey % 3 WHEN 0 THEN 'Developed' WHEN 1 THEN 'Emerging' END AS development_class,
    CASE WHEN s_suppkey % 6 < 5 THEN list_extract({_list(SECTORS)}, s_suppkey % 5 + 1) END AS sector_exposure,
    CASE WHEN s_suppkey % 8 = 0 THEN 'Monthly' WHEN s_suppkey % 8 < 6 THEN 'Quarterly' END AS distribution_frequency,
    s_suppkey % 10 = 0 AS is_leveraged,
    CASE WHEN s_suppkey % 20 = 0 THEN 2.0 WHEN s_suppkey % 10 = 0 THEN 3.0 END AS leveraged_amount,
    s_suppkey % 50 <> 0 AS is_active, s_suppkey % 20 = 0 AS is_etn,
    CAST(ROUND(s_acctbal * 1e6 * (CAST(1 AS DOUBLE) + ((s_suppkey * 7 + year(as_of_date)) % 11 - 5) / CAST(20 AS DOUBLE)), 2) AS DECIMAL(22,2)) AS aum,
    CASE WHEN s_suppkey % 11 <> 0 THEN (s_suppkey % 150) / CAST(100 AS DOUBLE) END AS net_expenses,
    CASE WHEN s_suppkey % 9 <> 0 THEN 80 + s_suppkey % 10 END AS num_holdings
    FROM (SELECT DISTINCT as_of_date, l_suppkey FROM lines) x JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    "last_funds": (("funds",), "SELECT * FROM funds WHERE as_of_date = (SELECT MAX(as_of_date) FROM funds)"),
    "own_last_funds": (("funds",), "SELECT * FROM funds QUALIFY ROW_NUMBER() OVER (PARTITION BY composite_ticker ORDER BY as_of_date DESC) = 1"),
    "securities": ((), f"""SELECT {_sql_identity('p_partkey')},
    CASE WHEN p_partkey % 3 <> 0 THEN 'C' || CAST(p_partkey AS VARCHAR) END AS cusip, p_name AS constituent_name, p_type AS security_type,
    CASE WHEN p_partkey % 10 >= 2 THEN CAST(p_partkey AS VARCHAR) END AS edgar_cik,
    CASE WHEN p_partkey % 10 >= 2 THEN 'Company ' || CAST(p_partkey AS VARCHAR) END AS edgar_name,
    CASE WHEN p_partkey % 10 >= 2 AND p_partkey % 13 <> 0 THEN CAST(1000 + p_partkey % 12 * 100 AS VARCHAR) END AS sic_code,
    CASE WHEN p_partkey % 10 >= 2 AND p_partkey % 13 <> 0 THEN 'Industry ' || CAST(p_partkey % 12 AS VARCHAR) END AS sic_description,
    CASE WHEN p_partkey % 10 >= 2 AND p_partkey % 6 <> 5 THEN list_extract({_list(STATES)}, p_partkey % 5 + 1) END AS state_of_inc,
    CASE WHEN p_partkey % 10 >= 2 THEN CASE WHEN p_partkey % 2 = 0 THEN 'operating' ELSE 'investment' END END AS entity_type,
    CASE WHEN p_partkey % 10 >= 2 THEN CASE p_partkey % 3 WHEN 0 THEN 'NYSE|Nasdaq' WHEN 1 THEN 'Nasdaq' ELSE ' nyse |OTC' END END AS listed_exchanges,
    CASE WHEN p_partkey % 10 >= 2 AND p_partkey % 9 <> 0 THEN list_extract(['Large accelerated filer', 'Accelerated filer', 'Non-accelerated filer'], p_partkey % 3 + 1) END AS filer_category,
    CASE WHEN p_partkey % 10 <> 0 THEN p_partkey % 10 > 3 END AS active_flag,
    CASE WHEN p_partkey % 10 = 1 THEN 'not_in_edgar_tickers' WHEN p_partkey % 10 = 2 THEN 'deregistration_15-12G'
      WHEN p_partkey % 10 = 3 AND p_partkey % 4 <> 1 THEN 'no_recent_10k_10q' END AS inactive_reason,
    CASE WHEN p_partkey % 10 >= 2 AND p_partkey % 5 <> 2 THEN p_partkey * 7919 % 1000003 * 1000 + 1 END AS shares_outstanding,
    CASE WHEN p_partkey % 10 >= 2 AND p_partkey % 5 <> 2 THEN DATE '2000-01-01' + CAST(p_partkey % 900 AS INTEGER) END AS shares_as_of_date,
    CASE WHEN p_partkey % 10 <> 0 THEN CAST(DATE '2024-01-01' + CAST(p_partkey % 365 AS INTEGER) AS TIMESTAMP) END AS edgar_enriched_at
    FROM part"""),
    "tickers": ((), f"""SELECT c_custkey AS cik, c_name AS name,
    'P' || {_sql_pad('c_custkey', 12)} || CASE c_custkey % 5 WHEN 0 THEN '-B' WHEN 1 THEN 'A' ELSE '' END AS ticker,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'NYSE' WHEN 'BUILDING' THEN 'Nasdaq' WHEN 'FURNITURE' THEN 'OTC' WHEN 'MACHINERY' THEN 'CBOE' END AS exchange
    FROM customer"""),
    "filings": ((), f"""SELECT {_sql_pad('o_custkey', 10)} AS cik, {_sql_pad('o_custkey', 10)} || '-' || {_sql_pad('o_orderkey', 12)} AS accession,
    CAST(o_orderdate AS DATE) AS filing_date,
    CASE WHEN o_orderkey % 20 < 18 THEN CAST(o_orderdate AS DATE) - 30 END AS report_date,
    CASE WHEN o_orderkey % 400 = 18 THEN '15-12G' ELSE list_extract({_list(FORMS)}, o_orderkey % 20 + 1) END AS form,
    CASE WHEN o_orderkey % 20 BETWEEN 10 AND 15 THEN list_extract(['1.03', '5.03,9.01', '2.01,9.01'], o_orderkey % 3 + 1) ELSE '' END AS items,
    o_orderkey % 2 AS is_xbrl, 'doc' || CAST(o_orderkey AS VARCHAR) || '.htm' AS primary_document, o_orderkey FROM orders"""),
    "facts": ((), f"""SELECT {_sql_pad('o_custkey', 10)} AS cik, 'Customer#' || {_sql_pad('o_custkey', 9)} AS entity_name,
    list_extract({_list([c[0] for c in CONCEPTS])}, l_partkey % 14 + 1) AS namespace,
    list_extract({_list([c[1] for c in CONCEPTS])}, l_partkey % 14 + 1) AS concept,
    list_extract({_list([c[2] for c in CONCEPTS])}, l_partkey % 14 + 1) AS unit,
    CAST(date_trunc('year', l_shipdate) AS DATE) AS period_end,
    CASE WHEN l_suppkey % 5 <> 0 THEN CAST(date_trunc('year', l_shipdate) AS DATE) - CASE l_suppkey % 5 WHEN 1 THEN 90 WHEN 2 THEN 270 ELSE 365 END END AS period_start,
    CAST(l_extendedprice AS DOUBLE) / CASE WHEN l_partkey % 29 = 5 THEN CAST(1e5 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS val, {_sql_pad('o_custkey', 10)} || '-' || {_sql_pad('o_orderkey', 12)} AS accn,
    list_extract({_list(FACT_FORMS)}, o_orderkey % 4 + 1) AS form, CAST(o_orderdate AS DATE) AS filed,
    CASE WHEN l_suppkey % 5 >= 3 THEN 'CY' || CAST(year(l_shipdate) AS VARCHAR) END AS frame,
    CASE WHEN l_suppkey % 11 <> 0 THEN CAST(year(l_shipdate) + CASE WHEN o_custkey % 3 = 0 THEN 1 ELSE 0 END AS INTEGER) END AS fy,
    CASE WHEN l_suppkey % 11 <> 0 THEN CASE WHEN o_orderkey % 4 % 2 = 0 THEN 'FY' ELSE 'Q' || CAST(o_custkey % 4 + 1 AS VARCHAR) END END AS fp
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""),
}


def with_views(names: str, body: str) -> str:
    """SQL with the named views, and the views they need, as common table expressions."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for needed in SQL_VIEWS[name][0]:
            add(needed)
        if name not in wanted:
            wanted.append(name)

    for name in names.split():
        add(name)
    tables = ",\n".join(f"{n} AS ({SQL_VIEWS[n][1]})" for n in wanted)
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {tables},\n{body[5:]}"
    return f"WITH {tables}\n{body}"
