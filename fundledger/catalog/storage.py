"""Queries that read raw documents, and that write tables and read them back.

Raw documents and files are made by Spark from the given tables, so the work grows with them.
Files go to a new directory below the shared folder on every run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fundledger.catalog import views as v
from fundledger.catalog.filings import _INDEX, index_lines
from fundledger.catalog.registry import d, r, register
from fundledger.functions.keys import cik10
from fundledger.operators.counting import ratio_report, value_counts
from fundledger.operators.filings import daily_changes
from fundledger.operators.funds import screen
from fundledger.plans import layers as plans
from fundledger.session import cut_lineage, scratch_path
from fundledger.sources import checked, layers, loads, raw, schemas
from fundledger.sources.layers import ensure_columns

DAY, NEXT_DAY, STAMP = "2024-01-25", "2024-01-26", "2024-01-25 06:30:00"
_CIK = "lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(length(CAST(c_custkey AS VARCHAR)), 10) AS INTEGER), '0')"

# --- raw documents

register("ticker_documents", lambda spark, sf: raw.fields_and_rows(v.ticker_docs(spark, sf)), "tickers", "SELECT * FROM tickers")
register(
    "ticker_map_documents",
    lambda spark, sf: raw.ticker_map(v.ticker_map_docs(spark, sf)),
    "tickers",
    "SELECT ticker, lpad(CAST(cik AS VARCHAR), CAST(greatest(length(CAST(cik AS VARCHAR)), 10) AS INTEGER), '0') AS cik FROM tickers",
)


def _ticker_files(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written as one file each, then read back as files."""
    path = scratch_path(spark, "tickers")
    v.ticker_docs(spark, sf).select("raw").write.option("maxRecordsPerFile", 1).text(path)
    return raw.read_fields_rows(spark, path)


register("ticker_files", _ticker_files, "tickers", "SELECT * FROM tickers")


def _map_files(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "ticker-map")
    v.ticker_map_docs(spark, sf).select("raw").write.option("maxRecordsPerFile", 1).text(path)
    return raw.read_ticker_map(spark, path)


register("ticker_map_files", _map_files, "tickers", "SELECT ticker, lpad(CAST(cik AS VARCHAR), CAST(greatest(length(CAST(cik AS VARCHAR)), 10) AS INTEGER), '0') AS cik FROM tickers")


INDEX_PAGE = 100_000


def day_files(rows: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """(rows with the file of their day, the files): a day's lines in order, at most ``size`` in a file.

    Lines are counted in runs of half a file's keys, and runs fill a day's files one after the other: files grow in
    number with the lines of a day, however wide its keys. One row a file is broadcast.
    """
    half = size // 2
    run = F.floor(F.col("line") / half)
    before = Window.partitionBy("day").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = rows.groupBy("day", run.alias("run")).agg(F.count("*").alias("n")).withColumn(
        "file", F.lpad(F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / half).cast("string"), 9, "0")
    )
    files = runs.groupBy("day", "file").agg(F.min("run").alias("first"), F.max("run").alias("last"))
    at = F.broadcast(files.withColumnRenamed("day", "_day"))
    placed = rows.join(at, rows["day"].eqNullSafe(at["_day"]) & run.between(F.col("first"), F.col("last")))
    return placed.drop("_day", "first", "last"), files.select("day", "file")


def _index_files(spark: SparkSession, sf: str) -> DataFrame:
    """Index files of a day, each with its header and at most INDEX_PAGE orders, read back as text."""
    path = scratch_path(spark, "index")
    rows, files = day_files(index_lines(spark, sf).where("line >= 10").select(F.col("path").alias("day"), "line", "value"), INDEX_PAGE)
    head = F.array(F.lit("Description: daily index"), F.lit("CIK|Company Name|Form Type|Date Filed|Filename"), F.lit("---|---|---"))
    heads = files.select("day", "file", F.posexplode(head).alias("line", "value"))
    lines = heads.withColumn("line", F.col("line").cast("long")).unionByName(rows)
    ordered = lines.repartition("day", "file").sortWithinPartitions("day", "file", "line")
    ordered.select("day", "file", "value").write.partitionBy("day", "file").text(path)
    found = raw.read_daily_index(spark, path)
    return daily_changes(found.withColumn("ingestion_date", F.col("date_filed")))


register(
    "index_files",
    _index_files,
    "filings",
    f"""WITH {_INDEX}, firsts AS (SELECT filing_date AS y, cik, form, MIN(o_orderkey) AS k, MIN(entity) AS entity FROM idx GROUP BY 1, 2, 3)
    SELECT CAST(y AS VARCHAR) AS ingestion_date, cik, MIN(entity) AS company_name, '["' || string_agg(form, '","' ORDER BY k) || '"]' AS forms_filed FROM firsts GROUP BY 1, 2""",
)
register(
    "missing_index",
    lambda spark, sf: raw.read_daily_index(spark, scratch_path(spark, "holiday")).unionByName(raw.parse_index(index_lines(spark, sf))).select("cik", "form"),
    "filings",
    f"WITH {_INDEX} SELECT cik, form FROM idx",
)


def _parsed(spark, sf):
    return raw.submission_faults(raw.parse_submissions(v.company_docs(spark, sf)))


register(
    "submission_companies",
    lambda spark, sf: raw.flatten_submissions(_parsed(spark, sf).where("fault IS NULL")).select(
        "cik", "name", "entityType", "sic", "tickers", "exchanges", "formerNames", "category", "filing_files_count",
        "addr_mailing_city", "addr_business_street1", "addr_business_stateOrCountry", "addr_business_zipCode",
    ),
    "tickers",
    f"""SELECT {_CIK} AS cik, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN 'operating' ELSE 'other' END AS "entityType", CAST(1000 + c_custkey % 12 * 100 AS VARCHAR) AS sic,
    '["' || ticker || '"]' AS tickers, CASE WHEN exchange IS NULL THEN '[null,null,"CBOE"]' ELSE '["' || exchange || '","' || exchange || '","CBOE"]' END AS exchanges,
    '[]' AS "formerNames", list_extract(['Large accelerated filer', 'Accelerated filer<br>Smaller reporting company', 'Non-accelerated filer'], c_custkey % 3 + 1) AS category,
    CASE WHEN c_custkey % 4 = 0 THEN 1 ELSE 0 END AS filing_files_count, CAST(NULL AS VARCHAR) AS addr_mailing_city,
    CAST(c_custkey AS VARCHAR) || ' Main St' AS addr_business_street1, list_extract(['DE', 'NY', 'CA', 'TX', 'NV'], c_custkey % 5 + 1) AS "addr_business_stateOrCountry",
    lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(length(CAST(c_custkey AS VARCHAR)), 5) AS INTEGER), '0') AS "addr_business_zipCode" FROM customer JOIN tickers ON cik = c_custkey WHERE c_custkey % 211 <> 7""",
)
register(
    "submission_rejects",
    lambda spark, sf: _parsed(spark, sf).where("fault IS NOT NULL").select(cik10("s.cik").alias("cik"), "fault"),
    "",
    f"SELECT {_CIK} AS cik, 'no name' AS fault FROM customer WHERE c_custkey % 211 = 7",
)
_FILING_HEAD = f"""cik, accession AS "accessionNumber", {d('filing_date')} AS "filingDate", {d('report_date')} AS "reportDate", form, items, is_xbrl AS "isXBRL",
    primary_document AS "primaryDocument", CAST(NULL AS VARCHAR) AS act"""
_FILING_COLUMNS = ["cik", "accessionNumber", "filingDate", "reportDate", "form", "items", "isXBRL", "primaryDocument", "act"]
register(
    "submission_filings",
    lambda spark, sf: raw.explode_filings(raw.parse_submissions(v.filing_docs(spark, sf))).select(*_FILING_COLUMNS),
    "filings",
    f"SELECT {_FILING_HEAD} FROM filings WHERE CAST(cik AS BIGINT) % 97 <> 11",
)
register(
    "uneven_filings",
    lambda spark, sf: value_counts(raw.submission_faults(raw.parse_submissions(v.filing_docs(spark, sf))), "fault", null_label="none"),
    "filings",
    """SELECT CASE WHEN CAST(cik AS BIGINT) % 97 = 11 THEN 'filing arrays of unequal length' ELSE 'none' END AS fault, COUNT(*) AS n
    FROM (SELECT DISTINCT cik, o_orderkey // 1000 AS page FROM filings) GROUP BY 1""",
)


def _with_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Each company's newest document as its recent filings, the rest as older pages."""
    docs = v.filing_docs(spark, sf)
    newest = v.paged_filings(spark, sf).groupBy("cik").agg(F.max("page").alias("_last"))
    # Written once, as the source has them: both readers parse their own documents only.
    docs = cut_lineage(docs.join(newest, "cik").select("page", "_last", "raw"))

    recent = raw.explode_filings(raw.parse_submissions(docs.where("page = _last")))
    paged = raw.explode_filings(raw.parse_submissions(docs.where("page < _last"), ["page"]), ["page"])
    return raw.union_filing_pages(recent, paged)


register(
    "filing_pages",
    lambda spark, sf: _with_pages(spark, sf).select(*_FILING_COLUMNS),
    "filings",
    f"SELECT {_FILING_HEAD} FROM filings WHERE CAST(cik AS BIGINT) % 97 <> 11",
)
register(
    "fact_documents",
    lambda spark, sf: raw.explode_facts(v.fact_docs(spark, sf)),
    "facts",
    f"""SELECT cik, entity_name, namespace, concept, concept AS label, unit, fy, fp, {d('period_end')} AS "end", {d('period_start')} AS start, {r('val')} AS val, accn, form, {d('filed')} AS filed, frame FROM facts""",
)


def _variants(spark, sf):
    """Documents with a field that no schema declares, read back from the variant that keeps it."""
    docs = v.fact_docs(spark, sf).withColumn("raw", F.regexp_replace("raw", r'"accn":"([^"]*)"', r'"segment":{"id":"s-$1"},"accn":"$1"'))
    rows = raw.explode_fact_variants(docs)
    return rows.withColumn("segment", F.variant_get("entry", "$.segment.id", "string")).drop("entry")


register(
    "fact_variants",
    _variants,
    "facts",
    f"""SELECT cik, entity_name, namespace, concept, concept AS label, unit, fy, fp, {d('period_end')} AS "end", {d('period_start')} AS start, {r('val')} AS val, accn, form, {d('filed')} AS filed, frame,
    's-' || accn AS segment FROM facts""",
)
register(
    "concept_documents",
    lambda spark, sf: raw.explode_concept(v.concept_docs(spark, sf)).select("cik", "namespace", "concept", "val", "end", "form", "filed", "accn"),
    "facts",
    f"""SELECT cik, namespace, concept, {r('val')} AS val, {d('period_end')} AS "end", form, {d('filed')} AS filed, accn FROM facts WHERE unit = 'shares'""",
)


def _position_rules():
    return {
        "ticker": F.trim("constituent_ticker") != "",
        "cusip": F.col("cusip") != "",
        "weight": F.col("weight") > 0,
    }


def _split(spark, sf):
    """Positions as a careless source sends them, held against three rules."""
    return raw.validate(v.dirty_holdings(spark, sf), _position_rules())


def _checked(spark, sf):
    """The same positions checked while they are written: the figures of the write beside counts of what was written."""
    path = scratch_path(spark, "checked")
    rows = v.dirty_holdings(spark, sf).select("composite_ticker", "constituent_ticker", "cusip", "isin", "weight")
    figures = checked.write_checked(rows, _position_rules(), path, ["isin", "weight"])
    checked.gate_figures({"positions": figures})
    good, bad = checked.read_checked(spark, path, "composite_ticker string, constituent_ticker string, cusip string, isin string, weight double")
    counted = spark.createDataFrame(list(figures.items()), "figure string, n long")
    return counted.select("*", *[side.agg(F.count("*")).scalar().alias(name) for name, side in (("good", good), ("bad", bad))])


register(
    "checked_write",
    _checked,
    "dirty_holdings",
    """WITH x AS (SELECT COALESCE(trim(constituent_ticker) <> '', FALSE) AS a, COALESCE(cusip <> '', FALSE) AS b, COALESCE(weight > 0, FALSE) AS c, isin, weight FROM dirty_holdings),
    totals AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (a AND b AND c) AS good FROM x),
    figures AS (SELECT 'rows' AS figure, n FROM totals UNION ALL SELECT 'accepted', good FROM totals UNION ALL SELECT 'rejected', n - good FROM totals
      UNION ALL SELECT 'broken: ticker', COUNT(*) FILTER (NOT a) FROM x UNION ALL SELECT 'broken: cusip', COUNT(*) FILTER (NOT b) FROM x
      UNION ALL SELECT 'broken: weight', COUNT(*) FILTER (NOT c) FROM x UNION ALL SELECT 'null: isin', COUNT(*) FILTER (isin IS NULL) FROM x
      UNION ALL SELECT 'null: weight', COUNT(*) FILTER (weight IS NULL) FROM x)
    SELECT figure, figures.n, good, totals.n - good AS bad FROM figures, totals""",
)


register(
    "rejected_positions",
    lambda spark, sf: _split(spark, sf)[1].select("composite_ticker", "constituent_ticker", "broken"),
    "dirty_holdings",
    """WITH x AS (SELECT composite_ticker, constituent_ticker, array_to_string(list_filter([CASE WHEN COALESCE(trim(constituent_ticker) = '', TRUE) THEN 'ticker' END,
      CASE WHEN cusip = '' THEN 'cusip' END, CASE WHEN COALESCE(NOT weight > 0, TRUE) THEN 'weight' END], lambda z: z IS NOT NULL), '|') AS broken FROM dirty_holdings)
    SELECT * FROM x WHERE broken <> ''""",
)
register(
    "accepted_positions",
    lambda spark, sf: _split(spark, sf)[0].groupBy("composite_ticker").agg(F.count("*").alias("n")),
    "dirty_holdings",
    "SELECT composite_ticker, COUNT(*) AS n FROM dirty_holdings WHERE trim(constituent_ticker) <> '' AND cusip <> '' AND weight > 0 GROUP BY 1",
)
register(
    "valid_filings",
    lambda spark, sf: raw.validate(v.filings(spark, sf), raw.filing_rules())[0].select("accessionNumber"),
    "filings",
    'SELECT accession AS "accessionNumber" FROM filings',
)
register(
    "valid_facts",
    lambda spark, sf: ratio_report(raw.validate(v.facts(spark, sf), raw.fact_rules())[0], {"framed": F.col("frame").isNotNull()}),
    "facts",
    "SELECT COUNT(*) AS rows, COUNT(frame) AS framed FROM facts",
)

# --- layers and tables


def _bronze(spark, sf) -> DataFrame:
    return v.filings(spark, sf).drop("_orderkey", "_custkey")


def _skip_existing(spark: SparkSession, sf: str) -> DataFrame:
    """A bronze date is written once; a second load of the same date changes nothing."""
    root = scratch_path(spark, "lake")
    wrote = layers.write_layer(_bronze(spark, sf), root, "bronze", "filings_index", DAY, rows_per_file=5000)
    again = layers.write_layer(_bronze(spark, sf).limit(1), root, "bronze", "filings_index", DAY)
    layers.gate(spark, root, DAY, ["filings_index"])
    kept = layers.read_layer(spark, root, "bronze", "filings_index", DAY)
    return kept.groupBy("ingestion_date", "form").agg(F.count("*").alias("n")).withColumns({"wrote": F.lit(wrote), "again": F.lit(again)})


register(
    "bronze_write_once",
    _skip_existing,
    "filings",
    f"SELECT '{DAY}' AS ingestion_date, form, COUNT(*) AS n, TRUE AS wrote, FALSE AS again FROM filings GROUP BY 2",
)


def _replace_date(spark: SparkSession, sf: str) -> DataFrame:
    """Two silver dates, the second written twice: the first stays and the second is replaced."""
    root = scratch_path(spark, "lake")
    rows = _bronze(spark, sf).select("cik", "form")
    for date, some in ((DAY, rows), (NEXT_DAY, rows), (NEXT_DAY, rows.where("form = '8-K'"))):
        layers.write_layer(some, root, "silver", "filings_index", date, mode="overwrite_partition")
    kept = layers.read_layer(spark, root, "silver", "filings_index")
    return kept.groupBy("snapshot_date", "form").agg(F.count("*").alias("n"))


register(
    "silver_replace_date",
    _replace_date,
    "filings",
    f"""SELECT '{DAY}' AS snapshot_date, form, COUNT(*) AS n FROM filings GROUP BY 2
    UNION ALL SELECT '{NEXT_DAY}', form, COUNT(*) FROM filings WHERE form = '8-K' GROUP BY 2""",
)


def _layered(spark: SparkSession, sf: str) -> tuple[str, dict[str, DataFrame]]:
    """Bronze written, silver built from it and written, gold built from silver and written."""
    root = scratch_path(spark, "lake")
    bronze = {"tickers": v.tickers(spark, sf), "filings_index": _bronze(spark, sf), "companyfacts": v.facts(spark, sf)}
    for name, df in bronze.items():
        layers.write_layer(df, root, "bronze", name, DAY)
    layers.gate(spark, root, DAY, list(bronze))
    read = {name: layers.read_layer(spark, root, "bronze", name, DAY).drop("ingestion_date") for name in bronze}
    for name, df in plans.to_silver(read["tickers"], read["filings_index"], read["companyfacts"], DAY, stamp=STAMP).items():
        layers.write_layer(df, root, "silver", name, DAY, mode="overwrite_partition")
    silver = {
        name: layers.read_layer(spark, root, "silver", name, DAY).drop("snapshot_date")
        for name in ("dim_security", "filings_index", "financial_facts", "corporate_actions")
    }
    gold = plans.to_gold(silver, stamp=STAMP)
    for name, df in gold.items():
        layers.write_layer(df, root, "gold", name, DAY, mode="overwrite", sort_by=plans.GOLD_SORT[name])
    return root, gold


def _gold_counts(spark: SparkSession, sf: str) -> DataFrame:
    root, gold = _layered(spark, sf)
    parts = [
        layers.read_layer(spark, root, "gold", name, DAY)
        .groupBy("exchange" if "exchange" in df.columns else F.lit("all").alias("exchange"))
        .agg(F.count("*").alias("n"))
        .select(F.lit(name).alias("table"), "exchange", "n")
        for name, df in gold.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


register(
    "gold_layer",
    _gold_counts,
    "filings facts tickers",
    """WITH dim AS (SELECT lpad(CAST(cik AS VARCHAR), CAST(greatest(length(CAST(cik AS VARCHAR)), 10) AS INTEGER), '0') AS cik, exchange FROM tickers WHERE exchange IN ('NYSE', 'Nasdaq')),
    kinds AS (SELECT *, CASE WHEN period_start IS NULL THEN 'instant' WHEN period_end - period_start BETWEEN 355 AND 375 THEN 'annual'
      WHEN period_end - period_start BETWEEN 85 AND 100 THEN 'quarterly' ELSE 'other' END AS kind FROM facts),
    wide AS (SELECT DISTINCT cik, period_end, form FROM kinds WHERE (kind = 'instant') OR (kind = 'annual' AND form IN ('10-K', '10-K/A')) OR (kind = 'quarterly' AND form IN ('10-Q', '10-Q/A'))),
    quarters AS (SELECT w.cik, exchange FROM wide w JOIN dim ON w.cik = dim.cik WHERE form IN ('10-Q', '10-Q/A')
      QUALIFY ROW_NUMBER() OVER (PARTITION BY w.cik ORDER BY period_end DESC, form) <= 8),
    listed AS (SELECT f.* FROM filings f JOIN dim ON f.cik = dim.cik)
    SELECT 'financial_statements_annual' AS "table", exchange, COUNT(*) AS n FROM wide w JOIN dim ON w.cik = dim.cik WHERE form IN ('10-K', '10-K/A') GROUP BY 2
    UNION ALL SELECT 'financial_statements_quarterly', exchange, COUNT(*) FROM quarters GROUP BY 2
    UNION ALL SELECT 'company_profile', exchange, COUNT(*) FROM dim GROUP BY 2
    UNION ALL SELECT 'filing_catalog', 'all', COUNT(*) FROM listed
    UNION ALL SELECT 'corporate_events', 'all', SUM(CASE WHEN form = 'SC 13E-3' THEN 2 WHEN form IN ('S-4', '15-12G') THEN 1
      WHEN form = '8-K' AND (items LIKE '%1.03%' OR items LIKE '%5.03%') THEN 1 ELSE 0 END)::BIGINT FROM listed""",
)


def _copied(spark: SparkSession, sf: str) -> DataFrame:
    return layers.create_copy(v.funds(spark, sf).select("composite_ticker", "as_of_date", "aum"), scratch_path(spark, "copy"))


register("table_copy", _copied, "funds", f"SELECT composite_ticker, {d('as_of_date')} AS as_of_date, {r('aum')} AS aum FROM funds")


def _exported(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "export")
    rows = screen(v.funds(spark, sf), region=["ASIA", "EUROPE"]).select("composite_ticker", "issuer", "num_holdings")
    layers.export_csv(rows, path)
    return spark.read.option("header", True).schema("composite_ticker string, issuer string, num_holdings int").csv(path)


register(
    "csv_export",
    _exported,
    "own_last_funds",
    "SELECT composite_ticker, issuer, num_holdings FROM own_last_funds WHERE region IN ('ASIA', 'EUROPE')",
)
register(
    "ensured_columns",
    lambda spark, sf: ensure_columns(v.tickers(spark, sf), {"sic": "string", "exchange": "string"}),
    "tickers",
    "SELECT *, CAST(NULL AS VARCHAR) AS sic FROM tickers",
)


def _loaded_once(spark: SparkSession, sf: str) -> DataFrame:
    """Files are loaded, more files arrive, and a rerun loads only those."""
    source, target, mark = (scratch_path(spark, n) for n in ("arrivals", "loaded", "history"))
    rows = _bronze(spark, sf).select("cik", "accessionNumber", "form")
    schema = "cik string, accessionNumber string, form string"
    rows.where("form = '10-Q'").write.mode("append").parquet(source)
    layers.load_new_files(spark, source, schema, target, mark)
    rows.where("form <> '10-Q'").write.mode("append").parquet(source)
    layers.load_new_files(spark, source, schema, target, mark)
    return layers.load_new_files(spark, source, schema, target, mark)


register("load_new_files", _loaded_once, "filings", 'SELECT cik, accession AS "accessionNumber", form FROM filings')


def _load_history(spark: SparkSession, sf: str) -> DataFrame:
    """Two loads of good files and one broken file among them; the history after both, by load."""
    source, root = scratch_path(spark, "arrivals"), scratch_path(spark, "loads")
    rows = _bronze(spark, sf).select("cik", "accessionNumber", "form")
    schema = "cik string, accessionNumber string, form string"
    rows.where("form = '10-Q'").write.mode("append").parquet(source)
    # A text file under a name that readers take for Parquet.
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    path = hadoop.Path(f"{source}/broken.parquet")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    out.writeBytes("not a table, but longer than a footer")
    out.close()
    loads.load_files(spark, source, schema, root)
    rows.where("form <> '10-Q'").write.mode("append").parquet(source)
    for _ in range(2):
        loads.load_files(spark, source, schema, root)
    known = loads.history(spark, root).groupBy("load").agg(F.sum("rows").alias("rows"), F.count("error").alias("rejected"))
    held = loads.loaded(spark, root, schema).groupBy((F.col("form") != "10-Q").cast("int").alias("later")).agg(F.count_distinct("accessionNumber").alias("accessions"))
    return known.join(held, known["load"] == held["later"] + 1).select("load", "rows", "rejected", "accessions")


register(
    "load_history",
    _load_history,
    "filings",
    """SELECT CASE form WHEN '10-Q' THEN 1 ELSE 2 END AS load, COUNT(*) AS "rows", CASE form WHEN '10-Q' THEN 1 ELSE 0 END AS rejected,
    COUNT(DISTINCT accession) AS accessions FROM (SELECT accession, CASE form WHEN '10-Q' THEN form ELSE 'other' END AS form FROM filings) GROUP BY form""",
)
