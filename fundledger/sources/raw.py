"""Readers of raw registry files: JSON documents and pipe-delimited index text.

A document is one row of text and is parsed with a declared schema on the executors, so any
number of documents is spread over the cluster.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from fundledger.functions.keys import cik10
from fundledger.functions.text import clean_ticker
from fundledger.sources import schemas


def read_documents(spark: SparkSession, path: str, whole_files: bool = True) -> DataFrame:
    """JSON documents as (path, raw): one per file, or one per line."""
    rows = spark.read.text(path, wholetext=whole_files)
    return rows.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("raw"))


def fields_and_rows(docs: DataFrame, schema: str = schemas.TICKERS) -> DataFrame:
    """Documents of the form {fields: [..], data: [[..], ..]} as typed rows, matched by field name."""
    parsed = docs.select(F.from_json("raw", "fields array<string>, data array<array<string>>").alias("d"))
    rows = parsed.select(F.col("d.fields").alias("_fields"), F.explode("d.data").alias("_row"))
    wanted = T._parse_datatype_string(schema).fields

    def pick(field: T.StructField) -> Column:
        place = F.array_position("_fields", F.lit(field.name)).cast("int")
        value = F.when(place > 0, F.get("_row", place - 1))
        return value.try_cast(field.dataType).alias(field.name)

    return rows.select(*[pick(f) for f in wanted])


def read_fields_rows(spark: SparkSession, path: str, schema: str = schemas.TICKERS) -> DataFrame:
    return fields_and_rows(read_documents(spark, path), schema)


def ticker_map(docs: DataFrame) -> DataFrame:
    """Documents of the form {"0": {cik_str, ticker, title}, ..} as one (ticker, cik) per ticker.

    The entry that comes last in a document wins.
    """
    entries = docs.select(
        "path", F.posexplode(F.map_values(F.from_json("raw", schemas.TICKER_MAP))).alias("_place", "e")
    ).select("path", "_place", clean_ticker("e.ticker").alias("ticker"), cik10("e.cik_str").alias("cik"))
    return (
        entries.where(F.col("ticker").isNotNull())
        .groupBy("ticker")
        .agg(F.max_by("cik", F.struct("path", "_place")).alias("cik"))
    )


def read_ticker_map(spark: SparkSession, path: str) -> DataFrame:
    return ticker_map(read_documents(spark, path))


def parse_index(lines: DataFrame) -> DataFrame:
    """Lines (path, line, value) of daily index files as typed rows.

    Whatever stands above a file's first line of dashes is header; below it, lines with fewer than
    five parts or a company number that is not digits drop out.
    """
    text = F.trim("value")
    dashes = text.rlike(r"^-[-| ]*$")
    starts = lines.where(dashes).groupBy("path").agg(F.min("line").alias("_start"))
    parts = F.split(text, r"\|")
    body = lines.join(starts, "path").where(F.col("line") > F.col("_start"))
    return (
        body.withColumn("_p", parts)
        .where((F.size("_p") >= 5) & F.get("_p", F.lit(0)).rlike("^[0-9]+$"))
        .select(
            "path",
            "line",
            cik10(F.get("_p", F.lit(0))).alias("cik"),
            F.get("_p", F.lit(1)).alias("company_name"),
            F.get("_p", F.lit(2)).alias("form"),
            F.get("_p", F.lit(3)).alias("date_filed"),
            F.get("_p", F.lit(4)).alias("filename"),
        )
    )


def read_index_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of index files with their place in the file (one file is one day's index).

    A line's offset within its file split orders it: the split's start, then the row in the split.
    """
    rows = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("_block"),
        "value",
    )
    return rows.select(
        "path",
        (F.col("_block") + F.monotonically_increasing_id() % (1 << 33)).alias("line"),
        "value",
    )


def read_daily_index(spark: SparkSession, path: str) -> DataFrame:
    """Index rows of a path; a path that does not exist (no index that day) is an empty table."""
    try:
        lines = read_index_lines(spark, path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], schemas.INDEX_ROWS)
    return parse_index(lines)


def parse_submissions(docs: DataFrame, also: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Submission documents as one parsed struct each, with the raw text kept for rejects.

    A filter on a parsed field would move below a plain projection and parse a document again for every field it
    names. It does not move below a generated column, so each document is parsed once.
    """
    return docs.select(*also, "raw", F.explode(F.array(F.from_json("raw", schemas.SUBMISSION))).alias("s"))


def _lengths(recent: Column) -> Column:
    """Distinct lengths of the arrays that have any entry."""
    sizes = F.array(*[F.size(recent.getField(f)) for f in schemas.FILING_FIELDS])
    return F.array_distinct(F.filter(sizes, lambda n: n > 0))


def submission_faults(parsed: DataFrame) -> DataFrame:
    """Parsed submissions with the reason to reject each, null for a good one."""
    fault = (
        F.when(F.col("s").isNull() | F.col("s.cik").isNull(), "no company number")
        .when(F.col("s.name").isNull(), "no name")
        .when(F.size(_lengths(F.col("s.filings.recent"))) > 1, "filing arrays of unequal length")
    )
    return parsed.withColumn("fault", fault)


def flatten_submissions(parsed: DataFrame) -> DataFrame:
    """One company row per submission: scalars, lists as JSON text, two addresses as twelve columns."""
    plain = [F.col(f"s.{c}").alias(c) for c in schemas.SUBMISSION_SCALARS]
    addresses = [
        F.col("s.addresses")[kind].getField(f).alias(f"addr_{kind}_{f}")
        for kind in ("mailing", "business")
        for f in schemas.ADDRESS_FIELDS
    ]
    none = F.lit("[]")
    return parsed.select(
        cik10("s.cik").alias("cik"),
        *plain,
        F.coalesce(F.to_json("s.tickers"), none).alias("tickers"),
        F.coalesce(F.to_json("s.exchanges"), none).alias("exchanges"),
        F.coalesce(F.to_json("s.formerNames"), none).alias("formerNames"),
        F.greatest(F.size(F.coalesce(F.col("s.filings.files"), F.array())), F.lit(0)).alias("filing_files_count"),
        *addresses,
    )


def explode_filings(parsed: DataFrame, also: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """One row per filing from the parallel arrays; an absent or empty array is a column of nulls.

    A record whose arrays differ in length gives no rows: ``submission_faults`` reports it.
    ``also`` names columns of the input to keep beside the filing's own.
    """
    recent = F.col("s.filings.recent")
    arrays = [
        F.coalesce(recent.getField(f), F.array().cast(f"array<{schemas.filing_type(f)}>")).alias(f)
        for f in schemas.FILING_FIELDS
    ]
    even = F.size(_lengths(recent)) <= 1
    zipped = parsed.where(F.coalesce(even, F.lit(False))).select(*also, F.col("s.cik").alias("_cik"), *arrays).select(
        *also, "_cik", F.posexplode(F.arrays_zip(*schemas.FILING_FIELDS)).alias("position", "_f")
    )
    return zipped.select(
        *also, cik10("_cik").alias("cik"), "position", *[F.col(f"_f.{f}").alias(f) for f in schemas.FILING_FIELDS]
    )


def union_filing_pages(recent: DataFrame, pages: DataFrame) -> DataFrame:
    """Recent filings with those of all older pages. Missing columns are null."""
    return recent.unionByName(pages.drop("page"), allowMissingColumns=True)


def explode_facts(docs: DataFrame) -> DataFrame:
    """One row per tagged value of company-facts documents: every namespace, concept, unit and entry."""
    doc = docs.select(F.from_json("raw", schemas.COMPANY_FACTS).alias("d"))
    spaces = doc.select(
        cik10("d.cik").alias("cik"),
        F.col("d.entityName").alias("entity_name"),
        F.explode("d.facts").alias("namespace", "_concepts"),
    )
    concepts = spaces.select("cik", "entity_name", "namespace", F.explode("_concepts").alias("concept", "_c"))
    units = concepts.select(
        "cik", "entity_name", "namespace", "concept", F.col("_c.label").alias("label"),
        F.explode("_c.units").alias("unit", "_entries"),
    )
    return units.select(
        "cik", "entity_name", "namespace", "concept", "label", "unit", F.inline("_entries")
    ).select(
        "cik", "entity_name", "namespace", "concept", "label", "unit",
        "end", "start", "val", "accn", "fy", "fp", "form", "filed", "frame",
    )


def explode_fact_variants(docs: DataFrame) -> DataFrame:
    """One row per tagged value, without a schema for what a document holds.

    Namespaces, concepts and units are opened level by level, so rows leave one by one and no map of a whole
    document is built. The declared fields of an entry are typed, null where their value does not fit;
    ``entry`` keeps all of it as a variant, fields that nobody declared included. Documents that are no JSON, or
    hold no facts, give no rows.
    """
    tvf = docs.sparkSession.tvf

    def opened(df: DataFrame, column: str, key: str, value: str) -> DataFrame:
        cells = df.lateralJoin(tvf.variant_explode(F.col(column).outer()))
        return cells.drop(column, "pos").withColumnsRenamed({"key": key, "value": value})

    doc = docs.select(F.try_parse_json("raw").alias("_d")).select(
        cik10(F.try_variant_get("_d", "$.cik", "string")).alias("cik"),
        F.try_variant_get("_d", "$.entityName", "string").alias("entity_name"),
        F.try_variant_get("_d", "$.facts", "variant").alias("_facts"),
    )
    concepts = opened(opened(doc, "_facts", "namespace", "_space"), "_space", "concept", "_concept")
    units = concepts.select(
        "cik", "entity_name", "namespace", "concept",
        F.try_variant_get("_concept", "$.label", "string").alias("label"),
        F.try_variant_get("_concept", "$.units", "variant").alias("_units"),
    )
    entries = opened(opened(units, "_units", "unit", "_list"), "_list", "_key", "entry").drop("_key")
    types = {"end": "string", "start": "string", "val": "double", "accn": "string", "fy": "int", "fp": "string", "form": "string", "filed": "string", "frame": "string"}
    fields = [F.try_variant_get("entry", f"$.{name}", kind).alias(name) for name, kind in types.items()]
    return entries.select("cik", "entity_name", "namespace", "concept", "label", "unit", *fields, "entry")


def explode_concept(docs: DataFrame, unit: str = "shares") -> DataFrame:
    """Points of one unit from company-concept documents."""
    doc = docs.select(F.from_json("raw", schemas.COMPANY_CONCEPT).alias("d"))
    return doc.select(
        cik10("d.cik").alias("cik"),
        F.col("d.taxonomy").alias("namespace"),
        F.col("d.tag").alias("concept"),
        F.inline(F.col("d.units")[unit]),
    )


def broken_rules(rules: dict[str, Column]) -> Column:
    """Names of the rules a row breaks; a rule that comes out null counts as broken."""
    return F.filter(
        F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]),
        lambda x: x.isNotNull(),
    )


def validate(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Split rows into those that keep every rule and those that do not, with the broken rules' names.

    A rule that comes out null counts as broken; good and bad together are all rows.
    """
    checked = df.withColumn("broken", broken_rules(rules))
    good = checked.where(F.size("broken") == 0).drop("broken")
    return good, checked.where(F.size("broken") > 0)


def filing_rules() -> dict[str, Column]:
    """Rules of an exploded filing row."""
    return {
        "accession": F.col("accessionNumber").isNotNull(),
        "form": F.col("form").isNotNull(),
        "filing date": F.col("filingDate").try_cast("date").isNotNull(),
    }


def fact_rules() -> dict[str, Column]:
    """Rules of an exploded fact row."""
    present = {c: F.col(c).isNotNull() for c in ("accn", "end", "form", "filed")}
    return {**present, "val": F.col("val").isNotNull()}

