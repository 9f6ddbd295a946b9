"""Queries that run the streaming jobs over the event table, delivered as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundledger.catalog import views as v
from fundledger.catalog.registry import register
from fundledger.functions.keys import cik10
from fundledger.plans.layers import listed_only
from fundledger.session import scratch_path
from fundledger.sources import buckets
from fundledger.streaming import jobs

_ROWS = """lpad(CAST(event_id AS VARCHAR), CAST(greatest(length(CAST(event_id AS VARCHAR)), 12) AS INTEGER), '0') AS accession_number, lpad(CAST(user_id AS VARCHAR), CAST(greatest(length(CAST(user_id AS VARCHAR)), 10) AS INTEGER), '0') AS cik, event_type AS form_type,
    CAST(CAST(ts AS DATE) AS VARCHAR) AS filed_date, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item"""


def _land(spark: SparkSession, sf: str, copies: int = 1) -> str:
    """The events as files, each event ``copies`` times."""
    path = scratch_path(spark, "landing")
    rows = v.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    for _ in range(copies - 1):
        rows = rows.unionByName(v.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp")))
    rows.write.parquet(path)
    return path


def _filings(spark: SparkSession, sf: str, copies: int = 1, per_batch: int | None = None) -> DataFrame:
    return jobs.to_filings(jobs.file_stream(spark, _land(spark, sf, copies), files_per_batch=per_batch))


def _to_silver(spark: SparkSession, sf: str) -> DataFrame:
    """The job runs twice over the same files; the second run finds nothing new."""
    landing, table, mark = _land(spark, sf), scratch_path(spark, "silver"), scratch_path(spark, "mark")
    for _ in range(2):
        jobs.run_to_table(jobs.to_filings(jobs.file_stream(spark, landing)), table, mark)
    return spark.read.parquet(table).drop("ts")


register("stream_to_silver", _to_silver, "", f"SELECT {_ROWS} FROM events")


def _once(spark: SparkSession, sf: str) -> DataFrame:
    table, mark = scratch_path(spark, "once"), scratch_path(spark, "mark")
    jobs.run_to_table(jobs.once_per_accession(_filings(spark, sf, copies=2)), table, mark)
    return spark.read.parquet(table).drop("ts")


register("stream_once_per_accession", _once, "", f"SELECT {_ROWS} FROM events")


def _parts(spark: SparkSession, sf: str, name: str, reduce, merge) -> DataFrame:
    """Each micro-batch adds its own part, and pairs of parts are compacted; all parts together are the answer."""
    root, mark = scratch_path(spark, name), scratch_path(spark, "mark")
    jobs.run_batches(_filings(spark, sf, per_batch=1), mark, jobs.keep_parts(spark, root, reduce, merge, every=2))
    return jobs.read_parts(spark, root)


register(
    "stream_daily_forms",
    lambda spark, sf: jobs.daily_forms(_parts(spark, sf, "daily", jobs.daily_parts, jobs.merged_days)),
    "",
    """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS filed_date, event_type AS form_type, COUNT(*) AS filings, COUNT(DISTINCT user_id) AS filers
    FROM events GROUP BY 1, 2""",
)
register(
    "stream_upsert_companies",
    lambda spark, sf: jobs.merged_companies(_parts(spark, sf, "companies", jobs.seen_companies, jobs.merged_companies)),
    "",
    """SELECT lpad(CAST(user_id AS VARCHAR), CAST(greatest(length(CAST(user_id AS VARCHAR)), 10) AS INTEGER), '0') AS cik, CAST(MIN(CAST(ts AS DATE)) AS VARCHAR) AS first_seen_date,
    CAST(MAX(CAST(ts AS DATE)) AS VARCHAR) AS last_seen_date FROM events GROUP BY 1""",
)


def _in_universe(spark: SparkSession, sf: str) -> DataFrame:
    universe = listed_only(v.tickers(spark, sf)).select(cik10("cik").alias("cik"))
    table, mark = scratch_path(spark, "matched"), scratch_path(spark, "mark")
    jobs.run_to_table(jobs.in_universe(_filings(spark, sf), universe), table, mark)
    return spark.read.parquet(table).drop("ts")


register(
    "stream_in_universe",
    _in_universe,
    "",
    f"SELECT {_ROWS} FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING'))",
)


def _merged(spark: SparkSession, sf: str) -> DataFrame:
    """Each micro-batch merges its companies into the buckets it touches; all files come twice."""
    landing, table, mark = _land(spark, sf), scratch_path(spark, "dim"), scratch_path(spark, "mark")
    for name in (mark, f"{mark}-again"):
        stream = jobs.to_filings(jobs.file_stream(spark, landing, files_per_batch=2))
        jobs.run_batches(stream, name, jobs.upsert_companies(spark, table, 16))
    return buckets.read_buckets(spark, table, jobs.COMPANIES)


register(
    "stream_merged_companies",
    _merged,
    "",
    """SELECT lpad(CAST(user_id AS VARCHAR), CAST(greatest(length(CAST(user_id AS VARCHAR)), 10) AS INTEGER), '0') AS cik, CAST(MIN(CAST(ts AS DATE)) AS VARCHAR) AS first_seen_date,
    CAST(MAX(CAST(ts AS DATE)) AS VARCHAR) AS last_seen_date FROM events GROUP BY 1""",
)


def _windows(spark: SparkSession, sf: str) -> DataFrame:
    """All events in one batch; the batch after it gives out the days that the watermark has passed."""
    table, mark, progress = (scratch_path(spark, n) for n in ("windows", "mark", "progress"))
    jobs.run_windows(spark, jobs.daily_windows(_filings(spark, sf, per_batch=100_000)), table, mark, progress)
    return spark.read.parquet(table)


_CLOSED = """closed AS (SELECT CAST(ts AS DATE) AS filed_date, event_type AS form_type, user_id FROM events
  WHERE CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT MAX(ts) - INTERVAL 1 DAY FROM events))"""
register(
    "stream_daily_windows",
    lambda spark, sf: _windows(spark, sf).select("filed_date", "form_type", "filings"),
    "",
    f"WITH {_CLOSED} SELECT CAST(filed_date AS VARCHAR) AS filed_date, form_type, COUNT(*) AS filings FROM closed GROUP BY ALL",
)


def _near(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct filers of each form over all closed days from merged sketches, next to the exact number."""
    sketched = jobs.distinct_filers(_windows(spark, sf), ["form_type"])
    events = v.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    last = events.agg(F.max("ts")).scalar() - F.expr("interval 1 day")
    closed = events.where(F.date_add(F.to_date("ts"), 1).cast("timestamp") <= last)
    exact = closed.groupBy(F.col("event_type").alias("form_type")).agg(F.count_distinct("user_id").alias("exact"))
    near = F.abs(F.col("filers") - F.col("exact")) <= 0.05 * F.col("exact")
    return sketched.join(exact, "form_type").select("form_type", "filings", "exact", near.alias("within_5_percent"))


register(
    "stream_filers_over_days",
    _near,
    "",
    f"WITH {_CLOSED} SELECT form_type, COUNT(*) AS filings, COUNT(DISTINCT user_id) AS exact, true AS within_5_percent FROM closed GROUP BY ALL",
)
