"""Structured Streaming jobs over filing events.

Each job runs over everything that has arrived and stops (``availableNow``); its checkpoint makes
the next run go on from there. Checkpoints and tables belong in shared storage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundledger.functions.keys import cik10
from fundledger.functions.text import pad_zeros
from fundledger.sources.buckets import upsert_buckets
from fundledger.sources.layers import exists, remove

EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"


def file_stream(spark: SparkSession, path: str, schema: str = EVENTS, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files as they arrive in a directory."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_to_table(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Run a stream over what is there into Parquet files."""
    stream.writeStream.outputMode(mode).format("parquet").option("path", path).option(
        "checkpointLocation", checkpoint
    ).trigger(availableNow=True).start().awaitTermination()


def run_batches(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Run a stream over what is there, handing each micro-batch to ``each``."""
    stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(each).trigger(
        availableNow=True
    ).start().awaitTermination()


def to_filings(events: DataFrame) -> DataFrame:
    """Filing events as silver rows."""
    return events.select(
        pad_zeros("event_id", 12).alias("accession_number"),
        cik10("user_id").alias("cik"),
        F.col("event_type").alias("form_type"),
        F.to_date("ts").alias("filed_date"),
        F.get_json_object("props", "$.k").cast("bigint").alias("item"),
        "ts",
    )


def once_per_accession(filings: DataFrame, late: str = "1 day") -> DataFrame:
    """Each accession once; a copy that comes within ``late`` of the first is dropped, and state is freed after it."""
    return filings.withWatermark("ts", late).dropDuplicatesWithinWatermark(["accession_number"])


def daily_parts(batch: DataFrame) -> DataFrame:
    """A batch's filings per day, form and filer."""
    return batch.groupBy("filed_date", "form_type", "cik").agg(F.count("*").alias("filings"))


def daily_forms(parts: DataFrame) -> DataFrame:
    """Filings and distinct filers per day and form, from the parts of all batches."""
    return merged_days(parts).groupBy("filed_date", "form_type").agg(F.sum("filings").alias("filings"), F.count("*").alias("filers"))


def in_universe(filings: DataFrame, universe: DataFrame) -> DataFrame:
    """Streamed filings of companies in a static universe."""
    return filings.join(universe.select("cik"), "cik", "left_semi")


def seen_companies(batch: DataFrame) -> DataFrame:
    """A batch's companies with the first and last day it saw them."""
    return batch.groupBy("cik").agg(
        F.min("filed_date").alias("first_seen_date"), F.max("filed_date").alias("last_seen_date")
    )


def keep_parts(
    spark: SparkSession,
    root: str,
    reduce: Callable[[DataFrame], DataFrame],
    merge: Callable[[DataFrame], DataFrame] | None = None,
    every: int = 16,
) -> Callable[[DataFrame, int], None]:
    """A batch handler that writes each batch's reduced rows once, below ``root``.

    No state grows, and a batch replayed after a failure replaces its own part. A folder with parts of later
    batches belongs to another checkpoint, and one that lacks an earlier part has lost history: both raise
    an error.

    With ``merge``, which reduces the rows of several parts to rows of the same columns, parts of finished
    batches are compacted: ``every`` parts in a row become one, ``every`` of those become one again, and so
    on. After n batches there are at most ``every`` times log n parts, and a row was rewritten log n times.
    What a compaction replaced is deleted a batch later, so that readers that have just listed it can end.
    """

    def keep(batch: DataFrame, number: int) -> None:
        there = part_runs(spark, root)
        if any(high > number for _, high in there):
            raise RuntimeError(f"{root} holds parts of another checkpoint; use a new folder")
        live = live_runs(there)
        known = sum(high - low + 1 for low, high in live if high < number)
        if known != number:
            raise RuntimeError(f"{root} lacks a part before {number}: its history is gone")
        for run in there - set(live):
            remove(spark, _part(root, *run))
        reduce(batch).write.mode("overwrite").parquet(_part(root, number, number))
        if merge:
            compact_parts(spark, root, merge, every, number)

    return keep


def compact_parts(spark: SparkSession, root: str, merge: Callable[[DataFrame], DataFrame], every: int, before: int) -> None:
    """Merge every ``every`` neighbouring parts of one length, of batches below ``before`` only: those aren't replayed."""
    if every < 2:
        raise ValueError("every is 2 or more")
    live, width = live_runs(part_runs(spark, root)), every
    while width <= before:
        for low in range(0, before - width + 1, width):
            inside = [run for run in live if low <= run[0] and run[1] < low + width]
            # A run of this length or longer is merged already.
            if len(inside) > 1:
                merge(_read_runs(spark, root, inside)).write.mode("overwrite").parquet(_part(root, low, low + width - 1))
                live = sorted({*live, (low, low + width - 1)} - set(inside))
        width *= every


def _part(root: str, low: int, high: int) -> str:
    return f"{root}/part={low}" if low == high else f"{root}/part={low}-{high}"


def part_runs(spark: SparkSession, root: str) -> set[tuple[int, int]]:
    """First and last batch of each part that was written whole, replaced ones included."""
    if not exists(spark, root):
        return set()
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(root)
    entries = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(folder)
    names = [e.getPath().getName() for e in entries]
    found = [n.removeprefix("part=").split("-") for n in names if n.startswith("part=")]
    runs = {(int(ends[0]), int(ends[-1])) for ends in found}
    return {run for run in runs if exists(spark, f"{_part(root, *run)}/_SUCCESS")}


def live_runs(runs: set[tuple[int, int]]) -> list[tuple[int, int]]:
    """The parts that no longer one replaces, in order."""
    live: list[tuple[int, int]] = []
    for low, high in sorted(runs, key=lambda run: (run[0], -run[1])):
        if not live or low > live[-1][1]:
            live.append((low, high))
    return live


def _read_runs(spark: SparkSession, root: str, runs: list[tuple[int, int]]) -> DataFrame:
    return spark.read.option("basePath", root).parquet(*[_part(root, *run) for run in runs]).drop("part")


def read_parts(spark: SparkSession, root: str) -> DataFrame:
    """The rows of all parts, each batch once."""
    return _read_runs(spark, root, live_runs(part_runs(spark, root)))


def merged_days(parts: DataFrame) -> DataFrame:
    """Parts' filings per day, form and filer, as one part."""
    return parts.groupBy("filed_date", "form_type", "cik").agg(F.sum("filings").alias("filings"))


def merged_companies(parts: DataFrame) -> DataFrame:
    """Each company's first and last day over all parts."""
    return parts.groupBy("cik").agg(
        F.min("first_seen_date").alias("first_seen_date"), F.max("last_seen_date").alias("last_seen_date")
    )


COMPANIES = "cik string, first_seen_date date, last_seen_date date"


def upsert_companies(spark: SparkSession, path: str, buckets: int = 64) -> Callable[[DataFrame, int], None]:
    """A batch handler that merges each batch's companies into a bucketed table.

    A batch reads and rewrites only the buckets of its companies; a replayed batch changes nothing.
    """

    def spans(batch: DataFrame, known: DataFrame) -> DataFrame:
        both = batch.unionByName(known.join(batch.select("cik"), "cik", "left_semi"))
        return merged_companies(both)

    def each(batch: DataFrame, number: int) -> None:
        rows = seen_companies(batch.where("cik is not null"))
        upsert_buckets(spark, path, COMPANIES, rows, ["cik"], ["first_seen_date", "last_seen_date"], buckets, spans)

    return each


def daily_windows(filings: DataFrame, late: str = "1 day") -> DataFrame:
    """Filings of each day of event time and form, with a sketch of their filers.

    A day is given out once the watermark, ``late`` behind the latest event, has passed its end, and its state
    is freed then. Rows that come later are not counted here. Sketches of several days or forms merge.
    """
    days = filings.withWatermark("ts", late).groupBy(F.window("ts", "1 day").alias("day"), "form_type")
    sums = days.agg(F.count(F.lit(1)).alias("filings"), F.hll_sketch_agg("cik").alias("filers"))
    return sums.select(F.to_date("day.start").alias("filed_date"), "form_type", "filings", "filers")


def distinct_filers(windows: DataFrame, by: list[str]) -> DataFrame:
    """Filings and distinct filers of closed windows, merged to coarser groups."""
    return windows.groupBy(*by).agg(F.sum("filings").alias("filings"), F.hll_sketch_estimate(F.hll_union_agg("filers")).alias("filers"))


PROGRESS = "batch long, watermark string, input_rows long, state_rows long, late_groups long"


def run_windows(spark: SparkSession, stream: DataFrame, path: str, checkpoint: str, progress: str) -> None:
    """Run windowed sums over what is there; each batch's state and what came too late go to a side table.

    ``late_groups`` counts what the watermark turned away after sums within a task, that is groups of late rows.
    A restart writes a further part of the side table.
    """
    query = stream.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    rows = []
    for p in query.recentProgress:
        state = p.stateOperators[0] if p.stateOperators else None
        mark = p.eventTime.get("watermark") if p.eventTime else None
        rows.append((p.batchId, mark, p.numInputRows, state.numRowsTotal if state else 0, state.numRowsDroppedByWatermark if state else 0))
    if rows:
        spark.createDataFrame(rows, PROGRESS).coalesce(1).write.mode("append").parquet(progress)
