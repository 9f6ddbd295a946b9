"""Loading new files into a table, with a history of every file and its error.

A load reads the files that the history doesn't know in their present form, and goes on past files that
can't be read. Files are only ever read whole: all new files together first, and only if that fails the
list is halved until the broken ones stand alone. A file that is mended later has another time of change,
and is new again; one that could not be read is not tried again before that.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundledger.sources.layers import exists

HISTORY = "file string, changed long, bytes long, rows long, error string, load int"
# Conditions that blame a file's content; any other error ends the load.
BROKEN = ("CANNOT_READ_FILE_FOOTER", "FAILED_READ_FILE", "CANNOT_MERGE_SCHEMAS", "is not a Parquet file", "PARQUET_COLUMN_DATA_TYPE_MISMATCH")


def files_in(spark: SparkSession, folder: str) -> DataFrame:
    """(file, changed, bytes) of the Parquet files in a folder; their contents are not read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder)
    return listed.select(F.col("path").alias("file"), F.unix_millis("modificationTime").alias("changed"), F.col("length").alias("bytes"))


def history(spark: SparkSession, root: str) -> DataFrame:
    """One row for each file and load that met it: its rows, or why it was not loaded."""
    path = f"{root}/history"
    return spark.read.schema(HISTORY).parquet(path) if exists(spark, path) else spark.createDataFrame([], HISTORY)


def loaded(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The rows of all loads that ended; a load that broke off has no history and is not read."""
    done = [r["load"] for r in history(spark, root).where("rows is not null").select("load").distinct().collect()]
    paths = [p for n in sorted(done) for p in _parts(spark, f"{root}/data/load={n}")]
    rows = spark.read.schema(schema)
    return rows.parquet(*paths) if paths else spark.createDataFrame([], schema)


def _parts(spark: SparkSession, folder: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    if not exists(spark, folder):
        return []
    entries = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return sorted(f"{folder}/{e.getPath().getName()}" for e in entries if e.getPath().getName().startswith("part="))


def load_files(spark: SparkSession, source: str, schema: str, root: str) -> DataFrame:
    """Load the new files of ``source``, and return this load's history. Columns are matched by name.

    Rows are written to a folder of this load, which counts once its history is written. The list of new
    files goes through the driver, as it does in every reader.
    """
    before = history(spark, root)
    number = (before.agg(F.max("load")).first()[0] or 0) + 1
    new = files_in(spark, source).join(before.select("file", "changed"), ["file", "changed"], "left_anti")
    files = {r["file"]: (r["changed"], r["bytes"]) for r in new.orderBy("file").collect()}
    target, found, errors = f"{root}/data/load={number}", [], {}

    def read(some: list[str]) -> None:
        part = f"{target}/part={len(found)}"
        try:
            rows = spark.read.schema(schema).parquet(*some).withColumn("_file", F.col("_metadata.file_path"))
            rows.write.mode("overwrite").parquet(part)
        except (PySparkException, Py4JJavaError) as error:
            text = str(error)
            if not any(b in text for b in BROKEN):
                raise
            if len(some) == 1:
                errors[some[0]] = next(line for line in text.splitlines() if any(b in line for b in BROKEN)).strip()[:500]
                return
            half = len(some) // 2
            read(some[:half])
            read(some[half:])
            return
        found.append(part)

    if files:
        read(sorted(files))
    counts = {}
    if found:
        written = spark.read.parquet(*found).groupBy("_file").agg(F.count(F.lit(1)).alias("n"))
        counts = {_plain(r["_file"]): r["n"] for r in written.collect()}
    rows = [(f, *files[f], None if f in errors else counts.get(_plain(f), 0), errors.get(f), number) for f in sorted(files)]
    made = spark.createDataFrame(rows, HISTORY)
    if rows:
        made.coalesce(1).write.mode("append").parquet(f"{root}/history")
    return made


def _plain(path: str) -> str:
    """A path without the slashes that some readers put behind the scheme."""
    scheme, colon, rest = path.partition(":")
    return f"{scheme}:/{rest.lstrip('/')}" if colon else path
