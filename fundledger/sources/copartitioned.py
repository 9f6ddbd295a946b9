"""Tables bucketed alike, so that joins between them move no rows.

Spark leaves the shuffle under a join out if both sides are bucketed by the join's keys into the same number
of buckets. But a bucket is read by one task, which the adaptive skew join cannot split, so a key that owns a
large part of a table would fill one task. Therefore buckets are of key and salt: a detail row's salt follows
from its other columns, and the side with one row per key is written once for each salt. A key's rows are
spread over up to ``salts`` buckets, and each of them meets its own copy of the key's row.

What it costs is known in advance: ``salts`` copies of the small side. What a reader gets is every join of
these tables without an exchange, as often as they are joined. Take ``buckets`` so that a bucket fits a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundledger.sources.layers import exists

SALT = "_salt"


def salted(rows: DataFrame, by: list[str], salts: int) -> DataFrame:
    """Detail rows with a salt that follows from the columns ``by``; equal rows have equal salts, nulls are values."""
    _free(rows)
    return rows.withColumn(SALT, F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int"))


def replicated(rows: DataFrame, salts: int) -> DataFrame:
    """Each row once for every salt."""
    _free(rows)
    return rows.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def one_copy(rows: DataFrame) -> DataFrame:
    """The rows that ``replicated`` was given; other tables stay as they are."""
    return rows.where(F.col(SALT) == 0).drop(SALT) if SALT in rows.columns else rows


def join_keys(rows: DataFrame, copies: DataFrame, keys: list[str]) -> list[str]:
    """What detail rows and the side with one row per key are joined on: with the salt, if both have it."""
    if SALT in copies.columns and SALT not in rows.columns:
        raise ValueError("the replicated side would multiply rows without a salt")
    return [*keys, SALT] if SALT in copies.columns else list(keys)


def write_bucketed(rows: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Write a new table of ``buckets`` files, one a bucket, and read it through the catalog, which knows the layout."""
    laid = rows.repartition(buckets, *[F.col(k) for k in keys])
    laid.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name)
    return rows.sparkSession.table(name)


def declare_bucketed(spark: SparkSession, name: str, path: str, schema: str, keys: list[str], buckets: int) -> DataFrame:
    """A table that another session wrote: files alone do not tell how they are bucketed."""
    if not exists(spark, f"{path}/_SUCCESS"):
        raise ValueError(f"{path} was not written whole")
    columns = ", ".join(f"`{k}`" for k in keys)
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({columns}) SORTED BY ({columns}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def _free(rows: DataFrame) -> None:
    if SALT in rows.columns:
        raise ValueError(f"rows already have a column {SALT}")
