"""Tables laid out by a hash bucket of their key, so that a batch rewrites only the buckets it touches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundledger.session import cut_lineage
from fundledger.sources.layers import exists, upsert

BUCKET = "_bucket"


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def read_buckets(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table without its bucket column; empty, if nothing was written yet."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(f"{schema}, {BUCKET} int").parquet(path).drop(BUCKET)


def upsert_buckets(
    spark: SparkSession,
    path: str,
    schema: str,
    source: DataFrame,
    keys: list[str],
    update: list[str],
    buckets: int,
    merge: Callable[[DataFrame, DataFrame], DataFrame] | None = None,
) -> int:
    """Upsert a batch (one row per key) and return how many buckets it rewrote; the others keep their files.

    ``merge`` makes the rows to write from the batch and the known rows of the same buckets, where they are not the batch's own.
    A bucket's rows are one file, so the table has as many files as buckets, however many batches came. The
    number of buckets is fixed for a table; take it so that a bucket fits a task. The same batch again gives
    the same table.
    """
    arrived = cut_lineage(source.withColumn(BUCKET, bucket_of(keys, buckets)))
    touched = sorted(r[0] for r in arrived.select(BUCKET).distinct().collect())  # at most ``buckets``
    if not touched:
        return 0
    if exists(spark, path):
        # The partition filter leaves the other buckets unread.
        known = spark.read.schema(f"{schema}, {BUCKET} int").parquet(path).where(F.col(BUCKET).isin(touched)).drop(BUCKET)
    else:
        known = spark.createDataFrame([], schema)
    rows = arrived.drop(BUCKET)
    merged = upsert(known, rows if merge is None else merge(rows, known), keys, update).withColumn(BUCKET, bucket_of(keys, buckets))
    # Written beside the table first: a bucket is not read while it is replaced.
    ready = cut_lineage(merged)
    writer = ready.repartition(BUCKET).write.partitionBy(BUCKET).option("partitionOverwriteMode", "dynamic")
    writer.mode("overwrite").parquet(path)
    return len(touched)
