"""Bronze, silver and gold tables as Parquet directories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PARTITION = {"bronze": "ingestion_date", "silver": "snapshot_date", "gold": "refreshed_date"}


def _path(root: str, layer: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{dataset}"


def exists(spark: SparkSession, path: str) -> bool:
    """True when a path exists on whatever file system it names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder and what is in it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def mark(spark: SparkSession, path: str) -> None:
    """Write an empty marker file; names that begin with an underscore are not data to Spark."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True).close()


def read_layer(
    spark: SparkSession, root: str, layer: str, dataset: str, date: str | None = None
) -> DataFrame:
    """A whole dataset with its partition column, or one date of it (only that directory is read)."""
    df = spark.read.option("basePath", _path(root, layer, dataset)).parquet(_path(root, layer, dataset))
    return df if date is None else df.where(F.col(PARTITION[layer]) == F.lit(date).cast("date"))


def write_layer(
    df: DataFrame,
    root: str,
    layer: str,
    dataset: str,
    date: str,
    mode: str = "skip",
    rows_per_file: int = 0,
    sort_by: list[str] | None = None,
) -> bool:
    """Write one date of a dataset as Snappy Parquet; True when rows were written.

    ``skip`` leaves a date alone once it has been loaded whole, which a marker beside it says (bronze), ``overwrite_partition`` replaces that date
    only (silver), ``overwrite`` replaces the dataset (gold). ``sort_by`` clusters the files by
    range, so later filters skip most of them.
    """
    path = _path(root, layer, dataset)
    column = PARTITION[layer]
    done = f"{path}/_loaded-{date}"
    if mode == "skip" and exists(df.sparkSession, done):
        return False
    if sort_by:
        df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
    writer = (
        df.withColumn(column, F.lit(date).cast("date"))
        .write.partitionBy(column)
        .option("compression", "snappy")
    )
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if mode == "skip":
        # A date without its marker is a load that broke off: it is written anew as a whole.
        writer.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
        mark(df.sparkSession, done)
    elif mode == "overwrite_partition":
        writer.option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)
    elif mode == "overwrite":
        writer.option("partitionOverwriteMode", "static").mode("overwrite").parquet(path)
    else:
        raise ValueError(f"unknown mode {mode}")
    return True


def gate(spark: SparkSession, root: str, date: str, datasets: list[str]) -> None:
    """Raise unless every bronze dataset has rows for the date."""
    empty = [
        d
        for d in datasets
        if not exists(spark, f"{_path(root, 'bronze', d)}/{PARTITION['bronze']}={date}")
        or read_layer(spark, root, "bronze", d, date).isEmpty()
    ]
    if empty:
        raise RuntimeError(f"no bronze rows on {date} for {', '.join(empty)}")


def create_copy(df: DataFrame, path: str) -> DataFrame:
    """Write a query's result as a new table and read it back."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Write a filtered set as CSV with a header line in every part."""
    df.write.mode("errorifexists").option("header", True).csv(path)


def ensure_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add the columns that are missing, as typed nulls; present ones stay as they are."""
    missing = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update: list[str],
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Target rows with the ``update`` columns of matching source rows, and new source rows added.

    Columns outside ``update`` keep the target's value where there is one; ``keep`` names columns
    that must not change even when null. Both sides have one row per key.
    """
    new = source.withColumnsRenamed({c: f"_new_{c}" for c in source.columns}).withColumn("_arrived", F.lit(True))
    on = [target[k].eqNullSafe(new[f"_new_{k}"]) for k in keys]
    joined = target.withColumn("_old", F.lit(True)).join(new, on, "full_outer")
    known, arrived = F.col("_old").isNotNull(), F.col("_arrived").isNotNull()

    def value(c: str):
        if f"_new_{c}" not in joined.columns:
            return F.col(c)
        if c in update:
            return F.when(arrived, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
        if c in keep:
            return F.when(known, F.col(c)).otherwise(F.col(f"_new_{c}")).alias(c)
        return F.coalesce(F.col(c), F.col(f"_new_{c}")).alias(c)

    return joined.select(*[value(c) for c in target.columns])


def load_new_files(
    spark: SparkSession, source: str, schema: str, target: str, checkpoint: str
) -> DataFrame:
    """Append files of ``source`` that were not loaded before to ``target``, and return ``target``.

    The checkpoint is the load history: a rerun finds nothing to do. Columns are matched by name. A
    file that cannot be read fails the load, and the run after it is mended goes on from there.
    """
    stream = spark.readStream.schema(schema).parquet(source)
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", target)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(schema).parquet(target)
