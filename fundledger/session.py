"""Session settings, shared scratch space and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "fundledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; a cluster's own master and sizes are left alone."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by the cluster in ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one process, may fall back to a
    temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the whole cluster")
    folder = tempfile.mkdtemp(prefix="fundledger-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


_RUN = uuid.uuid4().hex


def _run_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/fundledger/{_RUN}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path of its own below the shared folder; nothing is ever overwritten."""
    return f"{_run_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this run's scratch tables. Call it when the results that read them are used up."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_run_folder(spark))
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the files.

    A lost executor then cannot change the rows, and later steps read only the columns they need.
    One pass over ``df`` is enough, where an eager ``checkpoint()`` makes two.
    """
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
