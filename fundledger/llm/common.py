"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundledger.session import cut_lineage, scratch_path

# Rows handed to a Python worker at once: texts of a few hundred kilobytes each still fit.
ARROW_ROWS = 512

__all__ = ["ARROW_ROWS", "arrow_rows", "cut_lineage", "scratch_path", "table", "only"]


def arrow_rows(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the rows of one Arrow batch, and with them a Python worker's memory.

    Workers also give large freed blocks back to the system, so that idle ones stay small, and get
    this package's own folder on their path, for clusters that mount it; elsewhere the package is
    shipped as any other, with --py-files.
    """
    spark.sparkContext.environment.update(ARROW_DEFAULT_MEMORY_POOL="system", MALLOC_ARENA_MAX="2", MALLOC_TRIM_THRESHOLD_=str(64 << 20), MALLOC_MMAP_THRESHOLD_=str(32 << 20))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in path:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *path])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def only(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The id and the text under fixed names, whatever else the table holds."""
    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
