"""Substring search through a table of postings: which rows hold which runs of two and three characters.

A term's rows hold all its runs. A search joins the runs of all terms, the rarest few of each, with the
postings, keeps the rows that have all of them, and checks these few in full. Nothing else of the table is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Runs of a term that are looked up: the rarest.
LOOKED_UP = 3


def grams(text: Column, size: int) -> Column:
    """The different runs of ``size`` characters of a text in lower case."""
    low = F.lower(F.coalesce(text, F.lit("")))
    places = F.sequence(F.lit(1), F.greatest(F.length(low) - (size - 1), F.lit(1)))
    runs = F.transform(places, lambda i: F.substring(low, i, F.lit(size)))
    return F.array_distinct(F.filter(runs, lambda x: F.length(x) == size))


def postings(table: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(gram, key) for every run of two and of three characters in any of the columns.

    Write it once, with :func:`write_postings`, and search often.
    """
    runs = F.array_distinct(F.flatten(F.array(*[grams(F.col(c), n) for c in columns for n in (2, 3)])))
    # A row becomes some fifty, and the table may be one file that one task reads: rows are dealt out first.
    rows = table.where(F.col(key).isNotNull()).select(key, *[c for c in columns if c != key]).hint("rebalance")
    return rows.select(F.explode(runs).alias("gram"), F.col(key).alias("key"))


def write_postings(index: DataFrame, path: str) -> DataFrame:
    """The postings in order of their runs, so that a file's statistics name the few runs in it."""
    index.repartitionByRange("gram", "key").sortWithinPartitions("gram", "key").write.parquet(path)
    return index.sparkSession.read.schema(index.schema).parquet(path)


def gram_sizes(index: DataFrame) -> DataFrame:
    """How many rows hold each run."""
    return index.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))


def search(terms: DataFrame, table: DataFrame, key: str, columns: list[str], index: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """(term, key): the rows of ``table`` with a column that contains the term, in any case, for all ``terms`` (term) at once.

    Terms of two characters are one run, and its postings are the answer; shorter ones are an error of the
    caller and find nothing. ``key`` is unique in ``table``.
    """
    asked = terms.select("term").distinct().where(F.length("term") >= 2)
    size = F.when(F.length("term") == 2, F.lit(2)).otherwise(F.lit(3))
    runs = F.when(size == 2, grams(F.col("term"), 2)).otherwise(grams(F.col("term"), 3))
    looked = asked.select("term", F.explode(runs).alias("gram")).join(gram_sizes(index) if sizes is None else sizes, "gram", "left")
    # A term has no more runs than characters. One that no row holds comes first, and leaves no rows.
    rarest = Window.partitionBy("term").orderBy(F.coalesce("n", F.lit(0)), "gram")
    chosen = looked.withColumn("nth", F.row_number().over(rarest)).where(F.col("nth") <= LOOKED_UP)
    wanted = chosen.groupBy("term").agg(F.count(F.lit(1)).alias("wanted"))
    # A task of the join hardly ever meets a pair twice, so pairs move first and are counted where they meet. Their
    # tasks are all that the session shuffles into: pairs pack so well that adaptive merging would fill a task's memory.
    tasks = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = chosen.select("term", "gram").join(index, "gram").repartition(tasks, "key")
    met = pairs.groupBy("term", "key").agg(F.count(F.lit(1)).alias("held"))
    few = met.join(wanted, "term").where("held = wanted").select("term", "key")
    rows = table.select(F.col(key).alias("key"), *[F.lower(F.col(c)).alias(f"_c{i}") for i, c in enumerate(columns)])
    hit = F.lit(False)
    for i in range(len(columns)):
        hit = hit | F.coalesce(F.contains(F.col(f"_c{i}"), F.lower("term")), F.lit(False))
    return few.join(rows, "key").where(hit).select("term", F.col("key").alias(key))
