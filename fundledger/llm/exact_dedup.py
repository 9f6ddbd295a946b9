"""Exact deduplication by a 128-bit content hash, with bytes compared inside each hash group.

One aggregation on (hash, text) does both steps: rows meet by the hash and are merged only where the
text itself is the same byte for byte, so two texts with one hash stay apart. It combines on the map
side, so a text that a third of all rows share leaves each task once. Members then learn their group
from a narrow join of digests; the texts move once. Everything is SQL functions.

Defined results: a null text counts as empty, and empty texts equal each other. A null id is smaller
than any other id; a group of null ids alone keeps a null id. Rows that repeat both id and text are
one document: all carry the same decision and :func:`deduplicate` returns one of them. An empty table
gives an empty result. Column names of the input never clash with those used here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def content_hash(text: Column) -> Column:
    """128 bits of the text's UTF-8 bytes."""
    return F.unhex(F.md5(text))


def groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    hashed: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    ``keep`` says which id of equal texts stays: the "smallest" or the "largest".
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    pick = F.min if keep == "smallest" else F.max
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = rows.withColumn("content", hashed(F.col("text")))
    digest = F.unhex(F.sha2("text", 256))
    same = (
        rows.groupBy("content", "text")
        .agg(pick("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
        .select(F.col("content").alias("content2"), digest.alias("digest2"), "keep_id", "group_size")
    )
    narrow = rows.select("doc_id", "content", digest.alias("digest"))
    met = narrow.join(same, (F.col("content") == F.col("content2")) & (F.col("digest") == F.col("digest2")), "left")
    alone = F.col("group_size").isNull()
    return met.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (alone | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows that stay, with the input's columns.

    One aggregation on (hash, text) carries a row's other columns along, so texts move once. Of rows that
    repeat id and text the one with the smaller hash of its other columns stays.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    pick = F.min_by if keep == "smallest" else F.max_by
    own, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    others = [c for c in docs.columns if c != text_col]
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)], text.isNull().alias("none"))
    order = F.struct(own.alias("id"), text.isNull().alias("none"), F.xxhash64(*[F.col(f"`{c}`") for c in others]).alias("rest"))
    held = docs.select(F.coalesce(text, F.lit("")).alias("text"), row.alias("row"), order.alias("order"))
    same = held.groupBy(content_hash(F.col("text")).alias("content"), "text").agg(pick("row", "order").alias("row"))
    back = {text_col: F.when(~F.col("row.none"), F.col("text")), **{c: F.col(f"row.c{i}") for i, c in enumerate(others)}}
    return same.select(*[back[c].alias(c) for c in docs.columns])
