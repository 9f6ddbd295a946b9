"""A Merkle manifest of a dataset: one tree for each source, one tree over their roots, and membership proofs.

* A row's leaf is the hash of its columns, each written as length and value. Leaves of a source stand in
  order of their ids; every ``FAN`` consecutive nodes have one parent, whose digest is the hash of theirs.
  The roots of all sources, in order of the sources, are the leaves of a top tree with the dataset's root.
* Inner nodes are stored by content: a record maps a digest to its children.
* Proofs descend from the root. A request's place, written in base ``FAN``, says which child to take at
  each node; the children not taken are collected. Requests whose leading digits agree go down together
  as one row, so a level has as many rows as requested nodes, and only the last level has one for each
  leaf. At the end the collected segments are reversed: they then run from the leaf to the root.

Ranks within a source come from one range partitioning by (source, id, leaf) and offsets of its
partitions, so no source meets in one task, however many rows it has. Building takes one grouped job a
level, over a third of the rows of the level before. Everything is SQL functions.

Defined results: a null column is written as ``-``; null sources are one source, before all others; null
ids stand first in their source. Rows that repeat an id stand in order of their leaves, and rows equal in
all columns are leaves of their own. A tree of one leaf has that leaf as root and no siblings. Where the
text changes, ids and other columns stay. An empty table has no root and no proofs. Further columns of
the table are not read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundledger.llm.common import cut_lineage

FAN = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_NONE = bytearray(b"")


def field(value: Column) -> Column:
    """A value with its length in bytes, or ``-``."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def text_of(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def hashed(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def leaf_of(*values: Column) -> Column:
    return hashed(F.concat(*[field(v) for v in values]))


def _joined(digests: Column) -> Column:
    return F.aggregate(digests, F.lit(_NONE), lambda a, x: F.concat(a, x))


@dataclass
class Manifest:
    """``leaves``: the rows with source, tree, rank, n (leaves of the tree) and leaf. ``levels``: for each height from 1
    the records (tree, rank, n, digest, children). ``sources``: tree, height and root of each. ``top``: the
    same as ``levels`` over the sources. ``root``: the dataset's, None if it is empty."""

    leaves: DataFrame
    levels: list[DataFrame]
    sources: DataFrame
    top: list[DataFrame]
    root: str | None


def ranked(rows: DataFrame, group: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """(``rows`` with ``rank`` from 0 and ``n`` in their group, and ``tree``: the group's place; the groups with their places).

    Without ``group`` there is one, at place 0.
    """
    keys = [*group, *order]
    laid = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id())
    laid = cut_lineage(laid).withColumn("part", F.shiftright("at", 33))
    held = laid.groupBy(*group, "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("held"))
    # One row for each group and partition that holds some of it: as many as groups and partitions together.
    mine = Window.partitionBy(*[F.col(g) for g in group] or [F.lit(0)])
    before = mine.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = cut_lineage(held.withColumns({"n": F.sum("held").over(mine), "gone": F.coalesce(F.sum("held").over(before), F.lit(0))}))
    places = parts.select(*group, "n").distinct()
    if group:
        places = ranked(places.withColumnRenamed("n", "size"), [], group)[0].select(*group, F.col("size").alias("n"), F.col("rank").alias("tree"))
        places = cut_lineage(places)
        named = parts.alias("p").join(places.alias("g"), _same("p", "g", group)).select("p.*", "g.tree")
    else:
        places, named = places.withColumn("tree", F.lit(0).cast("long")), parts.withColumn("tree", F.lit(0).cast("long"))
    met = laid.alias("r").join(named.alias("o"), (F.col("r.part") == F.col("o.part")) & _same("r", "o", group))
    rank = F.col("r.at") - F.col("o.first") + F.col("o.gone")
    return met.select(*[F.col(f"r.`{c}`") for c in rows.columns], rank.alias("rank"), F.col("o.n").alias("n"), F.col("o.tree").alias("tree")), places


def _same(left: str, right: str, columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns], F.lit(True))


def build(leaves: DataFrame) -> list[DataFrame]:
    """The records of each height over ``leaves`` (tree, rank, n, digest); trees of one node end below."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    level, levels = leaves, []
    while most > 1:
        runs = level.where("n > 1").groupBy("tree", F.floor(F.col("rank") / FAN).alias("rank"), F.ceil(F.col("n") / FAN).alias("n"))
        made = runs.agg(F.array_sort(F.collect_list(F.struct(F.col("rank"), F.col("digest")))).alias("run"))  # at most FAN
        made = made.select("tree", "rank", "n", F.transform("run", lambda x: x["digest"]).alias("children"))
        digest = hashed(text_of(_joined(F.col("children"))))
        level = cut_lineage(made.withColumn("digest", digest))
        levels.append(level)
        most = -(-most // FAN)
    return levels


def manifest(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, source: str = "source", order: str = "doc_id", carry: dict[str, Column] | None = None) -> Manifest:
    """The trees of ``docs``. ``carry`` names further expressions over its columns, kept with the leaves."""
    kept = {k: v for k, v in (carry or {}).items()}
    named = docs.select(*[F.col(f"`{c}`").alias(c) for c in dict.fromkeys((*columns, source, order))])
    rows = named.select(F.col(order).alias("doc_id"), F.col(source).alias("source"), leaf_of(*[F.col(c) for c in columns]).alias("leaf"), *[v.alias(k) for k, v in kept.items()])
    leaves, _ = ranked(cut_lineage(rows), ["source"], ["doc_id", "leaf"])
    leaves = cut_lineage(leaves)
    nodes = leaves.select("tree", "rank", "n", F.col("leaf").alias("digest"))
    levels = build(nodes)
    ends = [x.where("n = 1").select("tree", F.col("digest").alias("subroot"), F.lit(h).alias("height")) for h, x in enumerate([nodes, *levels])]
    sources = cut_lineage(reduce(DataFrame.unionByName, ends))
    count = sources.count()
    heads = sources.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), F.lit(count).cast("long").alias("n"), F.col("subroot").alias("digest"))
    top = build(heads)
    last = (top[-1] if top else heads).select(text_of(F.col("digest")).alias("root")).first()
    return Manifest(leaves, levels, sources, top, last["root"] if last else None)


def _segment(children: Column, place: Column) -> Column:
    """What stands left and right of the chosen child."""
    left = _joined(F.slice(children, F.lit(1), place))
    right = _joined(F.slice(children, place + 2, F.lit(FAN)))
    return F.struct(left.alias("left"), right.alias("right"))


def _records(level: DataFrame) -> DataFrame:
    """Digest to children; equal digests have equal children."""
    return level.select("digest", "children").dropDuplicates(["digest"])


def _down(front: DataFrame, level: DataFrame, others: list[str]) -> DataFrame:
    """One step: each row gives one for each child, with the children not taken put to its path."""
    met = front.join(_records(level), "digest").select("*", F.posexplode("children").alias("place", "child"))
    path = F.concat("path", F.array(_segment(F.col("children"), F.col("place"))))
    return met.select("tree", (F.col("rank") * FAN + F.col("place")).alias("rank"), F.col("child").alias("digest"), path.alias("path"), *others)


def prove(made: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """The leaves asked for (``requests``: tree, rank; all, if None) with subroot and ``path`` (left and right siblings, leaf first)."""
    spark = made.leaves.sparkSession
    asked = made.leaves if requests is None else made.leaves.join(requests.select("tree", "rank").distinct(), ["tree", "rank"], "left_semi")

    def wanted(front: DataFrame, height: int) -> DataFrame:
        if requests is None:
            return front
        prefix = requests.select("tree", F.floor(F.col("rank") / FAN**height).alias("rank")).distinct()
        return front.join(prefix, ["tree", "rank"], "left_semi")

    empty = "array<struct<left:binary,right:binary>>"
    front = spark.range(1).select(F.lit(0).cast("long").alias("tree"), F.lit(0).cast("long").alias("rank"), F.unhex(F.lit(made.root)).alias("digest"), F.array().cast(empty).alias("path"))
    for level in reversed(made.top):
        front = _down(front, level, [])
    heads = front.select(F.col("rank").alias("tree"), F.col("digest").alias("subroot"), "path")
    heads = cut_lineage(heads.join(made.sources.select("tree", "height"), "tree"))
    begin = lambda h: heads.where(F.col("height") == h).select("tree", F.lit(0).cast("long").alias("rank"), F.col("subroot").alias("digest"), "path", "subroot")
    front = None
    for height in range(len(made.levels), 0, -1):
        here = begin(height) if front is None else front.unionByName(begin(height))
        if height > 1:
            front = cut_lineage(wanted(_down(here, made.levels[height - 1], ["subroot"]), height - 1))
        else:
            front = here.join(_records(made.levels[0]), "digest").select("tree", "rank", "path", "subroot", "children")
    alone = begin(0).select("tree", "rank", "path", "subroot", F.lit(None).cast("array<binary>").alias("children"))
    parents = (alone if front is None else front.unionByName(alone)).withColumnRenamed("rank", "above")
    met = asked.withColumn("above", F.floor(F.col("rank") / FAN)).join(parents, ["tree", "above"])
    own = _segment(F.col("children"), F.pmod(F.col("rank"), F.lit(FAN)).cast("int"))
    path = F.reverse(F.concat("path", F.when(F.col("children").isNull(), F.array().cast(empty)).otherwise(F.array(own))))
    return met.select(*asked.columns, "subroot", path.alias("path"))


def proof_text(path: Column) -> Column:
    """The siblings' digests, level by level from the leaf, left to right."""
    return text_of(F.aggregate(path, F.lit(_NONE), lambda a, s: F.concat(a, s["left"], s["right"])))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda a, s: hashed(text_of(F.concat(s["left"], a, s["right"]))))


def proofs(docs: DataFrame, tampered: Column | None = None, text_col: str = "text", columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """One row per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    ``tampered`` is an expression for the text that a reader got; the leaf folded up is that of this text.
    """
    got = F.col(text_col) if tampered is None else tampered
    other = leaf_of(*[got if c == text_col else F.col(c) for c in columns])
    made = manifest(docs, columns, carry={"other": other})
    if made.root is None:
        return docs.sparkSession.createDataFrame([], f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    end = text_of(folded(F.col("other"), F.col("path")))
    out = prove(made).select(
        "doc_id",
        text_of(F.col("leaf")).alias("leaf"),
        text_of(F.col("subroot")).alias("subroot"),
        F.lit(made.root).alias("root"),
        F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"),
        end.alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
