"""SimHash near-duplicates, with links found by covering locality-sensitive hashing.

A fingerprint has 64 bits: bit i is 1 if it is set in over half of the hashes (XXH64, seed 42) of the
text's word shingles. Two fingerprints link at ``RADIUS`` or fewer differing bits.

Covering tables: every bit position i gets a non-zero vector m(i) of RADIUS + 1 bits. For each
non-zero vector v there is one table, keyed by the fingerprint's bits at the positions where the
inner product <m(i), v> is odd. RADIUS differing positions span at most RADIUS dimensions, so some v is
orthogonal to all of them, and in its table the two fingerprints have the same key: no pair within the
radius can be missed. Pairs from a shared key are compared exactly.

Only distinct fingerprints enter the tables. A key with many fingerprints is not paired out: its
members are joined through the centres at distance one or less. Two fingerprints differ in two or
fewer bits exactly if they share such a centre, so linking each member to the smallest member of its
centre is exact and linear.

Defined results: a null text has no words; no words give fingerprint zero, which links like any other.
Fewer words than a shingle give one shingle of all words. A null id takes no part in links but keeps
its row, with its component. Repeated rows repeat in the result. Empty tables give empty results.
Of a group :func:`drop_near_copies` keeps the row with the smallest id (null before all), of equal ids the one
with the smaller text hash; rows equal in id and text stay or go together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundledger.llm.common import arrow_rows, cut_lineage, only
from fundledger.llm.components import components

BITS = 64
RADIUS = 2
WIDTH = 3
SEED = 42
# A table key with more fingerprints than this is joined through centres in place of pairs.
PAIRED = 32

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 of every run of ``width`` words, A-Z lowered; of all words, if there are fewer."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    count = max(1, len(words) - width + 1)
    ends = (starts + sizes)[-count:]
    one = xxhash.xxh64_intdigest
    return np.fromiter((one(line[a:b], SEED) for a, b in zip(starts[:count].tolist(), ends.tolist())), dtype=np.uint64, count=count)


def fold(hashes: np.ndarray, block: int = 1 << 16) -> int:
    """The fingerprint of a text's shingle hashes."""
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), block):
        part = hashes[start : start + block].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(doc_id, fp): the fingerprint's 64 bits as a long, one row per input row."""
    arrow_rows(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fold(shingle_hashes(t, width)) for t in batch.column("text").to_pylist()]
            bits = np.array(made, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bits)], ["doc_id", "fp"])

    rows = only(docs, id_col, text_col)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, fp long")


def covering_masks(bits: int = BITS, radius: int = RADIUS) -> list[int]:
    """One mask per table. Positions are dealt evenly over the non-zero vectors of radius + 1 bits."""
    vectors = (1 << (radius + 1)) - 1
    dealt = [i % vectors + 1 for i in range(bits)]
    return [sum(1 << i for i in range(bits) if (dealt[i] & v).bit_count() % 2) for v in range(1, vectors + 1)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _keys(mask_of: Column) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(t).alias("t"), mask_of.bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(covering_masks())]))


def _spread(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every node under its key in every table, and the number of nodes of each key that has several."""
    spread = cut_lineage(nodes.select("node", "fp", _keys(F.col("fp")).alias("k")).select("node", "fp", "k.t", "k.key"))
    return spread, cut_lineage(spread.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))


def _through_centres(crowd: DataFrame) -> DataFrame:
    """Links of a crowd: each node with the smallest one of every centre at distance one or less."""
    flips = [0, *(1 << i for i in range(BITS))]
    around = crowd.select("node", F.explode(F.transform(F.array(*[F.lit(_signed(b)) for b in flips]), lambda b: F.col("fp").bitwiseXOR(b))).alias("centre"))
    around = cut_lineage(around)
    least = around.groupBy("centre").agg(F.min("node").alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1").select("centre", "v")
    return around.join(least, "centre").where(F.col("node") != F.col("v")).select(F.col("node").alias("u"), "v")


def links(nodes: DataFrame, paired: int = PAIRED) -> DataFrame:
    """(u, v) over ``nodes`` (node, fp; one row per distinct fp) whose transitive closure is that of all links."""
    spread, sizes = _spread(nodes)
    few = spread.join(sizes.where(F.col("n") <= paired).select("t", "key"), ["t", "key"])
    left = few.select("t", "key", F.col("node").alias("u"), F.col("fp").alias("a"))
    right = few.select("t", "key", F.col("node").alias("v"), F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS
    pairs = left.join(right, ["t", "key"]).where(F.col("u") < F.col("v")).where(near).select("u", "v")
    crowd = spread.join(sizes.where(F.col("n") > paired).select("t", "key"), ["t", "key"], "left_semi").select("node", "fp").distinct()
    return pairs.unionByName(_through_centres(crowd)).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per input row: doc_id, fp, component_id (the smallest id that links reach)."""
    marked = cut_lineage(fingerprints(docs, id_col, text_col, width))
    nodes = cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("node")))
    known = nodes.where("node is not null")
    found = components(links(known))
    grouped = nodes.join(found.withColumnRenamed("component", "c"), "node", "left").select(
        "fp", F.coalesce("c", "node").alias("component_id")
    )
    return marked.join(grouped, "fp", "left").select("doc_id", "fp", "component_id")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of linked fingerprints, with the input's columns."""
    own, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    # Rows are told apart by id and text, as ids may repeat.
    key = F.struct(own.alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("mark"))
    rows = docs.select(key.alias("row"), text.alias("text"))
    gone = near_duplicates(rows, "row").where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("_row")).distinct()
    # Texts move once, at every size of the table alike.
    held = docs.withColumn("_row", key).join(gone.hint("merge"), "_row", "left_anti")
    return held.select(*[F.col(f"`{c}`") for c in docs.columns])


def fingerprint_hex(fp: Column) -> Column:
    """16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
