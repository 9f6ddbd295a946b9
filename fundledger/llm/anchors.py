"""Content-chosen anchors: the smallest gram hash of every window of a sequence.

Two equal windows choose the same gram at the same place in them, so all copies of a window meet under
one anchor. Neighbouring windows mostly share their anchor and form one run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIX = np.uint64(0x9E3779B97F4A7C15)
_PLACE_BITS = np.uint64(24)
_PLACE = np.uint64((1 << 24) - 1)


def scramble(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values, so that their order says nothing about the content."""
    x = (x ^ (x >> np.uint64(31))) * MIX
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def window_minima(grams: np.ndarray, width: int) -> np.ndarray:
    """For each start, the place of the smallest of ``width`` grams from there; the leftmost of equals."""
    count = len(grams) - width + 1
    if count <= 0:
        return np.empty(0, dtype=np.int64)
    packed = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    padded = np.full(-(-len(packed) // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(packed)] = packed
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(back[:count], ahead[width - 1 : width - 1 + count]) & _PLACE).astype(np.int64)


def runs(places: np.ndarray, starts: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of each run of consecutive windows with one anchor and one owner."""
    if not len(starts):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (places[1:] != places[:-1]) | (owners[1:] != owners[:-1]) | (np.diff(starts) != 1)
    first = np.flatnonzero(new)
    return first, np.diff(np.append(first, len(starts)))


def parts(sizes: list[int], length: int, most: int) -> Iterator[list[tuple[int, int, int]]]:
    """Lists of (text, from, to) with about ``most`` symbols each, that hold every window of ``length`` once."""
    batch, held = [], 0
    for text, size in enumerate(sizes):
        for start in range(0, max(0, size - length + 1), most):
            stop = min(size, start + most + length - 1)
            batch.append((text, start, stop))
            held += stop - start
            if held >= most:
                yield batch
                batch, held = [], 0
    if batch:
        yield batch


def windows_of(batch: list[tuple[int, int, int]], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of parts laid end to end: the starts of whole windows, the part of each, and where each part begins."""
    sizes = np.array([stop - start for _, start, stop in batch])
    begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    owner = np.repeat(np.arange(len(batch)), sizes)
    starts = np.flatnonzero(np.arange(len(owner)) + length <= (begins + sizes)[owner])
    return starts, owner[starts], begins


def merge_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs that half-open spans cover together; touching spans are one run."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(starts), dtype=bool)
    new[1:] = starts[1:] > reach[:-1]
    first = np.flatnonzero(new)
    return starts[first], reach[np.append(first[1:], len(starts)) - 1]


def same_row(left: DataFrame, right: DataFrame) -> Column:
    """Rows of one document: the id, null or not, and the text's hash."""
    return left["doc_id"].eqNullSafe(right["doc_id"]) & (left["mark"] == right["mark"])


def rows_of(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, mark, raw): the id, a hash of the text that parts rows of one id, and the text's bytes."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("mark"), text.cast("binary").alias("raw"))


def packed(rows: DataFrame) -> DataFrame:
    """The rows with their texts compressed, for a shuffle that moves every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            raw = pa.array([squeeze(x) for x in batch.column("raw").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("mark"), raw], ["doc_id", "mark", "raw"])

    return rows.mapInArrow(run, rows.schema)


def unpack(raw: bytes) -> bytes:
    return zstandard.decompress(raw) if raw else b""
