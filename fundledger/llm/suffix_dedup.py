"""Repeated byte strings, found by sorting suffixes in range-partitioned buckets.

Every byte covered by a string of ``length`` bytes that also starts anywhere else is repeated. A full
suffix array would move ``length`` bytes for each byte of text, so suffixes are sorted only where a
repeat is still open:

1. Windows of ``length`` bytes choose anchors by content (see ``anchors``). A run of windows with one
   anchor is a segment, known by the hashes of its anchor gram and of its bytes. Both are counted.
   An anchor that occurs once holds no repeat; segments that recur whole are repeated throughout.
2. Segments that share only their anchor stay open. Their bytes are fetched once, range-partitioned by
   the leading bytes of the anchor with sampled splitters, and every bucket sorts all its suffixes, cut
   to ``length`` bytes, by multikey quicksort: eight bytes at a time, going on with tied groups alone.
   Suffixes that stay tied to the end are repeated.
3. Splitters never part equal anchors, so no repeat lies across a bucket's boundary. An anchor with more
   than ``CROWD`` different segments would overfill a bucket; its suffixes are spread by a 128-bit hash
   of their whole length instead, and compared by counting.

Matches never cross documents. Defined results: a null text is empty; texts shorter than ``length`` have
no repeats; rows repeating an id and text repeat each other like any other copies. Null ids are ids.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundledger.llm.anchors import merge_spans, packed, parts, rows_of, runs, same_row, scramble, unpack, window_minima, windows_of
from fundledger.llm.common import arrow_rows, cut_lineage

LENGTH = 200
GRAM = 32  # a power of two
BLOCK = 1 << 19
CROWD = 1 << 14
SORTED = 1 << 19


def gram_hashes(x: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from every place, by doubling."""
    h, span = scramble(x.astype(np.uint64) + np.uint64(1)), 1
    while span < GRAM:
        h = h[:-span] * np.uint64(0xD6E8FEB86659FD93 + 2 * span) + (h[span:] ^ (h[span:] >> np.uint64(17)))
        span *= 2
    return scramble(h)


def segments(raws: list[bytes], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, start, windows, anchor, content) of every run of windows with one anchor."""
    for batch in parts([len(r) for r in raws], length, BLOCK):
        joined = b"".join(raws[i][a:b] for i, a, b in batch)
        grams = gram_hashes(np.frombuffer(joined, dtype=np.uint8))
        starts, owner, begins = windows_of(batch, length)
        places = window_minima(grams, length - GRAM + 1)[starts]
        first, count = runs(places, starts, owner)
        at, own = starts[first], owner[first]
        ends = at + count + length - 1
        digest = xxhash.xxh3_64_intdigest
        content = np.fromiter((digest(joined[a:b]) for a, b in zip(at.tolist(), ends.tolist())), dtype=np.uint64, count=len(at))
        text = np.array([i for i, _, _ in batch])[own]
        start = np.array([a for _, a, _ in batch])[own] + at - begins[own]
        yield text, start, count, grams[places[first]].view(np.int64), content.view(np.int64)


def _segments(rows: DataFrame, length: int) -> DataFrame:
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column("doc_id"), batch.column("mark")
            for text, start, count, anchor, content in segments(batch.column("raw").to_pylist(), length):
                take = pa.array(text)
                columns = [ids.take(take), marks.take(take), pa.array(start), pa.array(count.astype(np.int32)), pa.array(anchor), pa.array(content)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "mark", "start", "windows", "anchor", "content"])

    return rows.mapInArrow(run, f"doc_id {id_type}, mark long, start long, windows int, anchor long, content long")


def tied(body: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of the suffixes at ``starts``, cut to ``length`` bytes, equal another one: multikey quicksort.

    Each round sorts the tied groups by their next eight bytes and keeps the groups that stay tied.
    """
    padded = np.concatenate([body, np.zeros(8, dtype=np.uint8)])
    words = np.zeros(len(body), dtype=np.uint64)
    for i in range(8):
        words = (words << np.uint64(8)) | padded[i : i + len(body)]
    live, group = np.arange(len(starts)), np.zeros(len(starts), dtype=np.int64)
    steps = [*range(0, length - 7, 8)]
    if length % 8:
        steps.append(length - 8)  # overlaps the one before, so no byte behind the end is read
    for step in steps:
        if not len(live):
            break
        word = words[starts[live] + step]
        order = np.lexsort((word, group))
        live, group, word = live[order], group[order], word[order]
        new = np.ones(len(live), dtype=bool)
        new[1:] = (group[1:] != group[:-1]) | (word[1:] != word[:-1])
        number = np.cumsum(new) - 1
        again = np.bincount(number)[number] > 1
        live, group = live[again], number[again]
    out = np.zeros(len(starts), dtype=bool)
    out[live] = True
    return out


def _bodies(rows: DataFrame, kinds: DataFrame, length: int) -> DataFrame:
    """The bytes of each open segment (one place of each), and the leading bytes of its anchor."""
    id_type = rows.schema["doc_id"].dataType.simpleString()
    wanted = kinds.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("anchor", "content", "times", "hot", "start", "windows")).alias("open"))
    text = packed(rows)
    met = text.join(wanted, same_row(text, wanted)).select(text["doc_id"], text["mark"], "raw", "open")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[dict] = []
            for row in batch.to_pylist():
                raw = unpack(row["raw"])
                for seg in row["open"]:
                    body = raw[seg["start"] : seg["start"] + seg["windows"] + length - 1]
                    # The anchor is the smallest gram of the first window, and stands in all of them.
                    grams = gram_hashes(np.frombuffer(body, dtype=np.uint8))
                    at = int(np.flatnonzero(grams.view(np.int64) == seg["anchor"])[0])
                    lead = int.from_bytes(body[at : at + 7], "big")
                    out.append({"doc_id": row["doc_id"], "mark": row["mark"], **seg, "lead": lead, "body": body})
            names = ["doc_id", "mark", "anchor", "content", "times", "hot", "start", "windows", "lead", "body"]
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([(n, t) for n, t in zip(names, _body_types(batch))]))

    return met.mapInArrow(
        run, f"doc_id {id_type}, mark long, anchor long, content long, times long, hot boolean, start long, windows int, lead long, body binary"
    )


def _body_types(batch: pa.RecordBatch) -> list[pa.DataType]:
    return [batch.schema.field("doc_id").type, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]


def _spans_schema(id_type: str) -> str:
    return f"doc_id {id_type}, mark long, start long, stop long"


def _sorted_spans(bodies: DataFrame, length: int) -> DataFrame:
    """Repeated spans of open segments that occur once, from buckets of sorted suffixes."""
    id_type = bodies.schema["doc_id"].dataType.simpleString()
    buckets = bodies.where("!hot").repartitionByRange("lead", "anchor").sortWithinPartitions("lead", "anchor")

    def settle(held: list[dict], id_arrow: pa.DataType) -> pa.RecordBatch:
        body = np.frombuffer(b"".join(r["body"] for r in held), dtype=np.uint8)
        begins = np.concatenate(([0], np.cumsum([len(r["body"]) for r in held])[:-1]))
        counts = np.array([r["windows"] for r in held])
        owner = np.repeat(np.arange(len(held)), counts)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        same = tied(body, begins[owner] + inner, length) & (np.array([r["times"] for r in held]) == 1)[owner]
        own, start = owner[same], inner[same] + np.array([r["start"] for r in held])[owner[same]]
        first, count = runs(own, start, own)
        rows, begin = own[first].tolist(), start[first]
        columns = [pa.array([held[i]["doc_id"] for i in rows], id_arrow), pa.array([held[i]["mark"] for i in rows], pa.int64())]
        return pa.RecordBatch.from_arrays([*columns, pa.array(begin), pa.array(begin + count + length - 1)], ["doc_id", "mark", "start", "stop"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        suffixes, id_arrow = 0, None
        for batch in batches:
            id_arrow = batch.schema.field("doc_id").type
            for row in batch.to_pylist():
                if suffixes >= SORTED and held[-1]["anchor"] != row["anchor"]:
                    yield settle(held, id_arrow)
                    held, suffixes = [], 0
                held.append(row)
                suffixes += row["windows"]
        if held:
            yield settle(held, id_arrow)

    return buckets.mapInArrow(run, _spans_schema(id_type))


def _crowd_spans(bodies: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many segments: suffixes spread and counted by a 128-bit hash."""
    id_type = bodies.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            for row in batch.to_pylist():
                body, n = row["body"], row["windows"]
                both = np.frombuffer(b"".join(digest(body[i : i + length]) for i in range(n)), dtype=np.int64).reshape(-1, 2)
                columns = [
                    pa.array([row["doc_id"]] * n, batch.schema.field("doc_id").type),
                    *(pa.array(np.full(n, row[c], dtype=np.int64)) for c in ("mark", "times")),
                    pa.array(row["start"] + np.arange(n)),
                    *(pa.array(np.ascontiguousarray(both[:, i])) for i in (0, 1)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "mark", "times", "start", "h1", "h2"])

    each = bodies.where("hot").mapInArrow(run, f"doc_id {id_type}, mark long, times long, start long, h1 long, h2 long")
    again = each.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2")
    return each.where("times = 1").join(again, ["h1", "h2"]).select("doc_id", "mark", "start", (F.col("start") + length).alias("stop"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD) -> DataFrame:
    """(doc_id, mark, start, stop): byte spans, overlapping, that cover exactly the repeated bytes."""
    if length < GRAM + 1:
        raise ValueError(f"length is over {GRAM} bytes")
    arrow_rows(docs.sparkSession)
    rows = rows_of(docs, id_col, text_col)
    cut = _segments(rows, length)
    known = cut.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.min("content").alias("lo"), F.max("content").alias("hi"))
    known = cut_lineage(known.where("n > 1").select("anchor", (F.col("lo") != F.col("hi")).alias("several")))
    met = cut_lineage(cut.join(known, "anchor"))
    several = met.where("several")
    at = F.min(F.struct("doc_id", "mark", "start", "windows")).alias("at")
    kinds = cut_lineage(several.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("times"), at).select("anchor", "content", "times", "at.*"))
    crowds = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowd).select("anchor", F.lit(True).alias("hot"))
    kinds = kinds.join(crowds, "anchor", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    bodies = cut_lineage(_bodies(rows, kinds, length))
    stop = (F.col("start") + F.col("windows") + (length - 1)).alias("stop")
    recur = kinds.where("times > 1").select("anchor", "content")
    spans = met.where("!several").select("doc_id", "mark", "start", stop)
    spans = spans.unionByName(several.join(recur, ["anchor", "content"], "left_semi").select("doc_id", "mark", "start", stop))
    return spans.unionByName(_sorted_spans(bodies, length)).unionByName(_crowd_spans(bodies, length))


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, spans, kept_sha256, kept (the remaining bytes)."""
    spans = cut_lineage(repeated_spans(docs, length, id_col, text_col, crowd))
    listed = spans.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    text = packed(rows_of(docs, id_col, text_col))
    met = text.join(listed, same_row(text, listed), "left").select(text["doc_id"], "raw", "spans")
    id_type = text.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, gone, pieces, digests, left = [], [], [], [], []
            for raw, found in zip(batch.column("raw").to_pylist(), batch.column("spans").to_pylist()):
                raw = unpack(raw)
                both = np.array([(s["start"], s["stop"]) for s in found or ()], dtype=np.int64).reshape(-1, 2)
                starts, stops = merge_spans(both[:, 0], both[:, 1])
                kept = b"".join(raw[a:b] for a, b in zip([0, *stops.tolist()], [*starts.tolist(), len(raw)]))
                sizes.append(len(raw))
                gone.append(int((stops - starts).sum()))
                pieces.append([{"start": a, "stop": b} for a, b in zip(starts.tolist(), stops.tolist())])
                digests.append(hashlib.sha256(kept).hexdigest())
                left.append(kept)
            spans_type = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            columns = [
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(gone, pa.int64()),
                pa.array([len(p) for p in pieces], pa.int64()),
                pa.array(pieces, spans_type),
                pa.array(digests, pa.string()),
                pa.array(left, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256", "kept"])

    return met.mapInArrow(
        run,
        f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,stop:long>>, kept_sha256 string, kept binary",
    )
