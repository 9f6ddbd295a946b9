"""Substring deduplication on words: seeds from winnowed anchors, extended while earlier documents agree.

A window is ``length`` consecutive words of one document. Each word covered by a window that also starts
in a document of smaller id is removed.

1. Winnowing: every window chooses the smallest hash of its GRAM-word grams (see ``anchors``), so any two
   equal windows choose the same gram at the same place. Neighbouring windows with one anchor form a
   seed, known by the hashes of its anchor and of all its words.
2. Anchors found in a single document are dropped after one grouped minimum and maximum.
3. Seeds join on what is left. Seeds with the same words match over their whole length, and only the
   smallest id of each kind is carried on. Kinds that share their anchor alone are extended from it, bucket
   by bucket: all kinds at once, word by word to the left and to the right, into classes that still agree.
   A match of l words before the anchor and r words after it counts where together they reach ``length``.
   An anchor with more than CROWD kinds is not gathered: its windows' words meet in a grouped minimum.
4. Overlapping and touching matches of a document are merged to maximal repeats, and cut out.

No pairs of documents are listed, so a passage in n documents costs n rows.

Defined results: a null text has no words. A null id neither gives nor loses words. Rows that repeat an
id are one document: they never take words from each other. Texts shorter than ``length`` stay whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundledger.llm.anchors import MIX, merge_spans, packed, parts, rows_of, runs, same_row, scramble, unpack, window_minima, windows_of
from fundledger.llm.common import arrow_rows, cut_lineage

LENGTH = 13
GRAM = 5
BLOCK = 1 << 17
CROWD = 2000
# Bytes of words that are extended together; one anchor has at most CROWD kinds.
GATHERED = 1 << 23

_ODD = int(MIX)
_BACK = pow(_ODD, -1, 1 << 64)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


class Rolling:
    """Hashes of any run of symbols, from sums of symbol times power (modulo 2^64)."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.down = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(n, np.uint64(_BACK)))))
        up = np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(max(n - 1, 0), np.uint64(_ODD)))))[:n]
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(symbols * up, dtype=np.uint64)))

    def of(self, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        return scramble((self.sums[stops] - self.sums[starts]) * self.down[starts] + (stops - starts).astype(np.uint64))


def seeds(texts: list[list[bytes]], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(text, start, windows, anchor, content) of every run of windows with one anchor."""
    for batch in parts([len(t) for t in texts], length, BLOCK):
        symbols = word_hashes([w for i, a, b in batch for w in texts[i][a:b]])
        rolling, count = Rolling(symbols), len(symbols) - GRAM + 1
        grams = rolling.of(np.arange(count), np.arange(count) + GRAM)
        starts, owner, begins = windows_of(batch, length)
        places = window_minima(grams, length - GRAM + 1)[starts]
        first, run = runs(places, starts, owner)
        at, own = starts[first], owner[first]
        content = rolling.of(at, at + run + length - 1)
        text = np.array([i for i, _, _ in batch])[own]
        start = np.array([a for _, a, _ in batch])[own] + at - begins[own]
        yield text, start, run, grams[places[first]].view(np.int64), content.view(np.int64)


def _seeds(rows: DataFrame, length: int) -> DataFrame:
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, marks = batch.column("doc_id"), batch.column("mark")
            for text, start, count, anchor, content in seeds([r.split() for r in batch.column("raw").to_pylist()], length):
                take = pa.array(text)
                # Start and number of windows share a field, which keeps the shuffled row short.
                place = pa.array(start << 8 | count)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(take), marks.take(take), place, pa.array(anchor), pa.array(content)], ["doc_id", "mark", "place", "anchor", "content"]
                )

    return rows.mapInArrow(run, f"doc_id {id_type}, mark long, place long, anchor long, content long")


def _start(place: str = "place"):
    return F.shiftright(place, 8)


def _windows(place: str = "place"):
    return F.col(place).bitwiseAND(F.lit(255).cast("long"))


def _short(word: bytes) -> bytes:
    """The word, or for a long one its digest; no word is written like a digest, as such a word is long itself."""
    return word if len(word) <= 64 else b"\0" + hashlib.sha256(word).hexdigest().encode()


def _seed_words(rows: DataFrame, kinds: DataFrame, length: int) -> DataFrame:
    """(doc_id, anchor, content, hot, at, words): the words of each open kind and the place of its anchor in them."""
    id_type = rows.schema["doc_id"].dataType.simpleString()
    wanted = kinds.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("anchor", "content", "hot", "place")).alias("open"))
    text = packed(rows)
    met = text.join(wanted, same_row(text, wanted)).select(text["doc_id"], "raw", "open")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, anchors, contents, hot, at, words = [], [], [], [], [], []
            for doc, raw, found in zip(*(batch.column(i).to_pylist() for i in range(3))):
                own = unpack(raw).split()
                rolling, last = Rolling(word_hashes(own)), len(own) - GRAM + 1
                grams = rolling.of(np.arange(last), np.arange(last) + GRAM).view(np.int64)
                for kind in found:
                    start, size = kind["place"] >> 8, (kind["place"] & 255) + length - 1
                    ids.append(doc), anchors.append(kind["anchor"]), contents.append(kind["content"]), hot.append(kind["hot"])
                    # Windows choose the leftmost of equal grams.
                    at.append(int((grams[start : start + size - GRAM + 1] == kind["anchor"]).argmax()))
                    words.append(b" ".join(map(_short, own[start : start + size])))
            columns = [
                pa.array(ids, batch.schema.field(0).type), pa.array(anchors, pa.int64()), pa.array(contents, pa.int64()),
                pa.array(hot, pa.bool_()), pa.array(at, pa.int32()), pa.array(words, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "anchor", "content", "hot", "at", "words"])

    return met.mapInArrow(run, f"doc_id {id_type}, anchor long, content long, hot boolean, at int, words binary")


_HIT = "anchor long, content long, first int, count int"


class Extension:
    """Classes of kinds that agree on ever more words to one side of their anchors."""

    def __init__(self, words: np.ndarray, begins: np.ndarray, stops: np.ndarray):
        self.words, self.begins, self.stops, self.spread = words, begins, stops, int(words.max(initial=0)) + 1

    def further(self, classes: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Classes that also agree on the word at ``places``; -1 for kinds that end before it."""
        alive = np.flatnonzero((classes >= 0) & (places >= self.begins) & (places < self.stops))
        out = np.full(len(classes), -1, dtype=np.int64)
        out[alive] = np.unique(classes[alive] * self.spread + self.words[places[alive]], return_inverse=True)[1]
        return out


def extend(docs: np.ndarray, anchors: np.ndarray, at: np.ndarray, words: list[list[bytes]], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(kind, first): the windows of each kind that a kind of the same anchor and a smaller document holds too."""
    number: dict[bytes, int] = {}
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    flat = np.fromiter((number.setdefault(w, len(number)) for own in words for w in own), dtype=np.int64, count=int(sizes.sum()))
    begins = np.cumsum(sizes) - sizes
    side, middle = Extension(flat, begins, begins + sizes), begins + at
    classes = np.unique(anchors, return_inverse=True)[1].astype(np.int64)
    for k in range(GRAM):
        classes = side.further(classes, middle + k)
    left, right = [classes], [classes]
    for k in range(length - GRAM):
        left.append(side.further(left[-1], middle - 1 - k))
        right.append(side.further(right[-1], middle + GRAM + k))
    kinds, firsts = [], []
    for before in range(length - GRAM + 1):
        one, two = left[before], right[length - GRAM - before]
        whole = np.flatnonzero((one >= 0) & (two >= 0))
        match = np.unique(one[whole] * len(words) + two[whole], return_inverse=True)[1]
        least = np.full(int(match.max(initial=-1)) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, match, docs[whole])
        hit = whole[docs[whole] > least[match]]
        kinds.append(hit), firsts.append(at[hit] - before)
    kind, first = np.concatenate(kinds), np.concatenate(firsts)
    order = np.lexsort((first, kind))
    return kind[order], first[order]


def _extended(open_kinds: DataFrame, length: int) -> DataFrame:
    """(anchor, content, first, count): runs of windows that a kind shares with one of a smaller document."""
    buckets = open_kinds.where("!hot").repartition("anchor").sortWithinPartitions("anchor")

    def settle(held: list[tuple]) -> pa.RecordBatch:
        anchors = np.array([h[1] for h in held], dtype=np.int64)
        contents = np.array([h[2] for h in held], dtype=np.int64)
        # Ids are compared, not counted with, so their ranks do.
        _, rank = np.unique(np.array([h[0] for h in held]), return_inverse=True)
        own, at = extend(rank, anchors, np.array([h[3] for h in held], dtype=np.int64), [h[4].split() for h in held], length)
        first, count = runs(own, at, own)
        rows = own[first]
        return pa.RecordBatch.from_arrays(
            [pa.array(anchors[rows]), pa.array(contents[rows]), pa.array(at[first].astype(np.int32)), pa.array(count.astype(np.int32))],
            ["anchor", "content", "first", "count"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "anchor", "content", "at", "words"))):
                if size >= GATHERED and held[-1][1] != row[1]:
                    yield settle(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield settle(held)

    return buckets.mapInArrow(run, _HIT)


def _crowded(open_kinds: DataFrame, length: int) -> DataFrame:
    """The same for anchors of very many kinds, one row per window."""
    id_type = open_kinds.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take, firsts, windows = [], [], []
            for i, raw in enumerate(batch.column("words").to_pylist()):
                own = raw.split()
                for first in range(len(own) - length + 1):
                    take.append(i), firsts.append(first), windows.append(b" ".join(own[first : first + length]))
            at = pa.array(take, pa.int32())
            columns = [batch.column(c).take(at) for c in ("doc_id", "anchor", "content")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(firsts, pa.int32()), pa.array(windows, pa.binary())], ["doc_id", "anchor", "content", "first", "words"])

    each = open_kinds.where("hot").mapInArrow(run, f"doc_id {id_type}, anchor long, content long, first int, words binary")
    least = each.groupBy("anchor", "words").agg(F.min("doc_id").alias("least"))
    met = each.join(least, ["anchor", "words"]).where("least < doc_id")
    return met.select("anchor", "content", "first", F.lit(1).cast("int").alias("count"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD) -> DataFrame:
    """(doc_id, mark, start, stop): word spans, overlapping, that cover exactly the words to remove."""
    if not GRAM < length < 256 - GRAM:
        raise ValueError(f"length is from {GRAM + 1} to {255 - GRAM} words")
    arrow_rows(docs.sparkSession)
    rows = rows_of(docs, id_col, text_col)
    rows = rows.where("doc_id is not null")
    cut = _seeds(rows, length)
    known = cut.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("anchor")
    met = cut_lineage(cut.join(cut_lineage(known), "anchor"))
    at = F.min(F.struct("doc_id", "mark", "place")).alias("at")
    kinds = cut_lineage(met.groupBy("anchor", "content").agg(at).select("anchor", "content", "at.*"))
    several = kinds.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor", (F.col("n") > crowd).alias("hot"))
    open_kinds = cut_lineage(_seed_words(rows, kinds.join(several, "anchor"), length))
    hits = cut_lineage(_extended(open_kinds, length).unionByName(_crowded(open_kinds, length)))
    first = kinds.select("anchor", "content", F.col("doc_id").alias("least"))
    # A kind's later documents lose all of its windows; its first document those that others had before.
    later = met.join(first, ["anchor", "content"]).where("doc_id > least")
    spans = later.select("doc_id", "mark", _start().alias("start"), (_start() + _windows() + (length - 1)).alias("stop"))
    touched = hits.select("anchor", "content").distinct().join(first, ["anchor", "content"])
    firsts = met.join(touched, ["anchor", "content"]).where("doc_id = least").join(hits, ["anchor", "content"])
    begin = _start() + F.col("first")
    return spans.unionByName(firsts.select("doc_id", "mark", begin.alias("start"), (begin + F.col("count") + (length - 1)).alias("stop")))


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, spans (words), kept_sha256, kept (words joined by a space)."""
    spans = cut_lineage(repeated_spans(docs, length, id_col, text_col, crowd))
    listed = spans.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    text = packed(rows_of(docs, id_col, text_col))
    met = text.join(listed, same_row(text, listed), "left").select(text["doc_id"], "raw", "spans")
    id_type = text.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, gone, pieces, digests, left = [], [], [], [], []
            for raw, found in zip(batch.column("raw").to_pylist(), batch.column("spans").to_pylist()):
                words = unpack(raw).split()
                both = np.array([(s["start"], s["stop"]) for s in found or ()], dtype=np.int64).reshape(-1, 2)
                starts, stops = merge_spans(both[:, 0], both[:, 1])
                kept = b" ".join(w for a, b in zip([0, *stops.tolist()], [*starts.tolist(), len(words)]) for w in words[a:b])
                sizes.append(len(words))
                gone.append(int((stops - starts).sum()))
                pieces.append([{"start": a, "stop": b} for a, b in zip(starts.tolist(), stops.tolist())])
                digests.append(hashlib.sha256(kept).hexdigest())
                left.append(kept)
            columns = [
                batch.column("doc_id"),
                pa.array(sizes, pa.int64()),
                pa.array(gone, pa.int64()),
                pa.array(pieces, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                pa.array(digests, pa.string()),
                pa.array(left, pa.binary()).cast(pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "spans", "kept_sha256", "kept"])

    return met.mapInArrow(
        run, f"doc_id {id_type}, n_words long, n_removed long, spans array<struct<start:long,stop:long>>, kept_sha256 string, kept string"
    )
