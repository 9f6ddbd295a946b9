"""Alignment of two tokenizers: which tokens of one lie over which of the other, and how common each pair is.

Both tokenizers cut the same bytes. Texts are laid end to end in blocks of bounded size, and
``pandas.merge_asof``, keyed by document, gives each token start the other side's covering token: once
from A to B and once from B to A. The union of both directions is every pair of tokens whose byte ranges
overlap. Where tokens of both sides end at the same byte, a group ends.

How many documents hold a pair is counted in two steps. A block lists its distinct pairs once, with the
number of its documents that hold each; its documents point into that list. Only the lists are summed
over the corpus and joined with the sums, so a pair that stands in a third of all documents is one row a
block, and the counts come back to a block as one bounded table.

A is a byte-level vocabulary in a tokenizers file, B a sentencepiece model that puts a space before the
text. Texts with Latin letters alone are encoded from A's vocabulary as ranks, which gives the same ids
faster; all others by the file's own library.

Defined results: null and empty texts, and texts where one side's bytes differ from a space and the text,
have no tokens: all numbers are 0 and ``groups_sha256`` is empty. A text of any length is one unit; a
block holds at least one. Null and repeated ids are rows of their own. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundledger.llm.common import arrow_rows, cut_lineage, only

# Bytes of text that are aligned together.
BLOCK_BYTES = 3 << 20
# Latin letters with their marks, and common punctuation.
_OTHER = re.compile("[^\x00-ɏ‐-‧€]")


def byte_letters() -> dict[str, int]:
    """The letter that a byte-level vocabulary writes for each byte: itself if it is visible, else one from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {**{chr(b): b for b in shown}, **{chr(256 + k): b for k, b in enumerate(hidden)}}


class ByteSide:
    """Token ids by a byte-level file; ``table`` holds each id's bytes."""

    def __init__(self, path: str, pattern: str):
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.own = Tokenizer.from_file(path)
        self.own.encode_special_tokens = True
        letters = byte_letters()
        with open(path, encoding="utf-8") as file:
            known = json.load(file)
        special = {t["content"] for t in known.get("added_tokens", ())}
        vocabulary = known["model"]["vocab"]
        self.table = [b""] * (max([*vocabulary.values(), *(t["id"] for t in known.get("added_tokens", ()))]) + 1)
        for piece, i in vocabulary.items():
            self.table[i] = piece.encode() if piece in special else bytes(letters[c] for c in piece)
        ranks = {self.table[i]: i for piece, i in vocabulary.items() if piece not in special}
        self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if _OTHER.search(text):
            return self.own.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class PieceSide:
    """Token ids by a sentencepiece model, which writes a space as U+2581 and single bytes as <0xHH>."""

    def __init__(self, path: str):
        import sentencepiece

        self.own = sentencepiece.SentencePieceProcessor(model_file=path)
        self.table = [self._bytes(i) for i in range(self.own.get_piece_size())]

    def _bytes(self, i: int) -> bytes:
        piece = self.own.id_to_piece(i)
        if self.own.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode("utf-8")

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.own.encode(texts, num_threads=1) if texts else []


class Aligner:
    def __init__(self, byte_path: str, pattern: str, piece_path: str):
        self.a, self.b = ByteSide(byte_path, pattern), PieceSide(piece_path)
        self.size_a = np.array([len(x) for x in self.a.table], dtype=np.int64)
        self.size_b = np.array([len(x) for x in self.b.table], dtype=np.int64)
        # What stands behind an id: the next token of its side, or the end of its side in the group.
        self.words = np.array(
            [f"{i}," for i in range(len(self.size_a))]
            + [f"{i}|" for i in range(len(self.size_a))]
            + [f"{i}," for i in range(len(self.size_b))]
            + [f"{i};" for i in range(len(self.size_b))],
            dtype=object,
        )

    def tokens(self, texts: list[str | None]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides; none where a side's bytes are not those of a space and the text."""
        have = [t for t in texts if t]
        b_ids = iter(self.b.encode(have))
        left, right = [], []
        for t in texts:
            a, b = (self.a.encode(" " + t), next(b_ids)) if t else ([], [])
            if t:
                raw = b" " + t.encode("utf-8")
                if b"".join(map(self.a.table.__getitem__, a)) != raw or b"".join(map(self.b.table.__getitem__, b)) != raw:
                    a, b = [], []
            left.append(a)
            right.append(b)
        return left, right

    def align(self, texts: list[str | None]) -> dict[str, np.ndarray | list]:
        """The numbers of each text, its distinct pairs as places in the block's list, and that list."""
        lists_a, lists_b = self.tokens(texts)
        rows = len(texts)
        n_a, n_b = (np.fromiter(map(len, x), dtype=np.int64, count=rows) for x in (lists_a, lists_b))
        a, b = (np.fromiter(chain.from_iterable(x), dtype=np.int64, count=int(n.sum())) for x, n in ((lists_a, n_a), (lists_b, n_b)))
        doc_a, doc_b = np.repeat(np.arange(rows), n_a), np.repeat(np.arange(rows), n_b)
        # Both sides cut the same bytes of the same texts, so ends laid end to end agree.
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        side_a = pd.DataFrame({"doc": doc_a, "start": end_a - self.size_a[a], "i": np.arange(len(a))})
        side_b = pd.DataFrame({"doc": doc_b, "start": end_b - self.size_b[b], "j": np.arange(len(b))})
        forth = pd.merge_asof(side_a, side_b, on="start", by="doc")
        back = pd.merge_asof(side_b, side_a, on="start", by="doc")
        i, j = back["i"].to_numpy(), back["j"].to_numpy()
        # Pairs that start together are in both directions; they count once.
        new = side_a["start"].to_numpy()[i] != side_b["start"].to_numpy()[j] if len(b) else np.empty(0, dtype=bool)
        i, j = np.concatenate([forth["i"].to_numpy(), i[new]]), np.concatenate([forth["j"].to_numpy(), j[new]])
        pairs, at = np.unique(a[i] << 32 | b[j], return_inverse=True)
        held, times = np.unique(doc_a[i] * max(1, len(pairs)) + at, return_counts=True)
        owner, place = np.divmod(held, max(1, len(pairs)))
        digests, n_groups = self._groups(rows, a, b, doc_a, doc_b, end_a, end_b)
        return {
            "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "groups_sha256": digests, "n_links": np.bincount(doc_a[i], minlength=rows),
            "ends": np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=rows)))), "place": place, "times": times,
            "a": pairs >> 32, "b": pairs & 0xFFFFFFFF, "docs": np.bincount(place, minlength=len(pairs)),
        }

    def _groups(self, rows: int, a, b, doc_a, doc_b, end_a, end_b) -> tuple[list[str], np.ndarray]:
        # Ends ascend on both sides; a group ends where they meet.
        meet = np.searchsorted(end_b, end_a)
        stop_a = end_b[np.minimum(meet, len(end_b) - 1)] == end_a if len(end_b) else np.zeros(0, dtype=bool)
        stop_b = np.zeros(len(b), dtype=bool)
        stop_b[meet[stop_a]] = True
        group_a, group_b = np.cumsum(stop_a) - stop_a, np.cumsum(stop_b) - stop_b
        of_a, of_b = np.bincount(group_a), np.bincount(group_b)
        # In the text of a group its A tokens stand first, then its B tokens.
        words = np.empty(len(a) + len(b), dtype=np.int64)
        size = len(self.size_a)
        words[np.arange(len(a)) + (np.cumsum(of_b) - of_b)[group_a]] = a + np.where(stop_a, size, 0)
        words[np.arange(len(b)) + np.cumsum(of_a)[group_b]] = b + 2 * size + np.where(stop_b, len(self.size_b), 0)
        text = self.words[words].tolist()
        ends = np.cumsum(np.bincount(doc_a, minlength=rows) + np.bincount(doc_b, minlength=rows)).tolist()
        digests = [hashlib.sha256("".join(text[x:y])[:-1].encode()).hexdigest() if y > x else "" for x, y in zip([0, *ends], ends)]
        return digests, np.bincount(doc_a[stop_a], minlength=rows)


@lru_cache(maxsize=1)
def _aligner(byte_path: str, pattern: str, piece_path: str) -> Aligner:
    """Kept by a Python worker from task to task."""
    return Aligner(byte_path, pattern, piece_path)


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.Array, list[str | None]]]:
    """Ids and texts, about ``most`` bytes at a time."""
    ids, texts, size, kind = [], [], 0, None
    for batch in batches:
        kind = batch.column("doc_id").type
        for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            ids.append(i)
            texts.append(t)
            size += len(t or "") + 64
            if size >= most:
                yield pa.array(ids, kind), texts
                ids, texts, size = [], [], 0
    if ids:
        yield pa.array(ids, kind), texts


def _lists(ends: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.astype(np.int32)))


def blocks_of(docs: DataFrame, byte_path: str, pattern: str, piece_path: str, id_col: str, text_col: str, block_bytes: int) -> DataFrame:
    """Rows of documents (``doc``: true) and, one a block, of its distinct pairs."""
    rows = only(docs, id_col, text_col)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    names = ["block", "doc", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "place", "times", "a", "b", "docs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, task = _aligner(byte_path, pattern, piece_path), TaskContext.get().partitionId()
        for k, (ids, texts) in enumerate(_blocks(batches, block_bytes)):
            x, n = known.align(texts), len(texts)
            block, none = task << 32 | k, np.empty(0)
            numbers = [pa.array(x[c].astype(np.int64)) for c in ("n_a", "n_b", "n_groups", "n_links")]
            empty = _lists(np.zeros(n + 1), none)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, block)), pa.array([True] * n), ids, *numbers, pa.array(x["groups_sha256"], pa.string()),
                 _lists(x["ends"], x["place"]), _lists(x["ends"], x["times"]), empty, empty, empty], names)
            whole, zero = np.array([0, len(x["a"])]), pa.array([0], pa.int64())
            empty = _lists(np.zeros(2), none)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.array([False]), pa.nulls(1, ids.type), zero, zero, zero, zero, pa.array([""]), empty, empty,
                 *(_lists(whole, x[c]) for c in ("a", "b", "docs"))], names)

    arrays = ", ".join(f"{c} array<int>" for c in names[8:])
    schema = f"block long, doc boolean, doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, {arrays}"
    return rows.mapInArrow(run, schema)


def _summed(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """The counts of a block's pairs, added up for each of its documents."""
    place = pairs.column("place").to_numpy()
    count, best = np.zeros(len(place), dtype=np.int64), np.zeros(len(place), dtype=np.int64)
    count[place], best[place] = pairs.column("n").to_numpy(), pairs.column("best").to_numpy()
    lists, times = docs.column("place").combine_chunks(), docs.column("times").combine_chunks()
    at, often = lists.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
    ends = np.concatenate(([0], np.cumsum(np.diff(lists.offsets.to_numpy()))))
    total = lambda values: pa.array(np.diff(np.concatenate(([0], np.cumsum(values[at] * often)))[ends]))
    out = {c: docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    return pa.table({**out, "n_best": total(best), "count_sum": total(count), "groups_sha256": docs.column("groups_sha256")})


def pair_counts(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the pairs of each block with their place in its list; of each pair of ids the documents that hold it, and whether no
    other pair of its A id is in more). An A id has at most as many pairs as B's vocabulary has pieces."""
    listed = blocks.where("not doc").select("block", F.posexplode(F.arrays_zip("a", "b", "docs")).alias("place", "pair"))
    listed = listed.select("block", "place", "pair.a", "pair.b", "pair.docs")
    counts = listed.groupBy("a", "b").agg(F.sum("docs").alias("n"))
    most = F.max("n").over(Window.partitionBy("a"))
    return listed, cut_lineage(counts.withColumn("best", (F.col("n") == most).cast("long")))


def align(
    docs: DataFrame, byte_path: str, pattern: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    arrow_rows(docs.sparkSession)
    blocks = cut_lineage(blocks_of(docs, byte_path, pattern, piece_path, id_col, text_col, block_bytes))
    listed, counts = pair_counts(blocks)
    priced = listed.join(counts, ["a", "b"]).select(F.col("block").alias("its_block"), "place", "n", "best")
    texts = blocks.where("doc").select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "place", "times")
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return texts.groupBy("block").cogroup(priced.groupBy("its_block")).applyInArrow(_summed, schema)
