"""Byte-level BPE: encoding and decoding with a public rank file.

Each task splits its texts into pre-tokens and encodes every new distinct one. New pre-tokens are
laid out by length in padded matrices of token ids, one each. In every round each of them merges its
leftmost pair of minimum rank; the ranks of the two new pairs come from a hashed table of pair keys.
Merged cells and finished pre-tokens are compacted away. A bounded cache keeps what the task has
already encoded.

A very long pre-token would need as many rounds as it has merges. There a round merges all leftmost
places of the minimum pair, unless one of those merges makes a pair that would have come first.

Defined results: a null text has no tokens; a null token list decodes to no bytes; special tokens are
never made; an unknown id or a null inside a token list raises an error on decoding. Ids and further
columns pass through unchanged, repeated rows repeat.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundledger.llm.common import arrow_rows

# Pre-tokens up to so many bytes are laid out in one matrix per length bucket.
BUCKETS = (2, 3, 4, 5, 6, 7, 8, 9, 10, 12, 14, 16, 20, 24, 32, 48, 64, 128, 256)
MATRIX_CELLS = 1 << 21
CACHE = 150_000


class Ranks:
    """A rank file: the bytes of each id, and the pair table. Ids are ranks."""

    def __init__(self, lines: Iterable[bytes]):
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.bytes = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        self.whole = ranks
        self.alone = [i.to_bytes(4, 'little') for i in range(len(self.tokens))]
        keys, made = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    made.append(rank)
        # Hashed lookup: an open table of a power of two, keys placed by a multiplicative hash.
        self.shift = np.uint64(64 - max(4, (4 * len(keys)).bit_length()))
        self.table_keys = np.full(1 << (64 - int(self.shift)), -1, dtype=np.int64)
        self.table_ranks = np.full(len(self.table_keys), NONE, dtype=np.int64)
        left_over, slots, at = np.array(keys, dtype=np.int64), np.array(made, dtype=np.int64), 0
        self.probes = 0
        while len(left_over):
            where = (self._slot(left_over) + at) % len(self.table_keys)
            free = self.table_keys[where] == -1
            _, first = np.unique(where, return_index=True)
            put = np.zeros(len(where), dtype=bool)
            put[first] = True
            put &= free
            self.table_keys[where[put]], self.table_ranks[where[put]] = left_over[put], slots[put]
            left_over, slots, at = left_over[~put], slots[~put], at + 1
        self.probes = at

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank each pair merges to, NONE where it doesn't. Negative ids never merge."""
        keys = (left.astype(np.int64) << 32) | right
        slot = self._slot(keys)
        found = self.table_keys[slot]
        out = np.where(found == keys, self.table_ranks[slot], NONE)
        todo = np.flatnonzero((found != keys) & (found != -1))
        for _ in range(self.probes):
            if not len(todo):
                break
            slot = (self._slot(keys[todo]) if _ == 0 else slot) + 1
            slot &= len(self.table_keys) - 1
            found = self.table_keys[slot]
            hit = found == keys[todo]
            out[todo[hit]] = self.table_ranks[slot[hit]]
            more = ~hit & (found != -1)
            todo, slot = todo[more], slot[more]
        out[(left < 0) | (right < 0)] = NONE
        return out


NONE = np.int64(1) << 40


def merge_matrix(ids: np.ndarray, ranks: Ranks) -> list[bytes]:
    """Merge every column of a padded matrix (one pre-token a column, -1 behind its end) to its final ids.

    The ids of a pre-token come as the bytes of their 32-bit integers.

    A cell of ``order`` holds the rank of the pair that starts there, and the cell's place below it, so
    one minimum down the matrix finds each pre-token's leftmost pair of minimum rank. Merged cells drop
    out of the links between neighbours; finished pre-tokens drop out of the matrix.
    """
    width, count = ids.shape
    out = [b""] * count
    owners = np.arange(count)
    ids = np.concatenate([ids, np.full((1, count), -1, dtype=ids.dtype)])
    place = np.arange(width, dtype=np.int64)
    order = np.stack([(ranks.pair_ranks(ids[c], ids[c + 1]) << 9) | c for c in range(width)])
    behind = np.repeat(place[:, None] + 1, count, axis=1)
    before = np.repeat(place[:, None] - 1, count, axis=1)
    never = NONE << 9
    while True:
        least = order.min(axis=0)
        going = least < never
        if going.sum() <= 0.75 * len(going) or not going.any():
            ready = ids[:, ~going].T.astype(np.int32)
            filled = ready >= 0
            flat, ends = ready[filled].tobytes(), (np.cumsum(filled.sum(axis=1)) * 4).tolist()
            for owner, start, end in zip(owners[~going].tolist(), [0, *ends], ends):
                out[owner] = flat[start:end]
            if not going.any():
                return out
            ids, order, behind, before = ids[:, going], order[:, going], behind[:, going], before[:, going]
            owners, least = owners[going], least[going]
            going = np.ones(len(least), dtype=bool)
        col = np.flatnonzero(going)
        at, rank = least[col] & 511, least[col] >> 9
        gone = behind[at, col]
        after = behind[gone, col]
        ids[at, col], ids[gone, col] = rank, -1
        behind[at, col] = after
        inside = after < width
        before[after[inside], col[inside]] = at[inside]
        order[gone, col] = never
        order[at, col] = (ranks.pair_ranks(ids[at, col], ids[after, col]) << 9) | at
        front = before[at, col]
        has = front >= 0
        front, col, at = front[has], col[has], at[has]
        order[front, col] = (ranks.pair_ranks(ids[front, col], ids[at, col]) << 9) | front


def merge_long(token: bytes, ranks: Ranks) -> bytes:
    """One very long pre-token: a round merges all leftmost places of the minimum pair, where that is safe.

    It is safe if no pair that appears on the way has that rank or a lower one; else one place merges.
    """
    ids = ranks.bytes[np.frombuffer(token, dtype=np.uint8)]
    while len(ids) > 1:
        pairs = ranks.pair_ranks(ids[:-1], ids[1:])
        least = pairs.min()
        if least == NONE:
            break
        at = np.flatnonzero(pairs == least)
        if len(at) > 1:
            # Overlapping places are runs of one repeated id: every other one merges, from the left.
            opens = np.concatenate(([True], np.diff(at) > 1))
            at = at[(at - at[opens][np.cumsum(opens) - 1]) % 2 == 0]
        merged = ids.copy()
        merged[at] = least
        merged = np.delete(merged, at + 1)
        if len(at) > 1:
            now = at - np.arange(len(at))
            next_old = np.append(ids, -1)[at + 2]
            new = np.concatenate([ranks.pair_ranks(np.full(len(at), least), next_old), ranks.pair_ranks(np.append(merged, -1)[now - 1], merged[now])])
            if new.min() <= least:
                merged = ids.copy()
                merged[at[0]] = least
                merged = np.delete(merged, at[0] + 1)
        ids = merged
    return ids.astype(np.int32).tobytes()


def encode_distinct(tokens: list[bytes], ranks: Ranks) -> list[bytes]:
    """The ids of each distinct pre-token, as the bytes of 32-bit integers."""
    out = [b""] * len(tokens)
    todo: dict[int, list[int]] = {}
    for i, token in enumerate(tokens):
        whole = ranks.whole.get(token)
        if whole is not None:
            out[i] = ranks.alone[whole]
        elif len(token) > BUCKETS[-1]:
            out[i] = merge_long(token, ranks)
        else:
            todo.setdefault(next(b for b in BUCKETS if len(token) <= b), []).append(i)
    for width, members in todo.items():
        step = max(1, MATRIX_CELLS // width)
        for start in range(0, len(members), step):
            part = members[start : start + step]
            raw = np.frombuffer(b"".join(tokens[i].ljust(width, b"\0") for i in part), dtype=np.uint8).reshape(-1, width)
            sizes = np.fromiter((len(tokens[i]) for i in part), dtype=np.int64, count=len(part))
            ids = np.where(np.arange(width)[:, None] < sizes, ranks.bytes[raw.T], -1)
            for i, made in zip(part, merge_matrix(ids, ranks)):
                out[i] = made
    return out


@lru_cache(maxsize=2)
def read_ranks(path: str) -> Ranks:
    with open(path, "rb") as lines:
        return Ranks(lines)


def narrowed(pattern: str) -> str:
    """The pattern with its Unicode classes spelled out for code points below 256.

    On texts without higher code points it finds the same matches, in a faster engine.
    """

    def spelled(name: str) -> str:
        runs: list[list[int]] = []
        for i in (i for i in range(256) if regex.match(name, chr(i))):
            if runs and runs[-1][1] == i - 1:
                runs[-1][1] = i
            else:
                runs.append([i, i])
        return "".join(rf"\x{a:02x}-\x{b:02x}" for a, b in runs)

    found = {name: spelled(name) for name in (r"\p{L}", r"\p{N}", r"\s")}
    out, at, inside = "", 0, False
    while at < len(pattern):
        name = next((c for c in found if pattern.startswith(c, at)), None)
        if name:
            out += found[name] if inside else f"[{found[name]}]"
            at += len(name)
        elif pattern.startswith(r"\S", at) and not inside:
            out += rf"[^{found[r'\s']}]"
            at += 2
        elif pattern[at] == "\\":
            out += pattern[at : at + 2]
            at += 2
        else:
            inside = (inside or pattern[at] == "[") and pattern[at] != "]"
            out += pattern[at]
            at += 1
    return out


class Splitter:
    """Finds a pattern's matches: the pre-tokens of a text."""

    def __init__(self, pattern: str):
        self.wide, self.narrow = regex.compile(pattern).findall, re.compile(narrowed(pattern)).findall

    def __call__(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.wide(text)
        return self.narrow(text)


class Encoder:
    """Encodes texts, remembering a bounded number of pre-tokens."""

    def __init__(self, ranks: Ranks, pattern: str):
        self.ranks, self.seen, self.find = ranks, {}, Splitter(pattern)

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """Several texts; their new pre-tokens are encoded together."""
        found = [self.find(t or "") for t in texts]
        new = {w for words in found for w in words if w not in self.seen}
        if len(self.seen) + len(new) > CACHE:
            self.seen = {}
            new = {w for words in found for w in words}
        if new:
            fresh = list(new)
            made = encode_distinct([w.encode("utf-8") for w in fresh], self.ranks)
            self.seen.update(zip(fresh, made))
        get = self.seen.__getitem__
        return [np.frombuffer(b"".join(map(get, words)), dtype=np.int32) for words in found]


@lru_cache(maxsize=2)
def read_encoder(path: str, pattern: str) -> Encoder:
    """Kept by a Python worker from task to task."""
    return Encoder(read_ranks(path), pattern)


def encode(
    docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "token_ids", carry: tuple[str, ...] | None = None
) -> DataFrame:
    """Add ``ids_col`` (array of int). ``carry`` names the columns kept beside it, by default all."""
    arrow_rows(docs.sparkSession)
    keep = [c for c in (docs.columns if carry is None else carry) if c != ids_col]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(ids_col, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = read_encoder(path, pattern)
        for batch in batches:
            lists = coder.encode_batch(batch.column(batch.num_columns - 1).to_pylist())
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32)
            values = np.concatenate(lists) if lists else np.empty(0, dtype=np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], [*keep, ids_col])

    # The text goes in once more as the last column, as its own name may be among those kept or not.
    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias("_bpe_text")).mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids_col: str = "token_ids", bytes_col: str = "decoded") -> DataFrame:
    """Add ``bytes_col`` (binary): the bytes that the ids stand for."""
    keep = [c for c in df.columns if c != bytes_col]
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField(bytes_col, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(path)
        for batch in batches:
            column = batch.column(keep.index(ids_col))
            flat, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            if column.values.null_count or (len(flat) and not (0 <= flat.min() and flat.max() < len(ranks.tokens))):
                raise ValueError("a token list holds an id that the vocabulary doesn't have")
            get, gone = ranks.tokens.__getitem__, column.is_null().to_pylist()
            made = [b"" if no else b"".join(map(get, flat[a:b].tolist())) for a, b, no in zip(offsets[:-1], offsets[1:], gone)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, type=pa.binary())], [*keep, bytes_col])

    return df.select(*[F.col(f"`{c}`") for c in keep]).mapInArrow(run, schema)
