"""Token counts under a unigram model, with forward scores shared along a trie.

A pre-token's best segmentation is the one whose pieces have the largest sum of scores; of equal sums
the one with fewer pieces. The forward score of a position depends on the bytes before it alone, so
pre-tokens with a common prefix share it. Each task puts its new distinct pre-tokens in a trie, walked in
sorted order: the path to the current node holds the forward scores, a node is computed once for all
pre-tokens below it, and the piece count at a terminal node is that pre-token's token count. A bounded
table keeps the counts of pre-tokens from text to text, and whole texts are counted.

The public vocabularies come without unigram scores; ``zipf_scores`` gives a piece of rank r the log of a
Zipf frequency, -log(r + 2). Every single byte must be a piece, so each text can be segmented.

Defined results: a null or empty text has no pre-tokens and no tokens. Ids, further columns and repeated
rows pass through unchanged.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundledger.llm.byte_bpe import Splitter
from fundledger.llm.common import arrow_rows

KEPT = 150_000


@lru_cache(maxsize=2)
def zipf_scores(path: str) -> dict[bytes, float]:
    """Scores of the pieces of a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): -math.log(int(b) + 2) for a, b in (line.split() for line in lines if line.strip())}


def _shared(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # the common prefix by bisection, for long pre-tokens
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle)
    return low


def trie_counts(tokens: list[bytes], scores: dict[bytes, float], longest: int) -> list[int]:
    """The piece count of each pre-token's best segmentation, by a walk over the trie of all of them."""
    order = sorted(range(len(tokens)), key=tokens.__getitem__)
    out, best, count, path = [0] * len(tokens), [0.0], [0], b""
    score_of = scores.get
    for i in order:
        token = tokens[i]
        depth = _shared(path, token)
        del best[depth + 1 :], count[depth + 1 :]
        for end in range(depth + 1, len(token) + 1):
            top, fewest = -math.inf, 0
            for start in range(max(0, end - longest), end):
                score = score_of(token[start:end])
                if score is not None:
                    total = best[start] + score
                    if total > top or (total == top and count[start] + 1 < fewest):
                        top, fewest = total, count[start] + 1
            best.append(top)
            count.append(fewest)
        path, out[i] = token, count[len(token)]
    return out


class Counter:
    """Counts texts, remembering a bounded number of pre-tokens."""

    def __init__(self, path: str, pattern: str):
        self.scores, self.split, self.seen = zipf_scores(path), Splitter(pattern), {}
        self.longest = max(map(len, self.scores))
        if any(bytes([i]) not in self.scores for i in range(256)):
            raise ValueError("the vocabulary lacks a single byte")

    def count(self, texts: list[str | None]) -> list[tuple[int, int]]:
        """(pre-tokens, tokens) of each text."""
        found = [self.split(t or "") for t in texts]
        new = {w for words in found for w in words if w not in self.seen}
        if len(self.seen) + len(new) > KEPT:
            self.seen = {}
            new = {w for words in found for w in words}
        fresh = list(new)
        self.seen.update(zip(fresh, trie_counts([w.encode("utf-8") for w in fresh], self.scores, self.longest)))
        return [(len(words), sum(map(self.seen.__getitem__, words))) for words in found]


@lru_cache(maxsize=2)
def _counter(path: str, pattern: str) -> Counter:
    return Counter(path, pattern)


def count_tokens(docs: DataFrame, path: str, pattern: str, text_col: str = "text", carry: tuple[str, ...] | None = None) -> DataFrame:
    """Add n_pretokens and n_tokens. ``carry`` names the columns kept, by default all."""
    arrow_rows(docs.sparkSession)
    made = ["n_pretokens", "n_tokens"]
    keep = [c for c in (docs.columns if carry is None else carry) if c not in made]
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(n, T.LongType()) for n in made])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, pattern)
        for batch in batches:
            counts = counter.count(batch.column(batch.num_columns - 1).to_pylist())
            columns = [pa.array([c[i] for c in counts], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*keep, *made])

    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias("_count_text")).mapInArrow(run, schema)
