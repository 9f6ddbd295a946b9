"""Language identification with error-correcting output codes.

Every language gets a codeword of bits. For each bit a binary classifier over hashed byte n-grams says
whether the text's language has a 1 there: its weight for an n-gram is the log odds of that n-gram in
training texts of the languages with a 1 against those with a 0. A text's margin for a bit is the mean
weight of all its n-grams. Decoding is loss-weighted: the distance of a text to a codeword is the sum
over bits of the classifier's weight (how often it is right in training) times the logistic loss of the
margin; the nearest codeword wins, and a second codeword close behind it marks the text as ambiguous.

Training reads at most ``per_language`` texts of each language (those with the smallest hash of the id,
among texts of at most LONGEST characters), as a bounded sample; every text is classified whole, in pieces of bounded size.

Defined results: a null text, or one without a letter, is ``und`` with score 0. If no labelled row can
be learned from, every text is ``und``. Rows with a null label or text are not learned from. Ids and
repeated rows pass through unchanged. Language, source and id never enter a prediction.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundledger.llm.common import arrow_rows

UNKNOWN = "und"
PER_LANGUAGE = 300
LONGEST = 50_000
HASH_BITS = 16
SIZES = (2, 3, 4)
# Margins are mean log odds; this turns them into the scale of the logistic loss.
SHARPNESS = 12.0
PIECE = 1 << 18
_LETTER = regex.compile(r"\p{L}").search


def has_letter(text: str | None) -> bool:
    return text is not None and _LETTER(text) is not None


def codes_between(x: np.ndarray, start: int, stop: int) -> np.ndarray:
    """Codes of the n-grams that start in [start, stop)."""
    codes = []
    for n in SIZES:
        count = min(stop, len(x) - n + 1) - start
        if count > 0:
            h = np.full(count, n, dtype=np.uint32)
            for k in range(n):
                h = h * np.uint32(0x01000193) + x[start + k : start + k + count]
            codes.append((h * np.uint32(0x9E3779B1)) >> np.uint32(32 - HASH_BITS))
    return np.concatenate(codes) if codes else np.empty(0, dtype=np.uint32)


def text_codes(text: str) -> Iterator[np.ndarray]:
    """All n-gram codes of a whole text, in pieces of bounded size."""
    x = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), dtype=np.uint8)
    for start in range(0, len(x), PIECE):
        yield codes_between(x, start, start + PIECE)


def codewords(count: int, seed: int = 7) -> np.ndarray:
    """(count, bits) of 0/1. Few languages get every distinct split; more get the best of seeded draws."""
    if count == 1:
        return np.ones((1, 1), dtype=np.int8)
    if count <= 5:
        splits = range(1, 1 << (count - 1))
        return np.array([[(s >> i) & 1 if i < count - 1 else 0 for s in splits] for i in range(count)], dtype=np.int8)
    bits, rng, best, spread = int(np.ceil(10 * np.log2(count))), np.random.default_rng(seed), None, -1
    for _ in range(200):
        drawn = rng.integers(0, 2, size=(count, bits), dtype=np.int8)
        drawn = drawn[:, (drawn.min(axis=0) == 0) & (drawn.max(axis=0) == 1)]
        apart = min(int((drawn[i] != drawn[i + 1 :]).sum(axis=1).min()) for i in range(count - 1))
        if apart > spread:
            best, spread = drawn, apart
    return best


@dataclass
class Model:
    languages: list[str]
    words: np.ndarray  # (languages, bits), +1 or -1
    weights: np.ndarray  # (n-gram codes, bits) of float32
    trust: np.ndarray  # of each bit's classifier

    def margins(self, text: str) -> np.ndarray:
        total, count = np.zeros(self.weights.shape[1]), 0
        for codes in text_codes(text):
            # Counting codes first is cheaper for long pieces; summing rows is for short ones.
            if len(codes) > 1 << 14:
                total += np.bincount(codes, minlength=len(self.weights)) @ self.weights
            else:
                total += self.weights[codes].sum(axis=0)
            count += len(codes)
        return total / max(count, 1)

    def decode(self, margins: np.ndarray) -> np.ndarray:
        """The probability of each language, from loss-weighted distances to its codeword."""
        loss = np.logaddexp(0, -SHARPNESS * self.words * margins)
        far = (loss * self.trust).sum(axis=1)
        near = np.exp(-(far - far.min()))
        return near / near.sum()


def fit(samples: list[tuple[str, str]]) -> Model | None:
    """A model from (text, language) pairs; None without any."""
    languages = sorted({lang for _, lang in samples})
    if not languages:
        return None
    words, place = codewords(len(languages)), {lang: i for i, lang in enumerate(languages)}
    counts = np.zeros((len(languages), 1 << HASH_BITS))
    for text, lang in samples:
        for codes in text_codes(text):
            counts[place[lang]] += np.bincount(codes, minlength=1 << HASH_BITS)
    # Each language counts alike, however much text it has.
    rates = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True)
    one = words.T.astype(float)
    inside = one @ rates / np.maximum(one.sum(axis=1, keepdims=True), 1)
    outside = (1 - one) @ rates / np.maximum((1 - one).sum(axis=1, keepdims=True), 1)
    weights = np.log(np.maximum(inside, 1e-12)) - np.log(np.maximum(outside, 1e-12)) if len(languages) > 1 else inside * 0 + 1
    model = Model(languages, words * 2 - 1, np.ascontiguousarray(weights.T, dtype=np.float32), np.ones(words.shape[1]))
    right = np.zeros(words.shape[1])
    for text, lang in samples:
        right += np.sign(model.margins(text)) == model.words[place[lang]]
    model.trust = np.clip(right / len(samples), 0.5, 1.0)
    return model


def training_sample(docs: DataFrame, usable: Column, per_language: int, id_col: str, text_col: str, lang_col: str) -> list[tuple[str, str]]:
    """At most ``per_language`` texts a language, chosen by the smallest hash of their id."""
    rows = docs.where(usable & F.col(f"`{lang_col}`").isNotNull() & (F.length(f"`{text_col}`") <= LONGEST))
    order = Window.partitionBy("lang").orderBy("mark", "doc_id")
    picked = (
        rows.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{lang_col}`").alias("lang"), F.xxhash64(f"`{id_col}`").alias("mark"))
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= per_language)
        .select("doc_id")
        .distinct()
    )
    # Bounded: per_language ids of each language.
    joined = rows.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").alias("lang"))
    taken = joined.join(F.broadcast(picked), "doc_id", "left_semi").select("text", "lang").collect()
    return sorted((r["text"], r["lang"]) for r in taken if has_letter(r["text"]))


def identify(
    docs: DataFrame,
    model: Model | None,
    text_col: str = "text",
    margin: float = 0.2,
    carry: tuple[str, ...] | None = None,
) -> DataFrame:
    """Add lang_pred, score (its probability, 0 to 1), lang_second, ambiguous.

    ``ambiguous`` marks texts whose best and second language are less than ``margin`` apart.
    ``carry`` names the columns kept, by default all; they are read beside the text and never used.
    """
    spark = docs.sparkSession
    arrow_rows(spark)
    made = ["lang_pred", "score", "lang_second", "ambiguous"]
    keep = [c for c in (docs.columns if carry is None else carry) if c not in made]
    shared = spark.sparkContext.broadcast(model)  # its size depends on the hash space and the languages alone

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            best, score, second, unsure = [], [], [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                if known is None or not has_letter(text):
                    best.append(UNKNOWN), score.append(0.0), second.append(None), unsure.append(False)
                    continue
                chance = known.decode(known.margins(text))
                order = np.argsort(-chance, kind="stable")
                best.append(known.languages[order[0]])
                score.append(float(min(1.0, chance[order[0]])))
                second.append(known.languages[order[1]] if len(order) > 1 else None)
                unsure.append(bool(len(order) > 1 and chance[order[0]] - chance[order[1]] < margin))
            columns = [pa.array(best, pa.string()), pa.array(score, pa.float64()), pa.array(second, pa.string()), pa.array(unsure, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*keep, *made])

    kept = docs.select(*[F.col(f"`{c}`") for c in keep])
    schema = T.StructType(
        [*kept.schema.fields, *(T.StructField(n, t) for n, t in zip(made, (T.StringType(), T.DoubleType(), T.StringType(), T.BooleanType())))]
    )
    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias("_lid_text")).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from training: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def trained(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = PER_LANGUAGE) -> Model | None:
    """A model learned from the labelled rows that are not held out."""
    return fit(training_sample(docs, ~held_out(id_col), per_language, id_col, text_col, lang_col))
