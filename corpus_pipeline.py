"""A training corpus from raw documents: five stages, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundledger.llm import byte_bpe, exact_dedup, language, mixing, simhash
from fundledger.llm.common import cut_lineage, table
from fundledger.llm.queries import BPE_FILE, MIX_RATE, MIX_SEED, TARGETS

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop texts without a letter, and those between two languages; ``lang`` becomes the predicted one.

    A text goes only if no language reaches half of the probability; clean texts are far above that.
    """
    found = language.identify(docs, language.trained(docs), margin=0.0)
    sure = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= 0.5)
    return found.where(sure).withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest doc_id stays."""
    return exact_dedup.deduplicate(docs).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose SimHash fingerprints of three-word shingles link at two bits, the smallest doc_id stays."""
    return simhash.drop_near_copies(docs).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sample documents so that sources, languages and topics have their target shares of tokens."""
    return mixing.mix(docs, TARGETS, rate=MIX_RATE, seed=MIX_SEED).where("kept").select(*COLUMNS)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to its bytes again."""
    path = public_tokenizers.path(BPE_FILE)
    coded = byte_bpe.encode(docs, path, public_tokenizers.PATTERN)
    back = byte_bpe.decode(coded, path)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return back.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", same.alias("round_trip"))


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode_texts),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents").select(*COLUMNS)
    for _, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return docs


# A learned classifier and links over all pairs are not SQL; tests compare run() with a plain version.
ORACLE_SQL = None
