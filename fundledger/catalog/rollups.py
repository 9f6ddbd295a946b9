"""Queries answered from a table of sketches, next to the exact figures that bound their error."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundledger.catalog import views as v
from fundledger.catalog.registry import d, register
from fundledger.operators import rollups as ro
from fundledger.session import scratch_path

KEYS, SPAN = ["composite_ticker", "constituent_ticker"], 3
QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def sketched(spark: SparkSession, sf: str) -> DataFrame:
    """The sketch table of all snapshots, by asset class."""
    positions = v.holdings(spark, sf).select("as_of_date", "asset_class", *KEYS, "weight")
    return ro.refresh(positions, scratch_path(spark, "sketches"), ["asset_class"], KEYS, ["weight"])


def trailing_counts(sketches: DataFrame) -> DataFrame:
    """Positions, funds and securities of each snapshot and the two before it; reads the sketch table alone."""
    counts = [ro.distinct_count(c).alias(f"{c}_near") for c in KEYS]
    return ro.trailing(sketches, [], KEYS, [], SPAN).select("as_of_date", "rows", *counts)


def _trailing(spark: SparkSession, sf: str) -> DataFrame:
    near = trailing_counts(sketched(spark, sf))
    positions = v.holdings(spark, sf).select("as_of_date", *KEYS)
    spans = F.broadcast(ro.trailing_spans(positions, SPAN))
    exact = positions.join(spans, "as_of_date").groupBy(F.col("end").alias("as_of_date")).agg(*[F.count_distinct(c).alias(c) for c in KEYS])
    within = [(F.abs(F.col(f"{c}_near") - F.col(c)) <= 0.04 * F.col(c)).alias(f"{c}_within_4_percent") for c in KEYS]
    return near.join(exact, "as_of_date").select("as_of_date", "rows", *KEYS, *within)


register(
    "sketched_trailing_counts",
    _trailing,
    "holdings",
    f"""WITH dates AS (SELECT as_of_date, ROW_NUMBER() OVER (ORDER BY as_of_date) AS place FROM (SELECT DISTINCT as_of_date FROM holdings)),
    spans AS (SELECT a.as_of_date, z.as_of_date AS ending FROM dates a JOIN dates z ON a.place BETWEEN z.place - {SPAN - 1} AND z.place)
    SELECT {d('ending')} AS as_of_date, COUNT(*) AS "rows", COUNT(DISTINCT composite_ticker) AS composite_ticker, COUNT(DISTINCT constituent_ticker) AS constituent_ticker,
    TRUE AS composite_ticker_within_4_percent, TRUE AS constituent_ticker_within_4_percent FROM holdings JOIN spans USING (as_of_date) GROUP BY ending""",
)


def class_quartiles(sketches: DataFrame) -> DataFrame:
    """Quartiles of the weight of each asset class over all snapshots; reads the sketch table alone."""
    marks = [ro.quantile("weight", p).alias(name) for name, p in QUARTILES.items()]
    return ro.merge(sketches, ["asset_class"], [], ["weight"]).select("asset_class", "rows", *marks)


def _quartiles(spark: SparkSession, sf: str) -> DataFrame:
    """Each sketched quartile's true ranks: the share of weights below it, and of those up to it."""
    near = class_quartiles(sketched(spark, sf)).withColumnRenamed("asset_class", "class")
    weights = v.holdings(spark, sf).select("asset_class", "weight").where("weight IS NOT NULL")
    met = weights.join(near, weights["asset_class"].eqNullSafe(near["class"])).groupBy("asset_class", "rows")
    n = F.count(F.lit(1))
    within = [
        ((F.count_if(F.col("weight") < F.col(name)) <= (p + 0.02) * n) & (F.count_if(F.col("weight") <= F.col(name)) >= (p - 0.02) * n)).alias(f"{name}_within_2_percent")
        for name, p in QUARTILES.items()
    ]
    return met.agg(n.alias("weights"), *within)


register(
    "sketched_class_quartiles",
    _quartiles,
    "holdings",
    """SELECT asset_class, COUNT(*) AS "rows", COUNT(weight) AS weights, TRUE AS q25_within_2_percent, TRUE AS q50_within_2_percent,
    TRUE AS q75_within_2_percent FROM holdings GROUP BY asset_class""",
)
