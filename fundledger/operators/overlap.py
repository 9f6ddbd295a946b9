"""How much two funds hold in common.

The funds to compare are chosen by the caller, two to four as pairs, or one against all others: then a
security gives no more rows than that choice. :func:`overlap_above` finds all pairs of funds whose common
weight reaches a threshold, without listing the pairs that share a security.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundledger.operators.ranking import top_per_group
from fundledger.operators.snapshots import latest_per_fund
from fundledger.session import cut_lineage


def latest_positions(holdings: DataFrame) -> DataFrame:
    """Positions of each fund at its own latest snapshot."""
    rows = holdings.select("as_of_date", "composite_ticker", "constituent_ticker", "weight")
    return rows.join(latest_per_fund(holdings), ["composite_ticker", "as_of_date"], "left_semi")


def _pairs(funds: list[str]):
    if not 2 <= len(set(funds)) <= 4:
        raise ValueError("compare two to four different funds")
    return list(combinations(sorted(set(funds)), 2))


def shared_weights(holdings: DataFrame, funds: list[str]) -> DataFrame:
    """One row per security held by any of the chosen funds.

    ``held0``, ``w0``, ``held1``, ... say for the chosen funds in sorted order whether each holds it, and
    with what weight; a held position may have a null weight. Tickers never become column names.
    """
    names = sorted(set(funds))
    cells = []
    for i, fund in enumerate(names):
        own = F.col("composite_ticker") == fund
        cells += [F.max(own).alias(f"held{i}"), F.max(F.when(own, F.col("weight"))).alias(f"w{i}")]
    return latest_positions(holdings.where(F.col("composite_ticker").isin(names))).groupBy("constituent_ticker").agg(*cells)


def shared_holdings(holdings: DataFrame, fund_a: str, fund_b: str) -> DataFrame:
    """Securities both funds hold, with the weight in either and the common weight."""
    if fund_a == fund_b:
        raise ValueError("compare two different funds")
    swap = fund_a > fund_b
    wide = shared_weights(holdings, [fund_a, fund_b]).where("held0 and held1")
    a, b = ("w1", "w0") if swap else ("w0", "w1")
    return wide.select(
        "constituent_ticker", F.col(a).alias("weight_a"), F.col(b).alias("weight_b"), F.when(F.col("w0").isNotNull() & F.col("w1").isNotNull(), F.least("w0", "w1")).alias("common_weight")
    )


def overlap(holdings: DataFrame, funds: list[str]) -> DataFrame:
    """For each pair of the chosen funds: shared securities, their weight in either fund, common weight."""
    pairs, names = _pairs(funds), sorted(set(funds))
    wide = shared_weights(holdings, funds)
    rows = F.array(
        *[
            F.struct(
                F.lit(a).alias("fund_a"),
                F.lit(b).alias("fund_b"),
                F.col(f"held{names.index(a)}").alias("_ha"),
                F.col(f"held{names.index(b)}").alias("_hb"),
                F.col(f"w{names.index(a)}").alias("_wa"),
                F.col(f"w{names.index(b)}").alias("_wb"),
            )
            for a, b in pairs
        ]
    )
    both = F.col("_ha") & F.col("_hb")
    known = both & F.col("_wa").isNotNull() & F.col("_wb").isNotNull()
    return (
        wide.select(F.inline(rows))
        .groupBy("fund_a", "fund_b")
        .agg(
            F.count_if(both).alias("overlap_count"),
            F.coalesce(F.sum(F.when(both, F.col("_wa"))), F.lit(0.0)).alias("overlap_weight_in_a"),
            F.coalesce(F.sum(F.when(both, F.col("_wb"))), F.lit(0.0)).alias("overlap_weight_in_b"),
            F.coalesce(F.sum(F.when(known, F.least("_wa", "_wb"))), F.lit(0.0)).alias("overlap_by_weight"),
            F.count_if(F.col("_ha") & ~F.col("_hb")).alias("only_in_a"),
            F.count_if(F.col("_hb") & ~F.col("_ha")).alias("only_in_b"),
        )
    )


def common_holdings(holdings: DataFrame, funds: list[str]) -> DataFrame:
    """Securities every one of the chosen funds holds, with their smallest weight."""
    names = sorted(set(funds))
    rows = latest_positions(holdings.where(F.col("composite_ticker").isin(names)))
    return (
        rows.groupBy("constituent_ticker")
        .agg(F.count_distinct("composite_ticker").alias("_held_by"), F.min("weight").alias("min_weight"))
        .where(F.col("_held_by") == len(names))
        .select("constituent_ticker", "min_weight")
    )


def only_in(holdings: DataFrame, fund: str, other: str) -> DataFrame:
    """Securities one fund holds and the other does not."""
    if fund == other:
        raise ValueError("compare two different funds")
    wide, i = shared_weights(holdings, [fund, other]), sorted([fund, other]).index(fund)
    return wide.where(F.col(f"held{i}") & ~F.col(f"held{1 - i}")).select("constituent_ticker", F.col(f"w{i}").alias("weight"))


def overlap_against(holdings: DataFrame, anchor: DataFrame) -> DataFrame:
    """Overlap of one fund (a one-cell table) with every other fund.

    The anchor has at most one row per security, so the join gives at most one row per position.
    """
    rows = latest_positions(holdings)
    chosen = anchor.scalar()
    base = rows.where(F.col("composite_ticker") == chosen).select(
        "constituent_ticker", F.col("weight").alias("_anchor")
    )
    return (
        rows.where(F.col("composite_ticker") != chosen)
        .join(base, "constituent_ticker")
        .groupBy("composite_ticker")
        .agg(
            F.count("*").alias("overlap_count"),
            F.sum("weight").alias("weight_in_fund"),
            F.sum("_anchor").alias("weight_in_anchor"),
            F.sum(F.when(F.col("weight").isNotNull() & F.col("_anchor").isNotNull(), F.least("weight", "_anchor"))).alias("overlap_by_weight"),
        )
    )


def stepped_positions(holdings: DataFrame, least: float) -> DataFrame:
    """fund, security, weight, step, last: positions with a weight, at each fund's latest snapshot.

    Securities are ordered from rare to common, in steps of a quarter of a doubling. A fund's weight from a step
    onwards falls along this order; its part is all steps up to ``last``, the last from which ``least`` is still
    left. If two funds have ``least`` in common, the rarest security that they share lies in the part of both. Weights
    are summed for each fund and step, of which a fund has few, so no fund's positions are sorted in one task. Funds
    that hold less than ``least`` drop out.
    """
    # Read five times from here on, and few of all positions.
    rows = cut_lineage(
        latest_positions(holdings).where("weight > 0").select(
            F.col("composite_ticker").alias("fund"), F.col("constituent_ticker").alias("security"), F.col("weight").cast("double").alias("weight")
        )
    )
    held = rows.groupBy("security").agg(F.floor(4 * F.log2(F.count(F.lit(1)))).cast("int").alias("step"))
    stepped = rows.join(held, "security")
    onwards = Window.partitionBy("fund").orderBy(F.desc("step"))
    sums = stepped.groupBy("fund", "step").agg(F.sum("weight").alias("w")).withColumn("left", F.sum("w").over(onwards))
    # A little below the threshold, as sums of doubles depend on their order.
    last = sums.where(F.col("left") >= least - 1e-6).groupBy("fund").agg(F.max("step").alias("last"))
    return cut_lineage(stepped.join(last, "fund").select("fund", "security", "weight", "step", "last"))


def rare_parts(holdings: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """(positions as :func:`stepped_positions` gives them, of them those that a pair must meet in)."""
    rows = stepped_positions(holdings, least)
    return rows, rows.where("step <= last")


def _sides(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    a, b = (rows.select(F.col("fund").alias(f"fund_{x}"), "security", F.col("weight").alias(f"w{x}"), F.col("last").alias(f"last_{x}")) for x in "ab")
    return a, b


def met_pairs(part: DataFrame) -> DataFrame:
    """fund_a, fund_b, last_a, last_b, n, w: funds whose parts meet, with the number and common weight of what they meet in."""
    a, b = _sides(part)
    common = a.join(b, "security").where("fund_a < fund_b").groupBy("fund_a", "fund_b")
    return common.agg(
        F.max("last_a").alias("last_a"), F.max("last_b").alias("last_b"), F.count(F.lit(1)).alias("n"), F.sum(F.least("wa", "wb")).alias("w")
    )


def candidate_pairs(part: DataFrame) -> DataFrame:
    """(fund_a, fund_b): funds whose parts meet, each pair once."""
    return met_pairs(part).select("fund_a", "fund_b")


def rest_of_pairs(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """fund, other, fund_a, fund_b, security, w1: what a pair may share beyond the parts it met in.

    That lies behind the part that ends first, where its fund has less than the threshold left: few positions.
    """
    first = F.col("last_a") <= F.col("last_b")
    near = pairs.select(
        "fund_a", "fund_b", F.when(first, F.col("fund_a")).otherwise(F.col("fund_b")).alias("fund"), F.when(first, F.col("fund_b")).otherwise(F.col("fund_a")).alias("other")
    )
    return near.join(rows.where("step > last").select("fund", "security", F.col("weight").alias("w1")), "fund")


def overlap_above(holdings: DataFrame, least: float) -> DataFrame:
    """fund_a, fund_b, overlap_count, overlap_by_weight of every pair with at least ``least`` common weight.

    ``least`` is positive, in percent like the weights. Positions without a weight count for nothing. A security that
    two funds share lies either in the parts of both, and is counted as they meet, or behind the part that ends first.
    """
    if least <= 0:
        raise ValueError("the threshold is positive")
    rows, part = rare_parts(holdings, least)
    met = met_pairs(part)
    every = rows.select(F.col("fund").alias("other"), "security", F.col("weight").alias("w2"))
    rest = rest_of_pairs(rows, met).join(every, ["other", "security"]).select("fund_a", "fund_b", F.lit(1).cast("long").alias("n"), F.least("w1", "w2").alias("w"))
    common = met.select("fund_a", "fund_b", "n", "w").unionByName(rest).groupBy("fund_a", "fund_b")
    return common.agg(F.sum("n").alias("overlap_count"), F.sum("w").alias("overlap_by_weight")).where(F.col("overlap_by_weight") >= least)


def largest_funds(funds: DataFrame, n: int) -> DataFrame:
    """Tickers of the ``n`` funds with the most assets at each fund's latest row."""
    latest = top_per_group(
        funds.select("composite_ticker", "as_of_date", "aum"),
        ["composite_ticker"],
        [F.desc("as_of_date"), F.desc_nulls_last("aum")],
        1,
    )
    return latest.orderBy(F.desc_nulls_last("aum"), "composite_ticker").limit(n).select("composite_ticker")
