"""Mixing sources to target weights by iterative proportional fitting.

Token counts of documents are summed into cells of source, language and topic. Raking scales the cells
in turn until their sums over each dimension have the target shares. A document of a cell is then kept
with a probability proportional to fitted over present share, calibrated so that the wanted part of all
tokens is expected to stay; a cell that would need more than all its documents keeps all. The draw is a
hash of the id, so it repeats on any cluster.

The cells are bounded by the targets: a value that a dimension's targets do not name counts as
``OTHER``, so their number is at most the product of the targets' sizes, whatever the table's size.
Where the targets give ``OTHER`` no share, it keeps its present share of tokens, and the named targets share
the rest.

Defined results: a null source, language or topic counts as ``OTHER``; a null or empty text has no
tokens and is kept with its cell's probability; a cell without any tokens has weight 1, and the
wanted part of all tokens as its probability. A target for a value without tokens is
spread over the others of its dimension. Repeated rows share one draw. An empty table gives none.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OTHER = "other"


def token_count(text: Column) -> Column:
    """Words: runs of characters that are not ASCII white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def topic_of(text: Column) -> Column:
    """A coarse topic from the text's form: table, list, shouting, or prose.

    Separator bars, line breaks and exclamation marks are counted against the text's length.
    """
    text = F.coalesce(text, F.lit(""))
    share = lambda mark: F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))
    per = F.greatest(F.length(text), F.lit(1))
    return (
        F.when(share("|") * 40 > per, "table")
        .when(share("!") * 40 > per, "shouting")
        .when(share("\n") * 60 > per, "list")
        .otherwise("prose")
    )


def named(value: Column, targets: dict[str, float]) -> Column:
    """The value, or OTHER where the targets do not name it."""
    return F.when(value.isin(*targets), value).otherwise(F.lit(OTHER))


def rake(cells: dict[tuple[str, ...], float], targets: list[dict[str, float]], rounds: int = 200, close: float = 1e-9) -> dict[tuple[str, ...], float]:
    """Fitted shares of the cells: their sums over each dimension have the target shares."""
    kinds = [sorted({key[d] for key in cells}) for d in range(len(targets))]
    grid = np.zeros([len(k) for k in kinds])
    for key in itertools.product(*kinds):
        grid[tuple(k.index(x) for k, x in zip(kinds, key))] = max(cells.get(key, 0.0), 0.0)
    if grid.sum() <= 0:
        return dict.fromkeys(cells, 0.0)
    grid /= grid.sum()
    wanted = []
    for d, names in enumerate(kinds):
        sums = grid.sum(axis=tuple(a for a in range(grid.ndim) if a != d))
        share = np.array([targets[d].get(n, 0.0) for n in names]) * (sums > 0)
        free = np.array([n == OTHER and n not in targets[d] for n in names])
        scaled = share * (1 - sums[free].sum()) / share.sum() if share.sum() > 0 else sums
        wanted.append(np.where(free, sums, scaled))
    for _ in range(rounds):
        off = 0.0
        for d, share in enumerate(wanted):
            sums = grid.sum(axis=tuple(a for a in range(grid.ndim) if a != d))
            off = max(off, float(np.abs(sums - share).max()))
            factor = np.divide(share, sums, out=np.zeros_like(share), where=sums > 0)
            grid *= factor.reshape([-1 if a == d else 1 for a in range(grid.ndim)])
        if off < close:
            break
    return {key: float(grid[tuple(k.index(x) for k, x in zip(kinds, key))]) for key in cells}


def calibrated(present: dict[tuple[str, ...], float], ratio: dict[tuple[str, ...], float], rate: float) -> dict[tuple[str, ...], float]:
    """Probabilities min(1, c * ratio), with c such that ``rate`` of all tokens is expected to stay."""
    rest, weighed = rate * sum(present.values()), sum(present[k] * ratio[k] for k in present)
    scale = 0.0
    for key in sorted(present, key=lambda k: -ratio[k]):
        scale = rest / weighed if weighed > 1e-12 else float("inf")
        if ratio[key] * scale <= 1:
            break
        rest, weighed = rest - present[key], weighed - present[key] * ratio[key]
    return {k: min(1.0, r * scale) if r > 0 else 0.0 for k, r in ratio.items()}


def draw(id_col: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the id alone: 48 bits of a salted hash."""
    text = F.concat_ws(":", F.lit(str(seed)), F.coalesce(id_col.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def mix(
    docs: DataFrame,
    targets: dict[str, dict[str, float]],
    id_col: str = "doc_id",
    text_col: str = "text",
    topic: Column | None = None,
    rate: float = 0.7,
    seed: int = 20,
) -> DataFrame:
    """``docs`` with n_tokens, topic, weight, probability and kept.

    ``targets`` maps a column of ``docs``, or "topic", to target shares by value. ``weight`` is the
    cell's fitted share over its present share; ``probability`` is proportional to it, at most 1, and
    keeps ``rate`` of all tokens; ``kept`` is whether the id's draw lies below it.
    """
    dims = list(targets)
    work = docs.withColumns(
        {"n_tokens": token_count(F.col(f"`{text_col}`")), "topic": topic_of(F.col(f"`{text_col}`")) if topic is None else topic}
    )
    marked = work.withColumns({f"_cell{i}": named(F.col(f"`{d}`"), targets[d]) for i, d in enumerate(dims)})
    keys = [f"_cell{i}" for i in range(len(dims))]
    # Bounded: one row for each combination of named values.
    rows = marked.groupBy(*keys).agg(F.sum("n_tokens").alias("n")).collect()
    present = {tuple(r[k] for k in keys): float(r["n"]) for r in rows}
    fitted, total = rake(present, [targets[d] for d in dims]), sum(present.values())
    ratio = {key: (fitted[key] / (n / total) if n else 1.0) for key, n in present.items()}
    full = {key: n for key, n in present.items() if n}
    chance = {**dict.fromkeys(present, rate), **calibrated(full, {key: ratio[key] for key in full}, rate)}
    spark = docs.sparkSession
    schema = ", ".join(f"{k} string" for k in keys) + ", weight double, probability double"
    weights = [(*key, w, chance[key]) for key, w in sorted(ratio.items())]
    joined = marked.join(F.broadcast(spark.createDataFrame(weights, schema)), keys, "left").drop(*keys)
    return joined.withColumn("kept", draw(F.col(f"`{id_col}`"), seed) < F.col("probability"))
