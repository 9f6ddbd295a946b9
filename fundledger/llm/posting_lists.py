"""Approximate nearest neighbours with balanced posting lists.

* Centroids come from a bounded sample: it is halved again and again at the median of its main
  direction, so the lists of the leaves are balanced, and each leaf's mean is a centroid.
* Centroids are searched through a neighbour graph held in memory, best candidate first.
* Every vector is put into the list of its nearest centroid, and near a boundary into further lists too:
  those of the ``REPLICAS`` nearest that are at most ``SPREAD`` times as far.
* A query reads the lists whose centroids are at most ``REACH`` times as far as its nearest one, and,
  if those lists hold fewer than ``LEAST`` vectors, the next lists until they do.
* Lists are cut into blocks of bounded size, and so are the queries of a list; each pair of blocks is
  compared exactly, in double precision on the original vectors, and the best of all blocks are merged.

Only the sample and the number of centroids are bounded (``SAMPLE``, ``MOST_LISTS``); every vector is
indexed, and no list is capped. Recall against all pairs is measured in the tests.

Defined results: vectors that are null, zero, of another dimension than most, or with null or non-finite
components take no part. Of rows repeating an id one counts, with the smallest vector; a query never
finds its own id. Ties go to the smaller id. Fewer candidates than wanted are all returned. Empty tables
give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fundledger.llm.common import arrow_rows, cut_lineage

SAMPLE = 16_384
LIST_SIZE = 512
MOST_LISTS = 2048
DEGREE = 24
ENTRIES = 64
# Centroids that a search opens at once.
OPENED = 4
SPREAD = 1.03
REPLICAS = 4
REACH = 1.16
PROBES = 64
# Lists are read beyond that reach until they hold so many vectors.
LEAST = 4096
BLOCK = 4096


@dataclass
class Centroids:
    points: np.ndarray  # (lists, dimensions)
    graph: np.ndarray  # (lists, degree): neighbours of each
    entries: np.ndarray  # where searches begin

    def nearest(self, x: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each row, up to ``wanted`` centroids found through the graph, nearest first, and their distances."""
        found, far, _ = self.walk(x, wanted)
        return found, far

    def walk(self, x: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray, int]:
        """The same, and how many pairs of row and centroid were compared.

        Each row holds the ``wanted`` nearest centroids it has met. It opens the best ones not yet opened, that is
        it compares those of their neighbours that it hasn't met, until all it holds are open.
        """
        rows, lists = len(x), len(self.points)
        wanted = min(wanted, lists)
        held, far = np.full((rows, wanted), -1, dtype=np.int64), np.full((rows, wanted), np.inf)
        opened, met, compared = np.zeros((rows, wanted), dtype=bool), np.zeros((rows, lists), dtype=bool), 0
        row, new = np.repeat(np.arange(rows), len(self.entries)), np.tile(self.entries, rows)
        while True:
            if len(row):
                met[row, new] = True
                compared += len(row)
                counts = np.bincount(row, minlength=rows)
                place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                ids, apart = np.full((rows, counts.max()), -1, dtype=np.int64), np.full((rows, counts.max()), np.inf)
                ids[row, place], apart[row, place] = new, np.linalg.norm(x[row] - self.points[new], axis=1)
                both = np.concatenate((far, apart), axis=1)
                best = np.argpartition(both, wanted - 1, axis=1)[:, :wanted]
                far = np.take_along_axis(both, best, axis=1)
                held = np.take_along_axis(np.concatenate((held, ids), axis=1), best, axis=1)
                opened = np.take_along_axis(np.concatenate((opened, np.zeros_like(ids, dtype=bool)), axis=1), best, axis=1)
            waiting = np.where(opened, np.inf, far)
            pick = np.argpartition(waiting, min(OPENED, wanted) - 1, axis=1)[:, :OPENED]
            at, which = np.nonzero(np.isfinite(np.take_along_axis(waiting, pick, axis=1)))
            if not len(at):
                break
            place = pick[at, which]
            opened[at, place] = True
            pairs = np.unique(at[:, None] * lists + self.graph[held[at, place]])
            pairs = pairs[~met.ravel()[pairs]]
            row, new = pairs // lists, pairs % lists
        order = np.lexsort((held, far), axis=1)
        return np.take_along_axis(held, order, axis=1), np.take_along_axis(far, order, axis=1), compared

    def within(self, x: np.ndarray, ratio: float, sizes: np.ndarray, least: int) -> list[np.ndarray]:
        """Of each row, the centroids at most ``ratio`` times as far as its nearest, and the next ones
        until their lists hold ``least`` vectors."""
        wanted = PROBES
        while True:
            found, far = self.nearest(x, wanted)
            before = np.cumsum(sizes[found], axis=1) - sizes[found]
            read = (far <= ratio * far[:, :1]) | (before < least)
            if wanted >= len(self.points) or not read[:, -1].any():
                return [ids[r] for ids, r in zip(found, read)]
            wanted *= 4


def balanced_means(sample: np.ndarray, lists: int) -> np.ndarray:
    """Means of ``lists`` (a power of two) equal parts of the sample."""
    parts = [sample]
    while len(parts) < lists:
        halves = []
        for part in parts:
            centred = part - part.mean(axis=0)
            direction = centred[np.argmax((centred**2).sum(axis=1))]
            for _ in range(8):  # power iteration towards the main direction
                direction = centred.T @ (centred @ direction)
                size = np.linalg.norm(direction)
                direction = direction / size if size > 0 else direction
            order = np.argsort(centred @ direction, kind="stable")
            halves += [part[order[: len(part) // 2]], part[order[len(part) // 2 :]]]
        parts = halves
    return np.array([p.mean(axis=0) for p in parts])


def refine(sample: np.ndarray, points: np.ndarray, rounds: int = 4) -> np.ndarray:
    """A few rounds of means in which a full list costs more, so that lists stay balanced."""
    size, weight = len(sample) / len(points), np.zeros(len(points))
    for _ in range(rounds):
        square = (points**2).sum(axis=1)
        near = np.concatenate([(square - 2 * part @ points.T + weight).argmin(axis=1) for part in np.array_split(sample, -(-len(sample) // 2048))])
        count = np.bincount(near, minlength=len(points))
        sums = np.zeros_like(points)
        np.add.at(sums, near, sample)
        points = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], points)
        spread = ((sample - points[near]) ** 2).sum(axis=1).mean()
        weight = weight + 0.1 * spread * (count / size - 1)
    return points


def fit(sample: np.ndarray, total: int) -> Centroids:
    """Centroids and their graph from sampled vectors, for ``total`` vectors."""
    lists = 1
    while lists < MOST_LISTS and lists * LIST_SIZE < total and lists * 8 <= len(sample):
        lists *= 2
    points = balanced_means(sample, lists)
    if lists > 1:
        points = refine(sample, points)
    between = np.sqrt(np.maximum((points**2).sum(1)[:, None] - 2 * points @ points.T + (points**2).sum(1), 0))
    order = np.argsort(between, axis=1, kind="stable")
    near = order[:, 1 : DEGREE + 1] if lists > 1 else np.zeros((1, 1), dtype=np.int64)
    # A ring keeps the graph in one piece.
    ring = (np.arange(lists) + 1)[:, None] % lists
    return Centroids(points, np.concatenate([near, ring], axis=1), np.unique(np.linspace(0, lists - 1, min(lists, ENTRIES)).astype(int)))


def lists_to_join(index: Centroids, x: np.ndarray) -> list[np.ndarray]:
    """The posting lists of each vector: the nearest centroid's, and others close to the boundary."""
    found, far = index.nearest(x, REPLICAS)
    return [ids[d <= SPREAD * d[0]] for ids, d in zip(found, far)]


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _dealt(vectors: DataFrame, index: Centroids, sizes: np.ndarray | None = None) -> DataFrame:
    """(list, id, vector): the lists a vector stands in; with ``sizes`` of the lists, those a query reads."""
    shared = vectors.sparkSession.sparkContext.broadcast(index)  # at most MOST_LISTS centroids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                x = np.array(part.column("vector").to_pylist(), dtype=np.float64)
                joined = lists_to_join(known, x) if sizes is None else known.within(x, REACH, sizes, LEAST)
                take = pa.array(np.repeat(np.arange(len(x)), [len(j) for j in joined]))
                lists = pa.array(np.concatenate(joined).astype(np.int32))
                yield pa.RecordBatch.from_arrays([lists, part.column("id").take(take), part.column("vector").take(take)], ["list", "id", "vector"])

    return vectors.mapInArrow(run, "list int, id long, vector array<double>")


def _compare(wanted: int):
    def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
        ids = candidates.column("id").to_numpy()
        x = np.array(candidates.column("vector").to_pylist(), dtype=np.float64).reshape(len(ids), -1)
        asks = queries.column("id").to_numpy()
        y = np.array(queries.column("vector").to_pylist(), dtype=np.float64).reshape(len(asks), -1)
        q, v, s = [], [], []
        for i in range(len(asks) if len(ids) else 0):
            far = np.sqrt(((x - y[i]) ** 2).sum(axis=1))
            far[ids == asks[i]] = np.inf
            edge = np.partition(far, wanted - 1)[wanted - 1] if len(far) > wanted else np.inf
            near = np.flatnonzero((far <= edge) & np.isfinite(far))
            near = near[np.lexsort((ids[near], far[near]))[:wanted]]
            q.append(np.full(len(near), asks[i])), v.append(ids[near]), s.append(far[near])
        cat = lambda parts, kind: pa.array(np.concatenate(parts) if parts else np.empty(0), kind)
        return pa.table({"query_id": cat(q, pa.int64()), "vec_id": cat(v, pa.int64()), "score": cat(s, pa.float64())})

    return run


def search(
    table: DataFrame, is_query: Column, wanted: int = 10, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``wanted`` nearest other vectors found.

    ``is_query`` is a condition on a column named ``id``.
    """
    spark = table.sparkSession
    arrow_rows(spark, 2048)
    vector = F.col(f"`{vector_col}`")
    rows = table.where(F.col(f"`{id_col}`").isNotNull() & usable(vector)).select(F.col(f"`{id_col}`").cast("long").alias("id"), vector.cast("array<double>").alias("vector"))
    rows = cut_lineage(rows.groupBy("id").agg(F.min("vector").alias("vector")))
    sizes = rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    if sizes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("vector") == sizes["d"])
    # About twice the sample by a hash of the id, of which the sample's size is taken.
    share = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(min(1.0, 2 * SAMPLE / sizes["n"]) * (1 << 30))
    taken = rows.where(share).orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").toArrow().column(0).to_pylist()
    index = fit(np.array(taken, dtype=np.float64), sizes["n"])
    postings = cut_lineage(_dealt(rows, index))
    lengths = np.zeros(len(index.points), dtype=np.int64)
    for row in postings.groupBy("list").count().collect():  # at most MOST_LISTS rows
        lengths[row["list"]] = row["count"]
    asked = cut_lineage(_dealt(rows.where(is_query), index, lengths))
    # Bounded by the number of lists: into how many blocks each is cut.
    blocks = lambda df, name: df.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name))
    cuts = F.broadcast(blocks(postings, "nv").join(blocks(asked, "nq"), "list"))
    deal = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = postings.join(cuts, "list").withColumn("vb", deal("nv")).withColumn("qb", every("nq")).select("list", "vb", "qb", "id", "vector")
    right = asked.join(cuts, "list").withColumn("qb", deal("nq")).withColumn("vb", every("nv")).select("list", "vb", "qb", "id", "vector")
    key = ["list", "vb", "qb"]
    met = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_compare(wanted), "query_id long, vec_id long, score double")
    best = met.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= wanted)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
