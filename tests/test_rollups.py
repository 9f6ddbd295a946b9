"""Sketches per snapshot: merged figures against exact ones, refreshes, empty groups."""

import random

import pytest
from pyspark.sql import functions as F

from fundledger.catalog import rollups as queries
from fundledger.operators import rollups as ro
from fundledger.session import scratch_path

ROWS = "as_of_date date, kind string, key string, weight double"


@pytest.fixture(scope="module")
def positions(spark):
    random.seed(5)
    rows = [(day, "hot" if i % 3 else random.choice(["a", None]), f"k{random.randrange(4000)}", random.uniform(-5, 5) ** 3) for day in (1, 2, 3, 4) for i in range(6000)]
    rows += [(2, "none", None, None), (2, "none", "", None)]
    return spark.createDataFrame([(f"2024-01-0{day}", *rest) for day, *rest in rows], ROWS.replace("date date", "date string")).withColumn(
        "as_of_date", F.to_date("as_of_date")
    ).cache()


def test_any_range_of_dates_is_counted_within_the_error(spark, positions):
    table = ro.sketch(positions, ["kind"], ["key"], ["weight"])
    for first, last in (("2024-01-01", "2024-01-01"), ("2024-01-02", "2024-01-04"), ("2024-01-01", "2024-01-04")):
        span = F.col("as_of_date").between(first, last)
        near = {r["kind"]: r for r in ro.merge(table.where(span), ["kind"], ["key"], ["weight"]).select("kind", "rows", ro.distinct_count("key").alias("n")).collect()}
        exact = {r["kind"]: r for r in positions.where(span).groupBy("kind").agg(F.count("*").alias("rows"), F.count_distinct(F.nullif("key", F.lit(""))).alias("n")).collect()}
        assert near.keys() == exact.keys()
        for kind, row in exact.items():
            assert near[kind]["rows"] == row["rows"] and abs(near[kind]["n"] - row["n"]) <= 0.04 * row["n"]


def test_merged_quantiles_keep_their_ranks(spark, positions):
    table = ro.sketch(positions, ["kind"], [], ["weight"])
    shares = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = ro.merge(table, ["kind"], [], ["weight"]).select("kind", *[ro.quantile("weight", p).alias(str(p)) for p in shares]).collect()
    for row in got:
        some = [r["weight"] for r in positions.where(F.col("kind").eqNullSafe(row["kind"]) & F.col("weight").isNotNull()).collect()]
        for p in shares:
            if not some:
                assert row[str(p)] is None
                continue
            below, upto = sum(x < row[str(p)] for x in some) / len(some), sum(x <= row[str(p)] for x in some) / len(some)
            assert below <= p + 0.01 and upto >= p - 0.01


def test_trailing_windows_hold_the_snapshots_that_end_with_each(spark, positions):
    table = ro.sketch(positions, ["kind"], ["key"], [])
    near = [(str(r["as_of_date"]), r["rows"]) for r in ro.trailing(table, [], ["key"], [], 3).orderBy("as_of_date").collect()]
    assert near == [("2024-01-01", 6000), ("2024-01-02", 12002), ("2024-01-03", 18002), ("2024-01-04", 18002)]


def test_a_refresh_writes_its_own_dates_only(spark, positions):
    path = scratch_path(spark, "sketches")
    days = [positions.where(F.col("as_of_date") == f"2024-01-0{n}") for n in (1, 2)]
    for day in days:
        ro.refresh(day, path, ["kind"], ["key"], ["weight"])
    files = {f for f in spark.read.parquet(path).inputFiles() if "2024-01-01" in f}
    again = ro.refresh(days[1].limit(100), path, ["kind"], ["key"], ["weight"])
    assert files == {f for f in again.inputFiles() if "2024-01-01" in f}
    assert {str(r["as_of_date"]): r["n"] for r in again.groupBy("as_of_date").agg(F.sum("rows").alias("n")).collect()} == {"2024-01-01": 6000, "2024-01-02": 100}


def test_empty_tables_have_no_sketches(spark, positions):
    none = ro.sketch(positions.limit(0), ["kind"], ["key"], ["weight"])
    assert none.count() == 0 and ro.trailing(none, [], ["key"], ["weight"], 3).count() == 0


def test_answers_read_the_sketch_table_alone(spark):
    table = queries.sketched(spark, "/root/testdata/sf0.001")
    for answer in (queries.trailing_counts(table), queries.class_quartiles(table)):
        assert all("sketches" in f for f in answer.inputFiles()) and answer.count() > 0
