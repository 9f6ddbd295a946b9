"""Loads with a history, bucketed upserts, search postings, windows of event time."""

import glob
import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fundledger.operators import searching
from fundledger.sources import buckets, loads
from fundledger.streaming import jobs


def test_a_broken_file_is_listed_and_the_others_load(spark, tmp_path):
    source, root, schema = str(tmp_path / "in"), str(tmp_path / "table"), "k long, v string"
    assert loads.loaded(spark, root, schema).count() == 0
    os.mkdir(source)
    for i in range(10):
        spark.createDataFrame([(i, f"v{i}"), (i + 100, None)], schema).coalesce(1).write.parquet(str(tmp_path / f"one{i}"))
        os.rename(glob.glob(str(tmp_path / f"one{i}" / "part-*.parquet"))[0], f"{source}/f{i}.parquet")
    broken = f"{source}/f4.parquet"
    whole = open(broken, "rb").read()
    open(broken, "wb").write(whole[:-20] + b"\0" * 20)
    first = {os.path.basename(r["file"]): r for r in loads.load_files(spark, source, schema, root).collect()}
    assert len(first) == 10 and {f for f, r in first.items() if r["error"]} == {"f4.parquet"}
    assert all(r["rows"] == 2 for f, r in first.items() if f != "f4.parquet") and first["f4.parquet"]["rows"] is None
    assert loads.loaded(spark, root, schema).count() == 18
    # Nothing new: the broken file is not tried again.
    assert loads.load_files(spark, source, schema, root).count() == 0 and loads.loaded(spark, root, schema).count() == 18
    open(broken, "wb").write(whole)
    os.utime(broken, (2e9, 2e9))
    again = loads.load_files(spark, source, schema, root).collect()
    assert [(os.path.basename(r["file"]), r["rows"], r["load"]) for r in again] == [("f4.parquet", 2, 2)]
    assert sorted(r["k"] for r in loads.loaded(spark, root, schema).collect()) == [*range(10), *range(100, 110)]
    # A load that broke off before its history is not read, and is written anew.
    spark.createDataFrame([(1, "half")], schema).write.parquet(f"{root}/data/load=3/part=0")
    assert loads.loaded(spark, root, schema).count() == 20


SCHEMA = "k string, seen date, name string"


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    path = str(tmp_path / "dim")
    rows = [(f"k{i}", date(2024, 1, 1), f"n{i}") for i in range(300)]
    assert buckets.upsert_buckets(spark, path, SCHEMA, spark.createDataFrame(rows, SCHEMA), ["k"], ["seen"], 16) == 16
    before = {f: os.path.getmtime(f) for f in glob.glob(f"{path}/_bucket=*/*.parquet")}
    assert len(before) == 16
    batch = spark.createDataFrame([("k7", date(2024, 2, 2), "other"), ("new", date(2024, 2, 2), "x")], SCHEMA)
    touched = {r[0] for r in batch.select(buckets.bucket_of(["k"], 16)).collect()}
    for _ in range(2):
        assert buckets.upsert_buckets(spark, path, SCHEMA, batch, ["k"], ["seen"], 16) == len(touched)
        after = set(glob.glob(f"{path}/_bucket=*/*.parquet"))
        assert len(after) == 16
        kept = {f for f in before if int(f.split("_bucket=")[1].split("/")[0]) not in touched}
        assert kept <= after and all(os.path.getmtime(f) == before[f] for f in kept)
        got = {r["k"]: (r["seen"], r["name"]) for r in buckets.read_buckets(spark, path, SCHEMA).collect()}
        assert len(got) == 301 and got["k7"] == (date(2024, 2, 2), "n7") and got["new"][1] == "x" and got["k8"][0] == date(2024, 1, 1)
    assert buckets.upsert_buckets(spark, path, SCHEMA, batch.where("false"), ["k"], ["seen"], 16) == 0


def test_many_batches_leave_few_files(spark, tmp_path):
    each = jobs.upsert_companies(spark, str(tmp_path / "dim"), buckets=4)
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(12)]
    for n in (*range(12), 3):  # one batch is replayed
        each(spark.createDataFrame([(f"c{n % 5}", days[n]), ("all", days[n]), (None, days[n])], "cik string, filed_date date"), n)
    assert len(glob.glob(str(tmp_path / "dim" / "_bucket=*" / "*.parquet"))) <= 4
    got = {r["cik"]: (r["first_seen_date"], r["last_seen_date"]) for r in buckets.read_buckets(spark, str(tmp_path / "dim"), jobs.COMPANIES).collect()}
    assert got == {"all": (days[0], days[11]), **{f"c{k}": (days[k], days[k + 5 * ((11 - k) // 5)]) for k in range(5)}}


def test_searching_finds_what_a_scan_finds(spark, tmp_path):
    names = ["Blue Sky Inc", "blue whale", "100% Green_Co", "ÉTOILE du nord", "a", "", None, "aaaa", "Sky-Blue", "en", "Ben"]
    table = spark.createDataFrame([(f"T{i}", n) for i, n in enumerate(names)], "ticker string, name string")
    index = searching.write_postings(searching.postings(table, "ticker", ["ticker", "name"]), str(tmp_path / "index"))
    terms = ["blue", "BLUE ", "0%", "n_C", "étoile", "aa", "aaa", "aaaaa", "T1", "t10", "e", "", "sky", "en", "zzz", "e d"]
    found = searching.search(spark.createDataFrame([(t,) for t in terms * 2] + [(None,)], "term string"), table, "ticker", ["ticker", "name"], index)
    got = sorted((r["term"], r["ticker"]) for r in found.collect())
    scan = [(t, f"T{i}") for t in terms for i, n in enumerate(names) if len(t) > 1 and (t.lower() in f"t{i}" or t.lower() in (n or "").lower())]
    assert got == sorted(scan) and len(got) > 12


def test_windows_close_free_their_state_and_go_on_after_a_restart(spark, tmp_path):
    source, path, mark, progress = (str(tmp_path / n) for n in ("in", "out", "mark", "progress"))
    schema = "ts timestamp, form_type string, cik string"
    day = lambda n, hour=1: datetime(2024, 1, n, hour)

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = jobs.daily_windows(spark.readStream.schema(schema).parquet(source))
        jobs.run_windows(spark, stream, path, mark, progress)
        return {(r["filed_date"].day, r["form_type"]): (r["filings"], r["filers"]) for r in jobs.distinct_filers(spark.read.parquet(path), ["filed_date", "form_type"]).collect()}

    first = arrive([(day(d), "10-K", f"c{i % 3}") for d in range(1, 8) for i in range(5)])
    assert first == {(d, "10-K"): (5, 3) for d in range(1, 6)}
    # A late row of a closed day is turned away, one of an open day counts.
    second = arrive([(day(1), "10-K", "late"), (day(7, 5), "8-K", "c9"), (day(20), "10-K", "c1")])
    assert second == {**{(d, "10-K"): (5, 3) for d in range(1, 8)}, (7, "8-K"): (1, 1)}
    told = spark.read.parquet(progress)
    assert told.agg(F.sum("late_groups")).first()[0] == 1
    states = [r["state_rows"] for r in told.orderBy("batch").collect()]
    assert max(states) == 7 and states[-1] == 1
    whole = jobs.distinct_filers(spark.read.parquet(path), ["form_type"]).collect()
    assert {r["form_type"]: (r["filings"], r["filers"]) for r in whole} == {"10-K": (35, 3), "8-K": (1, 1)}
