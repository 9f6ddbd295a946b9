import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from fundledger.catalog import all_queries, storage, views
from fundledger.operators import searching
from fundledger.operators.securities import securities
from fundledger.plans.layers import dim_security
from fundledger.session import scratch_path
from fundledger.sources import checked, layers, raw
from fundledger.streaming import jobs


def documents(spark, *docs):
    return spark.createDataFrame([("p", json.dumps(d)) for d in docs], "path string, raw string")


def test_fields_are_matched_by_name(spark):
    docs = documents(spark, {"fields": ["name", "cik", "ticker"], "data": [["Apple", 320193, "AAPL"], ["Odd", "x", None]]})
    got = [tuple(r) for r in raw.fields_and_rows(docs).collect()]
    assert got == [(320193, "Apple", "AAPL", None), (None, "Odd", None, None)]


def test_last_ticker_entry_wins(spark):
    docs = documents(spark, {"0": {"cik_str": 1, "ticker": " abc "}, "1": {"cik_str": 2, "ticker": "ABC"}})
    assert [tuple(r) for r in raw.ticker_map(docs).collect()] == [("ABC", "0000000002")]


def test_absent_arrays_are_null_columns_and_uneven_ones_are_rejected(spark):
    good = {"cik": "1", "name": "n", "filings": {"recent": {"accessionNumber": ["a", "b"], "form": ["10-K", "8-K"], "items": []}}}
    bad = {"cik": "2", "name": "n", "filings": {"recent": {"accessionNumber": ["a", "b"], "form": ["10-K"]}}}
    nameless = {"cik": "3"}
    parsed = raw.submission_faults(raw.parse_submissions(documents(spark, good, bad, nameless)))
    assert {r.s.cik: r.fault for r in parsed.collect()} == {"1": None, "2": "filing arrays of unequal length", "3": "no name"}
    rows = raw.explode_filings(parsed).where("cik != '0000000003'").orderBy("position").collect()
    assert [(r.cik, r.accessionNumber, r.form, r["items"], r.size) for r in rows] == [
        ("0000000001", "a", "10-K", None, None), ("0000000001", "b", "8-K", None, None),
    ]


def test_addresses_flatten_and_country_code_is_left_out(spark):
    doc = {"cik": "7", "name": "n", "tickers": ["T"], "addresses": {"mailing": {"street1": "s", "countryCode": "US"}}, "unknownField": 1}
    row = raw.flatten_submissions(raw.parse_submissions(documents(spark, doc))).first()
    assert (row.addr_mailing_street1, row.addr_business_city, row.tickers, row.exchanges, row.filing_files_count) == ("s", None, '["T"]', "[]", 0)
    assert "countryCode" not in "".join(row.asDict())
    assert len(row.asDict()) + 1 == 36  # the ingestion date comes with the write


def test_facts_explode_every_entry(spark):
    entry = {"accn": "a", "end": "2023-12-31", "val": 1.5, "form": "10-K", "filed": "2024-01-01"}
    doc = {"cik": 5, "entityName": "E", "facts": {"us-gaap": {"Assets": {"label": "L", "units": {"USD": [entry, entry]}}}, "dei": {"X": {"units": {"shares": [entry], "pure": []}}}}}
    got = raw.explode_facts(documents(spark, doc)).collect()
    assert sorted((r.namespace, r.concept, r.unit) for r in got) == [("dei", "X", "shares"), ("us-gaap", "Assets", "USD"), ("us-gaap", "Assets", "USD")]
    assert {r.cik for r in got} == {"0000000005"} and {r.start for r in got} == {None}


def test_concept_points(spark):
    doc = {"cik": 5, "taxonomy": "dei", "tag": "S", "units": {"shares": [{"end": "e", "val": 3, "form": "10-K", "filed": "f"}], "USD": [{"val": 1}]}}
    assert [(r.concept, int(r.val)) for r in raw.explode_concept(documents(spark, doc)).collect()] == [("S", 3)]


def test_index_files_skip_header_and_bad_lines(spark, tmp_path):
    (tmp_path / "master.idx").write_text(
        "Description\n1|before|10-K|d|f\n-----|----\n320193|APPLE|10-K|2024-01-08|f\nx1|BAD|10-K|d|f\n5|SHORT|10-K|d\n320193|APPLE|8-K|2024-01-08|f\n"
    )
    got = raw.read_daily_index(spark, str(tmp_path)).orderBy("line").collect()
    assert [(r.cik, r.form) for r in got] == [("0000320193", "10-K"), ("0000320193", "8-K")]
    empty = raw.read_daily_index(spark, str(tmp_path / "holiday"))
    assert empty.count() == 0 and empty.columns == got[0].__fields__


def test_good_and_bad_rows_are_all_rows(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "n int, t string")
    good, bad = raw.validate(df, {"n": F.col("n") > 0, "t": F.col("t") != ""})
    assert good.count() == 1 and good.count() + bad.count() == df.count()
    assert sorted(r.broken for r in bad.collect()) == [["n"], ["t"]]


def test_every_older_page_is_read(spark):
    recent = spark.createDataFrame([("1", "r")], "cik string, a string")
    pages = spark.createDataFrame([("1", f"p{i}", i) for i in range(7)], "cik string, a string, page int")
    assert raw.union_filing_pages(recent, pages).count() == 8


def test_layer_modes(spark, tmp_path):
    root, one, two = str(tmp_path), spark.range(3), spark.range(5)
    assert layers.write_layer(one, root, "bronze", "t", "2024-01-01")
    assert not layers.write_layer(two, root, "bronze", "t", "2024-01-01")
    assert layers.write_layer(two, root, "bronze", "t", "2024-01-02", rows_per_file=2)
    assert layers.read_layer(spark, root, "bronze", "t", "2024-01-01").count() == 3
    assert layers.read_layer(spark, root, "bronze", "t").count() == 8
    for df in (one, two, two):
        layers.write_layer(df, root, "silver", "t", "2024-01-01", mode="overwrite_partition")
    layers.write_layer(one, root, "silver", "t", "2024-01-02", mode="overwrite_partition")
    assert layers.read_layer(spark, root, "silver", "t").count() == 8
    layers.write_layer(two, root, "gold", "t", "2024-01-01", mode="overwrite", sort_by=["id"])
    layers.write_layer(one, root, "gold", "t", "2024-01-02", mode="overwrite")
    assert layers.read_layer(spark, root, "gold", "t").count() == 3


def test_one_date_reads_one_directory(spark, tmp_path):
    for day in ("2024-01-01", "2024-01-02"):
        layers.write_layer(spark.range(3), str(tmp_path), "bronze", "t", day)
    plan = layers.read_layer(spark, str(tmp_path), "bronze", "t", "2024-01-01")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(ingestion_date" in plan


def test_gate(spark, tmp_path):
    layers.write_layer(spark.range(1), str(tmp_path), "bronze", "full", "2024-01-01")
    layers.write_layer(spark.range(0), str(tmp_path), "bronze", "empty", "2024-01-01")
    layers.gate(spark, str(tmp_path), "2024-01-01", ["full"])
    with pytest.raises(RuntimeError, match="empty, absent"):
        layers.gate(spark, str(tmp_path), "2024-01-01", ["full", "empty", "absent"])


def test_dimension_keeps_first_seen_and_unlisted_companies(spark):
    schema = "cik long, name string, ticker string, exchange string"
    day1 = dim_security(spark.createDataFrame([(1, "a", "A", "NYSE"), (2, "b", "B", "NYSE"), (9, "z", "Z", "OTC")], schema), "2024-01-01")
    day2 = dim_security(spark.createDataFrame([(1, "a2", "A", "Nasdaq"), (3, "c", "C", "NYSE")], schema), "2024-01-02", previous=day1)
    got = {r.cik: (r.company_name, r.exchange, r.first_seen_date.day, r.last_seen_date.day) for r in day2.collect()}
    assert got == {"0000000001": ("a2", "Nasdaq", 1, 2), "0000000002": ("b", "NYSE", 1, 1), "0000000003": ("c", "NYSE", 2, 2)}


def test_upsert_updates_only_named_columns(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", "x")], "k int, v string, w string")
    new = spark.createDataFrame([(1, "A", "n"), (3, "C", "n")], "k int, v string, w string")
    got = sorted(tuple(r) for r in layers.upsert(old, new, ["k"], ["v"]).collect())
    assert got == [(1, "A", "n"), (2, "b", "x"), (3, "C", "n")]
    kept = sorted(tuple(r) for r in layers.upsert(old, new, ["k"], ["v"], keep=("w",)).collect())
    assert kept[0] == (1, "A", None)


def test_stream_drops_copies_and_merges_companies(spark, tmp_path):
    events = spark.createDataFrame(
        [(1, "2024-01-01 10:00:00", 7, "view", 1.0, '{"k": 4}'), (1, "2024-01-01 10:00:00", 7, "view", 1.0, '{"k": 4}'), (2, "2024-01-03 10:00:00", 7, "view", 1.0, '{"k": 5}')],
        "event_id long, ts string, user_id long, event_type string, value double, props string",
    ).withColumn("ts", F.col("ts").cast("timestamp"))
    events.write.parquet(str(tmp_path / "in"))
    stream = jobs.to_filings(jobs.file_stream(spark, str(tmp_path / "in")))
    jobs.run_to_table(jobs.once_per_accession(stream), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert sorted(r.accession_number for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["000000000001", "000000000002"]
    root = str(tmp_path / "dim")
    jobs.run_batches(stream, str(tmp_path / "ck2"), jobs.keep_parts(spark, root, jobs.seen_companies))
    row = jobs.merged_companies(jobs.read_parts(spark, root)).collect()
    assert [(r.cik, r.first_seen_date, r.last_seen_date) for r in row] == [("0000000007", date(2024, 1, 1), date(2024, 1, 3))]


def test_replayed_batch_changes_nothing_and_lost_parts_are_noticed(spark, tmp_path):
    root = str(tmp_path / "t")
    keep = jobs.keep_parts(spark, root, lambda batch: batch)
    day = lambda n: spark.createDataFrame([(1, n)], "cik int, n int")
    for number in (0, 1, 1):
        keep(day(number), number)
    assert sorted(tuple(r) for r in jobs.read_parts(spark, root).collect()) == [(1, 0), (1, 1)]
    with pytest.raises(RuntimeError, match="another checkpoint"):
        keep(day(0), 0)
    with pytest.raises(RuntimeError, match="history"):
        keep(day(5), 5)


def test_parts_of_finished_batches_are_compacted(spark, tmp_path):
    root, every = str(tmp_path / "t"), 3
    spans = lambda rows: rows.groupBy("cik").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"))
    keep = jobs.keep_parts(spark, root, spans, spans, every)
    batch = lambda n: spark.range(1).select(F.lit(n % 4).alias("cik"), F.lit(n).alias("first"), F.lit(n).alias("last"), F.lit(1).cast("long").alias("n")).coalesce(1)
    for number in range(29):
        keep(batch(number), number)
        keep(batch(number), number)
        live = jobs.live_runs(jobs.part_runs(spark, root))
        assert [n for low, high in live for n in range(low, high + 1)] == list(range(number + 1))
        assert len(live) <= every * 4 and len(jobs.part_runs(spark, root)) <= 2 * every * 4
        # The last batch may be replayed, so it is never in a longer part.
        assert live[-1] == (number, number)
    assert (0, 26) in live
    got = sorted(tuple(r) for r in spans(jobs.read_parts(spark, root)).collect())
    assert got == [(k, k, max(range(k, 29, 4)), len(range(k, 29, 4))) for k in range(4)]


def test_a_compaction_that_broke_off_is_done_again(spark, tmp_path):
    root = str(tmp_path / "t")
    once = lambda rows: rows.groupBy("cik").agg(F.sum("n").alias("n"))
    batch = lambda: spark.range(1).select(F.lit(1).alias("cik"), F.lit(1).cast("long").alias("n"))
    for number in range(3):
        jobs.keep_parts(spark, root, once)(batch(), number)
    # Files without the mark of a whole write.
    once(batch()).write.parquet(f"{root}/part=0-1")
    (tmp_path / "t" / "part=0-1" / "_SUCCESS").unlink()
    assert jobs.live_runs(jobs.part_runs(spark, root)) == [(0, 0), (1, 1), (2, 2)]
    jobs.keep_parts(spark, root, once, once, 2)(batch(), 3)
    assert jobs.live_runs(jobs.part_runs(spark, root)) == [(0, 1), (2, 2), (3, 3)]
    assert jobs.read_parts(spark, root).agg(F.sum("n")).first()[0] == 4
    with pytest.raises(ValueError, match="2 or more"):
        jobs.compact_parts(spark, root, once, 1, 3)


def test_days_and_filers_over_parts(spark):
    parts = spark.createDataFrame([("d", "f", 1, 2), ("d", "f", 1, 1), ("d", "f", 2, 1)], "filed_date string, form_type string, cik int, filings long")
    assert [tuple(r) for r in jobs.daily_forms(parts).collect()] == [("d", "f", 4, 2)]


def test_load_that_broke_off_is_written_anew(spark, tmp_path):
    half = tmp_path / "bronze" / "t" / "ingestion_date=2024-01-01"
    spark.range(1).write.parquet(str(half))
    assert layers.write_layer(spark.range(3), str(tmp_path), "bronze", "t", "2024-01-01")
    assert not layers.write_layer(spark.range(9), str(tmp_path), "bronze", "t", "2024-01-01")
    assert layers.read_layer(spark, str(tmp_path), "bronze", "t").count() == 3


def test_gold_files_do_not_overlap_in_their_sort_column(spark, tmp_path):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_011).alias("ticker")).repartition(8)
    layers.write_layer(df, str(tmp_path), "gold", "t", "2024-01-01", mode="overwrite", sort_by=["ticker"])
    rows = layers.read_layer(spark, str(tmp_path), "gold", "t").select("ticker", F.col("_metadata.file_path").alias("f"))
    spans = sorted((r.lo, r.hi) for r in rows.groupBy("f").agg(F.min("ticker").alias("lo"), F.max("ticker").alias("hi")).collect())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_null_key_is_a_key_of_its_own(spark):
    old = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    new = spark.createDataFrame([(None, "A"), (2, "c")], "k int, v string")
    got = sorted((str(r.k), r.v) for r in layers.upsert(old, new, ["k"], ["v"]).collect())
    assert got == [("1", "b"), ("2", "c"), ("None", "A")]


def test_small_values_and_reported_periods_survive(spark):
    entry = {"accn": "a", "end": "2023-12-31", "val": 0.00003, "fy": 2022, "fp": "Q3", "form": "10-K", "filed": "2024-01-01"}
    doc = {"cik": 5, "entityName": "E", "facts": {"us-gaap": {"Assets": {"label": "L", "units": {"USD": [entry]}}}}}
    row = raw.explode_facts(documents(spark, doc)).first()
    assert (row.val, row.fy, row.fp) == (0.00003, 2022, "Q3")


def test_rows_are_checked_by_the_job_that_writes_them(spark):
    source, path = scratch_path(spark, "source"), scratch_path(spark, "checked")
    schema = "k long, v double"
    rows = spark.range(1000).select(F.col("id").alias("k"), F.when(F.col("id") % 10 != 0, F.col("id") % 7 - 1.0).alias("v"))
    rows.repartition(6).write.parquet(source)
    table = spark.read.schema(schema).parquet(source)
    spark.sparkContext.setJobGroup("checked", "one pass")
    figures = checked.write_checked(table, {"present": F.col("v").isNotNull(), "positive": F.col("v") > 0}, path, ["v"])
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("checked")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1
    low = sum(i % 10 == 0 or i % 7 - 1.0 <= 0 for i in range(1000))
    assert figures == {"rows": 1000, "accepted": 1000 - low, "rejected": low, "broken: present": 100, "broken: positive": low, "null: v": 100}
    good, bad = checked.read_checked(spark, path, schema)
    assert good.count() == 1000 - low and bad.count() == low
    assert bad.where("v is null").select("broken").distinct().collect()[0][0] == ["present", "positive"]
    checked.gate_figures({"a": figures})
    with pytest.raises(RuntimeError, match="too many"):
        checked.gate_figures({"a": figures}, rejected_share=0.1)


def test_an_empty_table_is_checked_and_stopped_at_the_gate(spark):
    none = spark.createDataFrame([], "k long, v double")
    figures = checked.write_checked(none, {"present": F.col("v").isNotNull()}, scratch_path(spark, "none"), ["v"])
    assert figures == {"rows": 0, "accepted": 0, "rejected": 0, "broken: present": 0, "null: v": 0}
    with pytest.raises(RuntimeError, match="no accepted rows for a"):
        checked.gate_figures({"a": figures})


def test_facts_without_a_schema(spark):
    docs = [
        '{"cik": 7, "entityName": "N", "facts": {"odd-space": {"C.1": {"label": "L", "units": {"USD/shares": [{"val": 1.5, "accn": "a", "end": "2024-01-01", "fy": "x", "note": {"deep": [1, 2]}}, {"val": "no number"}]}}}}}',
        '{"cik": "8", "facts": {"s": {"c": {"units": {}}, "d": {"label": null, "units": {"pure": [{"val": 2}]}}}}}',
        '{"cik": 9}', '{"cik": 10, "facts": null}', "no json", "", None,
    ]
    rows = raw.explode_fact_variants(spark.createDataFrame([("p", x) for x in docs], "path string, raw string"))
    got = rows.where("namespace is not null and entry is not null").select(
        "cik", "namespace", "concept", "label", "unit", "val", "accn", "fy", F.variant_get("entry", "$.note.deep[1]", "int").alias("deep")
    )
    assert {tuple(r) for r in got.collect()} == {
        ("0000000007", "odd-space", "C.1", "L", "USD/shares", 1.5, "a", None, 2),
        ("0000000007", "odd-space", "C.1", "L", "USD/shares", None, None, None, None),
        ("0000000008", "s", "d", None, "pure", 2.0, None, None, None),
    }
    assert rows.count() == 3


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_each_submission_is_parsed_once(spark):
    """Filters on parsed fields must not parse the document again for every field they name."""
    docs = documents(spark, {"cik": "1", "name": "A", "filings": {"recent": {"form": ["4"]}}}, "none").select(F.lit(1).alias("page"), "raw")
    good = raw.flatten_submissions(raw.submission_faults(raw.parse_submissions(docs)).where("fault IS NULL"))
    filed = raw.explode_filings(raw.parse_submissions(docs, ["page"]), ["page"])
    for df in (good, filed, raw.submission_faults(raw.parse_submissions(docs)).where("fault IS NOT NULL")):
        assert _plan(df).count("from_json(") == 1 and df.count() == 1
    assert filed.select("page", "cik", "form").first() == (1, "0000000001", "4")


def _tables(spark, path):
    spark.range(1, 40).selectExpr("id AS c_custkey", "'C' || id AS c_name", "'BUILDING' AS c_mktsegment").write.parquet(f"{path}/customer.parquet")
    spark.range(3000).selectExpr("id AS o_orderkey", "if(id = 7, NULL, id % 3) AS o_custkey", "timestamp'1998-01-01' AS o_orderdate").write.parquet(f"{path}/orders.parquet")
    spark.range(9000).selectExpr("id div 3 AS l_orderkey", "id AS l_partkey", "id AS l_suppkey", "1.5D AS l_extendedprice", "timestamp'1998-01-01' AS l_shipdate").write.parquet(f"{path}/lineitem.parquet")


def test_documents_are_spread_and_grouped_in_place(spark, tmp_path):
    _tables(spark, str(tmp_path))
    assert "REBALANCE_PARTITIONS" in _plan(views.company_docs(spark, str(tmp_path)))
    docs = views.fact_docs(spark, str(tmp_path))
    # One shuffle brings a document's rows together; those below it are the join's.
    above = _plan(docs).split("Join")[0]
    assert above.count("Exchange") == 1
    # Orders without a company make documents of their own, as any company does.
    assert docs.count() == 3 * 3 + 1
    rows = raw.explode_facts(docs)
    assert rows.count() == 9000 and rows.where("cik IS NULL").count() == 3


def test_newest_documents_and_older_pages_are_written_once(spark, tmp_path):
    _tables(spark, str(tmp_path))
    pages = storage._with_pages(spark, str(tmp_path))
    assert "collect_list" not in _plan(pages) and _plan(pages).count("from_json(") == 2
    assert pages.count() == 2999 and pages.select("accessionNumber").distinct().count() == 2999


def test_index_files_grow_with_lines_not_with_keys(spark):
    """Two days, one of them with most lines, over a wide range of keys."""
    rows = spark.range(2000).selectExpr("if(id % 10 = 0, '2024-01-01', '2024-01-02') AS day", "id * 7 + 10 AS line")
    rows = rows.unionByName(spark.createDataFrame([(None, 10), (None, 10**9)], "day string, line long"))
    placed, files = storage.day_files(rows, 100)
    assert placed.count() == 2002
    spans = placed.groupBy("day", "file").agg(F.count("*").alias("n"), F.min("line").alias("first"), F.max("line").alias("last")).orderBy("day", "file").collect()
    assert max(r["n"] for r in spans) <= 100 and len(spans) <= 2 * 2002 / 100 + 3
    assert all(a["last"] < b["first"] for a, b in zip(spans, spans[1:]) if a["day"] == b["day"])
    assert {(r["day"], r["file"]) for r in files.collect()} == {(r["day"], r["file"]) for r in spans}


def test_search_counts_pairs_where_they_meet(spark):
    table = spark.createDataFrame([("P1", "blue steel"), ("P2", "steel"), ("P3", None)], "t string, name string")
    terms = spark.createDataFrame([("steel",), ("blue s",), ("p3",), ("none",)], "term string")
    index = searching.postings(table, "t", ["t", "name"])
    assert "REBALANCE_PARTITIONS" in _plan(index)
    found = searching.search(terms, table, "t", ["t", "name"], index)
    # Partial counts of pairs, which hardly meet in a task, are not kept below the shuffle.
    assert "REPARTITION_BY_NUM" in _plan(found)
    assert sorted(map(tuple, found.collect())) == [("blue s", "P1"), ("p3", "P3"), ("steel", "P1"), ("steel", "P2")]


def test_master_moves_keys_before_names(spark, tmp_path):
    lines = "l_partkey long, l_suppkey long, l_shipdate timestamp_ntz, l_extendedprice double, l_quantity double"
    at = datetime(2020, 5, 1)
    spark.createDataFrame([(k, k % 5, at, 1.0, 1.0) for k in range(1, 200)] + [(7, 1, at, 1.0, 1.0), (7, 2, at, 2.0, 1.0), (8, None, None, 1.0, 1.0), (None, 1, at, 1.0, 1.0)], lines).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, f"name {k}", "TYPE") for k in range(1, 190)], "p_partkey long, p_name string, p_type string").write.parquet(f"{tmp_path}/part.parquet")
    rows = views.dirty_identities(spark, str(tmp_path))
    plan = _plan(rows)
    # Keys move into all shuffle tasks, then become text: no adaptive merging, nothing summed.
    moved = plan.index("REPARTITION_BY_NUM")
    assert "HashAggregate" not in plan and "lpad" not in plan[moved:].split("FileScan")[0] and "lpad" in plan[:moved]
    same = views.dirty_holdings(spark, str(tmp_path)).select(*rows.columns)
    assert rows.count() > same.count() and set(map(tuple, rows.collect())) == set(map(tuple, same.collect()))
    master = all_queries()["security_master"](spark, str(tmp_path))
    assert master.count() > 150 and sorted(map(str, master.collect())) == sorted(map(str, securities(same).collect()))
