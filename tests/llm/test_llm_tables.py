"""Languages, mixing, neighbours, tool calls and the pipeline."""

import collections
import json
import math
import random
import zlib

import duckdb
import numpy as np
import pytest
from check import compare, connect
from pyspark.sql import functions as F

import __spark_entry__ as registered
import corpus_pipeline
from test_llm_text import plain_near

from fundledger.llm import exact_dedup, language, mixing, posting_lists, queries, tool_chat

SF = "/root/testdata/sf0.001"
BIG = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(queries.CHECKS))
def test_query_matches_its_sql(spark, duck, name):
    outcome, detail, _ = compare(spark, duck, SF, name, registered.queries()[name], registered.oracle_sql()[name])
    assert outcome == "same", detail


def test_every_operator_has_one_query():
    names = [n for n in registered.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in registered.queries()


def test_codewords_differ_in_many_bits():
    for count in (1, 2, 4, 7, 30):
        words = language.codewords(count)
        assert len({tuple(w) for w in words.tolist()}) == count
        if count == 4:
            assert min(int((words[i] != words[j]).sum()) for i in range(4) for j in range(i)) == 4


def test_held_out_accuracy(spark):
    found = queries.op8_language(spark, BIG).join(spark.read.parquet(f"{BIG}/documents.parquet").select("doc_id", "lang"), "doc_id")
    rows = found.where("held_out and lang is not null").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.97 * len(rows) > 0
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_texts(spark):
    docs = spark.createDataFrame(
        [(1, "the cat sat on the mat and the dog", "en"), (5, "le chat est sur la table avec nous", "fr"), (8, None, "en"), (9, "123 !?", None), (10, "", None), (12, "the le " * 30, None)],
        "doc_id long, text string, lang string",
    ).withColumn("score", F.lit("clash"))
    model = language.fit([("the cat sat on the mat and the dog", "en"), ("le chat est sur la table avec nous", "fr")])
    got = {r["doc_id"]: r for r in language.identify(docs, model).collect()}
    assert (got[1]["lang_pred"], got[5]["lang_pred"]) == ("en", "fr")
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (8, 9, 10))
    assert language.identify(docs, None).where("lang_pred != 'und'").count() == 0
    assert language.fit([]) is None and language.trained(docs.where("false")) is None


def plain_grams(text):
    """N-gram codes one by one, with Python integers."""
    raw, codes = text.encode("utf-8", "surrogatepass").lower(), []
    for n in language.SIZES:
        for at in range(len(raw) - n + 1):
            h = n
            for byte in raw[at : at + n]:
                h = (h * 0x01000193 + byte) % 2**32
            codes.append((h * 0x9E3779B1 % 2**32) >> (32 - language.HASH_BITS))
    return codes


def plain_language_model(samples):
    """Weights of every bit and code as a dictionary, by the definition: log odds of the mean rates of both sides."""
    names = sorted({lang for _, lang in samples})
    counts = {lang: collections.Counter() for lang in names}
    for text, lang in samples:
        counts[lang].update(plain_grams(text))
    codes, space = set().union(*counts.values()), 1 << language.HASH_BITS
    total = {lang: sum(counts[lang].values()) + 0.5 * space for lang in names}
    rate = {lang: {c: (counts[lang][c] + 0.5) / total[lang] for c in codes} for lang in names}
    unseen = {lang: 0.5 / total[lang] for lang in names}
    words = language.codewords(len(names)).tolist()
    bits = range(len(words[0]))
    weights = []
    for bit in bits:
        ones, zeros = ([lang for lang, word in zip(names, words) if word[bit] == side] for side in (1, 0))
        odds = lambda of: math.log(sum(map(of, ones)) / len(ones)) - math.log(sum(map(of, zeros)) / len(zeros))
        weights.append(({c: odds(lambda lang: rate[lang][c]) for c in codes}, odds(lambda lang: unseen[lang])))

    def margins(text):
        grams = plain_grams(text)
        return [sum(known.get(c, other) for c in grams) / max(len(grams), 1) for known, other in weights]

    right = [0] * len(words[0])
    for text, lang in samples:
        word = words[names.index(lang)]
        for bit, margin in enumerate(margins(text)):
            right[bit] += (margin > 0) == (word[bit] == 1)
    trust = [min(max(n / len(samples), 0.5), 1.0) for n in right]

    def chances(text):
        found = margins(text)
        far = [sum(t * math.log1p(math.exp(-language.SHARPNESS * (2 * b - 1) * m)) for t, b, m in zip(trust, word, found)) for word in words]
        near = [math.exp(min(far) - f) for f in far]
        return {lang: n / sum(near) for lang, n in zip(names, near)}

    return chances


def test_language_equals_a_plain_version(spark):
    """Learned and decoded n-gram by n-gram; texts of all kinds, also very long labelled ones, which are not learned from."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").where("length(text) < 6000")
    longest = docs.where("lang = 'en'").limit(1).select(F.lit(-4).cast("long").alias("doc_id"), F.expr(f"repeat('zq ', {language.LONGEST // 3 + 1})").alias("text"), F.lit("fr").alias("lang"))
    docs = spark.createDataFrame(docs.unionByName(longest).collect(), "doc_id long, text string, lang string")
    rows = docs.collect()
    learned = [
        (r["text"], r["lang"]) for r in rows
        if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2 and r["lang"] and r["text"] and language.has_letter(r["text"]) and len(r["text"]) <= language.LONGEST
    ]
    assert len(learned) < language.PER_LANGUAGE and len({lang for _, lang in learned}) > 2
    chances = plain_language_model(learned)
    got = {r["doc_id"]: r for r in language.identify(docs, language.trained(docs)).collect()}
    assert len(got) == len(rows)
    for row in rows:
        found = got[row["doc_id"]]
        if not language.has_letter(row["text"]):
            assert (found["lang_pred"], found["score"]) == (language.UNKNOWN, 0)
            continue
        want = chances(row["text"])
        assert found["score"] == pytest.approx(max(want.values()), abs=1e-4)
        assert want[found["lang_pred"]] == pytest.approx(max(want.values()), abs=1e-4)
        ranked = sorted(want.values(), reverse=True)
        assert found["ambiguous"] == (ranked[0] - ranked[1] < 0.2) or abs(ranked[0] - ranked[1] - 0.2) < 1e-3


def test_long_texts_are_read_whole():
    text = "ab cd é" * 9
    whole = np.bincount(language.codes_between(np.frombuffer(text.encode(), np.uint8), 0, 10**6), minlength=1 << language.HASH_BITS)
    old, language.PIECE = language.PIECE, 7
    try:
        parts = sum(np.bincount(c, minlength=1 << language.HASH_BITS) for c in language.text_codes(text))
    finally:
        language.PIECE = old
    assert (whole == parts).all()


def test_raking_reaches_the_margins():
    rng = random.Random(1)
    cells = {(a, b, c): rng.random() + 0.1 for a in "xyz" for b in "pq" for c in "12"}
    targets = [{"x": 0.5, "y": 0.3, "z": 0.2}, {"p": 0.6, "q": 0.4}, {"1": 0.1, "2": 0.9}]
    fitted = mixing.rake(cells, targets)
    for d, target in enumerate(targets):
        for value, share in target.items():
            assert sum(w for k, w in fitted.items() if k[d] == value) == pytest.approx(share, abs=1e-6)
    assert mixing.rake({("x", "p", "1"): 0.0}, targets) == {("x", "p", "1"): 0.0}


def test_calibrated_probabilities_keep_the_rate():
    present, ratio = {"a": 50.0, "b": 30.0, "c": 20.0}, {"a": 0.2, "b": 1.0, "c": 30.0}
    for rate in (0.1, 0.5, 0.9):
        chance = mixing.calibrated(present, ratio, rate)
        assert sum(present[k] * chance[k] for k in present) == pytest.approx(100 * rate)
        assert max(chance.values()) <= 1 and chance["a"] <= chance["b"] <= chance["c"]


def test_mixing_odd_rows(spark):
    rows = [(1, None, None, None), (2, "", "src1", "en"), (3, "a b c", "elsewhere", "en"), (3, "a b c", "elsewhere", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumn("weight", F.lit("clash"))
    got = mixing.mix(docs, queries.TARGETS).collect()
    assert len(got) == 4 and len({(r["kept"], r["probability"]) for r in got if r["doc_id"] == 3}) == 1
    assert mixing.mix(docs.where("false"), queries.TARGETS).collect() == []


def test_mixing_keeps_the_share_of_unnamed_values(spark):
    kinds = [(s, v) for s in ("src0", "src1", "src2", "elsewhere", None) for v in ("en", "fr", "es", "pt", None)]
    rows = [(len(kinds) * i + k, "a b c d", *kind) for i in range(60) for k, kind in enumerate(kinds)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = mixing.mix(docs, {"source": queries.SOURCES, "lang": queries.LANGUAGES}, rate=0.5).collect()
    assert all(r["probability"] > 0 for r in got)
    shares = lambda test: sum(r["weight"] for r in got if test(r)) / len(got)
    assert shares(lambda r: r["source"] in (None, "elsewhere")) == pytest.approx(0.4, abs=1e-6)
    assert shares(lambda r: r["lang"] in (None, "pt")) == pytest.approx(0.4, abs=1e-6)
    assert {(r["source"], r["lang"]) for r in got if r["kept"]} == set(kinds)
    none = mixing.rake({("a", "x"): 1.0, ("other", "x"): 1.0}, [{"a": 1.0, "other": 0.0}, {"x": 1.0}])
    assert none == {("a", "x"): 1.0, ("other", "x"): 0.0}


def brute_neighbours(rows, wanted=10):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], dtype=np.float64)
    out = {}
    for i in np.flatnonzero(ids % 100 == 0):
        far = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, far)) if ids[j] != ids[i]][:wanted]
        out[int(ids[i])] = [(int(ids[j]), far[j]) for j in order]
    return out


@pytest.mark.parametrize("size", [posting_lists.LIST_SIZE, 64])
def test_neighbours_recall(spark, monkeypatch, size):
    monkeypatch.setattr(posting_lists, "LIST_SIZE", size)
    monkeypatch.setattr(posting_lists, "BLOCK", 70)
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{BIG}/embeddings.parquet").collect()]
    expected = brute_neighbours(rows)
    got = {}
    for r in posting_lists.search(spark.read.parquet(f"{BIG}/embeddings.parquet"), F.col("id") % 100 == 0).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert set(got) == set(expected)
    hits = sum(len({v for v, _ in got[q].values()} & {v for v, _ in expected[q]}) for q in expected)
    assert hits >= 0.9 * sum(map(len, expected.values()))
    for found in got.values():
        assert sorted(found) == list(range(1, len(found) + 1))
        assert [found[i] for i in sorted(found)] == sorted(found.values(), key=lambda p: (p[1], p[0]))


def test_the_graph_compares_few_centroids():
    rng = np.random.default_rng(4)
    sample = rng.normal(size=(posting_lists.SAMPLE, 12))
    index = posting_lists.fit(sample, 10**8)
    assert len(index.points) == posting_lists.MOST_LISTS
    x, wanted = sample[:200], 16
    found, far, compared = index.walk(x, wanted)
    every = np.linalg.norm(x[:, None, :] - index.points, axis=2)
    nearest = np.argsort(every, axis=1)[:, :wanted]
    assert np.mean([len({*a} & {*b}) / wanted for a, b in zip(found.tolist(), nearest.tolist())]) >= 0.9
    assert compared <= 0.2 * every.size
    assert np.allclose(far, np.take_along_axis(every, found, axis=1)) and (np.diff(far, axis=1) >= 0).all()
    # All of them, where as many are wanted as there are.
    whole = posting_lists.fit(sample[:256], 10**8)
    assert (np.sort(whole.nearest(x, 10**6)[0], axis=1) == np.arange(len(whole.points))).all()
    one = posting_lists.fit(sample[:3], 3)
    assert one.nearest(x, 5)[0].tolist() == [[0]] * len(x)


def test_a_query_in_a_tight_cluster_still_finds_enough(spark, monkeypatch):
    for name, value in (("LIST_SIZE", 30), ("LEAST", 200)):
        monkeypatch.setattr(posting_lists, name, value)
    rng = np.random.default_rng(8)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(1, 600)] + [(i, (8 + rng.normal(size=16) * 1e-3).tolist()) for i in (1000, 1001)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [r["vec_id"] for r in posting_lists.search(df, F.col("id") == 1000).orderBy("rank").collect()]
    assert len(got) == 10 and got[0] == 1001


def test_neighbours_of_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (100, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]),
            (6, [None, 1.0]), (7, [float("inf"), 0.0]), (8, [1.0, 2.0, 3.0]), (200, [0.0, 0.0]), (1, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("list", F.lit(1))
    got = [tuple(r) for r in posting_lists.search(df, F.col("id") % 100 == 0).orderBy("query_id", "rank").collect()]
    root = 2**0.5
    assert got == [(0, 1, 1, 0.0), (0, 2, 2, 0.0), (0, 3, 100, root), (100, 1, 0, root), (100, 2, 1, root), (100, 3, 2, root)]
    assert posting_lists.search(df.where("false"), F.col("id") % 100 == 0).collect() == []


def test_tool_calls(spark):
    schemas = {"find": {"n": tool_chat.Field("integer", least=1, most=9), "q": tool_chat.Field("string"), "x": tool_chat.Field("number", required=False)}}
    calls = spark.createDataFrame(
        [
            ("a", "find", '{"q": "é\\n", "n": 3}', None),
            ("b", "find", '{"q": 1, "n": 30, "z": 0}', "a"),
            ("b", "find", '{"q": 1, "n": 30, "z": 0}', "a"),
            ("c", "find", "not json", "b"),
            ("d", "other", "{}", "gone"),
            ("e", "find", None, "f"),
            ("f", "find", "[1]", "e"),
            (None, "find", '{"n": 1.5}', "a"),
        ],
        "call_id string, tool string, arguments string, after_id string",
    )
    results = [("a", "r2"), ("a", "r1"), ("a", "r1"), ("zz", "lost"), ("zz", "lost too"), (None, "nobody's"), (None, "nor theirs"), ("b", None)]
    results = spark.createDataFrame(results, "call_id string, result string")
    calls = calls.unionByName(spark.createDataFrame([("d", "zzz", "{}", None)], calls.schema))
    notes = spark.createDataFrame([("s", "system", "be kind"), (None, None, None)], "note_id string, role string, text string")
    rows = tool_chat.format_calls(calls, results, schemas, notes).collect()
    got = {r["call_id"]: r for r in rows if r["kind"] == "call"}
    assert {k: r["level"] for k, r in got.items()} == {"a": 0, "b": 1, "c": 2, "d": 0, "e": None, "f": None, None: 0}
    assert got["a"]["errors"] == [] and got["a"]["n_results"] == 3 and got["b"]["n_calls"] == 2
    assert got["a"]["message"] == '{"arguments":{"n":3,"q":"é\\n"},"id":"a","result":"r1","tool":"find"}'
    assert got["b"]["errors"] == ["unknown: z", "n: too large", "q: not a string"]
    assert got["c"]["errors"] == ["not an object"] == got["f"]["errors"] == got["e"]["errors"]
    assert got["d"]["errors"] == ["unknown tool"]
    assert got[None]["errors"] == ["n: not a integer", "q: missing"]
    lost = sorted((r["call_id"] or "", json.loads(r["message"])["result"]) for r in rows if r["kind"] == "orphan")
    assert lost == [("", "nobody's"), ("", "nor theirs"), ("zz", "lost"), ("zz", "lost too")]
    again = sorted((r["call_id"], r["n_calls"], r["n_results"], r["message"]) for r in rows if r["kind"] == "duplicate")
    assert again == [("a", 0, 1, '{"id":"a","result":"r2"}'), ("d", 1, 0, '{"arguments":{},"id":"d","result":null,"tool":"zzz"}')]
    assert [r["message"] for r in rows if r["kind"] == "note" and r["call_id"]] == ['{"id":"s","role":"system","text":"be kind"}']
    for r in rows:
        assert json.dumps(json.loads(r["message"]), sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r["message"]
    assert tool_chat.format_calls(calls.where("false"), results.where("false"), schemas).collect() == []


def test_levels_of_long_chains(spark):
    rows = [(f"n{i}", f"n{i - 1}" if i else None) for i in range(150)] + [(f"s{i}", "n149") for i in range(20)]
    got = {r["call_id"]: r["level"] for r in tool_chat.levels(spark.createDataFrame(rows, "call_id string, after_id string")).collect()}
    assert all(got[f"n{i}"] == i for i in range(150)) and got["s3"] == 150


def test_pipeline_equals_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    rows = {r["doc_id"]: r for r in docs.collect()}
    model = language.trained(docs)
    first = {}
    for i, r in sorted(rows.items()):
        if language.has_letter(r["text"]):
            chance = model.decode(model.margins(r["text"]))
            if chance.max() >= 0.5:
                first.setdefault(r["text"], (i, model.languages[int(chance.argmax())]))
    left = {i: lang for i, lang in first.values()}
    order = [(i, rows[i]["text"]) for i in left]
    gone = plain_near(order)
    kept = [i for k, (i, _) in enumerate(order) if k not in gone]
    frame = spark.createDataFrame([(i, rows[i]["text"], left[i], rows[i]["source"]) for i in kept], "doc_id long, text string, lang string, source string")
    mixed = {r["doc_id"] for r in mixing.mix(frame, queries.TARGETS, rate=queries.MIX_RATE, seed=queries.MIX_SEED).where("kept").collect()}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in got} == mixed and len(got) == len(mixed)
    assert all(r["round_trip"] and r["n_tokens"] == len(r["token_ids"]) and r["lang"] == left[r["doc_id"]] for r in got)


def test_stages_take_empty_and_odd_tables(spark):
    odd = spark.createDataFrame(
        [(1, None, None, None, None), (2, "", "en", "src1", 0), (3, "the same words here", "en", None, 1), (4, "the same words here", None, "src0", 1)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, odd.where("false")):
            out = stage(spark, docs, SF)
            out.collect()
            assert name == "byte_bpe" or tuple(out.columns) == corpus_pipeline.COLUMNS
    assert {r["doc_id"] for r in corpus_pipeline.drop_copies(spark, odd, SF).collect()} == {1, 3}
    assert exact_dedup.deduplicate(odd).count() == 2


def test_mixing_sql_holds_for_unnamed_and_empty_cells(spark, tmp_path):
    """Sources and languages without a target, and cells whose texts are all empty."""
    kinds = [(s, v) for s in ("src0", "src1", "elsewhere", None) for v in ("en", "fr", "pt", None)]
    rows = [(100 * i + k, "" if kind == ("src1", "fr") or i == 5 else "a b c d " * (1 + i % 3), *kind) for i in range(20) for k, kind in enumerate(kinds)]
    rows += [(9000 + i, text, "src5", "de") for i, text in enumerate([None, "", " "])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    outcome, detail, _ = compare(spark, con, str(tmp_path), "op7_mixing", queries.op7_mixing, queries.OP7_SQL)
    assert outcome == "same", detail
    got = {r["doc_id"]: r for r in queries.op7_mixing(spark, str(tmp_path)).collect()}
    assert {got[i]["probability"] for i in (9000, 9001, 9002)} == {queries.MIX_RATE} and got[9000]["weight"] == 1


def test_tool_chat_sql_holds_for_repeated_turns(spark, tmp_path):
    rows = [(1, 0, "system", "be brief"), (1, 1, "user", "one"), (1, 2, "assistant", "two"), (1, 1, "user", "another one"), (1, 1, "user", "one"),
            (1, 2, "assistant", "zwei"), (1, 2, "assistant", None), (2, 4, "assistant", "no call"), (2, 4, "assistant", "nor here"),
            (3, 3, None, "no role"), (3, 5, "user", "a\nb"), (3, 7, "user", "x")]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    outcome, detail, _ = compare(spark, con, str(tmp_path), "op3_tool_chat", queries.op3_tool_chat, queries.OP3_SQL)
    assert outcome == "same", detail
