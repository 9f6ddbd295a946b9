"""Tokens, fingerprints, exact copies and repeats against plain versions."""

import base64
import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline

from fundledger.llm import byte_bpe, exact_dedup, simhash, substring_dedup, suffix_dedup, token_counts
from fundledger.llm.components import components

SF = "/root/testdata/sf0.001"
RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [
    None, "", " ", "a", "\n\n\t  x ", "a" * 3000, "ab" * 700, "aab" * 300, " " * 900, "é" * 400, "日本語" * 90, "🙂 " * 50,
    "it's we'll they'd 12345 x1y2", "\x1c\x1d a\x85b\xa0c", "=-" * 150, "the" * 200, "İstanbul ĞÜ ſ K",
]


def frame(spark, texts, first=0):
    """Documents with columns whose names operators use inside."""
    rows = [(first + i, t, "x", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, token_ids string, fp int").repartition(3)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def plain_bpe():
    with open(RANK_FILE, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_public_encoder_and_decodes_back(spark, plain_bpe):
    texts = ODD + ["<|endoftext|>"] + [r["text"] for r in documents(spark).select("text").collect()]
    coded = byte_bpe.encode(frame(spark, texts), RANK_FILE, public_tokenizers.PATTERN, ids_col="ids")
    rows = byte_bpe.decode(coded, RANK_FILE, "ids").collect()
    assert len(rows) == len(texts) and set(coded.columns) >= {"token_ids", "fp", "text"}
    for row in rows:
        assert row["ids"] == plain_bpe.encode_ordinary(texts[row["doc_id"]] or "")
        assert bytes(row["decoded"]) == (texts[row["doc_id"]] or "").encode()


def test_bpe_long_and_matrix_forms_agree(plain_bpe):
    ranks, rng = byte_bpe.read_ranks(RANK_FILE), random.Random(1)
    words = ["".join(rng.choice("abcehint") for _ in range(rng.randint(2, 250))).encode() for _ in range(150)]
    assert byte_bpe.encode_distinct(words, ranks) == [byte_bpe.merge_long(w, ranks) for w in words]


def test_bpe_cache_overflow_changes_nothing(plain_bpe, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE", 5)
    coder = byte_bpe.Encoder(byte_bpe.read_ranks(RANK_FILE), public_tokenizers.PATTERN)
    for text in ("one two three four five", "two three six", "seven one two"):
        assert coder.encode_batch([text])[0].tolist() == plain_bpe.encode_ordinary(text)


def test_decode_refuses_unknown_ids(spark):
    bad = spark.createDataFrame([([1, 50256],)], "token_ids array<int>")
    with pytest.raises(Exception, match="vocabulary"):
        byte_bpe.decode(bad, RANK_FILE).collect()


def test_bpe_of_an_empty_table(spark):
    none = frame(spark, ["x"]).where("false")
    assert byte_bpe.decode(byte_bpe.encode(none, RANK_FILE, public_tokenizers.PATTERN), RANK_FILE).collect() == []


def plain_fingerprint(text, width=3):
    words = (text or "").encode().translate(simhash._LOWER).split()
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def plain_components(pairs, nodes):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    return {n: top(n) for n in nodes}


def test_masks_cover_every_pair_within_the_radius():
    rng = random.Random(2)
    for _ in range(3000):
        flip = sum(1 << i for i in rng.sample(range(64), rng.randint(0, 2)))
        assert any(flip & m == 0 for m in simhash.covering_masks())


def test_simhash_classes_equal_brute_force(spark):
    texts = [r["text"] for r in documents(spark).orderBy("doc_id").select("text").collect()] + ODD + ODD[:6] + ["A b C", "a B c"]
    rows = simhash.near_duplicates(frame(spark, texts)).collect()
    assert len(rows) == len(texts)
    prints = {i: plain_fingerprint(t) for i, t in enumerate(texts)}
    near = [(i, j) for i in prints for j in prints if i < j and (prints[i] ^ prints[j]).bit_count() <= 2]
    expected = plain_components(near, prints)
    assert {r["doc_id"]: r["component_id"] for r in rows} == expected
    assert all(r["fp"] % (1 << 64) == prints[r["doc_id"]] for r in rows)


@pytest.mark.parametrize("paired", [1, 4, 1000])
def test_crowded_keys_lose_no_link(spark, paired):
    rng = random.Random(3)
    prints = {rng.getrandbits(64) for _ in range(5)}
    for _ in range(120):
        base = rng.choice(sorted(prints))
        prints.add(base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    nodes = {i: p for i, p in enumerate(sorted(prints))}
    df = spark.createDataFrame([(i, simhash._signed(p)) for i, p in nodes.items()], "node long, fp long")
    found = {r["node"]: r["component"] for r in components(simhash.links(df, paired)).collect()}
    near = [(i, j) for i in nodes for j in nodes if i < j and (nodes[i] ^ nodes[j]).bit_count() <= 2]
    expected = plain_components(near, nodes)
    assert {n: found.get(n, n) for n in nodes} == expected



def test_components_of_chains_stars_and_nothing(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 80)] + [(7, 7), (None, 3)]
    rows = components(spark.createDataFrame(links, "u long, v long")).collect()
    assert {r["node"]: r["component"] for r in rows} == plain_components([p for p in links if None not in p], {n for p in links for n in p if n is not None and n != 7 or n == 7})
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_exact_groups_with_colliding_hashes(spark):
    texts = ["a", "b", "a", None, "", "b", "A", "a "]
    rows = exact_dedup.groups(frame(spark, texts), keep="largest", hashed=lambda t: F.unhex(F.lit("00"))).collect()
    members = defaultdict(list)
    for i, t in enumerate(texts):
        members[t or ""].append(i)
    for r in rows:
        own = members[texts[r["doc_id"]] or ""]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (max(own), len(own), r["doc_id"] == max(own))
        assert r["text_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()
    assert len(rows) == len(texts)


def test_exact_dedup_of_repeated_rows_null_ids_and_nothing(spark):
    rows = [(1, "x"), (1, "x"), (2, "x"), (None, "y"), (None, "y"), (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((str(r["doc_id"]), r["text"] or "") for r in exact_dedup.deduplicate(docs).collect())
    assert kept == [("1", "x"), ("3", ""), ("None", "y")]
    assert exact_dedup.groups(docs.where("false")).collect() == []


def repeated_texts(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 4))) for _ in range(14)]
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared, texts = [some(40) for _ in range(5)], []
    for _ in range(90):
        text = some(rng.randint(1, 50))
        if rng.random() < 0.5:
            text += " " + rng.choice(shared) + "\n\t" + some(rng.randint(0, 15))
        if rng.random() < 0.2 and texts:
            text = rng.choice(texts) + some(2)
        if rng.random() < 0.1:
            text += " ab" * 90
        texts.append(text)
    return texts + ["", None, "x" * 450, "é " * 300, texts[3], texts[3]]


def plain_words_removed(docs, length):
    first, words = {}, [(d, (t or "").encode().split()) for d, t in docs]
    for d, w in words:
        for i in range(len(w) - length + 1):
            key = tuple(w[i : i + length])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if first[tuple(w[i : i + length])] < d:
                gone[i : i + length] = [True] * length
        kept = b" ".join(x for x, y in zip(w, gone) if not y)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("length,crowd", [(13, 2000), (7, 2)])
def test_substring_dedup_equals_brute_force(spark, length, crowd):
    rng, texts = random.Random(5), repeated_texts(5)
    docs = list(zip(rng.sample(range(-500, 10**9), len(texts)), texts)) + [(11, "k l " * 40), (11, "k l " * 40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("start", F.lit(1)).repartition(4)
    found = substring_dedup.remove_repeats(df, length, crowd=crowd)
    assert sorted(tuple(r) for r in found.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()) == plain_words_removed(docs, length)


def test_substring_dedup_of_null_ids_and_nothing(spark):
    docs = spark.createDataFrame([(None, "a " * 30), (1, "a " * 30)], "doc_id long, text string")
    assert [r["n_removed"] for r in substring_dedup.remove_repeats(docs).collect()] == [0, 0]
    assert substring_dedup.remove_repeats(docs.where("false")).collect() == []


def plain_bytes_removed(docs, length):
    seen = Counter(t[i : i + length] for _, t in docs for i in range(len(t) - length + 1))
    out = []
    for d, t in docs:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(t), sum(gone), runs, hashlib.sha256(bytes(c for c, x in zip(t, gone) if not x)).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("length,crowd", [(200, 1000), (50, 2)])
def test_suffix_dedup_equals_brute_force(spark, length, crowd):
    texts = repeated_texts(6)
    df = frame(spark, texts).withColumn("mark", F.lit("m"))
    found = suffix_dedup.remove_repeats(df, length, crowd=crowd).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert sorted(tuple(r) for r in found.collect()) == plain_bytes_removed([(i, (t or "").encode()) for i, t in enumerate(texts)], length)
    assert suffix_dedup.remove_repeats(df.where("false"), length).collect() == []


def test_multikey_sort_finds_equal_suffixes():
    rng = np.random.default_rng(4)
    body = rng.integers(0, 2, 4000).astype(np.uint8)
    starts = np.arange(0, 3900)
    for length in (8, 13, 21, 64):
        pieces = [body[s : s + length].tobytes() for s in starts]
        count = Counter(pieces)
        assert suffix_dedup.tied(body, starts, length).tolist() == [count[p] > 1 for p in pieces]


def plain_count(token, scores, longest):
    best = [(0.0, 0)]
    for end in range(1, len(token) + 1):
        options = []
        for start in range(max(0, end - longest), end):
            if token[start:end] in scores:
                options.append((best[start][0] + scores[token[start:end]], -(best[start][1] + 1)))
        top = max(options)
        best.append((top[0], -top[1]))
    return best[-1][1]


def test_trie_counts_equal_separate_programmes(spark):
    scores = token_counts.zipf_scores(RANK_FILE)
    longest, split = max(map(len, scores)), byte_bpe.Splitter(public_tokenizers.PATTERN)
    texts = [t for t in ODD if t is None or len(t) < 500] + [r["text"] for r in documents(spark).limit(20).select("text").collect()]
    got = {r["doc_id"]: r for r in token_counts.count_tokens(frame(spark, texts), RANK_FILE, public_tokenizers.PATTERN).collect()}
    for i, text in enumerate(texts):
        words = [w.encode() for w in split(text or "")]
        assert got[i]["n_pretokens"] == len(words)
        assert got[i]["n_tokens"] == sum(plain_count(w, scores, longest) for w in words)
        assert (got[i]["n_tokens"] == 0) == (not text)


def test_trie_shares_prefixes_of_long_pretokens():
    scores = token_counts.zipf_scores(RANK_FILE)
    tokens = [b"a" * n for n in (1, 700, 699, 3)] + [b"", b"b" * 500 + b"c", b"b" * 500 + b"d"]
    assert token_counts.trie_counts(tokens, scores, 128) == [plain_count(t, scores, 128) for t in tokens]


def plain_near(rows):
    """Keys (id, text) of rows of (id, text) that go: all but the smallest id of each group of linked fingerprints."""
    prints = {k: simhash.fold(simhash.shingle_hashes(t, 3)) for k, (_, t) in enumerate(rows)}
    near = [(i, j) for i in prints for j in prints if i < j and (prints[i] ^ prints[j]).bit_count() <= 2]
    groups = defaultdict(list)
    for k, c in plain_components(near, prints).items():
        groups[c].append(k)
    return {k for g in groups.values() for k in g if rows[k][0] != min(rows[x][0] for x in g)}


def test_near_copies_go_and_rows_that_share_their_id_stay(spark):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id < 300").orderBy("doc_id").collect()]
    rows = [*enumerate(texts), (900, texts[3]), (7, "an unrelated text under a used id"), (901, None), (902, ""), (903, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"fp": F.lit(1), "_other": F.lit("x"), "component_id": F.lit(2)})
    left = simhash.drop_near_copies(df)
    gone = plain_near(rows)
    assert left.columns == df.columns and len(gone) > 5
    assert sorted((r["doc_id"], r["text"] or "") for r in left.collect()) == sorted((i, t or "") for k, (i, t) in enumerate(rows) if k not in gone)
    assert simhash.drop_near_copies(df.where("false")).collect() == []
    nameless = spark.createDataFrame([(None, "a b c d"), (5, "a b c d"), (None, None)], "doc_id long, text string")
    assert sorted((r["text"] or "") for r in simhash.drop_near_copies(nameless).collect()) == ["", "a b c d"]


def test_kinds_are_extended_word_by_word():
    """Windows of kinds round one anchor against all pairs of windows, with words that look alike when joined."""
    rng = random.Random(11)
    core, length = [b"k%d" % i for i in range(substring_dedup.GRAM)], substring_dedup.GRAM + 4
    for _ in range(30):
        docs, anchors, at, words = [], [], [], []
        for _ in range(rng.randint(1, 12)):
            before, after = rng.randint(0, 4), rng.randint(0, 4)
            if before + after < 4:
                after = 4 - before
            docs.append(rng.randint(0, 5)), anchors.append(rng.randint(1, 2)), at.append(before)
            words.append([rng.choice([b"a", b"aa"]) for _ in range(before)] + core + [rng.choice([b"b", b"bb"]) for _ in range(after)])
        cut = [[tuple(w[i : i + length]) for i in range(len(w) - length + 1)] for w in words]
        expected = [
            (k, i) for k, own in enumerate(cut) for i, x in enumerate(own)
            if any(anchors[j] == anchors[k] and docs[j] < docs[k] and x in cut[j] for j in range(len(cut)))
        ]
        kind, first = substring_dedup.extend(np.array(docs), np.array(anchors), np.array(at), words, length)
        assert list(zip(kind.tolist(), first.tolist())) == expected


def test_substring_dedup_of_very_long_words(spark):
    rng = random.Random(3)
    shared = ["x" * 5000 + str(i) if i % 4 == 0 else f"w{i}" for i in range(20)]
    texts = [" ".join([*(f"p{d}{rng.random()}" for _ in range(9)), *shared, *(f"s{d}{rng.random()}" for _ in range(9))]) for d in range(3)]
    texts.append(texts[0].replace("x" * 5000 + "8", "x" * 4999 + "y8"))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in substring_dedup.remove_repeats(rows).collect()}
    # The fourth text differs in its eighteenth word: 17 words before it and 20 after it are of the first.
    assert got == {0: 0, 1: 20, 2: 20, 3: 37}
