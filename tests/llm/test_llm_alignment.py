"""Cross-tokenizer alignment against a plain version."""

import hashlib
import json
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fundledger.llm import alignment, queries

PATHS = public_tokenizers.path(queries.BYTE_FILE), public_tokenizers.PATTERN, public_tokenizers.path(queries.PIECE_FILE)

ODD = [
    None, "", " ", "  two  spaces ", "\n\n\ttabs\r\n", "<|endoftext|> as text", "<s></s><unk>", "caña über naïve é", "日本語のテキスト", "🙂🙃 emoji 👩‍👩‍👧",
    "a▁b", "▁", " hard space　wide", "zero​width ﻿", "x" * 5000, "word " * 3000, "1234567890" * 40, "don't we'll I'D", "\x00\x01\x1f\x85",
    "ﬁ ligature ½ ²", "é combined", "Ⅷ 𝟘𝟙", "same text", "same text", "مرحبا", "a" + "̀" * 50,
]


def plain(texts):
    a_side = Tokenizer.from_file(PATHS[0])
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=PATHS[2])
    letters = alignment.byte_letters()
    names = {i: p for p, i in json.load(open(PATHS[0], encoding="utf-8"))["model"]["vocab"].items()}

    def b_bytes(i):
        piece = b_side.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_side.is_byte(i) else piece.replace("▁", " ").encode()

    def spans(parts):
        at, out = 0, []
        for p in parts:
            out.append((at, at + len(p)))
            at += len(p)
        return out

    made = []
    for t in texts:
        a = a_side.encode(" " + t, add_special_tokens=False).ids if t else []
        b = b_side.encode(t) if t else []
        x, y = [bytes(letters[c] for c in names[i]) for i in a], [b_bytes(i) for i in b]
        if t and not b"".join(x) == b"".join(y) == (" " + t).encode():
            a, b, x, y = [], [], [], []
        x, y = spans(x), spans(y)
        links = [(a[i], b[j]) for i, (s, e) in enumerate(x) for j, (u, v) in enumerate(y) if s < v and u < e] if len(x) < 2500 else None
        if links is None:
            links, j = [], 0
            for i, (s, e) in enumerate(x):
                while y[j][1] <= s:
                    j += 1
                k = j
                while k < len(y) and y[k][0] < e:
                    links.append((a[i], b[k]))
                    k += 1
        groups, i, j = [], 0, 0
        for stop in sorted({e for _, e in x} & {e for _, e in y}):
            p, q = i, j
            while i < len(x) and x[i][1] <= stop:
                i += 1
            while j < len(y) and y[j][1] <= stop:
                j += 1
            groups.append(",".join(map(str, a[p:i])) + "|" + ",".join(map(str, b[q:j])))
        made.append((len(a), len(b), groups, links))
    counts = Counter(p for *_, links in made for p in set(links))
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    digest = lambda groups: hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
    return [
        (a, b, len(g), len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links), digest(g)) for a, b, g, links in made
    ]


@pytest.mark.parametrize("block_bytes", [1, 5000, 4 << 20])
def test_alignment_equals_a_plain_version(spark, block_bytes):
    texts = ODD + [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    df = df.withColumns({"block": F.lit("x"), "place": F.lit(1), "a": F.lit(2), "docs": F.lit(3)})
    rows = {r["doc_id"]: tuple(r)[1:] for r in alignment.align(df, *PATHS, block_bytes=block_bytes).collect()}
    assert rows == dict(enumerate(plain(texts)))


def test_ranks_give_the_ids_of_the_file(spark):
    """Every character that the faster way takes, in words, numbers and runs of spaces."""
    side = alignment.ByteSide(*PATHS[:2])
    some = [chr(c) for c in [*range(0x250), *range(0x2010, 0x2028), 0x20AC]]
    texts = [f" a{c}b {c} 1{c}{c}2 \n{c}'s  {c}" for c in some] + ["".join(some), " ".join(some)]
    for t in texts:
        assert not alignment._OTHER.search(t)
        assert side.fast.encode_ordinary(t) == side.own.encode(t, add_special_tokens=False).ids, repr(t)


def test_alignment_of_odd_tables(spark):
    df = spark.createDataFrame([(None, "a b"), (3, "a b"), (3, "a b"), (None, None)], "doc_id int, text string")
    rows = alignment.align(df, *PATHS).collect()
    assert sorted((r["doc_id"] or 0, r["n_a"], r["count_sum"]) for r in rows) == [(0, 0, 0), (0, 2, 6), (3, 2, 6), (3, 2, 6)]
    assert alignment.align(df.where("false"), *PATHS).collect() == []
