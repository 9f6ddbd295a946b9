"""The Merkle manifest against a plain version."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from fundledger.llm import merkle, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def plain_hash(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return plain_hash(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_tree(nodes):
    """(root, the left and right siblings of each node, leaf level first)."""
    level, paths, owners = list(nodes), [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(level) > 1:
        ups, below = [], []
        for a in range(0, len(level), 3):
            run = level[a : a + 3]
            for k in range(len(run)):
                for i in owners[a + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            ups.append(plain_hash(*run))
            below.append(sum(owners[a : a + 3], []))
        level, owners = ups, below
    return level[0], paths


def plain_proofs(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((plain_leaf(r, r["text"]), r))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda x: (x[1]["doc_id"] is not None, x[1]["doc_id"] or 0, x[0]))
        trees[s] = plain_tree([leaf for leaf, _ in groups[s]])
    root, above = plain_tree([trees[s][0] for s in names])
    out = []
    for s, more in zip(names, above):
        for (leaf, r), path in zip(groups[s], trees[s][1]):
            text, own = r["text"], r["doc_id"]
            if text is not None and own is not None and zlib.crc32(str(own).encode()) % 2 == 0:
                text = text.replace("\n", "")
            acc = plain_leaf(r, text)
            for left, right in path + more:
                acc = plain_hash(left, acc, right)
            proof = plain_hash(*[x for pair in path + more for x in pair])
            out.append((own, leaf, trees[s][0], root, proof, acc, acc == root))
    return out


def by_text(rows):
    return sorted(map(str, rows))


@pytest.mark.parametrize("sources", [1, 3, 14])
def test_proofs_equal_a_plain_version(spark, tmp_path, sources):
    rows = [
        {"doc_id": i, "text": f"text {i}\nmore", "lang": "en", "source": None if i % (sources + 1) == sources else f"s{i % (sources + 1) % 5}é{i % (sources + 1)}", "n_chars": i}
        for i in range(173)
    ]
    rows += [
        {"doc_id": 9000, "text": None, "lang": None, "source": "only", "n_chars": None},
        {"doc_id": 9001, "text": "", "lang": "", "source": "", "n_chars": 0},
        {"doc_id": None, "text": "a\nb", "lang": "en", "source": "s", "n_chars": 1},
        {"doc_id": None, "text": "c\n", "lang": "en", "source": "s", "n_chars": -1},
        {"doc_id": 7, "text": "the same id\n", "lang": "en", "source": "s1é1", "n_chars": 5},
        {"doc_id": 8, "text": "x", "lang": "en", "source": "s", "n_chars": 5},
        {"doc_id": 8, "text": "x", "lang": "en", "source": "s", "n_chars": 5},
        {"doc_id": 9002, "text": "long \n" * 60_000, "lang": "en", "source": "s", "n_chars": 5},
    ]
    df = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], SCHEMA)
    df = df.withColumns({"tree": F.lit(1), "digest": F.lit("x"), "path": F.lit(0), "rank": F.lit(9)}).repartition(5)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in queries.op13_merkle(spark, str(tmp_path)).collect()]
    assert by_text(got) == by_text(plain_proofs(rows))


def test_empty_tables_have_no_proofs(spark):
    empty = spark.createDataFrame([], SCHEMA)
    out = merkle.proofs(empty)
    assert out.collect() == [] and out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_some_requests_get_the_same_proofs(spark):
    df = spark.createDataFrame([(i, f"t{i}", "en", f"s{i % 4}", i) for i in range(120)], SCHEMA)
    made = merkle.manifest(df)
    every = {r["doc_id"]: r["path"] for r in merkle.prove(made).collect()}
    asked = made.leaves.where("doc_id % 17 = 0").select("tree", "rank")
    some = {r["doc_id"]: r["path"] for r in merkle.prove(made, asked).collect()}
    assert some == {i: p for i, p in every.items() if i % 17 == 0} and len(every) == 120
    # Records are stored by content: no two of one level differ in children under one digest.
    for level in made.levels:
        assert level.groupBy("digest").agg(F.count_distinct("children").alias("n")).where("n > 1").isEmpty()
