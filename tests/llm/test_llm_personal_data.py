"""Personal data: patterns against plain expressions, messages against enumeration, labels carried on."""

import hashlib
import itertools
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundledger.llm import personal_data as pd11
from fundledger.llm import queries

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) if k % 2 == 0 else sum(divmod(2 * int(d), 10)) for k, d in enumerate(digits[::-1])]
    return sum(doubled) % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 16 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 8 <= len(digits) <= 15,
            }[kind]()
            if fine:
                out.append((kind, m.start(), m.end()))
    return out


def named(spans):
    return [(pd11.KINDS[k], a, b) for k, a, b in spans]


ODD = [
    None, "", "@", "a@b", "a@b.c@d.e", "a@b@c.d", "x@y..z", "x@y.z.", "+@+.+", "a.b+c%d@e-f.g-h.i", "é@b.cc", "ü.a@b.cc.", "1.2.3.4.5.6.7.8", "999.1.1.1.1", "1.2.3",
    "001.002.003.004 256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1111 2", "4111  1111 1111 1111", "4111111111111112", "+1 (988) 555-2485", "+1", "+12", "+123", "+1 ", "+1234567)", "++49 (0)170.1234567-",
    "٣.٤.٥.٦", "a@b.c,d@e.f;g@h.i", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "0" * 400 + ".1.1.1", "1.1.1." + "9" * 5000,
]


def test_patterns_equal_the_plain_expressions():
    rng = random.Random(4)
    texts = [t or "" for t in ODD[:-1]] + ["".join(rng.choices("ab@.-+19 ()", k=rng.randint(1, 60))) for _ in range(4000)]
    texts += ["".join(rng.choices("0123456789 -.+", k=rng.randint(10, 80))) for _ in range(2000)]
    for t in texts:
        assert named(pd11.patterns(t)) == plain(t), repr(t)
    assert pd11.patterns(ODD[-1]) == []


def test_long_texts_take_linear_time():
    begin = time.time()
    for part in ("a", "a@", "1", "1.", "+1", "1 ", "(", "@a.b", "x1 ", "+1 (988) 555-2485 "):
        text = part * (400_000 // len(part))
        pd11.spread(pd11.fit([]), [(text, pd11.patterns(text))])
    assert time.time() - begin < 120


def test_messages_give_exact_marginals_on_trees_and_near_ones_on_loops():
    rng = np.random.default_rng(3)
    labels = len(pd11.KINDS) + 1
    pots = pd11.Field(rng.normal(size=(pd11.FEATURES, labels)), rng.normal(size=(labels, labels)) / 2, np.eye(labels))
    for chain, skips, close in (([(0, 1), (1, 2)], [], 1e-3), ([(0, 1)], [(1, 3), (3, 4)], 1e-3), ([(0, 1), (2, 3)], [(0, 2), (1, 3)], 0.05)):
        n = 5
        forms, allowed = rng.random((n, pd11.FEATURES)), rng.random((n, labels)) < 0.8
        allowed[:, 0] = True
        got = pd11.marginals(pots, forms, allowed, *(np.array(x, dtype=int).reshape(-1, 2) for x in (chain, skips)), 200)
        left, right = {j for _, j in chain}, {i for i, _ in chain}
        node = forms @ pots.form
        exact = np.zeros((n, labels))
        for y in itertools.product(range(labels), repeat=n):
            if all(allowed[i, v] for i, v in enumerate(y)):
                score = sum(node[i, v] + (i not in left) * pots.chain[0, v] + (i not in right) * pots.chain[v, 0] for i, v in enumerate(y))
                score += sum(pots.chain[y[i], y[j]] for i, j in chain) + sum(pots.skip[y[i], y[j]] for i, j in skips)
                exact[range(n), y] += np.exp(score)
        assert np.abs(got - exact / exact.sum(axis=1, keepdims=True)).max() < close


@pytest.fixture(scope="module")
def field(spark):
    return pd11.trained(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def added(field, text):
    more = pd11.spread(field, [(text, pd11.patterns(text))])[0]
    return [(pd11.KINDS[k], text[a:b]) for k, a, b in more]


def test_labels_are_carried_to_words_alike(field):
    assert added(field, "call +1 (988) 555-2485 now, or later (988) 555-2485, he said") == [("phone", "555-2485")]
    assert added(field, "write to bosbt.42@mail8.example.com. Then BOSBT.42@mail8 wrote") == [("email", "BOSBT.42@mail8")]
    assert added(field, "from 42.144.35.254 and so on: host 42.144.35.254:80") == []
    assert added(field, "card 4041894974608795 is 4041-8949-7460-8795; 994041894974608795000") == []
    assert added(field, "the year 2024, room 42 and password=b7db7aa4a5fcc78305, call +1 (988) 555-2485") == []
    assert added(field, "no match here: (988) 555-2485 and again (988) 555-2485, 4041894974608796 4041894974608796") == []
    assert added(field, "") == []


def test_query_on_odd_rows(spark, tmp_path):
    texts = ODD + ["tel +1 (988) 555-2485 | tel 555-2485 555-2485", "é ü bosbt.42@mail8.example.com 1.2.3.4 bosbt.42"]
    df = spark.createDataFrame([(i if i else None, t) for i, t in enumerate(texts)] + [(1, "")], "doc_id long, text string")
    df.withColumns({"base": F.lit(1), "added": F.lit(2), "kind": F.lit(3)}).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.op11_personal_data(spark, str(tmp_path)).collect()
    assert len(rows) == len(texts) + 1
    got = {r["doc_id"] or 0: r for r in rows}
    for i, t in enumerate(texts):
        base = [] if t == ODD[-1] else plain(t)
        assert got[i]["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in PLAIN] == [sum(b[0] == k for b in base) for k in PLAIN]
        spans = [tuple(s.split(":")) for s in got[i]["spans"].split(",") if s]
        assert {(k, str(a), str(b)) for k, a, b in base} <= set(spans)
        assert spans == sorted(spans, key=lambda s: (pd11.KINDS.index(s[0]), int(s[1]), int(s[2])))
    (tmp_path / "none").mkdir()
    df.where("false").write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert queries.op11_personal_data(spark, str(tmp_path / "none")).collect() == []
