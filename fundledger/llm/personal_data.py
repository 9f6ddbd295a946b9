"""Personal data: patterns, and a skip-chain conditional random field that carries their labels on.

Patterns find e-mail addresses, network addresses, card and phone numbers; what they find always stays.
The field then labels the words of a document that hold a digit or ``@``. Its nodes are these words, its
edges join neighbours in the text (the chain) and words that are equal or alike wherever they stand (the
skips): the same word in any case, the same last digits of a number, the same mailbox. Potentials are
log-linear in the form of a word, in the labels of neighbours and in the labels across a skip. Loopy
sum-product messages run over all edges until they settle, so that words which are alike get one label in
the whole document: a phone number that once stands without its country code, or a mailbox without its
host, is found because it was found elsewhere in full.

Words of a pattern's match have its label as evidence. Another word may take a label only if skips lead
from it to such a word; words without digit or ``@`` have none. A document without matches therefore has
no spans, and messages run only where matches and words like them meet.

Weights are learned from ``docs`` by pseudo-likelihood, on a bounded sample (``SAMPLE`` documents of at most
``SAMPLE_CHARS`` characters, drawn by a hash): the labels are the patterns' own. Everything else
covers whole texts of all rows.

Defined results: a null text is empty and has no spans. Patterns are matched for each kind on its own,
from the left, without overlaps; spans of two kinds may overlap. Spans count code points, the end not
included. The time for a text grows with its length, not with a power of it. Repeated rows and null ids
are rows of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundledger.llm.common import arrow_rows, only

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 1000
SAMPLE_CHARS = 20_000
# A label is taken over only if the field is this sure of it.
SURE = 0.75
ROUNDS = 50

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# Begins only where a run of digits does: from inside the run the rest would match or fail alike.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_HINT = re.compile(r"[0-9@]")
_WORD = re.compile(r"\S+")
_EDGES = ".,;:!?\"'()[]<>{}"

Span = tuple[int, int, int]


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each ``@``: all that may stand before it, back to the match before, and a host with a dot."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
            last = host.end()
        at = text.find("@", at + 1)


def passes_luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def patterns(text: str) -> list[Span]:
    """(kind, start, end) of what the patterns match and the tests of each kind let pass, by kind and start."""
    out: list[Span] = []
    if "@" in text:
        out += [(0, a, b) for a, b in emails(text)]
    if not _DIGITS.search(text):
        return out
    if "." in text:
        out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(p := x.lstrip("0")) <= 3 and int(p or "0") <= 255 for x in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and passes_luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 8 <= sum(map(m[0].count, "0123456789")) <= 15]
    return out


@dataclass
class Word:
    start: int
    end: int
    place: int  # among all words of the text
    text: str
    label: int  # the pattern's, 0: none


def words_of(text: str, found: list[Span]) -> list[Word]:
    """Words with a digit or ``@``, without punctuation around them, and the label of a match that they lie in."""
    out, spans, at = [], sorted((a, b, k) for k, a, b in found), 0
    for place, m in enumerate(_WORD.finditer(text)):
        if not _HINT.search(m[0]):
            continue
        left = m.start() + len(m[0]) - len(m[0].lstrip(_EDGES))
        core = m[0].strip(_EDGES)
        if not core:
            continue
        while at < len(spans) and spans[at][1] <= left:
            at += 1
        label = next((k + 1 for a, b, k in spans[at : at + 4] if a < left + len(core) and left < b), 0)
        out.append(Word(left, left + len(core), place, core, label))
    return out


def keys_of(word: str) -> Iterator[str]:
    """What makes words alike: their lower case, the last seven digits of a number, the mailbox of an address."""
    low = word.lower()
    if len(low) > 3:
        yield "w" + low
    digits = "".join(_DIGITS.findall(low))
    if len(digits) >= 7 and len(digits) * 2 > len(low):
        yield "d" + digits[-7:]
    box = low.split("@")[0]
    if len(box) > 4 and not box.isdigit():
        yield "u" + box


FEATURES = 18


def form_of(word: str) -> np.ndarray:
    """The form of a word as numbers between 0 and 1."""
    size, digits = len(word), sum(map(word.count, "0123456789"))
    letters = sum(map(str.isalpha, word))
    dots, dashes = word.count("."), word.count("-")
    return np.array(
        [1.0, "@" in word, dots == 1, dots == 2, dots == 3, dots > 3, dashes == 1, dashes > 1, word[0] == "+", letters == 0, letters > digits,
         digits < 4, 4 <= digits < 8, 8 <= digits < 13, 13 <= digits < 20, digits >= 20, digits == size, "=" in word or "/" in word]
    ).astype(np.float64)


@dataclass
class Field:
    """Log-linear weights: of a word's form by label, of neighbours' labels, and of labels across a skip."""

    form: np.ndarray  # (FEATURES, labels)
    chain: np.ndarray  # (labels, labels): the earlier word's, the later one's
    skip: np.ndarray  # (labels, labels), symmetric


def graph_of(words: list[Word]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """(neighbours in the text, each word with the next one like it): linear in the words, however many are alike."""
    chain = [(i, i + 1) for i in range(len(words) - 1) if words[i + 1].place == words[i].place + 1]
    last: dict[str, int] = {}
    skips = set()
    for i, w in enumerate(words):
        for key in keys_of(w.text):
            if key in last:
                skips.add((last[key], i))
            last[key] = i
    return chain, sorted(skips)


def allowed_of(words: list[Word], skips: list[tuple[int, int]]) -> np.ndarray:
    """The labels each word may have: its pattern's alone; else none, or those of the words that skips lead to."""
    head = list(range(len(words)))

    def root(i: int) -> int:
        while head[i] != i:
            head[i] = head[head[i]]
            i = head[i]
        return i

    for i, j in skips:
        head[root(i)] = root(j)
    reach = np.zeros((len(words), len(KINDS) + 1), dtype=bool)
    reach[:, 0] = True
    for i, w in enumerate(words):
        reach[root(i), w.label] = True
    out = reach[[root(i) for i in range(len(words))]] if words else reach
    for i, w in enumerate(words):
        if w.label:
            out[i] = np.arange(len(KINDS) + 1) == w.label
    return out


def marginals(field: Field, forms: np.ndarray, allowed: np.ndarray, chain: np.ndarray, skips: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Loopy sum-product: each node's label probabilities. Edges are pairs of nodes; messages move at once, half damped."""
    node = forms @ field.form
    # A word without a neighbour stands beside words of no label.
    open_left, open_right = np.ones(len(node), dtype=bool), np.ones(len(node), dtype=bool)
    if len(chain):
        open_left[chain[:, 1]], open_right[chain[:, 0]] = False, False
    node = node + open_left[:, None] * field.chain[0] + open_right[:, None] * field.chain[:, 0]
    node = np.where(allowed, node, -1e9)
    pairs = np.concatenate([chain, skips])
    source, target = np.concatenate([pairs[:, 0], pairs[:, 1]]), np.concatenate([pairs[:, 1], pairs[:, 0]])
    n, c = len(pairs), len(chain)
    tables = np.concatenate([np.broadcast_to(field.chain, (c, *field.chain.shape)), np.broadcast_to(field.skip, (n - c, *field.skip.shape))])
    tables = np.concatenate([tables, tables.transpose(0, 2, 1)])
    back = np.concatenate([np.arange(n, 2 * n), np.arange(n)])
    sent = np.zeros((2 * n, node.shape[1]))
    for _ in range(rounds if n else 0):
        belief = node.copy()
        np.add.at(belief, target, sent)
        rest = (belief[source] - sent[back])[:, :, None] + tables
        top = rest.max(axis=1)
        new = top + np.log(np.exp(rest - top[:, None, :]).sum(axis=1))
        new -= new.max(axis=1, keepdims=True)
        moved = np.abs(new - sent).max()
        sent = 0.5 * sent + 0.5 * new
        if moved < 1e-4:
            break
    belief = node.copy()
    np.add.at(belief, target, sent)
    chance = np.exp(belief - belief.max(axis=1, keepdims=True))
    return chance / chance.sum(axis=1, keepdims=True)


def spread(field: Field, texts: list[tuple[str, list[Span]]]) -> list[list[Span]]:
    """The spans that the field adds to those of the patterns, for several documents at once."""
    added: list[list[Span]] = [[] for _ in texts]
    parts, words, allowed, chains, skips = [], [], [], [], []
    for d, (text, found) in enumerate(texts):
        mine = words_of(text, found) if found else []
        near, far = graph_of(mine)
        may = allowed_of(mine, far)
        if not any(not w.label and m[1:].any() for w, m in zip(mine, may)):
            continue  # no word that is like one of a match
        chains += [(i + len(words), j + len(words)) for i, j in near]
        skips += [(i + len(words), j + len(words)) for i, j in far]
        parts += [d] * len(mine)
        words += mine
        allowed.append(may)
    if not words:
        return added
    pairs = lambda some: np.array(some, dtype=np.int64).reshape(-1, 2)
    chance = marginals(field, np.array([form_of(w.text) for w in words]), np.concatenate(allowed), pairs(chains), pairs(skips))
    label, sure = chance.argmax(axis=1), chance.max(axis=1) >= SURE
    for i, (d, w) in enumerate(zip(parts, words)):
        if w.label or not label[i] or not sure[i]:
            continue
        kind, own = int(label[i]) - 1, added[d]
        near = i and parts[i - 1] == d and words[i - 1].place + 1 == w.place and own and own[-1][0] == kind and own[-1][2] == words[i - 1].end
        if near:
            own[-1] = (kind, own[-1][1], w.end)
        else:
            own.append((kind, w.start, w.end))
    return added


def fit(texts: list[str], steps: int = 1500, rate: float = 1.0, decay: float = 2e-4) -> Field:
    """Weights by pseudo-likelihood: each word's label given its form and the labels around it, which are the patterns'."""
    labels = len(KINDS) + 1
    rows, known = [], []
    for text in texts:
        words = words_of(text, patterns(text))
        chain, skips = graph_of(words)
        around = np.zeros((len(words), 3 * labels))
        around[:, 0], around[:, labels] = 1, 1
        for i, j in chain:
            around[j, :labels] = np.eye(labels)[words[i].label]
            around[i, labels : 2 * labels] = np.eye(labels)[words[j].label]
        for i, j in skips:
            around[i, 2 * labels + words[j].label] += 1
            around[j, 2 * labels + words[i].label] += 1
        rows += [np.concatenate([form_of(w.text), around[i]]) for i, w in enumerate(words)]
        known += [w.label for w in words]
    weight = np.zeros((FEATURES + 3 * labels, labels))
    # Words that are alike have one label unless the sample says otherwise.
    weight[FEATURES + 2 * labels :] = 3 * np.eye(labels)
    if rows:
        x, y = np.array(rows), np.eye(labels)[known]
        start = weight.copy()
        for _ in range(steps):
            score = x @ weight
            chance = np.exp(score - score.max(axis=1, keepdims=True))
            chance /= chance.sum(axis=1, keepdims=True)
            weight -= rate * (x.T @ (chance - y) / len(x) + decay * (weight - start))
    form, before, behind, skip = np.split(weight, [FEATURES, FEATURES + labels, FEATURES + 2 * labels])
    return Field(form, (before + behind.T) / 2, (skip + skip.T) / 2)


def trained(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, chars: int = SAMPLE_CHARS) -> Field:
    """A field fitted on up to ``sample`` texts with a digit or ``@``, of at most ``chars`` characters each."""
    rows = only(docs, id_col, text_col).where(F.length("text") <= chars).where(F.col("text").rlike("[0-9@]"))
    drawn = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    # About twice the sample by the hash alone, so that little more than it is ever gathered.
    share = min(1.0, 2 * sample / max(1, rows.count())) * (1 << 30)
    drawn = rows.where(drawn < int(share)).orderBy(drawn, "doc_id").limit(sample)
    return fit(drawn.select("text").toArrow().column(0).to_pylist())


def find(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, base and added (arrays of kind, start, end).

    ``base`` is what the patterns find, ``added`` what the field finds beyond.
    """
    arrow_rows(docs.sparkSession)
    rows = only(docs, id_col, text_col)
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    lists = lambda all_spans: pa.array([[(KINDS[k], a, b) for k, a, b in sorted(s)] for s in all_spans], pa.list_(span))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            base = [patterns(t) for t in texts]
            more = spread(field, list(zip(texts, base)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists(base), lists(more)], ["doc_id", "base", "added"])

    kinds = "array<struct<kind:string,start:bigint,end:bigint>>"
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, base {kinds}, added {kinds}")

