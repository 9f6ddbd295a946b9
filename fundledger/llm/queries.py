"""One query for each operator of this subpackage, over its whole table, and the SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundledger.llm import (
    alignment,
    byte_bpe,
    exact_dedup,
    language,
    merkle,
    mixing,
    personal_data,
    posting_lists,
    simhash,
    substring_dedup,
    suffix_dedup,
    token_counts,
    tool_chat,
)
from fundledger.llm.common import table

BPE_FILE = "byte_bpe_50k.tiktoken"
BYTE_FILE = "byte_bpe_50k.json"
PIECE_FILE = "piece_bpe_32k.model"

# Target shares of tokens. Values not named here keep their present share, and these are scaled to the rest.
SOURCES = {f"src{i}": 0.297 if i == 0 else 0.037 for i in range(20)}
LANGUAGES = {"en": 0.52, "fr": 0.17, "es": 0.14, "de": 0.17}
TOPICS = {"prose": 0.92, "table": 0.03, "shouting": 0.04, "list": 0.01}
TARGETS = {"source": SOURCES, "lang": LANGUAGES, "topic": TOPICS}
MIX_SEED = 20
# The part of all tokens that stays.
MIX_RATE = 0.8


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BPE_FILE)
    coded = byte_bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, carry=("doc_id",))
    back = byte_bpe.decode(coded, path)
    return back.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex(F.col("fp")).alias("fingerprint"), "component_id")


# The tools that a conversation's turns are read as calls of, and what their arguments must be.
SCHEMAS = {
    "lookup": {"chars": tool_chat.Field("integer", least=1, most=160), "query": tool_chat.Field("string", least=1)},
    "write": {"chars": tool_chat.Field("integer", least=1, most=400), "lines": tool_chat.Field("integer"), "query": tool_chat.Field("string", least=1)},
}


def op3_tool_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user turn is a tool call, and each assistant turn the result of the turn before it; all others are notes.

    A call follows the call two turns earlier. One line is looked up, several lines are written.
    """
    turns = table(spark, sf_dir, "conversations")
    name = lambda back: F.concat_ws(":", F.lit("call"), F.col("conv_id").cast("string"), (F.col("turn") - back).cast("string"))
    known = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    chars = F.length("text")
    one = F.to_json(F.struct(chars.alias("chars"), F.col("text").alias("query")))
    several = F.to_json(F.struct(chars.alias("chars"), lines.alias("lines"), F.col("text").alias("query")))
    calls = turns.where("role = 'user'").select(
        F.when(known, name(0)).alias("call_id"),
        F.when(lines > 1, "write").otherwise("lookup").alias("tool"),
        F.when(lines > 1, several).otherwise(one).alias("arguments"),
        F.when(known, name(2)).alias("after_id"),
    )
    results = turns.where("role = 'assistant'").select(F.when(known, name(1)).alias("call_id"), F.col("text").alias("result"))
    other = F.coalesce(~F.col("role").isin("user", "assistant"), F.lit(True))
    notes = turns.where(other).select(F.when(known, name(0)).alias("note_id"), "role", "text")
    made = tool_chat.format_calls(calls, results, SCHEMAS, notes)
    return made.withColumn("errors", F.array_join("errors", "; "))


OP3_SQL = """
WITH u AS (
  SELECT CASE WHEN lines > 1 THEN 'write' ELSE 'lookup' END AS tool, conv_id, turn, 'call:' || conv_id || ':' || turn AS call_id, chars,
         CASE WHEN lines > 1 THEN CAST(json_object('chars', chars, 'lines', lines, 'query', text) AS VARCHAR)
              ELSE CAST(json_object('chars', chars, 'query', text) AS VARCHAR) END AS a
  FROM (SELECT *, length(text) AS chars, length(text) - length(replace(text, chr(10), '')) + 1 AS lines FROM conversations WHERE role = 'user')
),
said AS (
  SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY tool, a) AS nth, sum(n) OVER (PARTITION BY call_id) AS n_calls
  FROM (SELECT *, count(*) AS n FROM u GROUP BY ALL)
),
given AS (
  SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY text NULLS FIRST) AS nth, sum(n) OVER (PARTITION BY call_id) AS n_results
  FROM (SELECT 'call:' || conv_id || ':' || (turn - 1) AS call_id, text, count(*) AS n FROM conversations WHERE role = 'assistant' GROUP BY ALL)
),
first AS (SELECT * FROM said WHERE nth = 1),
chains AS (SELECT *, turn // 2 - row_number() OVER (PARTITION BY conv_id, turn % 2 ORDER BY turn) AS chain FROM first),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id, turn % 2, chain ORDER BY turn) - 1 AS level FROM chains)
SELECT call_id, 'call' AS kind, level, CAST(n_calls AS BIGINT) AS n_calls, CAST(coalesce(n_results, 0) AS BIGINT) AS n_results, n_results IS NOT NULL AS linked,
       concat_ws('; ', CASE WHEN chars < 1 THEN 'chars: too small' END,
                 CASE WHEN chars > (CASE tool WHEN 'write' THEN 400 ELSE 160 END) THEN 'chars: too large' END,
                 CASE WHEN chars < 1 THEN 'query: too small' END) AS errors,
       CAST(json_object('arguments', CAST(a AS JSON), 'id', call_id, 'result', text, 'tool', tool) AS VARCHAR) AS message
FROM placed LEFT JOIN (SELECT * FROM given WHERE nth = 1) USING (call_id)
UNION ALL
SELECT call_id, 'duplicate', NULL, n, 0, false, 'another call has this identifier',
       CAST(json_object('arguments', CAST(a AS JSON), 'id', call_id, 'result', NULL, 'tool', tool) AS VARCHAR)
FROM said WHERE nth > 1
UNION ALL
SELECT g.call_id, CASE WHEN f.call_id IS NULL THEN 'orphan' ELSE 'duplicate' END, NULL, 0, g.n, false,
       CASE WHEN f.call_id IS NULL THEN 'no call' ELSE 'another result has this identifier' END, CAST(json_object('id', g.call_id, 'result', g.text) AS VARCHAR)
FROM given g LEFT JOIN first f USING (call_id) WHERE g.nth > 1 OR f.call_id IS NULL
UNION ALL
SELECT 'call:' || conv_id || ':' || turn, 'note', NULL, 0, 0, false, '',
       CAST(json_object('id', 'call:' || conv_id || ':' || turn, 'role', role, 'text', text) AS VARCHAR)
FROM conversations WHERE role IS DISTINCT FROM 'user' AND role IS DISTINCT FROM 'assistant'
"""


def op4_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_lists.search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.groups(table(spark, sf_dir, "documents"), keep="largest")


OP5_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), TARGETS, rate=MIX_RATE, seed=MIX_SEED)
    weight, probability = F.round("weight", 6).alias("weight"), F.round("probability", 6).alias("probability")
    return mixed.select("doc_id", "source", "lang", "topic", "n_tokens", weight, probability, "kept")


def _shares(name: str, targets: dict[str, float]) -> str:
    rows = ", ".join(f"('{k}', {v})" for k, v in targets.items())
    return f"{name}(v, share) AS (VALUES {rows})"


OP7_SQL = rf"""
WITH RECURSIVE {_shares('s_t', SOURCES)}, {_shares('l_t', LANGUAGES)}, {_shares('t_t', TOPICS)},
e AS (
  SELECT doc_id, source, lang, coalesce(text, '') AS x,
         CASE WHEN (length(x) - length(replace(x, '|', ''))) * 40 > greatest(length(x), 1) THEN 'table'
              WHEN (length(x) - length(replace(x, '!', ''))) * 40 > greatest(length(x), 1) THEN 'shouting'
              WHEN (length(x) - length(replace(x, chr(10), ''))) * 60 > greatest(length(x), 1) THEN 'list'
              ELSE 'prose' END AS topic,
         CAST(len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens
  FROM documents
),
d AS (
  SELECT e.*, coalesce(s_t.v, 'other') AS cs, coalesce(l_t.v, 'other') AS cl, coalesce(t_t.v, 'other') AS ct
  FROM e LEFT JOIN s_t ON s_t.v = source LEFT JOIN l_t ON l_t.v = lang LEFT JOIN t_t ON t_t.v = topic
),
cells AS (SELECT cs, cl, ct, sum(n_tokens) / nullif(sum(sum(n_tokens)) OVER (), 0) AS p FROM d GROUP BY ALL),
aims AS (
  SELECT c.*, coalesce(s.share, 0) AS a, coalesce(l.share, 0) AS b, coalesce(t.share, 0) AS c
  FROM cells c LEFT JOIN s_t s ON s.v = cs LEFT JOIN l_t l ON l.v = cl LEFT JOIN t_t t ON t.v = ct WHERE p > 0
),
-- Values without a target keep their present share; the targets are scaled to the rest.
there AS (
  SELECT (SELECT sum(a) FROM (SELECT DISTINCT cs, a FROM aims)) AS sa, (SELECT coalesce(sum(p), 0) FROM aims WHERE cs = 'other') AS oa,
         (SELECT sum(b) FROM (SELECT DISTINCT cl, b FROM aims)) AS sb, (SELECT coalesce(sum(p), 0) FROM aims WHERE cl = 'other') AS ob,
         (SELECT sum(c) FROM (SELECT DISTINCT ct, c FROM aims)) AS sc, (SELECT coalesce(sum(p), 0) FROM aims WHERE ct = 'other') AS oc
),
fit AS (
  SELECT 0 AS i, cs, cl, ct, p, CAST(p AS DOUBLE) AS w, CASE cs WHEN 'other' THEN oa ELSE a * (1 - oa) / sa END AS a,
         CASE cl WHEN 'other' THEN ob ELSE b * (1 - ob) / sb END AS b, CASE ct WHEN 'other' THEN oc ELSE c * (1 - oc) / sc END AS c
  FROM aims, there
  UNION ALL
  SELECT i + 1, cs, cl, ct, p,
         CASE i % 3 WHEN 0 THEN w * a / sum(w) OVER (PARTITION BY cs)
                    WHEN 1 THEN w * b / sum(w) OVER (PARTITION BY cl)
                    ELSE w * c / sum(w) OVER (PARTITION BY ct) END, a, b, c
  FROM fit WHERE i < 240
),
ends AS (SELECT cs, cl, ct, p, w / p AS ratio, row_number() OVER (ORDER BY w / p DESC, cs, cl, ct) AS n FROM fit WHERE i = 240),
scales AS (
  SELECT n, ratio, ({MIX_RATE} - coalesce(sum(p) OVER above, 0))
                   / (sum(p * ratio) OVER () - coalesce(sum(p * ratio) OVER above, 0)) AS scale
  FROM ends WINDOW above AS (ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
final AS (
  SELECT cs, cl, ct, ratio, least(1.0, ratio * (SELECT scale FROM scales WHERE ratio * scale <= 1 ORDER BY n LIMIT 1)) AS chance
  FROM ends
  UNION ALL
  SELECT cs, cl, ct, 1, {MIX_RATE} FROM cells WHERE p = 0 OR p IS NULL
)
SELECT doc_id, source, lang, topic, n_tokens, round(ratio, 6) AS weight, round(chance, 6) AS probability,
       CAST('0x' || sha256('{MIX_SEED}:' || doc_id)[1:12] AS BIGINT) / 281474976710656.0 < chance AS kept
FROM d JOIN final USING (cs, cl, ct)
"""


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language.identify(docs, language.trained(docs), carry=("doc_id",))
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "lang_second", "ambiguous")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(BPE_FILE)
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, carry=("doc_id",))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four counts and base_sha256 are of what the patterns find; spans holds what the field adds, too."""
    docs = table(spark, sf_dir, "documents")
    found = personal_data.find(docs, personal_data.trained(docs))
    text = lambda some: F.array_join(F.transform(some, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    kinds = F.array(*[F.lit(k) for k in personal_data.KINDS])
    placed = lambda x: F.struct(F.array_position(kinds, x["kind"]).alias("place"), x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))
    ordered = F.array_sort(F.transform(F.concat("base", "added"), placed))
    of_kind = lambda kind: F.filter("base", lambda x: x["kind"] == kind)
    counts = [F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in personal_data.KINDS]
    return found.select("doc_id", *counts, F.sha2(text(F.col("base")), 256).alias("base_sha256"), text(ordered).alias("spans"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path(BYTE_FILE), public_tokenizers.PATTERN, public_tokenizers.path(PIECE_FILE)
    return alignment.align(table(spark, sf_dir, "documents"), *paths)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    tampered = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.proofs(table(spark, sf_dir, "documents"), tampered)


_FIELD = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
_FIELDS = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars"))

OP13_SQL = f"""
WITH RECURSIVE sums AS (
  SELECT *, xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
           lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))
         )) % 2 = 0 AS even
  FROM documents
),
leaves AS (
  SELECT doc_id, source, sha256({_FIELDS} || {_FIELD.format("text")}) AS leaf,
         sha256({_FIELDS} || {_FIELD.format("CASE WHEN even THEN replace(text, chr(10), '') ELSE text END")}) AS got
  FROM sums
),
placed AS (
  SELECT *, row_number() OVER (ORDER BY doc_id, leaf) AS id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY source) AS n
  FROM leaves
),
low AS (
  SELECT 0 AS h, s, r, n, leaf AS digest FROM placed
  UNION ALL
  SELECT h + 1, s, r // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY r)) FROM low WHERE n > 1 GROUP BY h, s, r // 3, n
),
subroots AS (SELECT s, digest AS subroot FROM low WHERE n = 1),
high AS (
  SELECT 100 AS h, s AS r, count(*) OVER () AS n, subroot AS digest FROM subroots
  UNION ALL
  SELECT h + 1, r // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY r)) FROM high WHERE n > 1 GROUP BY h, r // 3, n
),
nodes AS (SELECT * FROM low UNION ALL SELECT h, 0, r, n, digest FROM high),
sides AS (
  SELECT x.h, x.s, x.r, coalesce(string_agg(y.digest, '' ORDER BY y.r) FILTER (y.r < x.r), '') AS lefts,
         coalesce(string_agg(y.digest, '' ORDER BY y.r) FILTER (y.r > x.r), '') AS rights
  FROM nodes x JOIN nodes y ON x.h = y.h AND x.s = y.s AND x.r // 3 = y.r // 3 WHERE x.n > 1 GROUP BY ALL
),
steps AS (
  SELECT id, lefts, rights, row_number() OVER (PARTITION BY id ORDER BY h) AS step
  FROM (
    SELECT id, h, lefts, rights FROM placed p JOIN sides x ON x.h < 100 AND x.s = p.s AND x.r = p.r // CAST(3 ** x.h AS BIGINT)
    UNION ALL
    SELECT id, h, lefts, rights FROM placed p JOIN sides x ON x.h >= 100 AND x.r = p.s // CAST(3 ** (x.h - 100) AS BIGINT)
  )
),
fold AS (
  SELECT id, 0 AS step, got AS acc FROM placed
  UNION ALL
  SELECT f.id, f.step + 1, sha256(t.lefts || f.acc || t.rights) FROM fold f JOIN steps t ON t.id = f.id AND t.step = f.step + 1
),
ends AS (SELECT id, arg_max(acc, step) AS folded_root FROM fold GROUP BY id),
proof AS (SELECT id, sha256(coalesce(string_agg(lefts || rights, '' ORDER BY step), '')) AS proof_sha256 FROM placed LEFT JOIN steps USING (id) GROUP BY id)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN subroots USING (s) JOIN ends USING (id) JOIN proof USING (id), (SELECT digest AS root FROM high WHERE n = 1)
"""


QUERIES = {
    f.__name__: f
    for f in (
        op1_byte_bpe,
        op2_simhash,
        op3_tool_chat,
        op4_posting_lists,
        op5_exact_dedup,
        op6_substring_dedup,
        op7_mixing,
        op8_language,
        op9_suffix_dedup,
        op10_token_counts,
        op11_personal_data,
        op12_alignment,
        op13_merkle,
    )
}
CHECKS = {"op3_tool_chat": OP3_SQL, "op5_exact_dedup": OP5_SQL, "op7_mixing": OP7_SQL, "op13_merkle": OP13_SQL}
