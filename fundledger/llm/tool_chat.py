"""Chat formatting: link tool calls to their results, order them, check arguments, write canonical JSON.

Everything is DataFrame and SQL functions.

* ``link`` hash-joins calls and results by identifier. Of different calls with one identifier the smallest
  is linked, and so is the smallest of a call's results; the others are kept as duplicates. Results without
  a call are orphans.
* ``levels`` orders calls topologically. A call may name one call that must come before it; its level is
  the length of that chain, found by pointer doubling, so a chain of n calls takes about log2(n) joins of
  narrow rows. Sorting by level is a topological order. Calls in or behind a cycle have no level.
* ``faults`` checks arguments, as JSON, against a schema of typed, required and bounded fields.
* ``canonical`` writes a message with sorted keys, no white space and unescaped non-ASCII characters.

Defined results: null identifiers link to nothing, and calls without one keep their own rows at level 0;
a predecessor that doesn't exist counts as none; null arguments or invalid JSON are a fault. Only rows
equal in all columns are merged, and their number is kept; no text is lost. Other turns, such as a system's,
are messages of their own. Empty tables give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundledger.llm.common import cut_lineage


@dataclass(frozen=True)
class Field:
    """An argument: its JSON type ("string", "integer", "number" or "boolean") and bounds.

    ``least`` and ``most`` bound a number's value or a string's length.
    """

    kind: str
    required: bool = True
    least: float | None = None
    most: float | None = None


_KINDS = {"string": "^STRING$", "integer": "^BIGINT$", "number": r"^(BIGINT|DOUBLE|DECIMAL\(.*)$", "boolean": "^BOOLEAN$"}


def link(calls: DataFrame, results: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(calls with ``result``, ``n_results``, ``n_calls``; other calls of their identifiers; results that are not linked).

    ``calls`` has call_id, tool, arguments, after_id; ``results`` has call_id, result; all strings. Of what is
    not linked ``extra`` says whether its call has another result.
    """
    said = calls.groupBy("call_id", "tool", "arguments", "after_id").agg(F.count(F.lit(1)).alias("n_calls"))
    given = results.groupBy("call_id", "result").agg(F.count(F.lit(1)).alias("n_results"))
    body = F.struct("tool", "arguments", "after_id")
    named = said.where("call_id is not null").groupBy("call_id").agg(F.min(body).alias("first"), F.sum("n_calls").alias("n_calls"))
    one = named.select("call_id", "first.*", "n_calls").unionByName(said.where("call_id is null"))
    others = said.join(named.select("call_id", "first"), "call_id").where(body != F.col("first")).drop("first")
    # A null result is one like any other, and comes before them.
    found = given.groupBy("call_id").agg(F.min(F.struct("result")).alias("answer"), F.sum("n_results").alias("n_results")).where("call_id is not null")
    met = one.join(found, "call_id", "left").withColumns({"result": F.col("answer.result"), "n_results": F.coalesce("n_results", F.lit(0).cast("long"))})
    known = named.select("call_id").join(found.select("call_id", "answer"), "call_id")
    rest = given.join(known, "call_id", "left").where(F.col("answer").isNull() | (F.struct("result") != F.col("answer")))
    return met.drop("answer"), others, rest.select("call_id", "result", "n_results", F.col("answer").isNotNull().alias("extra"))


def levels(calls: DataFrame) -> DataFrame:
    """(call_id, level) of calls with an identifier; ``calls`` has one row for each, with call_id and after_id."""
    nodes = calls.where("call_id is not null").select("call_id", "after_id")
    there = nodes.select(F.col("call_id").alias("known"))
    state = nodes.join(there, F.col("after_id") == F.col("known"), "left").select(
        "call_id", F.col("known").alias("up"), F.when(F.col("known").isNull(), 0).otherwise(1).cast("long").alias("level")
    )
    state = cut_lineage(state)
    total = state.count()
    for _ in range(max(1, total).bit_length() + 1):
        if state.where("up is not null").isEmpty():
            break
        above = state.select(F.col("call_id").alias("id2"), F.col("up").alias("up2"), F.col("level").alias("more"))
        still = state.where("up is not null").join(above, F.col("up") == F.col("id2"))
        moved = still.select("call_id", F.col("up2").alias("up"), (F.col("level") + F.col("more")).alias("level"))
        state = cut_lineage(state.where("up is null").unionByName(moved))
    return state.select("call_id", F.when(F.col("up").isNull(), F.col("level")).alias("level"))


def faults(tool: Column, arguments: Column, schemas: dict[str, dict[str, Field]]) -> Column:
    """An array of texts that say what is wrong with the arguments; empty if nothing is."""
    parsed = F.try_parse_json(arguments)
    whole = F.schema_of_variant(parsed)
    say = lambda test, text: F.when(test, F.lit(text))
    checked = F.array(F.lit("unknown tool"))
    for name, fields in schemas.items():
        found = [say(F.coalesce(~whole.startswith("OBJECT"), F.lit(True)), "not an object")]
        keys = F.json_object_keys(arguments)
        extra = F.array_sort(F.array_except(keys, F.array(*[F.lit(k) for k in fields])))
        found.append(F.when(F.size(extra) > 0, F.concat(F.lit("unknown: "), F.array_join(extra, ","))))
        for key, field in sorted(fields.items()):
            part = F.try_variant_get(parsed, f"$.{key}", "variant")
            kind = F.schema_of_variant(part)
            absent = kind.isNull() | (kind == "VOID")
            if field.required:
                found.append(say(whole.startswith("OBJECT") & absent, f"{key}: missing"))
            found.append(say(~absent & ~kind.rlike(_KINDS[field.kind]), f"{key}: not a {field.kind}"))
            size = F.length(F.try_variant_get(parsed, f"$.{key}", "string")) if field.kind == "string" else F.try_variant_get(parsed, f"$.{key}", "double")
            right = ~absent & kind.rlike(_KINDS[field.kind])
            if field.least is not None:
                found.append(say(right & (size < field.least), f"{key}: too small"))
            if field.most is not None:
                found.append(say(right & (size > field.most), f"{key}: too large"))
        checked = F.when(tool == name, F.array_compact(F.array(*found))).otherwise(checked)
    return checked


def canonical(**parts: Column) -> Column:
    """A JSON object of the parts with keys in order; variants are written as their own sorted JSON."""
    return F.to_json(F.struct(*[parts[k].alias(k) for k in sorted(parts)]), {"ignoreNullFields": "false"})


def format_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict[str, Field]], notes: DataFrame | None = None) -> DataFrame:
    """One row per message: call_id, kind, level, n_calls, n_results, linked, errors, message.

    ``kind`` is call, duplicate (another call or result of an identifier), orphan (a result without a call) or
    note (a row of ``notes``: note_id, role, text).
    """
    met, others, rest = link(calls, results)
    met, none = cut_lineage(met), F.lit(0).cast("long")
    placed = met.join(levels(met), "call_id", "left")
    said = lambda result: canonical(arguments=F.try_parse_json("arguments"), id=F.col("call_id"), result=result, tool=F.col("tool"))

    def rows(df: DataFrame, kind: Column, level: Column, n_calls: Column, n_results: Column, linked: Column, errors: Column, message: Column) -> DataFrame:
        named = {"kind": kind, "level": level, "n_calls": n_calls, "n_results": n_results, "linked": linked, "errors": errors, "message": message}
        return df.select("call_id", *[v.alias(k) for k, v in named.items()])

    no_level, no_link = F.lit(None).cast("long"), F.lit(False)
    level = F.when(F.col("call_id").isNull(), none).otherwise(F.col("level"))
    wrong = faults(F.col("tool"), F.col("arguments"), schemas)
    out = rows(placed, F.lit("call"), level, F.col("n_calls"), F.col("n_results"), F.col("n_results") > 0, wrong, said(F.col("result")))
    twice = F.array(F.lit("another call has this identifier"))
    out = out.unionByName(rows(others, F.lit("duplicate"), no_level, F.col("n_calls"), none, no_link, twice, said(F.lit(None).cast("string"))))
    kind = F.when(F.col("extra"), "duplicate").otherwise("orphan")
    why = F.array(F.when(F.col("extra"), "another result has this identifier").otherwise("no call"))
    out = out.unionByName(rows(rest, kind, no_level, none, F.col("n_results"), no_link, why, canonical(id=F.col("call_id"), result=F.col("result"))))
    if notes is not None:
        text = canonical(id=F.col("call_id"), role=F.col("role"), text=F.col("text"))
        held = notes.withColumnRenamed("note_id", "call_id")
        out = out.unionByName(rows(held, F.lit("note"), no_level, none, none, no_link, F.array().cast("array<string>"), text))
    return out
