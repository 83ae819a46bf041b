"""Prompt contexts, and model replies in JSON turned into facts with counted repairs.

A reply is never trusted whole: every field is read for itself, and one that cannot be read becomes an empty fact, never an
invented one. Four repairs are known, and each is counted: ``fence_strip`` (a code fence around the JSON),
``unwrap_root`` (all fields under one stray key), ``unwrap_field`` (a field's object under one stray key) and
``hash_prefix`` (a block id without its ``#``, restored only where such a block exists). ``payload_invalid`` and
``field_dropped`` count what no repair could save.
"""

from __future__ import annotations

import json
import numbers
from collections import Counter
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F

FACT = "struct<field:string,value:string,source_block_id:string,confidence:double>"
REPLIES = f"doc_id string, facts array<{FACT}>, repairs map<string,int>"
KEYS = ("value", "source_block_id", "confidence")
EMPTY = ("", None, 0.0)


def context(blocks: DataFrame) -> DataFrame:
    """doc_id, context: ``[id] text`` of every block in order, with an empty line between."""
    parts = F.array_sort(F.collect_list(F.struct("pos", F.concat(F.lit("["), "block_id", F.lit("] "), "text").alias("line"))))
    return blocks.groupBy("doc_id").agg(F.array_join(parts["line"], "\n\n").alias("context"))


def read_json(reply: str | None, repairs: Counter) -> dict:
    """The reply's object, or an empty one."""
    text = (reply or "").strip()
    fenced = text.startswith("```")
    for attempt in (reply, text.partition("\n")[2].rpartition("```")[0] if fenced else None):
        if attempt is None:
            continue
        try:
            found = json.loads(attempt)
        except ValueError:
            continue
        if attempt is not reply:
            repairs["fence_strip"] += 1
        elif not isinstance(found, dict):
            repairs["payload_invalid"] += 1
        return found if isinstance(found, dict) else {}
    repairs["payload_invalid"] += 1
    return {}


def as_clause(raw: dict) -> tuple[str, str | None, float] | None:
    """(value, block id, confidence) if each has its type and range; keys that are absent have their empty value."""
    value, block, confidence = (raw.get(k, empty) for k, empty in zip(KEYS, EMPTY))
    if isinstance(confidence, str):
        try:
            confidence = float(confidence)
        except ValueError:
            return None
    fits = isinstance(value, str) and (block is None or isinstance(block, str)) and isinstance(confidence, numbers.Real) and 0 <= confidence <= 1
    return (value, block, float(confidence)) if fits else None


def lone_value(raw: dict, known: Sequence[str]) -> dict | None:
    """The object under a single stray key, if it has some of the known keys."""
    inner = next(iter(raw.values())) if len(raw) == 1 else None
    return inner if isinstance(inner, dict) and not inner.keys().isdisjoint(known) else None


def read_field(raw: object, block_ids: frozenset[str], repairs: Counter) -> tuple[str, str | None, float]:
    if raw is None:
        return EMPTY
    clause, wrapped = None, False
    if isinstance(raw, dict):
        inner = lone_value(raw, KEYS)
        clause = as_clause(inner) if inner is not None else None
        wrapped = clause is not None
        clause = clause or as_clause(raw)
    if clause is None:
        repairs["field_dropped"] += 1
        return EMPTY
    repairs["unwrap_field"] += wrapped
    value, block, confidence = clause
    if block and block not in block_ids and "#" + block in block_ids:
        repairs["hash_prefix"] += 1
        block = "#" + block
    return value, block, confidence


def read_reply(reply: str | None, fields: Sequence[str], block_ids: Sequence[str]) -> tuple[list[tuple], Counter]:
    repairs: Counter = Counter()
    data = read_json(reply, repairs)
    if not set(data) & set(fields) and (inner := lone_value(data, fields)) is not None:
        repairs["unwrap_root"] += 1
        data = inner
    ids = frozenset(block_ids)
    facts = [(f, *read_field(data.get(f), ids, repairs)) for f in fields]
    return facts, +repairs


def read_replies(replies: DataFrame, fields: Sequence[str]) -> DataFrame:
    """``replies``: doc_id, reply, block_ids. Returns doc_id, facts (one per field) and repairs (counts by name) of every row."""
    names = list(fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for doc, reply, ids in zip(pdf.doc_id, pdf.reply, pdf.block_ids):
                facts, repairs = read_reply(reply, names, () if ids is None else tuple(ids))
                out.append((doc, [dict(zip(("field", *KEYS), f)) for f in facts], dict(repairs)))
            yield pd.DataFrame(out, columns=["doc_id", "facts", "repairs"])

    return replies.select(F.col("doc_id").cast("string"), "reply", "block_ids").mapInPandas(run, REPLIES)


def facts_of(read: DataFrame) -> DataFrame:
    return read.select("doc_id", F.explode("facts").alias("f")).select("doc_id", "f.*")


def repair_counts(read: DataFrame) -> DataFrame:
    """repair, n."""
    return read.select(F.explode("repairs").alias("repair", "n")).groupBy("repair").agg(F.sum("n").alias("n"))


def strict_schema(fields: Sequence[str]) -> dict:
    """The JSON schema that a constrained decoder is given: every key required, none besides, no bounds or defaults."""
    clause = {"type": "object", "properties": {"value": {"type": "string"}, "source_block_id": {"anyOf": [{"type": "string"}, {"type": "null"}]}, "confidence": {"type": "number"}}, "required": list(KEYS), "additionalProperties": False}
    return {"type": "object", "properties": {f: clause for f in fields}, "required": list(fields), "additionalProperties": False}
