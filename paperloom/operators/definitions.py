"""Defined terms: extraction with offsets, use, and injection into chunks' index text."""

from __future__ import annotations

import bisect
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from paperloom.functions.text import arrow, py_strip
from paperloom.model import FURNITURE, HEADINGS

LONGEST, MOST, MOST_CHARS = 300, 3, 600
#: The forms in which contracts define terms.
QUOTED = re.compile(r'["“](?P<term>[A-Z][^"”]{0,80}?)["”]\s+(?P<verb>shall mean|means|has the meaning|refers to|is defined as)\b')
PARENTHESIS = re.compile(r'\((?:[a-z][a-z ,]{0,30})?["“](?P<term>[A-Z][^"”]{0,60}?)["”]\)')
LISTED = re.compile(r'^["“]?(?P<term>[A-Z][A-Za-z]*(?:\s+[A-Z][A-Za-z]*){0,5})["”]?\s*:\s*(?P<rest>.+)', re.DOTALL)
BOUNDARY = re.compile(r'\.\s+(?=["“]?[A-Z])')


def _candidates(text: str, listed: bool) -> list[tuple[int, str, str]]:
    """(offset, term, definition) in the order of the text."""
    stops = [(m.start() + 1, m.end()) for m in BOUNDARY.finditer(text)]
    ends, starts = [e for e, _ in stops], [s for _, s in stops]

    def end_after(at: int) -> int:
        k = bisect.bisect_right(ends, at)
        return ends[k] if k < len(ends) else len(text)

    def start_before(at: int) -> int:
        k = bisect.bisect_right(starts, at)
        return starts[k - 1] if k else 0

    out = [(m.start(), m["term"], text[m.start("verb") : end_after(m.start("verb"))]) for m in QUOTED.finditer(text)]
    out += [(m.start(), m["term"], text[start_before(m.start()) : end_after(m.start())]) for m in PARENTHESIS.finditer(text)]
    if listed and (m := LISTED.match(text)):
        out.append((0, m["term"], m["rest"]))
    rows = []
    for at, term, definition in sorted(out, key=lambda c: c[0]):
        term, definition = term.strip(), definition.strip()[:LONGEST]
        if len(term) >= 3 and term[0].isupper() and 1 <= len(term.split()) <= 6 and definition:
            rows.append((at, term, definition))
    return rows


@arrow("array<struct<n:int,term:string,definition:string>>")
def definitions_in(text: pd.Series, listed: pd.Series) -> pd.Series:
    return pd.Series([[{"n": i, "term": t, "definition": d} for i, (_, t, d) in enumerate(_candidates(x, bool(y)))] for x, y in zip(text.fillna(""), listed)])


def extract_definitions(blocks: DataFrame) -> DataFrame:
    """doc_id, ord, term, definition, block_id: the first definition of each term (by lower case) of a document."""
    body = blocks.where(~F.col("type").isin(*FURNITURE) & (py_strip(F.col("text")) != ""))
    heading = F.col("type").isin(*HEADINGS)
    above = F.last(F.when(heading, py_strip(F.col("text"))), ignorenulls=True).over(Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    marked = body.withColumn("__listed", ~heading & F.coalesce(above.rlike("(?i)definitions?"), F.lit(False)))
    quoted = F.col("text").rlike('["“]') | F.col("__listed")
    found = marked.where(quoted).select("doc_id", "pos", "block_id", F.explode(definitions_in("text", "__listed")).alias("d"))
    rows = found.select("doc_id", "pos", "block_id", "d.*")
    first = F.row_number().over(Window.partitionBy("doc_id", F.lower("term")).orderBy("pos", "n"))
    kept = rows.withColumn("__k", first).where("__k = 1")
    return kept.select("doc_id", (F.col("pos") * 100000 + F.col("n")).alias("ord"), "term", "definition", "block_id")


def usage_pattern(term: Column) -> Column:
    """Case-sensitive whole-word use, with plural and possessive endings, and -ies for a last -y."""
    quote = lambda c: F.regexp_replace(c, r"([\\^$.|?*+()\[\]{}\-#&~])", r"\\$1")
    ies = F.when(term.endswith("y"), F.concat(F.lit("|"), quote(F.substr(term, F.lit(1), F.length(term) - 1)), F.lit("ies"))).otherwise("")
    return F.concat(F.lit(r"\b(?:"), quote(term), F.lit("(?:s|'s|es)?"), ies, F.lit(r")\b"))


def term_used(text: Column, term: Column) -> Column:
    return F.rlike(text, usage_pattern(term))


def inject_definitions(chunks: DataFrame, definitions: DataFrame, most: int = MOST, most_chars: int = MOST_CHARS) -> DataFrame:
    """Sets index_extra and definition_block_ids; the text itself is never touched.

    A chunk's candidates are the definitions it uses from other blocks, by frequency, then by first use;
    the first that would overflow ends the list.
    """
    pairs = chunks.select("doc_id", "chunk_id", "text", "block_ids").join(definitions, "doc_id").where(~F.array_contains("block_ids", F.col("block_id")))
    pattern = usage_pattern(F.col("term"))
    used = pairs.withColumn("freq", F.regexp_count("text", pattern)).where("freq > 0").withColumn("first", F.regexp_instr("text", pattern))
    piece = F.concat(F.lit('"'), "term", F.lit('" means '), "definition")
    by_chunk = Window.partitionBy("doc_id", "chunk_id").orderBy(F.desc("freq"), "first", "ord")
    ranked = used.withColumns({"piece": piece, "k": F.row_number().over(by_chunk)})
    so_far = F.sum(F.length("piece")).over(Window.partitionBy("doc_id", "chunk_id").orderBy("k")) + 3 * (F.col("k") - 1) + len("[DEFINITIONS: ]")
    fits = ranked.withColumn("__total", so_far).where((F.col("k") <= most) & (F.col("__total") <= most_chars))
    entry = F.array_sort(F.collect_list(F.struct("k", "piece", "block_id")))
    extra = fits.groupBy("doc_id", "chunk_id").agg(entry.alias("e")).select(
        "doc_id", "chunk_id", F.concat(F.lit("[DEFINITIONS: "), F.array_join(F.transform("e", lambda x: x["piece"]), " | "), F.lit("]")).alias("index_extra"),
        F.transform("e", lambda x: x["block_id"]).alias("definition_block_ids"),
    )
    plain = chunks.drop("index_extra", "definition_block_ids")
    return plain.join(extra, ["doc_id", "chunk_id"], "left").withColumns({"index_extra": F.coalesce("index_extra", F.lit("")), "definition_block_ids": F.coalesce("definition_block_ids", F.array().cast("array<string>"))})
