"""Rule extractors: one pass over the blocks, one shuffle per extractor.

A finder is a cue and a value, both Columns of a block. Per document the first block
(by position) with the cue and a value wins: a ``min_by`` per field in one grouping.
"""

from __future__ import annotations

from dataclasses import dataclass

import regex
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from paperloom.functions import legal as L
from paperloom.functions.text import arrow, py_strip
from paperloom.operators.verticals import CONTRACT_CLAUSES, CONTRACT_TAGS, NDA_CLAUSES, NDA_TAGS, Vertical, first_of, joined_entities, kleister_entities


@dataclass(frozen=True)
class Finder:
    field: str
    cue: Column
    value: Column
    confidence: float


def _first(finders: list[Finder], blocks: DataFrame, cite: bool = False) -> DataFrame:
    """doc_id and one struct (value, source_block_id, confidence, with ``cite`` also source_text) per finder.

    Values are columns before they are compared, so that each pattern is read once a block.
    """
    found = blocks.select("doc_id", "pos", "block_id", *(["text"] if cite else []), *[F.when(f.cue, f.value).alias(f"__{f.field}") for f in finders])
    hits = []
    for f in finders:
        value = F.col(f"__{f.field}")
        clause = F.struct(value.alias("value"), F.col("block_id").alias("source_block_id"), F.lit(f.confidence).alias("confidence"), *([F.col("text").alias("source_text")] if cite else []))
        hits.append(F.min_by(clause, F.when(value != "", F.col("pos"))).alias(f.field))
    return found.groupBy("doc_id").agg(*hits)


def _long(wide: DataFrame, fields: tuple[str, ...], cite: bool = False) -> DataFrame:
    """One row per field; a missing value is empty with confidence 0."""
    none = F.lit(None).cast("string")
    empty = F.struct(F.lit("").alias("value"), none.alias("source_block_id"), F.lit(0.0).alias("confidence"), *([none.alias("source_text")] if cite else []))
    entries = F.array(*[F.struct(F.lit(f).alias("field"), F.when(F.col(f)["value"].isNotNull(), F.col(f)).otherwise(empty).alias("c")) for f in fields])
    return wide.select("doc_id", F.explode(entries).alias("e")).select("doc_id", "e.field", "e.c.value", "e.c.source_block_id", "e.c.confidence", *(["e.c.source_text"] if cite else []))


def _made(df: DataFrame) -> DataFrame:
    """The same rows, through a generator of one row, so that columns which later ones read often are evaluated once."""
    return df.select(F.explode(F.array(F.struct(*df.columns))).alias("__row")).select("__row.*")


def _after(text: Column, cue: str, chars: int) -> Column:
    """The text from the cue's first match on, at most so many characters."""
    return F.when(text.rlike(cue), F.substr(text, F.regexp_instr(text, F.lit(cue)), F.lit(chars))).otherwise("")


def _names(c: Column) -> Column:
    return F.array_join(L.party_entities(c), "; ")


_T = lambda: F.col("text")


def contract_finders(t: Column) -> list[Finder]:
    """Those of the six contract fields over a block's text."""
    return [
        Finder("counterparty", t.rlike("(?i)by and between"), _names(_after(t, "(?i)by and between", 600)), 0.7),
        Finder("effective_date", t.rlike("(?i)effective"), L.first_date(t), 0.65),
        Finder("governing_law", t.rlike("(?i)govern"), L.jurisdiction_in(t), 0.7),
        Finder("total_value", F.contains(t, F.lit("$")), py_strip(F.regexp_extract(t, L.MONEY, 0)), 0.4),
        Finder("termination_notice_days", t.rlike("(?i)terminat|notice|renew"), py_strip(F.regexp_extract(t, L.NOTICE_DAYS, 0)), 0.55),
        Finder("auto_renewal", t.rlike(L.AUTO_RENEWAL), F.lit("yes"), 0.55),
    ]


def contract_facts(blocks: DataFrame, cite: bool = False) -> DataFrame:
    """The six contract fields; with ``cite`` also the cited block's text, which spares later checks a join."""
    return _long(_first(contract_finders(_T()), blocks, cite), CONTRACT_FIELDS, cite)


_NDA_DATE = regex.compile(L.NDA_DATE)
_DATE_CUE = regex.compile(r"(?i)\b(?:effective|dated?|made|entered\s+into|executed|as\s+of)\b")


@arrow("struct<cued:string,alone:string>")
def nda_dates(text: pd.Series) -> pd.DataFrame:
    """The first date with a cue in the 80 characters before it, and the date of a block that is little else."""
    rows = []
    for t in text:
        if t is None:
            rows.append((None, None))
            continue
        found = list(_NDA_DATE.finditer(t))
        cued = next((m[0].strip() for m in found if _DATE_CUE.search(t[max(0, m.start() - 80) : m.start()])), None)
        rest = regex.sub(r"[\W_]+", "", t[: found[0].start()] + t[found[0].end() :]) if found else ""
        rows.append((cued, found[0][0].strip() if found and len(rest) <= 8 else None))
    return pd.DataFrame(rows, columns=["cued", "alone"])


#: Role labels and preamble of an NDA's parties.
DISCLOSING, RECEIVING = r"(?i)disclos\w*\s+party|\bdiscloser\b", r"(?i)receiv\w*\s+party|\brecipient\b"
PREAMBLE = "(?i)by and between|by and among|between"


def _named_before(t: Column, label: str) -> Column:
    """The last entity of the 250 characters before a role label."""
    at = F.regexp_instr(t, F.lit(label))
    start = F.greatest(at - 250, F.lit(1))
    return F.when(at > 0, F.coalesce(F.try_element_at(L.party_entities(F.substr(t, start, at - start)), F.lit(-1)), F.lit(""))).otherwise("")


def _nda_wide(blocks: DataFrame) -> DataFrame:
    """doc_id and a clause for each of the seven NDA fields. Role labels give the parties; the preamble fills roles they leave empty, its first name disclosing."""
    t = _T()
    dated = blocks.withColumn("__d", nda_dates(F.when(t.rlike(r"\d{4}|/\d{2}"), t)))  # the other blocks go to Python empty
    between = t.rlike("(?i)by and between|between")
    duration = py_strip(F.regexp_extract(t, L.DURATION, 0))
    term = r"(?i)remain in (?:full )?(?:force|effect)|term of this|continue for|for a (?:term|period) of|shall terminate"
    secrecy = r"(?i)survive|obligations? of confidentiality|confidential\w*.*(?:survive|continue|remain)"
    law = L.jurisdiction_in(t)
    finders = [
        Finder("disclosing_party", between, _named_before(t, DISCLOSING), 0.7),
        Finder("receiving_party", between, _named_before(t, RECEIVING), 0.7),
        Finder("preamble", t.rlike(PREAMBLE), _names(_after(t, PREAMBLE, 600)), 0.5),
        Finder("head", F.col("pos") < 20, _names(t), 0.5),
        Finder("cued", F.lit(True), F.col("__d.cued"), 0.65),
        Finder("alone", F.lit(True), F.col("__d.alone"), 0.4),
        Finder("term", t.rlike(term), duration, 0.6),
        Finder("confidentiality_period", t.rlike(secrecy), duration, 0.6),
        Finder("return_of_materials", t.rlike(L.RETURN_MATERIALS), F.lit("yes"), 0.6),
        Finder("governing_law", t.rlike("(?i)govern"), law, 0.7),
    ]
    wide = _first(finders, dated)
    got = lambda f: F.col(f)["value"].isNotNull()
    source = F.when(got("preamble"), F.col("preamble")).otherwise(F.col("head"))
    named = F.coalesce(F.split(source["value"], "; "), F.array().cast("array<string>"))
    taken = F.transform(L.party_entities(F.concat(F.coalesce(F.col("disclosing_party")["value"], F.lit("")), F.lit("; "), F.coalesce(F.col("receiving_party")["value"], F.lit("")))), F.lower)
    wide = _made(wide.withColumns({"__src": source, "__named": named, "__taken": taken}))
    wide = _made(wide.withColumn("__rest", F.filter("__named", lambda e: ~F.array_contains(F.col("__taken"), F.lower(e)))))
    clause = lambda v: F.when(v != "", F.struct(v.alias("value"), F.col("__src.source_block_id").alias("source_block_id"), F.lit(0.5).alias("confidence")))
    both = F.array_join("__rest", "; ")
    neither = ~got("disclosing_party") & ~got("receiving_party")
    first = F.coalesce(F.try_element_at("__rest", F.lit(1)), F.lit(""))
    others = F.array_join(F.slice("__rest", F.lit(2), F.greatest(F.size("__rest"), F.lit(1))), "; ")
    wide = wide.withColumns({
        "disclosing_party": F.when(got("disclosing_party"), F.col("disclosing_party")).otherwise(clause(F.when(neither, first).otherwise(both))),
        "receiving_party": F.when(got("receiving_party"), F.col("receiving_party")).otherwise(clause(F.when(neither, others).otherwise(both))),
        "effective_date": F.when(got("cued"), F.col("cued")).otherwise(F.col("alone")),
    })
    return wide


def nda_facts(blocks: DataFrame) -> DataFrame:
    """The seven NDA fields, see ``_nda_wide``."""
    return _long(_nda_wide(blocks), NDA_FIELDS)


def kleister_facts(blocks: DataFrame) -> DataFrame:
    """The NDA fields seen as four: the parties of the better filled cited block, ties for the disclosing one's.

    All is decided within a document's row, so the blocks are read once.
    """
    text = lambda role, part: F.coalesce(F.col(role)[part], F.lit(""))
    given, taken = text("disclosing_party", "value"), text("receiving_party", "value")
    cites, other = text("disclosing_party", "source_block_id"), text("receiving_party", "source_block_id")
    alike = (given != "") & (taken != "") & (cites == other)
    wide = _made(_nda_wide(blocks).select("doc_id", "disclosing_party", "receiving_party", "effective_date", "term", "governing_law"))
    wide = wide.withColumns({
        "__first": L.party_entities(F.when(alike, F.concat(given, F.lit("; "), taken)).otherwise(given)),
        "__second": L.party_entities(F.when(alike, "").otherwise(taken)),
    })
    second = F.size("__second") > F.size("__first")
    least = F.least(*[F.when(text(f, "value") != "", F.col(f)["confidence"]) for f in ("disclosing_party", "receiving_party")])
    names = F.when(second, F.col("__second")).otherwise(F.col("__first"))
    party = F.struct(F.array_join(names, "; ").alias("value"), F.when(second, other).otherwise(cites).alias("source_block_id"), least.alias("confidence"))
    return _long(wide.withColumn("party", F.when(F.size(names) > 0, party)), KLEISTER_FIELDS)


CONTRACT_FIELDS = ("counterparty", "effective_date", "governing_law", "total_value", "termination_notice_days", "auto_renewal")
NDA_FIELDS = ("disclosing_party", "receiving_party", "effective_date", "term", "confidentiality_period", "return_of_materials", "governing_law")
KLEISTER_FIELDS = ("party", "effective_date", "term", "governing_law")

CONTRACT = Vertical(
    name="contract",
    fields=CONTRACT_FIELDS,
    set_fields=("counterparty",),
    judgment_fields=("auto_renewal",),
    risk={"total_value": "high", "termination_notice_days": "high", "auto_renewal": "high", "counterparty": "medium", "governing_law": "medium", "effective_date": "low"},
    canonical={"governing_law": L.jurisdiction_in, "total_value": L.money_digits, "termination_notice_days": L.days_in, "auto_renewal": L.auto_renewal_answer},
    gold={
        "counterparty": joined_entities,
        "effective_date": first_of(L.first_date),
        "governing_law": first_of(L.jurisdiction_in),
        "termination_notice_days": first_of(L.days_in),
        "auto_renewal": lambda c: F.when(py_strip(c) == "", "").when(c.rlike(L.AUTO_RENEWAL), "yes").otherwise("no"),
    },
    clauses=CONTRACT_CLAUSES,
    tags=CONTRACT_TAGS,
    money_is_finance=True,
    extract=contract_facts,
)
NDA = Vertical(
    name="nda",
    fields=NDA_FIELDS,
    set_fields=("disclosing_party", "receiving_party"),
    judgment_fields=("return_of_materials",),
    risk={"return_of_materials": "high", "confidentiality_period": "high", "term": "high", "disclosing_party": "medium", "receiving_party": "medium", "governing_law": "medium", "effective_date": "low"},
    canonical={"term": L.duration_in, "confidentiality_period": L.duration_in, "return_of_materials": L.return_answer, "governing_law": L.jurisdiction_in},
    gold={
        "disclosing_party": _names,
        "receiving_party": _names,
        "effective_date": lambda c: F.when(L.first_date(c) != "", py_strip(L.first_date(c))).otherwise(py_strip(c)),
        "term": L.duration_in,
        "confidentiality_period": L.duration_in,
        "return_of_materials": lambda c: L.return_answer(c, whole_words=True),
        "governing_law": L.jurisdiction_in,
    },
    clauses=NDA_CLAUSES,
    tags=NDA_TAGS,
    extract=nda_facts,
)
KLEISTER = Vertical(
    name="nda_kleister",
    fields=KLEISTER_FIELDS,
    set_fields=("party",),
    canonical={"effective_date": L.canonical_date, "term": L.canonical_duration, "governing_law": L.jurisdiction_in},
    entities=kleister_entities,
    clauses=NDA_CLAUSES,
    tags=NDA_TAGS,
    extract=kleister_facts,
)
