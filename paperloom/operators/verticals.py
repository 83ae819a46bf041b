"""Verticals: per-domain fields, clause labels, tags, canonical forms and rule extractors, all as Column functions."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paperloom.functions import legal as L
from paperloom.functions.text import ordered_distinct, py_strip

ColumnFn = Callable[[Column], Column]
RISK_TIERS = ("high", "medium", "low")


def _same(c: Column) -> Column:
    return c


@dataclass(frozen=True)
class Vertical:
    """What the generic engines read. ``finders`` maps blocks to candidate facts, see ``operators.extract``."""

    name: str
    fields: tuple[str, ...]
    set_fields: tuple[str, ...] = ()
    judgment_fields: tuple[str, ...] = ()
    risk: Mapping[str, str] = field(default_factory=dict)
    canonical: Mapping[str, ColumnFn] = field(default_factory=dict)
    gold: Mapping[str, ColumnFn] = field(default_factory=dict)
    entities: ColumnFn = L.party_entities
    clauses: tuple[tuple[str, str], ...] = ()
    tags: Mapping[str, str] = field(default_factory=dict)
    money_is_finance: bool = False
    extract: Callable[[DataFrame], DataFrame] | None = None

    def risk_of(self, name: str) -> str:
        return self.risk.get(name) if self.risk.get(name) in RISK_TIERS else "medium"

    def field_table(self, spark: SparkSession) -> DataFrame:
        """field, ord, is_set, is_judgment, risk: as many rows as the vertical has fields."""
        rows = [(f, i, f in self.set_fields, f in self.judgment_fields, self.risk_of(f)) for i, f in enumerate(self.fields)]
        return spark.createDataFrame(rows, "field string, ord int, is_set boolean, is_judgment boolean, risk string")

    def by_field(self, fns: Mapping[str, ColumnFn], c: Column, name: Column) -> Column:
        """Applies the function of each row's field; fields without one keep their value."""
        out = c
        for f, fn in fns.items():
            out = F.when(name == f, fn(c)).otherwise(out)
        return out

    def canonicalize(self, c: Column, name: Column) -> Column:
        return self.by_field(self.canonical, c, name)

    def classify(self, heading: Column, text: Column) -> Column:
        """The first label whose pattern is found in the lower-case heading and text."""
        hay = F.lower(F.concat(F.coalesce(heading, F.lit("")), F.lit(" "), text))
        out = F.lit("other")
        for label, pattern in reversed(self.clauses):
            out = F.when(hay.rlike(pattern), label).otherwise(out)
        return out

    def permission_tags(self, label: Column, text: Column) -> Column:
        base = F.coalesce(*[F.when(label == k, F.lit(v)) for k, v in self.tags.items()], F.lit("general"))
        finance = F.when(text.rlike(r"\$\s?\d"), "finance") if self.money_is_finance else F.lit(None).cast("string")
        restricted = F.when(text.rlike("(?i)confidential|proprietary"), "restricted")
        return F.array_sort(F.array_distinct(F.array_compact(F.array(base, finance, restricted))))

    def normalize_gold(self, gold: DataFrame) -> DataFrame:
        """Raw labels (doc_id, field, value) in the answer space; values may be stringified lists of spans."""
        return gold.withColumn("value", self.by_field(self.gold, F.coalesce("value", F.lit("")), F.col("field")))


def enrich(chunks: DataFrame, vertical: Vertical) -> DataFrame:
    """Adds clause_type and permission_tags."""
    typed = chunks.withColumn("clause_type", vertical.classify(F.col("heading"), F.col("text")))
    return typed.withColumn("permission_tags", vertical.permission_tags(F.col("clause_type"), F.col("text")))


def spans(c: Column) -> Column:
    """The strings of a stringified list; any other text is its own only span."""
    inner = F.regexp_extract_all(c, F.lit(r"""'((?:[^'\\]|\\.)*)'|"((?:[^"\\]|\\.)*)\""""), F.lit(0))
    plain = F.transform(inner, lambda s: F.regexp_replace(F.substring(s, F.lit(2), F.length(s) - 2), r"\\(.)", "$1"))
    t = py_strip(c)
    return F.when(t == "", F.array().cast("array<string>")).when(t.rlike(r"(?s)^\[.*\]$"), plain).otherwise(F.array(t))


def first_of(fn: ColumnFn) -> ColumnFn:
    """The first span for which the function gives an answer."""
    return lambda c: F.coalesce(F.try_element_at(F.filter(F.transform(spans(c), fn), lambda v: v != ""), F.lit(1)), F.lit(""))


def joined_entities(c: Column) -> Column:
    return F.array_join(ordered_distinct(F.flatten(F.transform(spans(c), L.party_entities))), "; ")


def kleister_entities(c: Column) -> Column:
    """Segments between semicolons: their corporate names, or the segment as it is."""
    segments = F.filter(F.transform(F.split(c, ";"), py_strip), lambda s: s != "")
    each = F.transform(segments, lambda s: F.when(F.size(L.party_entities(s)) > 0, L.party_entities(s)).otherwise(F.array(s)))
    return ordered_distinct(F.flatten(each))


#: Clause labels in match order with their patterns, and the labels' tags.
CONTRACT_CLAUSES = (
    ("governing_law", r"governing law|governed by|jurisdiction|\bvenue\b"),
    ("confidentiality", r"confidential|non-?disclosure|proprietary information"),
    ("indemnification", r"indemnif"),
    ("intellectual_property", r"intellectual property|patent|copyright|trademark|\blicense\b"),
    ("termination", r"terminat"),
    ("renewal", r"renew|successive (?:term|period)"),
    ("payment", r"payment|\bfees?\b|invoice|compensation|\bprice\b|royalt"),
    ("liability", r"liabilit|limitation of liability|\bdamages\b"),
    ("warranty", r"warrant"),
    ("assignment", r"assign"),
)
CONTRACT_TAGS = {
    "payment": "finance", "intellectual_property": "legal:ip", "confidentiality": "restricted", "indemnification": "legal", "liability": "legal",
    "governing_law": "legal", "termination": "legal", "renewal": "legal", "warranty": "legal", "assignment": "legal",
}
NDA_CLAUSES = (
    ("governing_law", r"governing law|governed by|jurisdiction|\bvenue\b"),
    ("return_of_materials", r"return or destroy|return and destroy|return all|promptly destroy|destroy all"),
    ("definition", r"definition of|\bmeans any\b|shall mean|defined (?:as|term)"),
    ("term", r"remain in (?:full )?(?:force|effect)|term of this|for a (?:term|period) of"),
    ("permitted_use", r"permitted (?:use|purpose)|solely (?:for|to)|sole purpose|solely in connection"),
    ("remedies", r"injunctive relief|irreparable harm|equitable relief|\bremed(?:y|ies)\b"),
    ("exclusions", r"publicly available|already known|independently developed|in the public domain"),
    ("confidentiality", r"confidential|non-?disclosure|proprietary"),
)
NDA_TAGS = {
    "confidentiality": "restricted", "definition": "restricted", "return_of_materials": "legal", "term": "legal", "governing_law": "legal",
    "permitted_use": "legal", "remedies": "legal", "exclusions": "legal",
}

_registry: dict[str, Vertical] = {}


def register(vertical: Vertical) -> Vertical:
    _registry[vertical.name] = vertical
    return vertical


def get(name: str | None = None) -> Vertical:
    """A registered vertical; the contract one unless named."""
    from paperloom.operators import extract

    for v in (extract.CONTRACT, extract.NDA):
        _registry.setdefault(v.name, v)
    if (name or "contract") not in _registry:
        raise KeyError(f"unknown vertical {name!r}; known: {', '.join(sorted(_registry))}")
    return _registry[name or "contract"]
