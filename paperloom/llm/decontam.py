"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may be edited ``m // per_error`` times. Split into one
piece more than that, at least one piece of any copy within the budget is unchanged.
An Aho-Corasick automaton over all pieces finds exact piece hits in the
normalised texts; hits of an item that lie on neighbouring diagonals share one window,
which Myers' bit-parallel distance then verifies. Nothing is missed within the
budget, whatever the mix of insertions, deletions and substitutions.

Texts and items are compared lower-cased with white space collapsed. Items go in blocks
of ``block`` items, one automaton and one pass over the texts each, so that what is
sent to the executors is bounded. Null and empty texts or items match nothing;
repeated items each report their own matches and repeated rows likewise.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, functions as F

HITS = "doc_id long, item_id long, distance int, start int, end int"


def normalise(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def budget(length: int, per_error: int) -> int:
    return length // per_error


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors`` + 1 pieces of nearly equal length, with their places."""
    n = errors + 1
    cuts = [len(item) * k // n for k in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def best_match(item: str, text: str, errors: int) -> tuple[int, int] | None:
    """Myers' algorithm: (distance, end) of the item's best approximate occurrence, the first end on ties.

    None if it is further than ``errors`` edits from every substring.
    """
    m = len(item)
    peq: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        peq[c] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, None
    get = peq.get
    for j, c in enumerate(text):
        eq = get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            if score <= errors and (best is None or score < best[0]):
                best = (score, j + 1)
        ph = ph << 1 & full
        mh = mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
    return best


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[tuple[int, str]], per_error: int) -> None:
        self.items = [(i, t, budget(len(t), per_error)) for i, t in items if t]
        self.automaton = ahocorasick.Automaton()
        at: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for n, (_, t, errors) in enumerate(self.items):
            for place, piece in pieces(t, errors):
                at[piece].append((n, place))
        for piece, places in at.items():
            self.automaton.add_word(piece, (len(piece), places))
        if at:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item id, distance, start, end) of each item's best match in the normalised text."""
        if not text or not self.items:
            return []
        diagonals: dict[int, set[int]] = defaultdict(set)
        for end, (size, places) in self.automaton.iter(text):
            for n, place in places:
                diagonals[n].add(end + 1 - size - place)
        out = []
        for n, found in diagonals.items():
            item, pattern, errors = self.items[n]
            best, m = None, len(pattern)
            ordered, k = sorted(found), 0
            while k < len(ordered):
                first = last = ordered[k]
                while k + 1 < len(ordered) and ordered[k + 1] - last <= 2 * errors:
                    k += 1
                    last = ordered[k]
                k += 1
                low, high = max(0, first - errors), min(len(text), last + m + errors)
                if high - low < m - errors:
                    continue
                if text.startswith(pattern, first) and first >= 0:
                    hit = (0, first, first + m)
                else:
                    hit = self._verify(pattern, text[low:high], errors, low)
                if hit and (best is None or hit < best):
                    best = hit
            if best:
                out.append((item, *best))
        return out

    @staticmethod
    def _verify(pattern: str, window: str, errors: int, low: int) -> tuple[int, int, int] | None:
        if (found := best_match(pattern, window, errors)) is None:
            return None
        distance, end = found
        back = best_match(pattern[::-1], window[max(0, end - len(pattern) - errors) : end][::-1], errors)
        start = end - (back[1] if back else len(pattern))
        return distance, low + start, low + end


def find_items(docs: DataFrame, benchmark: DataFrame, per_error: int = 20, block: int = 5000) -> DataFrame:
    """Every (document, item) whose text holds the item within its budget, with the best match.

    ``docs``: doc_id, text; ``benchmark``: item_id, text. Offsets count normalised characters.
    """
    spark = docs.sparkSession
    items = benchmark.where("text is not null and item_id is not null").select("item_id", "text")
    blocks = max(1, -(-items.count() // block))
    dealt = items.withColumn("__b", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    texts = docs.select("doc_id", "text").where("text is not null")

    def one(b: int) -> DataFrame:
        rows = dealt.where(F.col("__b") == b).select("item_id", "text").distinct().collect()  # a block of the test set
        matcher = spark.sparkContext.broadcast([(r["item_id"], normalise(r["text"])) for r in rows])

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            find = Matcher(matcher.value, per_error).find
            for pdf in batches:
                out = [(doc, item, d, s, e) for doc, text in zip(pdf.doc_id, pdf.text) for item, d, s, e in find(normalise(text))]
                yield pd.DataFrame(out, columns=["doc_id", "item_id", "distance", "start", "end"]).astype({"doc_id": "Int64"})

        return texts.mapInPandas(run, HITS)

    return reduce(DataFrame.unionByName, [one(b) for b in range(blocks)])


def clean_documents(docs: DataFrame, benchmark: DataFrame, per_error: int = 20, block: int = 5000) -> DataFrame:
    """The rows of ``docs`` that hold no item; columns as they came. For up to ``block`` items one pass, for more one pass per block."""
    spark = docs.sparkSession
    items = benchmark.where("text is not null and item_id is not null").select("item_id", "text")
    blocks = max(1, -(-items.count() // block))
    dealt = items.withColumn("__b", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    out = docs
    for b in range(blocks):
        rows = dealt.where(F.col("__b") == b).select("item_id", "text").distinct().collect()
        matcher = spark.sparkContext.broadcast([(r["item_id"], normalise(r["text"])) for r in rows])

        def run(batches: Iterator[pd.DataFrame], matcher=matcher) -> Iterator[pd.DataFrame]:
            find = Matcher(matcher.value, per_error).find
            for pdf in batches:
                yield pdf[[not find(normalise(t)) for t in pdf.text]]

        out = out.mapInPandas(run, docs.schema)
    return out
