"""Language-model scores by a weighted backoff automaton.

The model grows with the corpus: every word of the training texts, and every pair and triple of
words that occurs at least ``least`` times there, has an arc. The automaton's states are the
histories that have arcs; an arc carries a discounted log-probability, and a failure arc
the weight with which a state backs off to its shorter history. Counts, arcs and failure weights are
distributed tables of packed arrays (see ``packed``), dealt by the first bits of their keys.

A path's weight is a sum over the n-grams of the text: as a triple's pairs and a pair's words
have arcs too, an n-gram adds its arc's weight, less what its text costs without that arc, plus
its failure weight where it is a history. So a text needs one number for each of its n-grams, and fetches
them by a join. Only the ``core`` most frequent words and the ``kept`` most frequent pairs and triples form a broadcast
automaton that is traversed from left to right instead. The two bounds decide where a weight is looked up, not
what is in the model. Bit filters of fixed size spare the join most n-grams that have no arc; the join is exact
whatever they let through. A word without an arc at the root costs log10(1 / (N + V + 1)).
All probabilities of a state add up to one.

Words are ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; words, pairs, triples and texts are known by
64-bit hashes. Each text ends in one end token. Null texts are empty: one end token. Repeated rows are scored
each for itself; an empty training set makes every word unknown.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce
from itertools import groupby
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paperloom.llm import packed
from paperloom.llm.common import Scratch, batched_words, bounds, lean, materialize, shuffles_removed
from paperloom.llm.packed import Arrays, Gathered, Row, Table, cut, exact_order, order_of

FINISH = np.array([0x5EED0F7EE7D06], np.int64)  # the end token's key
DISCOUNT = 0.5
FLUSH = 1_000_000
TURN = {2: 21, 3: 32}  # by how much the first part's key is turned in an n-gram's key
FILTER_BITS = 27  # a filter has 2 ** FILTER_BITS bits


def turned(keys: np.ndarray, n: int) -> np.ndarray:
    x, r = keys.view(np.uint64), np.uint64(TURN[n])
    return ((x << r) | (x >> (np.uint64(64) - r))).view(np.int64)


class Tally:
    """Counts of n-grams by 64-bit key, merged when there are many and then handed on. ``heads``: each key's first part.

    Now and then a key has two rows (see ``order_of``), whose counts are added where all tasks' are.
    """

    def __init__(self, n: int) -> None:
        self.n = n
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray, heads: np.ndarray) -> None:
        if len(keys):
            self.parts.append((keys, heads, np.ones(len(keys), np.int64)))
            self.held += len(keys)

    def merge(self) -> None:
        if self.parts:
            keys, heads, n = (np.concatenate([p[i] for p in self.parts]) for i in range(3))
            at = order_of(keys)
            keys = keys[at]
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            self.parts = [(keys[first], heads[at[first]], np.add.reduceat(n[at], first))]
            self.held = len(first)

    def full(self) -> bool:
        if self.held > 2 * FLUSH:
            self.merge()
        return self.held > FLUSH and len(self.parts) == 1

    def take(self) -> Iterator[pa.RecordBatch]:
        """Heads, keys and counts, in the order of ``order_of`` by key."""
        self.merge()
        for k, heads, n in self.parts:
            yield pa.RecordBatch.from_arrays([pa.array(heads), pa.array(k), pa.array(n)], ["a", "key", "n"])
        self.parts, self.held = [], 0


def token_keys(texts: list[str | None]) -> list[np.ndarray]:
    """The keys of each text's words and its end."""
    return [np.concatenate([h.view(np.int64), FINISH]) for h in batched_words(texts)]


def token_run(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token keys of all texts in a row, a flag at each text's first, and the places of these."""
    each = token_keys(texts)
    places = np.cumsum([0, *map(len, each)])[:-1]
    tokens = np.concatenate(each)
    start = np.zeros(len(tokens), bool)
    start[places] = True
    return tokens, start, places


def ending(keys: np.ndarray, n: int) -> np.ndarray:
    """Keys of the n-grams that end at each place, from those of their last n - 1 words; the first place has none."""
    out = keys.copy()
    out[1:] ^= turned(keys[:-1], n)
    return out


class Filter:
    """A bit per key's first FILTER_BITS bits: keys it does not hold have no arc."""

    def __init__(self, counted: DataFrame) -> None:
        self.bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
        for r in packed.of_kind(counted, BITS).select("part", F.col("data")[0].alias("bits")).collect():  # 2 ** FILTER_BITS bits at most
            held = np.frombuffer(r["bits"], np.int64)
            self.bits[r["part"] * len(held) : (r["part"] + 1) * len(held)] = held

    @staticmethod
    def of_part(keys: np.ndarray, bits: int) -> bytes:
        """The bits of the keys of one of 2 ** ``bits`` parts."""
        held = np.zeros(1 << (FILTER_BITS - bits), np.uint8)
        held[(keys.view(np.uint64) << np.uint64(bits) >> np.uint64(64 - FILTER_BITS + bits)).view(np.int64)] = 1
        return np.packbits(held, bitorder="little").tobytes()

    def has(self, keys: np.ndarray) -> np.ndarray:
        spot = (keys.view(np.uint64) >> np.uint64(64 - FILTER_BITS)).view(np.int64)
        return self.bits[spot >> 6] >> (spot & 63) & 1 == 1


WORDS, NGRAMS, BITS = 0, 1, 2  # kinds of rows among counts: keys and counts; keys, counts and heads; a filter's bits


def _counted(texts: DataFrame, bits: int, least: int, pairs: Broadcast | None = None) -> DataFrame:
    """Counts of the n-grams of all texts, pairs and triples of ``least`` or more.

    Without ``pairs``: words and pairs. With ``pairs``, the filter of the pairs that are kept: triples; one is as frequent as its
    pairs at most, so others are left out.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[Row]:
        tallies = [Tally(3)] if pairs else [Tally(1), Tally(2)]
        for batch in batches:
            if not len(batch):
                continue
            tokens, start, _ = token_run(batch.column(0).to_pylist())
            heads, keys, at = tokens, ending(tokens, 2), ~start
            if pairs:
                at &= pairs.value.has(keys)
                at[1:] &= at[:-1].copy()
                at[:1] = False
                heads, keys = keys, ending(keys, 3)
            else:
                tallies[0].add(tokens, tokens)
            at = np.flatnonzero(at)
            tallies[-1].add(keys[at], heads[at - 1])
            for t in tallies:
                if t.full():
                    yield from dealt(t)
        for t in tallies:
            yield from dealt(t)

    def dealt(tally: Tally) -> Iterator[Row]:
        for batch in tally.take():
            heads, keys, n = (c.to_numpy() for c in batch.columns)
            yield from cut(bits, WORDS, keys, n) if tally.n == 1 else cut(bits, NGRAMS, keys, n, heads)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from packed.batched(rows(batches))

    return packed.mapped(packed.met(texts.select("text").mapInArrow(lean(run), packed.SCHEMA)), partial(_summed, bits, least))


def _summed(bits: int, least: int, rows: Iterator[Arrays]) -> Iterator[Row]:
    for (part, kind), group in groupby(rows, itemgetter(0, 1)):
        columns = [np.concatenate(c) for c in zip(*(r[3] for r in group))]
        at = exact_order(columns[0])
        columns = [c[at] for c in columns]
        first = bounds(columns[0])[:-1]
        columns[1] = np.add.reduceat(columns[1], first)
        keys, n, *heads = (c if i == 1 else c[first] for i, c in enumerate(columns))
        if kind == NGRAMS:
            often = np.flatnonzero(n >= least)
            keys, n, heads = keys[often], n[often], [heads[0][often]]
            if len(keys):
                yield part, BITS, 0, [Filter.of_part(keys, bits)]
        yield from cut(bits, kind, keys, n, *heads)


class Places:
    """Places of keys in a sorted array of 64-bit hashes, by a table over their first bits."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = keys
        bits = max(1, (2 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(self._bucket(keys), np.arange((1 << bits) + 1)).astype(np.int32)

    def _bucket(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) ^ np.uint64(1 << 63)) >> self.shift).view(np.int64)

    def of(self, wanted: np.ndarray) -> np.ndarray:
        """-1 for keys that are not there."""
        if not len(self.keys):
            return np.full(len(wanted), -1, np.int64)
        bucket = self._bucket(wanted)
        at, end = self.first[bucket].astype(np.int64), self.first[bucket + 1]
        out = np.full(len(wanted), -1, np.int64)
        todo = np.flatnonzero(at < end)
        while len(todo):
            hit = self.keys[at[todo]] == wanted[todo]
            out[todo[hit]] = at[todo[hit]]
            todo = todo[~hit]
            at[todo] += 1
            todo = todo[at[todo] < end[todo]]
        return out


@dataclass
class BackoffAutomaton:
    """Histories as states, sorted keys as arcs, failure weights per state.

    The root is state 0; a state of one word is 1 + its number; a state of two words is known by its pair's
    place. The state after a word is the longest suffix of what was read that is a state. Where a state
    has no arc for the next word, its failure arc leads to its history without the first word.
    """

    size: int
    root: np.ndarray  # log10 probability of each core word
    pairs: np.ndarray  # sorted first * size + second
    pair_log: np.ndarray
    one_fail: np.ndarray  # failure weight by word; 0 where the word is no state
    triples: np.ndarray  # sorted place of the pair * size + third
    triple_log: np.ndarray
    two_fail: np.ndarray  # failure weight by the pair's place; 0 where the pair is no state

    def traverse(self, ids: np.ndarray) -> float:
        """Log10 probability of a text's words; words outside the core (-1) cost only the failure arcs of the state they meet."""
        if not len(ids):
            return 0.0
        start = np.arange(len(ids)) == 0
        arc2 = self.pair_arcs(ids, start)
        return float(self.weights(ids, start, arc2, self.triple_arcs(ids, start, arc2)).sum())

    def pair_arcs(self, ids: np.ndarray, start: np.ndarray) -> np.ndarray:
        """The pair that each word ends, -1 where it has no arc; ``start`` flags the texts' first words."""
        before = np.where(start, -1, np.roll(ids, 1))
        return self._arcs(self.pairs, before, ids)

    def triple_arcs(self, ids: np.ndarray, start: np.ndarray, arc2: np.ndarray) -> np.ndarray:
        """The triple that each word ends, -1 where it has no arc."""
        held = np.where(start, -1, np.roll(arc2, 1))  # the two-word history each word meets
        return self._arcs(self.triples, held, ids)

    def _arcs(self, arcs: np.ndarray, states: np.ndarray, ids: np.ndarray) -> np.ndarray:
        out = np.full(len(ids), -1, np.int64)
        at = np.flatnonzero((states >= 0) & (ids >= 0))
        out[at] = self._find(arcs, states[at] * self.size + ids[at])
        return out

    def weights(self, ids: np.ndarray, start: np.ndarray, arc2: np.ndarray, arc3: np.ndarray) -> np.ndarray:
        """What each word costs, by the arcs of the pairs and triples that it ends."""
        n = len(ids)
        inside = ids >= 0
        u, held = (np.where(start, -1, np.roll(x, 1)) for x in (ids, arc2))
        fail2 = np.where(held >= 0, self.two_fail[held], 0.0) if len(self.two_fail) else np.zeros(n)
        fail1 = np.where(u >= 0, self.one_fail[u], 0.0)
        lower = np.where(arc2 >= 0, self.pair_log[arc2] if len(self.pair_log) else 0.0, fail1 + np.where(inside, self.root[ids], 0.0))
        return np.where(arc3 >= 0, self.triple_log[arc3] if len(self.triple_log) else 0.0, fail2 + lower)

    @staticmethod
    def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Places of the wanted keys, -1 for those that are not there."""
        if not len(keys):
            return np.full(len(wanted), -1, np.int64)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, at, -1)


def _failure(group: np.ndarray, states: int, mass: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Per state the log10 weight that makes its kept and backed-off probabilities add up to one."""
    kept, below = np.bincount(group, mass, states), np.bincount(group, lower, states)
    return np.where(kept > 0, np.log10(np.maximum(1 - kept, 1e-9) / np.maximum(1 - below, 1e-9)), 0.0)


def build_automaton(core: np.ndarray, total: int, distinct: int, pairs: np.ndarray, pair_n: np.ndarray, triples: np.ndarray, triple_n: np.ndarray) -> BackoffAutomaton:
    """``core``: counts by core number; ``pairs``: sorted first * size + second; ``triples``: sorted place of the pair * size + third."""
    size = max(1, len(core))
    root = np.log10((core + 1.0) / (total + distinct + 1)) if len(core) else np.zeros(1)
    first, second = pairs // size, pairs % size
    p2 = (pair_n - DISCOUNT) / core[first] if len(pairs) else np.empty(0)
    one_fail = _failure(first, size, p2, 10 ** root[second])
    out = BackoffAutomaton(size, root, pairs, np.log10(p2), one_fail, triples, np.empty(0), np.empty(0))
    if len(pairs):
        held, third = triples // size, triples % size
        p3 = (triple_n - DISCOUNT) / pair_n[held]
        middle = second[held]
        arc = out._find(pairs, middle * size + third)
        below = 10 ** np.where(arc >= 0, out.pair_log[arc], one_fail[middle] + root[third])
        out.two_fail = _failure(held, len(pairs), p3, below)
        out.triple_log = np.log10(p3)
    return out


SHORT, SUMS, LONG, LEVEL, HOT = 0, 1, 2, 3, 4  # kinds of rows of the stages below


def _level(cost: float, columns: list[np.ndarray]) -> list[np.ndarray]:
    """Keys, counts, probabilities and weights of shorter n-grams; words come with keys and counts only. ``cost`` is N + V + 1."""
    if len(columns) == 4:
        return [*columns[:2], *(c.view(float) for c in columns[2:])]
    keys, n = columns
    return [keys, n, (n + 1) / cost, np.log10(n + 1.0)]


def _by_last(bits: int, n: int, rows: Iterator[Arrays]) -> Iterator[Row]:
    """N-grams dealt by the keys of their last n - 1 words."""
    held = Gathered()
    for _, _, _, (keys, count, heads) in rows:
        held.add(keys ^ turned(heads, n), count, heads)
        if held.full():
            for columns in held.take():
                yield from cut(bits, LONG, *columns)
    for columns in held.take():
        yield from cut(bits, LONG, *columns)


def _with_lower(bits: int, cost: float, rows: Iterator[Arrays]) -> Iterator[Row]:
    """N-grams with the probability of their last n - 1 words, dealt by the keys of their first; and what these add up to for each of those."""

    def dealt() -> Iterator[Row]:
        for heads, lasts, count, lower in held.take():
            first = bounds(heads)[:-1]
            yield from cut(bits, SUMS, heads[first], np.add.reduceat(count - DISCOUNT, first), np.add.reduceat(lower, first))
            yield from cut(bits, LONG, heads, lasts, count, lower)

    held = Gathered()
    for group in packed.by_part(rows):
        table = Table()
        for _, kind, _, columns in group:
            if kind == SHORT:
                table.add(_level(cost, columns))
                continue
            lasts, count, heads = columns
            hit, at = table.find(lasts)
            if len(hit):
                held.add(heads[hit], lasts[hit], count[hit], table.columns[2][at])
            if held.full():
                yield from dealt()
    yield from dealt()


def _raised(bits: int, n: int, cost: float, often: int, rows: Iterator[Arrays]) -> Iterator[Row]:
    """What shorter n-grams add to a text's weight (SHORT), the failure weights of those of ``often`` occurrences (HOT), and the level of the longer ones (LEVEL).

    A part has the shorter n-grams first, then what its n-grams add up to for each history, then these.
    """

    def failures() -> np.ndarray:
        kept = mass / table.columns[1]
        return np.where(mass > 0, np.log10(np.maximum(1 - kept, 1e-9) / np.maximum(1 - below, 1e-9)), 0.0)

    def dealt() -> Iterator[Row]:
        for keys, count, probability, weight in held.take():
            yield from cut(bits, LEVEL, keys, count, probability, weight) if n == 2 else cut(bits, LEVEL, keys, weight)

    held = Gathered()
    for group in packed.by_part(rows):
        table, fail = Table(), None
        mass = below = np.empty(0)
        for kind, some in groupby(group, itemgetter(1)):
            if kind == SHORT:
                for r in some:
                    table.add(_level(cost, r[3]))
                mass, below = np.zeros((2, len(table.columns[0])))
            elif kind == SUMS:
                for _, _, _, (heads, *sums) in some:
                    hit, at = table.find(heads)
                    for total, x in zip((mass, below), sums):
                        np.add.at(total, at, x.view(float)[hit])
            else:
                fail = failures()
                for _, _, _, (heads, lasts, count, lower) in some:
                    hit, at = table.find(heads)
                    if not len(hit):
                        continue
                    probability = (count[hit] - DISCOUNT) / table.columns[1][at]
                    held.add(turned(heads[hit], n) ^ lasts[hit], count[hit], probability, np.log10(probability) - np.log10(lower.view(float)[hit]) - fail[at])
                    if held.full():
                        yield from dealt()
        if len(table.columns) > 1:
            keys, count, _, weight = table.columns
            fail = failures() if fail is None else fail
            yield from cut(bits, SHORT, keys, count, weight + fail) if n == 2 else cut(bits, SHORT, keys, weight + fail)
            at = np.flatnonzero(count >= often)
            yield from cut(bits, HOT, keys[at], count[at], fail[at])
    yield from dealt()


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many n-grams have which count, counts of 2 ** 20 and more as one; and the sum of these."""
    for _, kind, _, (_, n, *_) in packed.arrays(batches):
        size, at = np.unique(np.minimum(n, 1 << 20), return_inverse=True)
        numbers = [np.full(len(size), kind), size, np.bincount(at), np.bincount(at, n).astype(np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in numbers], ["kind", "n", "c", "total"])


def _often(bits: int, least: int, rows: Iterator[Arrays]) -> Iterator[Row]:
    for _, kind, _, (keys, n, *more) in rows:
        at = np.flatnonzero(n >= least)
        yield from cut(bits, kind, keys[at], n[at], *(x[at] for x in more))


def _collected(rows: DataFrame, columns: int) -> list[np.ndarray]:
    """The arrays of a small table, in order of its keys."""
    held = [[packed.numbers(x) for x in r["data"]] for r in rows.select("data").collect()]
    out = [np.concatenate(c) for c in zip(*held)] if held else [np.empty(0, np.int64)] * columns
    at = np.argsort(out[0])
    return [c[at] for c in out]


class Model:
    """The tables of a training set's model: what words, pairs and triples add to the weight of a text that has them.

    Counts and levels (key, count, probability, weight) are deleted once these and the automaton of the frequent n-grams are made of them.
    """

    def __init__(self, training: DataFrame, least: int, core: int, kept: int) -> None:
        spark = training.sparkSession
        self.scratch = Scratch(spark)
        keep, drop, broadcast = self.scratch.keep, self.scratch.drop, spark.sparkContext.broadcast
        size = training.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        # Parts of up to 4 MB of text, of 1 MB where there are less than 256. Smaller parts would be dealt more evenly, but in many small rows.
        self.bits = min(20, max(6, min(8, (size >> 20).bit_length()), (size >> 22).bit_length()))
        bits, of_kind, least = self.bits, packed.of_kind, max(least, 2)

        counted = keep(_counted(training, bits, least), "counted2", by="kind")
        sizes = self.sizes(counted)
        words = sizes[sizes["kind"] == WORDS]
        self.total, self.distinct = int(words["total"].sum()), int(words["c"].sum())
        self.unit, cost = math.log10(self.total + self.distinct + 1), float(self.total + self.distinct + 1)

        def raised(n: int, shorter: DataFrame, often: int) -> DataFrame:
            lower = packed.mapped(packed.met(shorter, packed.mapped(of_kind(counted, NGRAMS), partial(_by_last, bits, n))), partial(_with_lower, bits, cost))
            return keep(packed.mapped(packed.met(shorter, lower), partial(_raised, bits, n, cost, often)), f"raised{n}", by="kind")

        core_least, pair_least = self.fewest(sizes, WORDS, core, 2), self.fewest(sizes, NGRAMS, kept, least)
        hot_pairs = _collected(packed.mapped(of_kind(counted, NGRAMS), partial(_often, bits, pair_least)), 3)  # ``kept`` at most
        self.pair_filter = broadcast(Filter(counted))
        of_words = raised(2, of_kind(counted, WORDS, SHORT), core_least)
        drop("counted2")
        counted = keep(_counted(training, bits, least, self.pair_filter), "counted3", by="kind")
        triple_least = self.fewest(self.sizes(counted), NGRAMS, kept, least)
        hot_triples = _collected(packed.mapped(of_kind(counted, NGRAMS), partial(_often, bits, triple_least)), 3)  # ``kept`` at most
        self.triple_filter = broadcast(Filter(counted))
        of_pairs = raised(3, of_kind(of_words, LEVEL, SHORT), pair_least)
        drop("counted3", f"raised2/kind={LEVEL}")
        self.automaton = broadcast(self.hot(_collected(of_kind(of_words, HOT), 3), _collected(of_kind(of_pairs, HOT), 3), hot_pairs, hot_triples))
        # What the two parts of the n-grams of a text add.
        self.added = [[of_kind(of_words, SHORT, 0), of_kind(of_pairs, SHORT, 1)], [of_kind(of_pairs, LEVEL, 1)]]

    def sizes(self, counted: DataFrame) -> pd.DataFrame:
        found = counted.where(F.col("kind") != BITS).mapInArrow(_frequencies, "kind long, n long, c long, total long")
        return found.groupBy("kind", "n").agg(F.sum("c").alias("c"), F.sum("total").alias("total")).toPandas()  # 2 ** 20 rows a kind at most

    def fewest(self, sizes: pd.DataFrame, kind: int, limit: int, least: int) -> int:
        """The least count from which on there are ``limit`` n-grams at most."""
        of = sizes[sizes["kind"] == kind].sort_values("n", ascending=False)
        enough = of["n"][of["c"].cumsum() <= limit]
        return max(least, int(enough.min()) if len(enough) else 1 << 62)

    def hot(self, words: list[np.ndarray], failing: list[np.ndarray], pairs: list[np.ndarray], triples: list[np.ndarray]) -> tuple[BackoffAutomaton, Places]:
        """The automaton of the most frequent n-grams with the whole model's weights, and the places of its words.

        ``words``, ``failing`` (pairs): keys, counts and failure weights; ``pairs``, ``triples``: keys, counts and heads.
        """
        keys, n, one_fail = words[0], words[1], words[2].view(float)
        size = max(1, len(keys))
        root = np.log10(n + 1.0) - self.unit if len(n) else np.zeros(1)
        core = Places(keys)
        key, count, heads = pairs
        first, second = core.of(heads), core.of(key ^ turned(heads, 2))
        at = np.flatnonzero((first >= 0) & (second >= 0))
        at = at[np.argsort(first[at] * size + second[at])]
        key, count, first, second = key[at], count[at], first[at], second[at]
        two_fail = failing[2].view(float)[np.searchsorted(failing[0], key)] if len(key) else np.empty(0)
        place = pd.Series(np.arange(len(key)), key)
        held, last = (place.reindex(x).fillna(-1).to_numpy(np.int64) for x in (triples[2], triples[0] ^ turned(triples[2], 3)))
        at = np.flatnonzero((held >= 0) & (last >= 0))
        arc = held[at] * size + second[last[at]]
        at, arc = at[np.argsort(arc)], np.sort(arc)
        triple_log = np.log10((triples[1][at] - DISCOUNT) / count[held[at]])
        pair_log = np.log10((count - DISCOUNT) / n[first]) if len(key) else np.empty(0)
        return BackoffAutomaton(size, root, first * size + second, pair_log, one_fail if len(n) else np.zeros(1), arc, triple_log, two_fail), core


def score(docs: DataFrame, training: DataFrame, core: int = 250_000, kept: int = 150_000, least: int = 2) -> DataFrame:
    """All columns of ``docs`` but its text, with n_tokens, n_known, train_tokens, base_score and score.

    ``training`` holds the texts to learn from; pairs and triples of at least ``least`` occurrences (2 or more) count. ``core`` words
    and ``kept`` pairs and triples, the most frequent, are broadcast at most. Log-probabilities are decimal. Columns of ``docs`` that
    have the name of a result are replaced.
    """
    spark = docs.sparkSession
    with shuffles_removed(spark):  # each table is written once
        return _scored(spark, docs.drop(*RESULTS), Model(training, least, core, kept))


RESULTS = ("n_tokens", "n_known", "train_tokens", "base_score", "score")


BLOCK = 100_000  # texts of a block, about
ADDED, ASKED, TEXTS = 0, 2, 4  # kinds of rows of a look-up: tables, what is asked of them (words, then n-grams, both), and a block's texts


def _looked_up(bits: int, rows: Iterator[Arrays]) -> Iterator[Row]:
    """For the places of each block's texts what the n-grams that they ask for add, to their weight and (words) to the sum of unigrams, and how many there are."""

    def sums() -> Iterator[Row]:
        for block, answers in found.items():
            spots, *columns = (np.concatenate(c) for c in zip(*answers))
            touched = np.flatnonzero(np.bincount(spots))
            yield _home(block, bits), ASKED, block, [packed.planes(x) for x in (touched, *(np.bincount(spots, c)[touched] for c in columns))]
        found.clear()

    found: dict[int, list[tuple[np.ndarray, ...]]] = {}
    n = 0
    for group in packed.by_part(rows):
        tables = [Table(), Table()]
        for part, kind, block, columns in group:
            if kind == TEXTS:
                yield part, TEXTS, block, [packed.planes(x) for x in columns]
            elif kind < ASKED:
                tables[kind].add(columns)
            else:
                table = tables[kind - ASKED]
                hit, at = table.find(columns[0])
                if not len(hit):
                    continue
                add, word = table.columns[-1].view(float)[at], kind == ASKED
                base = np.log10(table.columns[1][at] + 1.0) if word else np.zeros(len(hit))
                found.setdefault(block, []).append((columns[1][hit], add, base, np.full(len(hit), float(word))))
                n += len(hit)
                if n > packed.FLUSH:
                    yield from sums()
                    n = 0
    yield from sums()


def _home(block: int, bits: int) -> int:
    """The part in which a block's rows meet."""
    mixed = (block ^ block >> 24) * 0x9E3779B97F4A7C15 & (1 << 64) - 1
    return mixed >> 64 - bits


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each text of a block: its name, what its traversal gives, and what its look-ups add."""
    for _, group in groupby(packed.arrays(batches), itemgetter(2)):
        texts, sums = None, None
        for _, kind, _, columns in sorted(group, key=lambda r: -r[1]):
            if kind == TEXTS:
                texts, sums = columns, np.zeros((3, len(columns[0])))
            else:
                for total, x in zip(sums, columns[1:]):
                    np.add.at(total, columns[0], x.view(float))
        yield pa.RecordBatch.from_arrays([pa.array(texts[0]), *(pa.array(x.view(float)) for x in texts[1:]), *map(pa.array, sums)], TOLD)


TOLD = ["__text", "tokens", "core", "base", "score", "add", "plain", "hits"]


def _scored(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    unit, total, bits = model.unit, model.total, model.bits
    automaton, pair_filter, triple_filter = model.automaton, model.pair_filter, model.triple_filter

    own = [f.name for f in docs.schema if f.name != "text"]
    texts = docs.select("text", F.xxhash64("text").alias("__text"))

    def asked(part: int, batches: Iterator[pa.RecordBatch]) -> Iterator[Row]:
        """The words and pairs (part 0) or triples (part 1) of each text whose weight is not broadcast, and the texts themselves with what their traversal gives (part 1)."""
        fsm, core = automaton.value
        own_cost = np.append(fsm.root, -unit)
        held, told, block = [Gathered(), Gathered()], [], TaskContext.get().partitionId() << 24

        def dealt() -> Iterator[Row]:
            if told:
                yield _home(block, bits), TEXTS, block, [packed.planes(np.concatenate(x)) for x in zip(*told)]
            for kind, of in enumerate(held):
                for columns in of.take():
                    yield from cut(bits, ASKED + kind, *columns, block=block)

        for batch in batches:
            if not len(batch):
                continue
            named = batch.column(1).to_numpy(zero_copy_only=False)
            tokens, start, places = token_run(batch.column(0).to_pylist())
            text = np.repeat(np.arange(len(named)) + sum(len(x[0]) for x in told), np.diff(np.append(places, len(tokens))))
            ids = core.of(tokens)
            arc2 = fsm.pair_arcs(ids, start)
            pairs = ending(tokens, 2)
            may2 = ~start & pair_filter.value.has(pairs)
            summed = [np.zeros(len(named))] * 4
            if part == 0:
                wanted = ((0, tokens, ids < 0), (1, pairs, may2 & (arc2 < 0)))
            else:
                arc3 = fsm.triple_arcs(ids, start, arc2)
                inside = ids >= 0
                summed = [np.add.reduceat(x, places) for x in (np.ones(len(ids)), inside.astype(float), own_cost[ids], np.where(inside, 0.0, -unit) + fsm.weights(ids, start, arc2, arc3))]
                triples = ending(pairs, 3)
                may3 = may2 & np.append(False, may2[:-1]) & (arc3 < 0)
                may3[may3] = triple_filter.value.has(triples[may3])
                wanted = ((1, triples, may3),)
            told.append((named, *summed))
            for kind, keys, at in wanted:
                at = np.flatnonzero(at)
                held[kind].add(keys[at], text[at])
            if sum(x.n for x in held) > packed.FLUSH or sum(len(x[0]) for x in told) > BLOCK:
                yield from dealt()
                told, block = [], block + 1
        yield from dealt()

    def run(part: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from packed.batched(asked(part, batches))

    slices = []
    for part in range(2):  # so that the look-up of the texts' n-grams keeps half on disk at a time
        rows = texts.mapInArrow(lean(partial(run, part)), packed.SCHEMA)
        found = packed.mapped(packed.met(*model.added[part], rows), partial(_looked_up, bits))
        each = packed.met(found, by=("part", "block")).mapInArrow(_told, "__text long, " + ", ".join(f"{c} double" for c in TOLD[1:]))
        # Equal texts have equal numbers.
        slices.append(materialize(each.groupBy("__text").agg(*[F.max(c).alias(f"__{c}{part}") for c in TOLD[1:]]), "fetched"))
        model.scratch.drop(*(("raised2", f"raised3/kind={SHORT}") if part == 0 else ("raised3",)))
    known = slices[1].join(slices[0], "__text", "left")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    each = lambda *c: reduce(Column.__add__, [zero(F.col(f"__{x}")) for x in c])
    known = known.select(
        "__text", each("tokens1").cast("long").alias("n_tokens"), each("core1", "hits0").cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        each("base1", "plain0").alias("base_score"), each("score1", "add0", "add1").alias("score"),
    )
    return docs.select(*own, F.xxhash64("text").alias("__text")).join(known, "__text").select(*own, *RESULTS)
