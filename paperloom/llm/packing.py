"""Best-fit packing of token sequences by a configuration linear program.

Texts are tokenized with a public vocabulary, ended by id 1, and cut into pieces of at
most ``capacity`` tokens. What the packing decides on is the histogram of piece
lengths, at most ``capacity`` rows whatever the number of pieces. Its configuration
program (how many sequences to fill with each multiset of lengths) is solved by
multiplicative weights: every round prices the lengths, a knapsack dynamic program
finds the dearest fillings, and the prices of what they use fall. Prices over the dearest filling's price bound the
number of sequences from below. Few lengths are priced with their counts, a filling a round, and the solution is rounded down; many lengths
take a filling for each of them from every pricing, in whole sequences. The program is solved again for what is left, and the last
remainder packed best-fit by decreasing length, all on counts. Pieces then find their place by their rank
among the pieces of their length.

Null and empty texts are one piece holding the end token. Repeated rows are packed
as often as they occur; an empty table gives no piece. Only doc_id and text are
read, so other columns may have any name.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, Window, functions as F
from tokenizers import Tokenizer

from paperloom.llm.common import lean, materialize

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
END = (1).to_bytes(4, "little")


def _byte_letters() -> list[str]:
    """Byte-level vocabularies write the printable bytes as themselves, the others from U+0100 on."""
    out, extra = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


class _Memo(dict):
    """Computes what it lacks, and starts anew past a bounded size."""

    LIMIT = 300_000

    def __init__(self, compute) -> None:
        self.compute = compute

    def __missing__(self, key):
        if len(self) >= self.LIMIT:
            self.clear()
        self[key] = out = self.compute(key)
        return out


class ChunkTokenizer:
    """Token ids of white-space separated chunks, remembered.

    No token of a vocabulary that drops white space reaches over it, so a text's ids are its
    chunks' ids. Printable Latin-1 chunks are split into pieces here and only the
    pieces go through the vocabulary's merges; any other chunk is encoded as a whole.
    """

    PLAIN = regex.compile(r"[\x21-\x7E\xA1-\xFF]+")
    PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")

    def __init__(self, path: str) -> None:
        self.whole = Tokenizer.from_file(path)
        self.merge = self.whole.model.tokenize
        self.letters = _byte_letters()
        self.memos = [_Memo(self._chunk), _Memo(self._piece)]
        self.chunk, self.piece = (m.__getitem__ for m in self.memos)

    def forget(self) -> None:
        """Workers outlive tasks; what they remember should not."""
        for m in self.memos:
            m.clear()

    def ids(self, text: str | None) -> bytes:
        """The text's ids, little-endian unsigned 32-bit."""
        return b"".join(map(self.chunk, text.encode().split())) if text else b""

    def _chunk(self, word: bytes) -> bytes:
        if word.isalpha():  # ASCII letters are one piece and stand for themselves
            return self._merged(word.lower().decode())
        text = word.decode()
        if "<|" in text or not self.PLAIN.fullmatch(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.piece, self.PIECE.findall(text.lower())))

    def _piece(self, piece: str) -> bytes:
        return self._merged(piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()]))

    def _merged(self, mapped: str) -> bytes:
        return b"".join([t.id.to_bytes(4, "little") for t in self.merge(mapped)])


_tokenizers: dict[str, ChunkTokenizer] = {}


def tokenizer(path: str) -> ChunkTokenizer:
    """One tokenizer per worker process."""
    if path not in _tokenizers:
        _tokenizers[path] = ChunkTokenizer(path)
    return _tokenizers[path]


def cut(docs: DataFrame, vocabulary: str, capacity: int = 4096) -> DataFrame:
    """One row per piece, kept in the shared folder."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = tokenizer(vocabulary).ids
        try:
            yield from pieces_of(batches, encode)
        finally:
            tokenizer(vocabulary).forget()

    def pieces_of(batches: Iterator[pd.DataFrame], encode) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc, text in zip(pdf.doc_id, pdf.text):
                ids = encode(text) + END
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    piece = ids[at : at + 4 * capacity]
                    rows.append((doc, k, at // 4, len(piece) // 4, zlib.crc32(piece)))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield out.astype({"doc_id": "Int64"})

    return materialize(docs.select("doc_id", "text").mapInPandas(lean(run), PIECES), "pieces")


Patterns = list[tuple[tuple[int, ...], int]]


class Knapsack:
    """Pricing: the multiset of lengths, no more of each than there are, that fills ``capacity`` at the highest total price.

    A length's copies are bundled in powers of two, so that a dynamic program over bundles allows any number up to its count.
    """

    def __init__(self, lengths: list[int], counts: list[int], capacity: int) -> None:
        self.capacity = capacity
        self.bundles: list[tuple[int, int, int]] = []  # (place of the length, copies, tokens)
        for k, (length, count) in enumerate(zip(lengths, counts)):
            left, copies = min(count, capacity // length), 1
            while left:
                n = min(copies, left)
                self.bundles.append((k, n, n * length))
                left -= n
                copies *= 2
        self.took = np.zeros((len(self.bundles), capacity + 1), bool)
        self.best = np.empty((2, capacity + 1))

    def dearest(self, prices: np.ndarray) -> tuple[dict[int, int], float]:
        """Number of copies by the place of the length, and their price."""
        best, other = self.best
        best[:] = 0.0
        for i, (k, n, tokens) in enumerate(self.bundles):
            with_it = other[: self.capacity + 1 - tokens]
            np.add(best[: self.capacity + 1 - tokens], prices[k] * n, out=with_it)
            np.greater(with_it, best[tokens:], out=self.took[i, tokens:])
            self.took[i, :tokens] = False
            np.maximum(best[tokens:], with_it, out=with_it)
            best[tokens:] = with_it
        used, room = Counter(), self.capacity
        for i in range(len(self.bundles) - 1, -1, -1):
            if self.took[i, room]:
                k, n, tokens = self.bundles[i]
                used[k] += n
                room -= tokens
        return used, float(best[self.capacity])


def fractional(counts: dict[int, int], capacity: int, work: int, spread: float = 0.05) -> tuple[list[tuple[Counter, float]], float]:
    """Multiplicative weights for the configuration program: configurations with how many sequences of each, and a lower bound.

    Prices start as shares of the capacity. Every round prices the lengths, takes the dearest filling as often as covers
    a ``step`` of its scarcest length, and cheapens what it covers by a factor that is exponential in the share covered.
    Prices over the dearest filling's price are feasible for the dual program, which bounds the number of sequences from
    below; the rounds end when every length is covered, or after ``work`` bundle updates of the dynamic program.
    """
    lengths = sorted(counts)
    need = np.array([counts[x] for x in lengths], float)
    knapsack = Knapsack(lengths, [counts[x] for x in lengths], capacity)
    rounds = max(16, work // max(1, len(knapsack.bundles)))
    rate = math.log(len(lengths) + 1) / spread
    step = min(1.0, max(spread / rate, 2 * len(lengths) / rounds))
    prices = np.array(lengths) / capacity
    covered = np.zeros(len(lengths))
    found: dict[frozenset, list] = {}
    bound = 0.0
    for _ in range(rounds):
        fill, price = knapsack.dearest(prices)
        if not fill:
            break
        bound = max(bound, float(need @ prices) / price)
        k, n = np.fromiter(fill, int), np.fromiter(fill.values(), float)
        times = step * (need[k] / n).min()
        covered[k] += n * times / need[k]
        prices[k] = lengths_at(lengths, k) / capacity * np.exp(-rate * covered[k])
        found.setdefault(frozenset(fill.items()), [Counter({lengths[i]: m for i, m in fill.items()}), 0.0])[1] += times
        if covered.min() >= 1:
            break
    return [(c, x) for c, x in found.values()], bound


def lengths_at(lengths: list[int], places: np.ndarray) -> np.ndarray:
    return np.array([lengths[i] for i in places], float)


def best_fit(counts: dict[int, int], capacity: int) -> Patterns:
    """Best-fit decreasing on counts: equal open sequences are kept as one entry."""
    open_by: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    free: list[int] = []  # sorted keys of open_by

    def put(room: int, pattern: tuple[int, ...], n: int) -> None:
        if room not in open_by:
            open_by[room] = []
            free.insert(bisect_left(free, room), room)
        open_by[room].append((pattern, n))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(free, length)
            if at == len(free):
                per = min(capacity // length, left)
                bins = left // per
                put(capacity - per * length, (length,) * per, bins)
                left -= per * bins
                continue
            room = free[at]
            pattern, n = open_by[room].pop()
            if not open_by[room]:
                del open_by[room]
                free.pop(at)
            per = min(room // length, -(-left // n))
            k = min(n, left // per)
            put(room - per * length, pattern + (length,) * per, k)
            if k < n:
                put(room, pattern, n - k)
            left -= k * per
    return [x for entries in open_by.values() for x in entries]


def _sequences(patterns: Patterns) -> int:
    return sum(n for _, n in patterns)


class Dearest:
    """Pricing for many lengths: the dearest filling of every room, in one pass over the rooms, and so the dearest filling that holds a given length.

    It knows no counts; who takes a filling looks whether there are enough pieces.
    """

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.best = np.zeros(capacity + 1)
        self.sums = np.empty(capacity)

    def price(self, prices: np.ndarray) -> None:
        """``prices`` by length from 0 to the capacity; lengths that are not to be used have -inf."""
        last, back = [0] * (self.capacity + 1), np.ascontiguousarray(prices[::-1])
        for room in range(1, self.capacity + 1):
            sums = np.add(self.best[:room], back[self.capacity - room : self.capacity], out=self.sums[:room])
            rest = int(sums.argmax())
            self.best[room] = self.best[room - 1]
            if sums[rest] > self.best[room]:
                self.best[room], last[room] = sums[rest], room - rest
        self.last = last
        self.full = np.maximum.accumulate(np.where(last, np.arange(self.capacity + 1), 0)).tolist()  # the room less what stays free

    def holding(self, length: int) -> dict[int, int]:
        """Copies by length of the dearest filling that holds ``length``."""
        fill, room = {length: 1}, self.full[self.capacity - length]
        while room:
            x = self.last[room]
            fill[x] = fill.get(x, 0) + 1
            room = self.full[room - x]
        return fill


def duals(counts: dict[int, int], pricing: Dearest, rounds: int = 40) -> tuple[np.ndarray, float]:
    """Feasible prices by length, and the number of sequences that they prove necessary.

    Prices start as shares of the capacity. A length whose dearest filling is worth less than the dearest of all is too
    cheap, and rises by half of what is missing; the prices with the highest bound count.
    """
    capacity = pricing.capacity
    lengths = np.array(sorted(counts))
    need = np.array([counts[x] for x in lengths.tolist()], float)
    now, bound, out = lengths / capacity, 0.0, np.full(capacity + 1, -np.inf)
    for _ in range(rounds):
        prices = np.full(capacity + 1, -np.inf)
        prices[lengths] = now
        pricing.price(prices)
        top = float(pricing.best[capacity])
        if float(need @ now) / top > bound:
            bound, out = float(need @ now) / top, prices / top
        missing = top - now - pricing.best[capacity - lengths]
        if missing.max() <= 1e-9 * top:
            break
        now = now + missing / 2
    return out, bound


def whole(counts: dict[int, int], capacity: int, seed: int, rounds: int = 120, slack: float = 5e-4, nudge: float = 1e-4) -> tuple[list[tuple[Counter, int]], float]:
    """The program in whole sequences, for many lengths: configurations with how many sequences of each, and a lower bound.

    A round is due to have placed its share of every length. Lengths behind it are nudged dearer than their dual prices,
    with some seeded noise against ties; each that is still behind takes the dearest filling that holds it, where that is worth a
    sequence but for ``slack`` and the pieces left allow it.
    """
    pricing, rng = Dearest(capacity), np.random.default_rng(seed)
    prices, bound = duals(counts, pricing)
    lengths = np.array(sorted(counts))
    need = np.array([counts[x] for x in lengths.tolist()], float)
    left, worth = dict(counts), prices.tolist()
    found: Counter = Counter()
    for turn in range(1, rounds + 1):
        rest = np.array([left[x] for x in lengths.tolist()])
        behind = turn / rounds - (1 - rest / need)
        nudged = np.full(capacity + 1, -np.inf)
        nudged[lengths] = np.where(rest > 0, prices[lengths] * (1 + nudge * (behind + 0.1 * rng.random(len(lengths)))), -np.inf)
        pricing.price(nudged)
        for length in lengths[np.argsort(-behind, kind="stable")].tolist() if turn % 2 else lengths[::-1].tolist():
            due = left[length] - counts[length] * (1 - turn / rounds)
            if due <= 0 or not left[length]:
                continue
            fill = pricing.holding(length)
            n = min(math.ceil(due / fill[length]), *(left[x] // m for x, m in fill.items()))
            if n > 0 and sum(worth[x] * m for x, m in fill.items()) >= 1 - slack:
                found[tuple(sorted(fill.items()))] += n
                for x, m in fill.items():
                    left[x] -= m * n
    return [(Counter(dict(fill)), n) for fill, n in found.items()], bound


def by_program(histogram: dict[int, int], capacity: int, work: int, turns: int = 12) -> tuple[Patterns, float]:
    """The program's plan and its lower bound.

    One filling a pricing covers few lengths within ``work`` bundle updates, so there it is the solution. Many lengths are solved in
    whole sequences, without regard to ``work``; only where that plan misses the bound by one in a thousand, the other is tried too, and the one that needs fewer sequences counts.
    """
    counts = {k: v for k, v in histogram.items() if v}
    one_each = lambda left, turn: fractional(left, capacity, work)
    bundles = sum(min(n, capacity // k).bit_length() for k, n in counts.items())
    if 2 * len(counts) * bundles <= work:
        return _turns(counts, capacity, one_each, turns)
    made, bound = _turns(counts, capacity, lambda left, turn: whole(left, capacity, turn), turns)
    if _sequences(made) > 1.001 * math.ceil(bound):
        other, below = _turns(counts, capacity, one_each, turns)
        made, bound = min(made, other, key=_sequences), max(bound, below)
    return made, bound


def _turns(histogram: dict[int, int], capacity: int, solve: Callable[[Counter, int], tuple[list, float]], turns: int) -> tuple[Patterns, float]:
    """Every filling is taken as often as its rounded-down number and the pieces left allow, most used first; the program is
    solved again for the rest, until rounding gives nothing more, the bound is met with one in a hundred tokens left, or ``turns`` are over. What is left after a turn
    is packed best-fit or by single dearest fillings, and the last turn after which this needs the fewest sequences counts.
    """
    left = Counter(histogram)
    tokens = sum(k * v for k, v in left.items())
    out: Patterns = []
    best: Patterns | None = None
    bound = 0.0
    for turn in range(turns if left else 0):
        fillings, below = solve(left, turn)
        bound = bound or below
        placed = 0
        for fill, x in sorted(fillings, key=lambda f: (-f[1], sorted(f[0].items()))):
            n = min(int(x), *(left[k] // m for k, m in fill.items()))
            if n > 0:
                out.append((tuple(sorted(fill.elements(), reverse=True)), n))
                left.subtract({k: m * n for k, m in fill.items()})
                placed += n
        left = +left
        rest = best_fit(left, capacity)
        if len(left) <= 200 and _sequences(out) + _sequences(rest) > math.ceil(bound):
            rest = min(rest, _greedy(left, capacity), key=_sequences)
        if best is None or _sequences(out) + _sequences(rest) <= _sequences(best):
            best = out + rest
        few = sum(k * v for k, v in left.items()) <= tokens / 100
        if not placed or not left or (few and _sequences(best) <= math.ceil(bound)):
            break
    return best or [], bound


def _greedy(counts: Counter, capacity: int) -> Patterns:
    """Dearest fillings one after the other, at prices that favour long pieces."""
    left, out = +counts, []
    while left:
        lengths = sorted(left)
        fill, _ = Knapsack(lengths, [left[x] for x in lengths], capacity).dearest((np.array(lengths) / capacity) ** 1.05)
        use = {lengths[k]: m for k, m in fill.items()}
        n = min(left[k] // m for k, m in use.items())
        out.append((tuple(sorted(Counter(use).elements(), reverse=True)), n))
        left.subtract({k: m * n for k, m in use.items()})
        left = +left
    return out


def plan(histogram: dict[int, int], capacity: int = 4096, work: int = 100_000) -> Patterns:
    """(lengths of one sequence, number of such sequences) for all pieces of the histogram: the program's plan.

    Only where best fit alone needs fewer sequences than the rounded program, its plan is taken.
    """
    made, _ = by_program(histogram, capacity, work)
    alone = best_fit(Counter({k: v for k, v in histogram.items() if v}), capacity)
    return alone if _sequences(alone) < _sequences(made) else made


def _slots(patterns: Patterns) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted keys (length, first rank), and the first sequence and the offset there."""
    rows, base, seen = [], 0, Counter()
    for pattern, n in patterns:
        offset = 0
        for length in pattern:
            rows.append((length, seen[length], base, offset))
            seen[length] += n
            offset += length
        base += n
    rows.sort()
    a = np.array(rows, np.int64).reshape(-1, 4)
    return (a[:, 0] << 48) + a[:, 1], a[:, 1:3], a[:, 3]


def ranked(pieces: DataFrame) -> DataFrame:
    """Adds ``rank``: the number of pieces of equal length before a row, files and rows in order.

    A file's rows of a length are numbered in the file; files are offset by running counts, so
    that a frequent length is never gathered in one task.
    """
    rows = pieces.select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    counts = rows.groupBy("length", "__file").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("length").orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "__file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__file", "length").orderBy("__row")) - 1
    return rows.withColumn("__in", inside).join(starts, ["length", "__file"]).withColumn("rank", F.col("__before") + F.col("__in")).drop("__file", "__row", "__in", "__before")


def place(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """``pieces`` (a table read from files) with sequence_id and offset."""
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    slots = pieces.sparkSession.sparkContext.broadcast(_slots(plan(histogram, capacity)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, first, offset = slots.value
        for pdf in batches:
            if len(pdf):
                at = np.searchsorted(keys, (pdf.length.to_numpy() << 48) + pdf["rank"].to_numpy(), side="right") - 1
                pdf["sequence_id"] = first[at, 1] + pdf["rank"].to_numpy() - first[at, 0]
                pdf["offset"] = offset[at]
                yield pdf[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    return ranked(pieces).mapInPandas(run, PIECES + ", sequence_id long, offset long")


def pack(docs: DataFrame, vocabulary: str, capacity: int = 4096) -> DataFrame:
    return place(cut(docs, vocabulary, capacity), capacity)
