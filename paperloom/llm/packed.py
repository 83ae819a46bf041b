"""Tables of 64-bit keys whose rows are arrays.

A row holds the sorted keys of one part (a range of keys, by their first bits) and columns of 8-byte numbers beside
them, so that a shuffle moves some thousand keys as one row. ``met`` brings the rows of a part together in one task, in the order of
their kind: a table's rows come first and are looked up by those that follow, which pass one by one however many they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import partial, reduce
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paperloom.llm.common import bounds, lean

SCHEMA = "part int, kind int, block long, data array<binary>"
NAMES = ["part", "kind", "block", "data"]
TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.binary())]
BATCH = 4_000_000  # bytes
FLUSH = 1_000_000  # keys that are gathered before they are dealt

Row = tuple[int, int, int, list[bytes]]
Arrays = tuple[int, int, int, list[np.ndarray]]


def planes(x: np.ndarray) -> bytes:
    """The first bytes of all numbers, then the second: the high bytes of sorted keys and of small numbers compress well."""
    return np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8).T).tobytes()


def numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view(np.int64).reshape(-1)


def order_of(keys: np.ndarray) -> np.ndarray:
    """An order that brings equal 64-bit hashes together, but for those that a hash with the same first bits comes between.

    The places stand in the last bits of what is sorted, which is much faster than to sort places by key.
    """
    low = np.uint64(max(1, len(keys).bit_length()))
    packed = (keys.view(np.uint64) >> low << low) | np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    return (packed & np.uint64((1 << int(low)) - 1)).view(np.int64)


def exact_order(keys: np.ndarray) -> np.ndarray:
    """``order_of`` with the last bits set right."""
    at = order_of(keys)
    by = keys[at].view(np.uint64)
    return at[np.argsort(by, kind="stable")] if (by[1:] < by[:-1]).any() else at


def cut(bits: int, kind: int, keys: np.ndarray, *columns: np.ndarray, block: int = 0) -> Iterator[Row]:
    """A row for each part of keys that are sorted by their first bits."""
    part = (keys.view(np.uint64) >> np.uint64(64 - bits)).view(np.int64)
    edge = bounds(part)
    for i, j in zip(edge[:-1].tolist(), edge[1:].tolist()):
        yield int(part[i]), kind, block, [planes(x[i:j]) for x in (keys, *columns)]


class Gathered:
    """Columns of numbers, gathered until there are many; the first are the keys."""

    def __init__(self) -> None:
        self.held: list[tuple[np.ndarray, ...]] = []
        self.n = 0

    def add(self, *columns: np.ndarray) -> None:
        if len(columns[0]):
            self.held.append(columns)
            self.n += len(columns[0])

    def full(self) -> bool:
        return self.n > FLUSH

    def take(self) -> Iterator[tuple[np.ndarray, ...]]:
        """All of them at once, in the order of ``order_of``, or nothing."""
        if self.n:
            at = order_of(np.concatenate([c[0] for c in self.held]))
            yield tuple(np.concatenate(c)[at] for c in zip(*self.held))
        self.held, self.n = [], 0


class Table:
    """A part's keys, in order, and their columns."""

    def __init__(self) -> None:
        self.held: list[list[np.ndarray]] = []
        self.made: list[np.ndarray] | None = None

    def add(self, columns: list[np.ndarray]) -> None:
        self.held.append(columns)

    @property
    def columns(self) -> list[np.ndarray]:
        if self.made is None:
            self.made = [np.concatenate(c) for c in zip(*self.held)] if self.held else [np.empty(0, np.int64)]
            at = exact_order(self.made[0])
            self.made, self.held = [c[at] for c in self.made], []
        return self.made

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the wanted keys are there, and their places."""
        keys = self.columns[0]
        if not len(keys):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = np.flatnonzero(keys[at] == wanted)
        return hit, at[hit]


def batched(rows: Iterable[Row]) -> Iterator[pa.RecordBatch]:
    held: list[Row] = []
    size = 0
    for row in rows:
        held.append(row)
        size += 64 + sum(map(len, row[3]))
        if size > BATCH:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[Row]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), TYPES)], NAMES)


def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[Arrays]:
    for batch in batches:
        head = zip(*(batch.column(i).to_pylist() for i in range(3)))
        for (part, kind, block), data in zip(head, batch.column(3)):
            yield part, kind, block, [numbers(x) for x in data.as_py()]


def by_part(rows: Iterator[Arrays]) -> Iterator[Iterator[Arrays]]:
    for _, group in groupby(rows, itemgetter(0)):
        yield group


def mapped(rows: DataFrame, run: Callable[[Iterator[Arrays]], Iterator[Row]]) -> DataFrame:
    return rows.mapInArrow(lean(partial(_run, run)), SCHEMA)


def _run(run: Callable[[Iterator[Arrays]], Iterator[Row]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (yield from batched(run(arrays(batches))))


def of_kind(rows: DataFrame, kind: int, now: int | None = None) -> DataFrame:
    found = rows.where(F.col("kind") == kind)
    return found if now is None else found.withColumn("kind", F.lit(now)).select(*NAMES)


def met(*tables: DataFrame, by: tuple[str, ...] = ("part", "kind")) -> DataFrame:
    return reduce(DataFrame.union, tables).repartition("part").sortWithinPartitions(*by)
