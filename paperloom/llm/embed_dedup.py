"""Embedding near-duplicates by randomised-rotation binary codes.

Every distinct vector is coded once and the code stored: after a fixed random rotation its signs, packed; the inner product of the signs with
the rotated vector, its correction factor; and the rotated vector in four bit planes. Signs and planes of two
vectors give, by AND and bit counts over the correction factor, an unbiased estimate of their cosine with a known spread.
Runs of signs of further rotations are the keys of several tables, their number and length set from the
number of distinct vectors so that a pair at the threshold shares a key with
probability 1 - ``miss``. Codes that share a key meet in cells, cut into blocks of bounded size. A
tile of two blocks hands on the vectors that have an estimate whose confidence interval reaches the threshold with another; only for
these are the vectors themselves fetched, and only such pairs computed exactly, in double precision. A pair counts in
the first table whose key it shares, so that link counts add up over tiles and no pair is ever listed; what a tile hands on is
vectors, counts and the edges of a spanning forest.

Equal vectors are one node with a number of copies. Vectors that are null, zero or hold null or
non-finite components link with nothing; vectors of different lengths are never
compared. Repeated rows are vectors of their own. Rows with a null vec_id link with nothing and are kept.
Only vec_id and embedding are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from paperloom.llm.common import Forest, Scratch, bounds, lean, runs, shuffles_removed
from paperloom.llm.graph import components

CELL, BLOCK, CONFIDENCE, PLANES = 256, 4096, 4.0, 4


def table_shape(vectors: int, threshold: float, miss: float) -> tuple[int, int]:
    """Bits of a key, and how many tables find a pair at the threshold with probability 1 - miss."""
    bits = max(0, math.ceil(math.log2(max(1, vectors) / CELL)))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, 1 if bits == 0 else math.ceil(math.log(miss) / math.log(1 - same))


def rotation(dim: int, n: int) -> np.ndarray:
    """The n-th random rotation of a dimension; always the same one."""
    q, r = np.linalg.qr(np.random.default_rng([dim, n]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


class Coder:
    """Codes and keys of unit vectors of one dimension."""

    def __init__(self, dim: int, bits: int, tables: int) -> None:
        self.bits, self.tables = bits, tables
        self.turns = [rotation(dim, n) for n in range(max(1, -(-bits * tables // dim)))]
        self.first = self.turns[0]
        self.dither = np.random.default_rng([dim, 1 << 20]).random(dim)  # rounds levels without bias

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """One integer per vector and table."""
        signs = np.hstack([unit @ q.T > 0 for q in self.turns])[:, : self.bits * self.tables]
        return signs.reshape(len(unit), self.tables, self.bits) @ (1 << np.arange(self.bits, dtype=np.int64))

    def code(self, unit: np.ndarray) -> Codes:
        turned = unit @ self.first.T
        n, dim = turned.shape
        low = turned.min(axis=1)
        step = np.maximum((turned.max(axis=1) - low) / (2**PLANES - 1), 1e-300)
        level = np.floor((turned - low[:, None]) / step[:, None] + self.dither).astype(np.int64).clip(0, 2**PLANES - 1)
        planes = [turned > 0, *[(level >> k) & 1 == 1 for k in range(PLANES)]]
        padded = np.zeros((n, len(planes), -(-dim // 64) * 64), bool)
        padded[:, :, :dim] = np.stack(planes, axis=1)
        return Codes(dim, np.packbits(padded, axis=2).view(np.uint64), np.abs(turned).sum(axis=1) / math.sqrt(dim), low, step, level.sum(axis=1))


@dataclass
class Codes:
    """Codes of vectors: signs and bit planes in 64-bit words, correction factors, and what the planes' levels stand for."""

    dim: int
    words: np.ndarray  # vector, plane (signs first), word
    factor: np.ndarray
    low: np.ndarray
    step: np.ndarray
    levels: np.ndarray  # sum of a vector's levels

    def rows(self, at: np.ndarray) -> Codes:
        return Codes(self.dim, self.words[at], self.factor[at], self.low[at], self.step[at], self.levels[at])

    def reaching(self, other: Codes, threshold: float) -> np.ndarray:
        """Pairs (place here, place there) whose estimated cosine's confidence interval reaches the threshold, 128 rows at a time."""
        found = []
        for s in range(0, len(self.factor), 128):
            x = self.rows(np.arange(s, min(s + 128, len(self.factor))))
            p, q = np.nonzero(x.upper(other) >= threshold)
            found.append(np.stack([p + s, q]))
        return np.hstack(found) if found else np.empty((2, 0), np.int64)

    def upper(self, other: Codes) -> np.ndarray:
        """The estimates of all pairs plus their reach."""
        signs = self.words[:, None, 0]
        dot = np.zeros((len(self.factor), len(other.factor)))
        for k in range(PLANES):
            dot += np.bitwise_count(signs & other.words[None, :, 1 + k]).sum(axis=2, dtype=np.int64) << k
        ones = np.bitwise_count(self.words[:, 0]).sum(axis=1, dtype=np.int64)
        # <signs, y> with signs of +-1 over the root of dim: twice the sum where the sign is positive less the whole sum.
        whole = other.low * self.dim + other.step * other.levels
        inner = (2 * (ones[:, None] * other.low + dot * other.step) - whole) / math.sqrt(self.dim)
        spread = np.sqrt((1 - self.factor**2).clip(0) / max(1, self.dim - 1))[:, None] + other.step / 2
        return (inner + CONFIDENCE * spread) / self.factor[:, None]


def usable(vector: object) -> np.ndarray | None:
    """The vector in double precision if it can be compared."""
    if vector is None:
        return None
    v = np.array([math.nan if x is None else x for x in vector] if getattr(vector, "dtype", None) == object else vector, float)
    return v if len(v) and np.isfinite(v).all() and (v != 0).any() else None


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def named(vectors: DataFrame) -> DataFrame:
    """vec_id, name (of the value, null if it cannot be compared), embedding as double."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            good = [usable(v) for v in pdf.embedding]
            yield pd.DataFrame({"vec_id": pdf.vec_id.astype("Int64"), "name": [None if v is None else xxhash.xxh3_128_digest(v.tobytes()) for v in good], "embedding": pd.Series(good, pdf.index, object)})

    return vectors.select("vec_id", "embedding").mapInPandas(lean(run), "vec_id long, name binary, embedding array<double>")


CODE = "dim int, code binary, factor double, low double, step double, levels long"


def coded(nodes: DataFrame) -> DataFrame:
    """The nodes with their codes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coders: dict[int, Coder] = {}
        for pdf in batches:
            for dim, part in pdf.groupby(pdf.embedding.map(len)):
                c = coders.setdefault(dim, Coder(dim, 0, 1)).code(_unit(np.vstack(part.embedding)))
                yield part.assign(dim=dim, code=[w.tobytes() for w in c.words], factor=c.factor, low=c.low, step=c.step, levels=c.levels)

    return nodes.mapInPandas(lean(run), f"name binary, node long, copies long, embedding array<double>, {CODE}")


def _codes(rows: pd.DataFrame) -> Codes:
    words = np.frombuffer(b"".join(rows.code), np.uint64).reshape(len(rows), 1 + PLANES, -1)
    return Codes(int(rows.dim.iloc[0]), words, *(rows[c].to_numpy() for c in ("factor", "low", "step", "levels")))


def _reaching(tile: pd.DataFrame, codes: Codes, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs of a tile's two blocks that are to be computed exactly."""
    block = tile.block.to_numpy()
    i, j = int(tile.ti.iloc[0]), int(tile.tj.iloc[0])
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    p, q = codes.rows(left).reaching(codes.rows(right), threshold)
    p, q = left[p], right[q]
    return (p[p < q], q[p < q]) if i == j else (p, q)


def _compare(tile: pd.DataFrame, coder: Coder, threshold: float) -> pd.DataFrame:
    """Link counts (node, links) and forest edges (node, to) of one tile."""
    unit = _unit(np.vstack(tile.embedding))
    keys, table = coder.keys(unit), int(tile.t.iloc[0])
    p, q = _reaching(tile, coder.code(unit), threshold)
    links = np.zeros(len(tile), np.int64)
    node, copies = tile.node.to_numpy(), tile.copies.to_numpy()
    forest, edges = Forest(len(tile)), []
    for s in range(0, len(p), 200_000):
        a, b = p[s : s + 200_000], q[s : s + 200_000]
        hit = (unit[a] * unit[b]).sum(axis=1) >= threshold
        hit &= ~(keys[a, :table] == keys[b, :table]).any(axis=1)
        a, b = a[hit], b[hit]
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        edges += [(x, y) for x, y in zip(a.tolist(), b.tolist()) if forest.join(x, y)]
    some = links > 0
    e = np.array(edges, np.int64).reshape(-1, 2)
    counts = pd.DataFrame({"node": node[some], "to": pd.array([None] * int(some.sum()), "Int64"), "links": links[some]})
    return pd.concat([counts, pd.DataFrame({"node": node[e[:, 0]], "to": pd.array(node[e[:, 1]], "Int64"), "links": 0})])


def link_vectors(vectors: DataFrame, threshold: float = 0.9, miss: float = 0.01) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row."""
    scratch = Scratch(vectors.sparkSession)
    with shuffles_removed(vectors.sparkSession):
        rows = scratch.keep(named(vectors), "vectors")
        known = rows.where("name is not null and vec_id is not null")
        nodes = scratch.keep(coded(known.groupBy("name").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))), "codes")
        found = scratch.keep(_links(nodes, scratch, threshold, miss), "links")
        labels = components(found.where("to is not null").select(F.col("node").alias("a"), F.col("to").alias("b")))
        counts = found.groupBy("node").agg(F.sum("links").alias("links"))
        full = nodes.select("name", "node", "copies").join(counts, "node", "left").join(labels, "node", "left")
        full = scratch.keep(full.select("name", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id")), "full")
        slim = scratch.keep(rows.select("vec_id", "name"), "names")
        scratch.drop(*[x for x in scratch.paths if x not in ("full", "names")])
    usable = "name is not null and vec_id is not null"
    valid = slim.where(usable).join(full, "name").select("vec_id", "n_links", "component_id")
    alone = slim.where(f"not ({usable})").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return valid.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _links(nodes: DataFrame, scratch: Scratch, threshold: float, miss: float) -> DataFrame:
    """node, to, links: link counts and forest edges of all tiles."""
    bits, tables = table_shape(nodes.count(), threshold, miss)
    code = [c.split()[0] for c in CODE.split(", ")]

    def expand(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coders: dict[int, Coder] = {}
        for pdf in batches:
            for dim, part in pdf.groupby("dim"):
                keys = coders.setdefault(dim, Coder(dim, bits, tables)).keys(_unit(np.vstack(part.embedding)))
                for t in range(tables):
                    yield part.assign(t=t, cell=keys[:, t])[["t", "cell", "node", *code]]

    cells = nodes.select("node", "embedding", *code).mapInPandas(lean(expand), f"t int, cell long, node long, {CODE}")
    where = ["dim", "t", "cell"]
    large = cells.groupBy(*where).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).where("blocks > 1")
    placed = cells.join(large, where, "left").na.fill(1, ["blocks"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(F.least("block", x).alias("ti"), F.greatest("block", x).alias("tj")))
    names = [*where, "ti", "tj"]
    tiles = placed.withColumn("p", F.explode(pair)).select(*where, "p.*", "block", "node", *code[1:])

    def screen(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in runs(batches, names):
            at = bounds(*(pdf[c].to_numpy() for c in names))
            keep = np.zeros(len(pdf), bool)
            for s, e in zip(at, at[1:]):
                if e - s > 1:
                    tile = pdf.iloc[s:e]
                    p, q = _reaching(tile, _codes(tile), threshold)
                    keep[s + p] = keep[s + q] = True
            yield pdf.loc[keep, [*names, "block", "node"]]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        coders: dict[int, Coder] = {}
        for pdf in runs(batches, names):
            at = bounds(*(pdf[c].to_numpy() for c in names))
            for s, e in zip(at, at[1:]):
                if e - s > 1:
                    dim = int(pdf.dim.iloc[s])
                    yield _compare(pdf.iloc[s:e].reset_index(drop=True), coders.setdefault(dim, Coder(dim, bits, tables)), threshold)

    screened = tiles.repartition(*names).sortWithinPartitions(*names).mapInPandas(lean(screen), "dim int, t int, cell long, ti int, tj int, block int, node long")
    close = scratch.keep(screened, "close").join(nodes.select("node", "copies", "embedding"), "node").select(*names, "block", "node", "copies", "embedding")
    return close.repartition(*names).sortWithinPartitions(*names).mapInPandas(lean(compare), "node long, to long, links long")
