"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def small_batches(spark: SparkSession) -> None:
    """Arrow batches bounded by bytes: a batch of very long texts stays small, and one of narrow rows is worth its overhead."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Where the session names none, a temporary folder is made and set if driver and executors are one process
    (tests, one machine); on a cluster that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="paperloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a table of the shared folder that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


class Scratch:
    """Tables of the shared folder by label, deleted when their last reader is done.

    Writing a table cuts its lineage: a lost executor costs a re-read, never a recomputation.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.paths: dict[str, str] = {}

    def keep(self, df: DataFrame, label: str, by: str | None = None) -> DataFrame:
        """``by``: a column whose values have folders of their own; ``drop`` also takes ``label/column=value``."""
        self.paths[label] = path = scratch_path(self.spark, label)
        df.write.parquet(path, partitionBy=by)
        found = self.spark.read.schema(df.schema).parquet(path)
        return found.select(*df.columns) if by else found  # that column would come last

    def drop(self, *labels: str) -> None:
        for label in labels:
            whole, _, folder = label.partition("/")
            discard(self.spark, f"{self.paths[whole]}/{folder}" if folder else self.paths.pop(whole))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """One table of the shared folder, for results that outlive the call that makes them."""
    return Scratch(df.sparkSession).keep(df, label)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within, a query's shuffle files go when it has ended; for jobs that write each of their tables once."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


Batches = Iterator[pd.DataFrame]


def lean(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for mapInPandas; a worker outlives its tasks, so what a task has freed goes back to the system."""

    def wrapped(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            with suppress(OSError, AttributeError):  # only in the GNU C library
                ctypes.CDLL(None).malloc_trim(0)

    return wrapped


def free_name(df: DataFrame, name: str) -> str:
    """The name, or a longer one that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_mod(col: str, modulus: int) -> Column:
    """crc32 of a column's decimal text modulo ``modulus``."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % modulus


def crc_mod_py(value: int, modulus: int) -> int:
    return zlib.crc32(str(value).encode()) % modulus


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def ascii_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text, A-Z lower-cased, as UTF-8.

    ``bytes.split`` splits on exactly these six characters.
    """
    return text.encode().translate(_LOWER).split() if text else []


_TABLE = np.random.default_rng(20240229).integers(0, 1 << 64, 256, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)  # 5 modulo 16
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_up_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            row = np.full(n, base, np.uint64)
            row[0] = 1
            _powers[k] = np.multiply.accumulate(row)
    return _powers[0], _powers[1]


def hash_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts in order, and each text's number of words.

    Words are ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased. A word's hash is a polynomial of random byte values,
    taken as a difference of prefix sums over the joined texts, so that no word is handled on its own.
    """
    parts = [t.encode() if t else b"" for t in texts]
    raw = np.frombuffer(b"\n".join([*parts, b""]).translate(_LOWER), np.uint8)
    space = _SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).view(np.int8)))
    start, end = edge[::2], edge[1::2]
    up, down = _powers_up_to(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_TABLE[raw] * up[: len(raw)], out=total[1:])
    size = (end - start).astype(np.uint64)
    hashes = mix64((total[end] - total[start]) * down[start] + size * _BASE)
    offsets = np.cumsum([len(p) + 1 for p in parts]) if parts else np.empty(0, np.int64)
    counts = np.diff(np.concatenate([[0], np.searchsorted(start, offsets)]))
    return hashes, counts


def batched_words(texts: list[str | None], most: int = 600_000) -> list[np.ndarray]:
    """The word hashes of each text; texts are joined up to about ``most`` characters at a time."""
    out: list[np.ndarray] = []
    i = 0
    while i < len(texts):
        j, n = i, 0
        while j < len(texts) and (j == i or n + len(texts[j] or "") <= most):
            n += len(texts[j] or "")
            j += 1
        hashes, counts = hash_words(texts[i:j])
        out += np.split(hashes, np.cumsum(counts)[:-1])
        i = j
    return out


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chain_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all runs of ``n`` consecutive items."""
    out = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + len(out)])
    return out


def runs(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Complete groups of a stream that is sorted by ``keys``.

    Yields frames that hold whole groups only: the last group of a batch waits
    for the next one. Memory is a batch plus the largest group.
    """
    rest: list[pd.DataFrame] = []
    for pdf in batches:
        if pdf.empty:
            continue
        k = pdf[keys].to_numpy()
        if rest and not (rest[-1][keys].to_numpy()[-1] == k[0]).all():
            yield pd.concat(rest, ignore_index=True)
            rest = []
        cut = np.flatnonzero((k[1:] != k[:-1]).any(axis=1))
        if len(cut):
            head, pdf = pdf.iloc[: cut[-1] + 1], pdf.iloc[cut[-1] + 1 :]
            yield pd.concat([*rest, head], ignore_index=True)
            rest = []
        rest.append(pdf)
    if rest:
        yield pd.concat(rest, ignore_index=True)


def bounds(*columns: np.ndarray) -> np.ndarray:
    """Start of each run of equal values, and the end."""
    n = len(columns[0])
    new = np.zeros(n, bool)
    if n:
        new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), n)


class Forest:
    """Union-find over positions 0..n-1."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True
