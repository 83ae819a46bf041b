"""Places where a caller's function stands for a model or a service: extractors, embedders, rerankers, page readers.

The function is called on executors, for each row of Arrow batches, and must be picklable. What it raises becomes a column; a row
never fails the stage.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor, TimeoutError as OutOfTime
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F


def attempt(fn: Callable[[Any], Any], value: Any, attempts: int, pause: float, timeout: float | None) -> tuple[Any, str | None]:
    """The function's result, or why the last of its attempts failed. Pauses grow by ``pause`` seconds an attempt.

    A call that exceeds ``timeout`` counts as failed at once; its thread is left behind, as threads cannot be stopped.
    """
    error = None
    for n in range(attempts):
        if n and pause:
            time.sleep(pause * n)
        try:
            if timeout is None:
                return fn(value), None
            pool = ThreadPoolExecutor(1)
            try:
                return pool.submit(fn, value).result(timeout), None
            finally:
                pool.shutdown(wait=False)
        except OutOfTime:
            return None, f"TimeoutError: exceeded {timeout:g}s"
        except Exception as e:  # noqa: BLE001 - whatever a caller's function raises is a result here
            error = f"{type(e).__name__}: {e}"
    return None, error


def call_each(df: DataFrame, column: str, fn: Callable[[Any], Any], result: str, attempts: int = 1, pause: float = 0.0, timeout: float | None = None) -> DataFrame:
    """All columns of ``df`` with ``result`` (of the given type, ``name type``) and ``error`` (null where the call succeeded)."""
    name = result.split()[0]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in df.drop(name, "error").schema], result, "error string"])
    names = [*df.drop(name, "error").columns, name, "error"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [attempt(fn, v, attempts, pause, timeout) for v in pdf[column]]
            pdf[name] = pd.Series([r for r, _ in found], pdf.index, dtype=object)
            pdf["error"] = pd.Series([e for _, e in found], pdf.index, dtype=object)
            yield pdf[names]

    return df.mapInPandas(run, schema)


def read_pages(pages: DataFrame, reader: Callable[[bytes], str], attempts: int = 2, pause: float = 1.0) -> DataFrame:
    """``pages`` (doc_id, page, image) with the reader's markdown as ``text``; a page that cannot be read has an empty text and an error."""
    return call_each(pages, "image", reader, "text string", attempts, pause).na.fill("", ["text"])


def embed(items: DataFrame, embedder: Callable[[str], list[float]], text: str = "text") -> DataFrame:
    return call_each(items, text, embedder, "embedding array<double>")


def rerank(hits: DataFrame, scorer: Callable[[dict], float], query: str = "query", text: str = "text", by: tuple[str, ...] = ("query_id",)) -> DataFrame:
    """Reorders each query's hits by the scorer's number for {query, text}, best first; ``degraded`` marks queries that kept their order, as a call failed."""
    asked = hits.withColumn("__ask", F.struct(F.col(query).alias("query"), F.col(text).alias("text")))
    scored = call_each(asked, "__ask", scorer, "__score double").drop("__ask")
    failed = F.max(F.col("error").isNotNull()).over(Window.partitionBy(*by))
    marked = scored.withColumn("degraded", failed)
    order = Window.partitionBy(*by).orderBy(F.when(F.col("degraded"), F.lit(0.0)).otherwise(F.col("__score")).desc(), "rank")
    return marked.withColumn("rank", F.row_number().over(order) - 1).drop("__score", "error")


def reorder(hits: DataFrame, answer: Column, by: tuple[str, ...] = ("query_id",)) -> DataFrame:
    """Reorders hits by the positions that a model's answer names (an array of 0-based ranks); ranks it leaves out follow in their order."""
    place = F.array_position(F.array_distinct(answer), F.col("rank"))
    order = Window.partitionBy(*by).orderBy(F.when(place > 0, place).otherwise(F.lit(1 << 30)), "rank")
    return hits.withColumn("rank", F.row_number().over(order) - 1)


def extract(contexts: DataFrame, extractor: Callable[[str], str], attempts: int = 1) -> DataFrame:
    """``contexts`` (doc_id, context) with the model's ``reply``, for ``constrained.read_replies``."""
    return call_each(contexts, "context", extractor, "reply string", attempts)


EMBEDDERS: dict[str, Callable[..., Any]] = {}


def embedder(kind: str, **options: Any) -> Callable[[str], list[float]]:
    """A registered embedder; an unknown kind is an error."""
    if kind not in EMBEDDERS:
        raise ValueError(f"unknown embedder {kind!r}; known: {', '.join(sorted(EMBEDDERS)) or 'none'}")
    return EMBEDDERS[kind](**options)
