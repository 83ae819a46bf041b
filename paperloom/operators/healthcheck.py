"""Health check of a folder: every document is processed on its own, and a failure is a row."""

from __future__ import annotations

import html
from collections.abc import Callable
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F

from paperloom.operators.seams import call_each

TIMEOUT = 120.0


def process(documents: DataFrame, fn: Callable[[Any], dict], column: str, outcome: str, timeout: float = TIMEOUT) -> DataFrame:
    """``documents`` with the function's outcome (a struct type) or the reason why it has none."""
    return call_each(documents, column, fn, f"outcome {outcome}", timeout=timeout).withColumnRenamed("error", "reason")


def report_names(documents: DataFrame, name: str = "filename") -> DataFrame:
    """Adds ``report``, a name of its own for each document: the stem, with the suffix where an earlier document has that, with a number where both are taken.

    Only documents of equal stems are compared, in the order of their names.
    """
    stem = F.regexp_replace(F.col(name), r"\.[^.]*$", "")
    suffix = F.lower(F.regexp_extract(F.col(name), r"(\.[^.]*)$", 1))
    stem = F.when(stem == "", "doc").otherwise(stem)
    rows = documents.withColumns({"__stem": stem, "__suffix": suffix})
    by_stem = F.row_number().over(Window.partitionBy("__stem").orderBy(name))
    rows = rows.withColumn("__nth", by_stem).withColumn("__same", F.row_number().over(Window.partitionBy("__stem", "__suffix", F.col("__nth") == 1).orderBy(name)))
    # Among later documents of a stem the first of each suffix takes it; the others count on from 2.
    plain = (F.col("__nth") > 1) & (F.col("__same") == 1) & (F.col("__suffix") != "")
    rows = rows.withColumn("__plain", plain)
    number = F.row_number().over(Window.partitionBy("__stem", (F.col("__nth") > 1) & ~F.col("__plain")).orderBy(name)) + 1
    report = F.when(F.col("__nth") == 1, F.concat("__stem", F.lit(".html"))).when(F.col("__plain"), F.concat("__stem", "__suffix", F.lit(".html"))).otherwise(F.concat("__stem", F.lit("-"), number.cast("string"), F.lit(".html")))
    return rows.withColumn("report", report).drop("__stem", "__suffix", "__nth", "__same", "__plain")


def summary(processed: DataFrame) -> DataFrame:
    """n_docs, n_failures, mean and least quality of (outcome, reason); outcome has quality_score and needs_review."""
    ok = F.col("reason").isNull()
    return processed.agg(
        F.count_if(ok).alias("n_docs"), F.count_if(~ok).alias("n_failures"), F.avg("outcome.quality_score").alias("mean_quality"), F.min("outcome.quality_score").alias("min_quality"), F.count_if(ok & F.col("outcome.needs_review")).alias("needs_review"),
    )


def compare_versions(dirty: DataFrame, cleaned: DataFrame, checks: DataFrame, fields: DataFrame) -> DataFrame:
    """Report rows: doc_id, field, dirty_value, cleaned_value, source_block_id, confidence, verified, risk of every field.

    ``dirty`` and ``cleaned``: facts; ``checks``: doc_id, field, passed of the cleaned ones; ``fields``: field, risk.
    """
    before = dirty.select("doc_id", "field", F.col("value").alias("dirty_value"))
    after = cleaned.select("doc_id", "field", F.col("value").alias("cleaned_value"), "source_block_id", "confidence")
    rows = after.join(before, ["doc_id", "field"], "left").join(checks.select("doc_id", "field", F.col("passed").alias("verified")), ["doc_id", "field"], "left")
    return rows.join(F.broadcast(fields.select("field", "risk")), "field").na.fill("", ["dirty_value"])  # a vertical's few fields


def _escaped(c: Column) -> Column:
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(mark), F.lit(entity))
    return c


def html_rows(rows: DataFrame, columns: list[str], title: str) -> DataFrame:
    """doc_id, page: one HTML page per document with a table of its rows, ready for a partitioned text writer."""
    cells = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), _escaped(F.coalesce(F.col(c).cast("string"), F.lit(""))), F.lit("</td>")) for c in columns], F.lit("</tr>"))
    head = "".join(f"<th>{html.escape(c)}</th>" for c in columns)
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("field", cells.alias("row")))), lambda r: r["row"]), "")
    page = F.concat(F.lit(f"<!doctype html><title>{html.escape(title)}</title><table><tr>{head}</tr>"), body, F.lit("</table>"))
    return rows.groupBy("doc_id").agg(page.alias("page"))
