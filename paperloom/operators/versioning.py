"""Versions of label sets, their differences, and the drafting of labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def version_id(gold: DataFrame) -> DataFrame:
    """One row: n_docs, version: 16 hex digits over the sorted per-document hashes, whatever the rows' order."""
    entry = F.array_sort(F.collect_list(F.struct("field", "value")))
    docs = gold.groupBy("doc_id").agg(F.sha2(F.to_json(F.struct("doc_id", entry.alias("facts"))), 256).alias("h"))
    return docs.agg(F.count("*").alias("n_docs"), F.left(F.sha2(F.concat_ws(",", F.array_sort(F.collect_list("h"))), 256), F.lit(16)).alias("version"))


def diff(old: DataFrame, new: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, change (added or removed)."""
    side = lambda a, b, name: a.select(key).distinct().join(b.select(key), key, "left_anti").withColumn("change", F.lit(name))
    return side(new, old, "added").unionByName(side(old, new, "removed"))


def prelabel(drafts: DataFrame, corrections: DataFrame, known_fields: list[str]) -> DataFrame:
    """Draft labels with corrections laid over them. A correction of an unknown field, or one that is empty, fails the query."""
    ok = F.col("field").isin(*known_fields) & (F.col("fixed") != "")
    fixes = corrections.select("doc_id", "field", F.col("value").alias("fixed")).where(F.assert_true(ok, "a correction names an unknown field or is empty").isNull())
    joined = drafts.select("doc_id", "field", "value").join(fixes, ["doc_id", "field"], "full")
    return joined.select("doc_id", "field", F.coalesce("fixed", "value").alias("value"))


def clause_complexity(gold: DataFrame) -> DataFrame:
    """doc_id, bucket: low up to one filled field, med up to three, else high."""
    n = F.count_if(F.col("value") != "")
    return gold.groupBy("doc_id").agg(n.alias("filled")).select("doc_id", F.when(F.col("filled") <= 1, "low").when(F.col("filled") <= 3, "med").otherwise("high").alias("bucket"))
