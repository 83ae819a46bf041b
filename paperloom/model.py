"""The data model: documents as ordered, typed text blocks in DataFrames.

blocks     doc_id, pos, block_id, type, text, bbox, parent_id, confidence, source_engine
chunks     doc_id, chunk_id, n, text, block_ids, heading, page [, clause_type, permission_tags, index_extra, definition_block_ids]
facts      doc_id, field, value, source_block_id, confidence        (one row per field)
gold       doc_id, field, value
A missing value of a fact is the empty string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BLOCK_TYPES = ("title", "heading", "paragraph", "table", "list_item", "footer", "header", "figure_caption")
HEADINGS = ("title", "heading")
FURNITURE = ("header", "footer")

BBOX = "struct<page:int,x0:double,y0:double,x1:double,y1:double>"
BLOCKS = f"doc_id string, pos int, block_id string, type string, text string, bbox {BBOX}, parent_id string, confidence double, source_engine string"
FACTS = "doc_id string, field string, value string, source_block_id string, confidence double"
GOLD = "doc_id string, field string, value string"
SPANS = "array<struct<name:string,duration_ms:double,status:string,error_type:string,tokens:int,cost_usd:double>>"
TRACES = f"trace_id string, doc_id string, spans {SPANS}"
TICKETS = "ticket_id string, baseline_handle_seconds double, assisted_handle_seconds double, suggestion_offered boolean, suggestion_accepted boolean, csat_before double, csat_after double, llm_cost_usd double, eval_passed boolean"


def no_bbox() -> Column:
    return F.lit(None).cast(BBOX)


def paragraphs(docs: DataFrame, split: str, block_id: str = "#/b/", strip: bool = False, drop_empty: bool = False) -> DataFrame:
    """Blocks from the ``text`` of documents, cut by a regular expression."""
    from paperloom.functions.text import py_strip

    text = F.col("text")
    parts = docs.where(text.isNotNull()).select("doc_id", F.posexplode(F.split(text, split)).alias("pos", "text"))
    if strip:
        parts = parts.withColumn("text", py_strip(F.col("text")))
    if drop_empty:
        parts = parts.where("text <> ''")
    return parts.select(
        "doc_id", "pos", F.concat(F.lit(block_id), F.col("pos")).alias("block_id"), F.lit("paragraph").alias("type"), "text",
        no_bbox().alias("bbox"), F.lit(None).cast("string").alias("parent_id"), F.lit(1.0).alias("confidence"), F.lit("text").alias("source_engine"),
    )
