"""Parsing and routing: page probes, engine routes, segments, and the shapes that engines return, as blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from paperloom.functions.text import py_strip
from paperloom.model import no_bbox
from paperloom.operators.pii import redact_blocks

COVERAGE_FROM = 0.8


def probe_pages(pages: DataFrame, min_chars: int = 1, text: str = "text") -> DataFrame:
    """Adds char_count (of the stripped text layer, 0 where it failed) and has_text."""
    n = F.coalesce(F.length(py_strip(F.col(text))), F.lit(0))
    return pages.withColumns({"char_count": n, "has_text": n >= min_chars})


def doc_profile(pages: DataFrame) -> DataFrame:
    """doc_id, page_count, pages_with_text, text_coverage of probed pages."""
    sums = pages.groupBy("doc_id").agg(F.count("*").alias("page_count"), F.sum(F.col("has_text").cast("long")).alias("pages_with_text"))
    return sums.withColumn("text_coverage", F.coalesce(F.try_divide("pages_with_text", "page_count"), F.lit(0.0)))


def scan_engine(vlm: bool = False, franken: bool = False) -> str:
    """The engine for pages without text, by what is configured."""
    return "vlm" if vlm else "frankenocr" if franken else "paddleocr"


def route(coverage: Column, scanned: str = "paddleocr", threshold: float = COVERAGE_FROM) -> Column:
    """The engine of a document or, with a coverage of 0 or 1, of a page."""
    return F.when(coverage >= threshold, "docling").otherwise(scanned)


def page_routes(pages: DataFrame, scanned: str = "paddleocr") -> DataFrame:
    return pages.withColumn("engine", route(F.col("has_text").cast("double"), scanned))


def segments(pages: DataFrame) -> DataFrame:
    """doc_id, segment (from 0), engine, first, last, pages: runs of pages with one engine."""
    by_doc = Window.partitionBy("doc_id").orderBy("page")
    turn = F.coalesce((F.lag("engine").over(by_doc) != F.col("engine")).cast("int"), F.lit(0))
    runs = pages.withColumn("__turn", turn).withColumn("segment", F.sum("__turn").over(by_doc))
    return runs.groupBy("doc_id", "segment", "engine").agg(F.min("page").alias("first"), F.max("page").alias("last"), F.array_sort(F.collect_list("page")).alias("pages"))


def merge_segments(blocks: DataFrame, parts: DataFrame) -> DataFrame:
    """Blocks of separately parsed segments (columns doc_id, segment) as one document's.

    Pages become the document's, ids get the segment's prefix (all leading # fall away), and positions follow
    the segments. A document of one segment keeps its ids.
    """
    many = parts.withColumn("__many", F.count("*").over(Window.partitionBy("doc_id")) > 1)
    joined = blocks.join(many.select("doc_id", "segment", "pages", "__many"), ["doc_id", "segment"])
    name = lambda c: F.when(F.col("__many"), F.concat(F.lit("#s"), F.col("segment"), F.lit(":"), F.ltrim(F.col(c), F.lit("#")))).otherwise(F.col(c))
    inside = F.col("bbox").isNotNull() & F.col("bbox.page").between(1, F.size("pages"))
    page = F.when(inside & F.col("__many"), F.try_element_at("pages", F.greatest(F.col("bbox.page"), F.lit(1)))).otherwise(F.col("bbox.page"))
    pos = F.row_number().over(Window.partitionBy("doc_id").orderBy("segment", "pos")) - 1
    moved = joined.withColumns({"block_id": name("block_id"), "parent_id": name("parent_id"), "bbox": F.when(F.col("bbox").isNotNull(), F.col("bbox").withField("page", page)), "pos": pos})
    return moved.select([c for c in blocks.columns if c != "segment"])


def markdown_blocks(docs: DataFrame, engine: str = "unlimited-ocr", prefix: str = "#/vlm") -> DataFrame:
    """Markdown lines as blocks: titles and headings, list items, tables, paragraphs; a parent is the nearest heading of a lower level.

    Lines are classified one by one; runs of table or paragraph lines are islands of a running
    count, and for each of the six heading levels the last heading is carried forward, which is all a stack holds.
    """
    lines = docs.select("doc_id", F.posexplode(F.split("text", r"\r\n|\r|\n")).alias("line", "raw"))
    raw = F.col("raw")
    kind = (
        F.when(raw.rlike(r"^\s*\|.*\|\s*$"), "table").when(py_strip(raw) == "", "blank").when(raw.rlike(r"^#{1,6}\s+.*$"), "heading")
        .when(raw.rlike(r"^\s*(?:[-*]|\d+\.)\s+.*$"), "list_item").otherwise("paragraph")
    )
    by_doc = Window.partitionBy("doc_id").orderBy("line")
    typed = lines.withColumn("kind", kind)
    alone = F.col("kind").isin("heading", "list_item")
    new = (alone | (F.lag("kind").over(by_doc) != F.col("kind")) | F.lag("kind").over(by_doc).isNull()).cast("int")
    runs = typed.withColumn("__new", new).withColumn("run", F.sum("__new").over(by_doc))
    text = (
        F.when(F.col("kind") == "table", F.regexp_replace("raw", r"\s+$", "")).when(F.col("kind") == "heading", py_strip(F.regexp_extract("raw", r"^#{1,6}\s+(.*)$", 1)))
        .when(F.col("kind") == "list_item", py_strip(F.regexp_extract("raw", r"^\s*(?:[-*]|\d+\.)\s+(.*)$", 1))).otherwise(py_strip(raw))
    )
    level = F.length(F.regexp_extract("raw", r"^(#{1,6})\s", 1))
    joined = runs.where("kind <> 'blank'").withColumns({"__t": text, "__level": F.when(F.col("kind") == "heading", level)}).groupBy("doc_id", "run", "kind").agg(F.array_sort(F.collect_list(F.struct("line", "__t"))).alias("b"), F.max("__level").alias("level"))
    parts = F.transform("b", lambda x: x["__t"])
    named = joined.withColumn("text", F.when(F.col("kind") == "table", F.array_join(parts, "\n")).otherwise(py_strip(F.array_join(parts, " ")))).where("kind <> 'paragraph' or text <> ''")
    pos = F.row_number().over(Window.partitionBy("doc_id").orderBy("run")) - 1
    placed = named.withColumn("pos", pos).withColumn("block_id", F.concat(F.lit(prefix + "/"), "pos"))
    before = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    parent = F.lit(None).cast("struct<pos:int,id:string>")
    for n in range(1, 7):
        # A heading is open for its level until one of the same or a lower level replaces it.
        last = F.last(F.when(F.col("level") == n, F.struct("pos", F.col("block_id").alias("id"))), ignorenulls=True).over(before)
        closed = F.max(F.when(F.col("level") <= n, F.col("pos"))).over(before)
        usable = F.when((last["pos"] == closed) & (F.coalesce("level", F.lit(99)) > n), last)
        parent = F.coalesce(usable, parent)
    out = placed.withColumn("__p", parent)
    return out.select(
        "doc_id", "pos", "block_id", F.when(F.col("level") == 1, "title").otherwise(F.col("kind")).alias("type"), "text", no_bbox().alias("bbox"),
        F.col("__p.id").alias("parent_id"), F.lit(1.0).alias("confidence"), F.lit(engine).alias("source_engine"),
    )


#: Layout labels of the structured engine and the block types they mean.
LABELS = {
    "title": "title", "section_header": "heading", "heading": "heading", "paragraph": "paragraph", "text": "paragraph", "table": "table", "list_item": "list_item",
    "page_header": "header", "page_footer": "footer", "caption": "figure_caption",
}


def layout_items(items: DataFrame, engine: str = "docling") -> DataFrame:
    """Items (doc_id, pos, id, label, text, bbox, parent_id, confidence) as blocks; unknown labels are paragraphs."""
    kind = F.coalesce(*[F.when(F.lower("label") == k, F.lit(v)) for k, v in LABELS.items()], F.lit("paragraph"))
    ident = F.coalesce("id", F.concat(F.lit("#/block/"), "pos"))
    return items.select("doc_id", "pos", ident.alias("block_id"), kind.alias("type"), "text", "bbox", "parent_id", F.coalesce("confidence", F.lit(1.0)).alias("confidence"), F.lit(engine).alias("source_engine"))


def ocr_lines(pages: DataFrame, engine: str = "paddleocr") -> DataFrame:
    """Pages (doc_id, page, texts, scores, quads: corner points per line) as blocks with enclosing boxes."""
    lines = pages.select("doc_id", "page", F.posexplode(F.arrays_zip("texts", "scores", "quads")).alias("__n", "l"))
    xs, ys = F.transform("l.quads", lambda p: p[0].cast("double")), F.transform("l.quads", lambda p: p[1].cast("double"))
    box = F.struct(F.col("page").cast("int").alias("page"), F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))
    pos = F.row_number().over(Window.partitionBy("doc_id").orderBy("page", "__n")) - 1
    return lines.withColumn("pos", pos).select(
        "doc_id", "pos", F.concat(F.lit("#/ocr/"), "pos").alias("block_id"), F.lit("paragraph").alias("type"), F.col("l.texts").alias("text"), box.alias("bbox"),
        F.lit(None).cast("string").alias("parent_id"), F.col("l.scores").cast("double").alias("confidence"), F.lit(engine).alias("source_engine"),
    )


def split_pages(docs: DataFrame, n_pages: str = "n_pages", mark: str = "<PAGE>") -> DataFrame:
    """doc_id, page, text: the marked segments, or one page if their number is not the document's number of pages."""
    parts = F.split("text", mark)
    fit = F.when(F.size(parts) == F.col(n_pages), parts).otherwise(F.array("text"))
    return docs.select("doc_id", F.posexplode(fit).alias("__n", "text")).select("doc_id", (F.col("__n") + 1).alias("page"), "text")


def is_scanned(blocks: DataFrame) -> DataFrame:
    """doc_id, scanned: whether the first block came from another engine than the structured one."""
    return blocks.groupBy("doc_id").agg((F.min_by("source_engine", "pos") != "docling").alias("scanned"))


def first_pages(blocks: DataFrame, n: int) -> DataFrame:
    return blocks.where(F.col("bbox").isNull() | (F.col("bbox.page") <= n))


def routing_analysis(pages: DataFrame, scanned: str = "paddleocr") -> DataFrame:
    """Per document: what one engine for all its pages gets wrong against an engine per page."""
    routed = page_routes(pages, scanned)
    profile = doc_profile(routed).withColumn("doc_route", route(F.col("text_coverage"), scanned))
    joined = routed.join(profile.select("doc_id", "doc_route"), "doc_id")
    digital = F.col("doc_route") == "docling"
    counts = joined.groupBy("doc_id").agg(
        F.count_if(F.col("engine") != F.col("doc_route")).alias("n_misrouted_pages"), F.count_if(digital & ~F.col("has_text")).alias("n_content_loss_pages"),
        F.count_if(~digital & F.col("has_text")).alias("n_degraded_pages"),
    )
    runs = segments(routed).groupBy("doc_id").agg(F.count("*").alias("n_segments"))
    return profile.join(counts, "doc_id").join(runs, "doc_id")


def routing_summary(analysis: DataFrame) -> DataFrame:
    """One row over the documents of ``routing_analysis``."""
    mixed = (F.col("pages_with_text") > 0) & (F.col("pages_with_text") < F.col("page_count"))
    return analysis.agg(
        F.count("*").alias("n_docs"), F.sum("page_count").alias("total_pages"), F.count_if(mixed).alias("n_docs_both_formats"), F.count_if(F.col("n_misrouted_pages") > 0).alias("n_docs_with_misroute"),
        F.avg((F.col("n_misrouted_pages") > 0).cast("double")).alias("frac_docs_with_misroute"), F.sum("n_misrouted_pages").alias("total_misrouted_pages"),
        F.sum("n_content_loss_pages").alias("total_content_loss_pages"), F.sum("n_degraded_pages").alias("total_degraded_pages"),
        F.count_if(F.col("n_content_loss_pages") > 0).alias("n_docs_content_loss"), F.count_if(F.col("n_degraded_pages") > 0).alias("n_docs_degraded"),
    )


def ingest(blocks: DataFrame, redact: bool = True) -> DataFrame:
    """Parsed blocks as they enter the store: personal data is masked unless that is switched off."""
    return redact_blocks(blocks) if redact else blocks
