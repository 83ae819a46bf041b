"""Sources and sinks of documents, labels, traces and vectors."""

from __future__ import annotations

import io
import lzma
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from paperloom.model import GOLD, TRACES, paragraphs

DOCUMENT_SUFFIXES = ("pdf", "docx", "txt")


def list_documents(spark: SparkSession, folder: str, prefix: str = "", recursive: bool = True, suffixes: tuple[str, ...] = DOCUMENT_SUFFIXES) -> DataFrame:
    """path, name, length, content of documents, by suffix and name prefix. Order by path where order matters."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    files = reader.load(folder).withColumn("name", F.element_at(F.split("path", "/"), -1))
    ok = F.lower("name").rlike(r"\.(" + "|".join(suffixes) + ")$") & F.startswith(F.col("name"), F.lit(prefix))
    return files.where(ok).select("path", "name", "length", "content")


def content_store(files: DataFrame) -> DataFrame:
    """One row per distinct content: file_hash, path (the first), content."""
    return files.withColumn("file_hash", F.sha2("content", 256)).groupBy("file_hash").agg(F.min_by(F.struct("path", "content"), "path").alias("f")).select("file_hash", "f.*")


def text_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Paragraph blocks of text files, cut at blank lines; doc_id is the file's stem."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder)
    docs = rows.select(F.regexp_extract("path", r"([^/]+)\.txt$", 1).alias("doc_id"), F.col("content").cast("string").alias("text"))
    cut = paragraphs(docs, r"\n\s*\n", strip=True, drop_empty=True)
    dense = F.row_number().over(Window.partitionBy("doc_id").orderBy("pos")) - 1
    return cut.withColumn("pos", dense).withColumn("block_id", F.concat(F.lit("#/b/"), "pos"))


def golden_set(spark: SparkSession, folder: str) -> DataFrame:
    """Labels in long form from JSON files of doc_id, source_pdf and a map of facts."""
    raw = spark.read.schema("doc_id string, source_pdf string, facts map<string,string>").json(folder, multiLine=True, pathGlobFilter="*.json")
    return raw.select("doc_id", F.explode("facts").alias("field", "value"))


def resolve_columns(columns: list[str], wanted: dict[str, str]) -> dict[str, str]:
    """Finds each wanted heading: equal without case, else contained; headings that are missing are an error."""
    out, missing = {}, []
    for name, heading in wanted.items():
        h = heading.lower()
        hit = next((c for c in columns if c.lower() == h), None) or next((c for c in columns if h in c.lower()), None)
        if hit is None:
            missing.append(heading)
        else:
            out[name] = hit
    if missing:
        raise KeyError(f"no column for: {', '.join(missing)}")
    return out


def labelled_csv(spark: SparkSession, path: str, wanted: dict[str, str], files: DataFrame | None = None, n: int | None = None) -> DataFrame:
    """Labels in long form from a wide CSV (``wanted``: field -> heading, with doc_id among them); with ``files``, only documents whose file exists."""
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"')
    at = resolve_columns(raw.columns, wanted)
    rows = raw.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(k) for k, c in at.items()])
    if files is not None:
        stems = files.select(F.regexp_replace("name", r"\.[^.]+$", "").alias("doc_id")).distinct()
        rows = rows.withColumn("doc_id", F.regexp_replace("doc_id", r"\.[^.]+$", "")).join(stems, "doc_id", "left_semi")
    if n is not None:
        rows = rows.orderBy("doc_id").limit(n)
    return rows.unpivot("doc_id", [k for k in at if k != "doc_id"], "field", "value")


def zipped_lines(spark: SparkSession, compressed: str, expected: str) -> DataFrame:
    """file, line number and label line of two line-aligned files, the first one xz-compressed. Unequal lengths are an error."""

    def lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for data in pdf.content:
                text = lzma.decompress(data).decode() if data[:6] == b"\xfd7zXZ\x00" else data.decode()
                rows = [(i, line) for i, line in enumerate(io.StringIO(text).read().splitlines())]
                yield pd.DataFrame(rows, columns=["n", "line"])

    load = lambda p: spark.read.format("binaryFile").load(p).select("content").mapInPandas(lines, "n long, line string")
    both = load(compressed).withColumnRenamed("line", "left").join(load(expected).withColumnRenamed("line", "right"), "n", "full")
    whole = F.col("left").isNotNull() & F.col("right").isNotNull()
    return both.where(F.assert_true(whole, "the files differ in length").isNull()).select("n", F.trim(F.split("left", "\t")[0]).alias("file"), F.col("right").alias("expected"))


#: Label keys of the key=value format and the fields they mean.
KEY_FIELDS = {"effective_date": "effective_date", "jurisdiction": "governing_law", "term": "term", "party": "party"}


def expected_facts(lines: DataFrame) -> DataFrame:
    """doc_id, field, value of "k=v k=v" label lines; several parties are one joined value, absent keys are empty, the last of a repeated key counts."""
    pairs = lines.select(F.col("file").alias("doc_id"), F.posexplode(F.filter(F.split(F.trim("expected"), r"\s+"), lambda p: p != "")).alias("i", "p"))
    kv = pairs.select("doc_id", "i", F.substring_index("p", "=", 1).alias("k"), F.trim(F.replace(F.regexp_replace("p", "^[^=]*=?", ""), F.lit("_"), F.lit(" "))).alias("v"))
    values = kv.groupBy("doc_id", "k").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda x: x["v"]), "; ").alias("all"), F.max_by("v", "i").alias("last"))
    frame = lines.select(F.col("file").alias("doc_id")).distinct().crossJoin(F.broadcast(lines.sparkSession.createDataFrame(list(KEY_FIELDS.items()), "k string, field string")))  # four keys
    value = F.when(F.col("k") == "party", F.col("all")).otherwise(F.col("last"))
    return frame.join(values, ["doc_id", "k"], "left").select("doc_id", "field", F.coalesce(value, F.lit("")).alias("value"))


def zones_xml(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, kind, page, x0, y0, x1, y1 of page-zone XML files, whatever their namespace."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.xml").load(folder)
    files = raw.select(F.regexp_extract("path", r"([^/]+)\.xml$", 1).alias("doc_id"), F.regexp_replace(F.regexp_replace(F.col("content").cast("string"), r"(?s)<\?xml.*?\?>", ""), r"\sxmlns(:\w+)?=\"[^\"]*\"|(?<=[</])\w+:", "").alias("x"))
    attr = lambda k: F.xpath("x", F.lit(f"//DL_ZONE/@{k}"))
    z = files.select("doc_id", F.explode(F.arrays_zip(attr("gedi_type").alias("kind"), attr("col").alias("col"), attr("row").alias("row"), attr("width").alias("width"), attr("height").alias("height"))).alias("z"))
    n = lambda k: F.col(f"z.{k}").cast("double")
    return z.select("doc_id", F.col("z.kind").alias("kind"), F.lit(1).alias("page"), n("col").alias("x0"), n("row").alias("y0"), (n("col") + n("width")).alias("x1"), (n("row") + n("height")).alias("y1"))


def traces(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRACES).json(path)


def append_traces(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_facts_csv(rows: DataFrame, path: str) -> None:
    """The export's eight columns, values guarded against running as formulas."""
    from paperloom.operators.report import csv_safe

    names = ["doc_id", "field", "clm_field", "value", "source_block_id", "confidence", "risk_tier", "verified"]
    rows.select(*[csv_safe(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in names]).write.csv(path, header=True, lineSep="\n", emptyValue="")


def write_facts_json(rows: DataFrame, path: str) -> None:
    rows.write.json(path)


def upsert_vectors(table: DataFrame, new: DataFrame) -> DataFrame:
    """Vectors by chunk_id: known chunks get the new embedding and nothing else, others are added."""
    fresh = new.select("chunk_id", F.col("embedding").alias("__e"))
    names = table.columns
    kept = table.join(fresh, "chunk_id", "left").withColumn("embedding", F.coalesce("__e", "embedding")).select(*names)
    return kept.unionByName(new.join(table.select("chunk_id"), "chunk_id", "left_anti").select(*names))


def cached(make: Callable[[], DataFrame], spark: SparkSession, path: str) -> DataFrame:
    """A table that is computed once: read if it is there, else written first."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.parquet(path)
    except AnalysisException:
        make().write.parquet(path)
        return spark.read.parquet(path)


def gold_frame(spark: SparkSession, rows: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rows, GOLD)


IMAGE_SUFFIXES = ("png", "jpg", "jpeg", "tif", "tiff", "pdf")


def scan_images(spark: SparkSession, folder: str, cap: int | None = None) -> DataFrame:
    """Image and PDF files directly in a folder, by name; ``cap`` keeps the first ones."""
    files = list_documents(spark, folder, recursive=False, suffixes=IMAGE_SUFFIXES).orderBy("name")
    return files if cap is None else files.limit(cap)


def labelled_pages(spark: SparkSession, folder: str, cap: int | None = None) -> DataFrame:
    """page_id, image (bytes), gold_html: rows of raw_input.csv whose gold file exists, by id; ``cap`` keeps the first ones."""
    images = spark.read.option("maxCharsPerColumn", -1).csv(f"{folder}/raw_input.csv", header=True).select(F.col("id").cast("long").alias("page_id"), "image")
    gold = spark.read.text(f"{folder}/gold_annotation_html", wholetext=True, pathGlobFilter="gold_*.txt").select(F.regexp_extract("_metadata.file_name", r"^gold_(\d+)\.txt$", 1).cast("long").alias("page_id"), F.col("value").alias("gold_html"))
    payload = F.when(F.col("image").startswith("data:"), F.regexp_extract("image", r"^[^,]*,(?s)(.*)$", 1)).otherwise(F.col("image"))
    rows = images.join(gold, "page_id").select("page_id", F.unbase64(payload).alias("image"), "gold_html")
    return rows if cap is None else rows.orderBy("page_id").limit(max(0, cap))


def physical_documents(index: DataFrame, order: str) -> DataFrame:
    """One row per physical file (entity, filename) of a master index, the first by ``order``; ``rel_path`` added, unreadable page counts are 0."""
    rows = index.withColumns({"rel_path": F.concat_ws("/", F.lit("by_entity"), "entity", "filename"), "pages": F.coalesce(F.expr("try_cast(pages AS INT)"), F.lit(0))})
    first = rows.groupBy("entity", "filename").agg(F.min_by(F.struct(*[c for c in rows.columns if c not in ("entity", "filename", order)]), order).alias("r"))
    return first.select("entity", "filename", "r.*")


def mixed_documents(documents: DataFrame, cap: int | None = None) -> DataFrame:
    """Documents of mixed format, or of scanned format where there are none, by path; ``cap`` keeps the first ones."""
    has_mixed = documents.agg(F.coalesce(F.bool_or(F.col("format") == "mixed"), F.lit(False)).alias("any"))
    wanted = has_mixed.select(F.when(F.col("any"), "mixed").otherwise("scanned").alias("format"))
    chosen = documents.join(F.broadcast(wanted), "format")  # one row
    return chosen if cap is None else chosen.orderBy("rel_path").limit(cap)


def write_facts_object(rows: DataFrame, stp: DataFrame, path: str) -> None:
    """Per document one JSON object of its ``facts`` (array) and its ``stp`` (struct)."""
    facts = rows.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("field", *[c for c in rows.columns if c not in ("doc_id", "field")]))).alias("facts"))
    whole = facts.join(stp.select("doc_id", F.struct(*[c for c in stp.columns if c != "doc_id"]).alias("stp")), "doc_id", "left")
    whole.write.mode("overwrite").json(path)
