"""Omission signals: fact survival, cross-checks, coverage geometry, signatures, calibration."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from paperloom.functions.text import arrow, collapse, tokens, unescape_nfkc
from paperloom.operators.quality import is_garbled

FACT_KINDS = ("number", "temporal", "monetaryunit", "reportingentity", "financialconcepts")
BIN_EDGES = (0.0, 0.5, 0.8, 0.9, 0.95, 0.99, 1.0)
NEIGHBOURHOOD = 2


def strip_tags(c: Column) -> Column:
    """Tags become spaces; basic entities are resolved; white space collapses."""
    t = F.regexp_replace(c, r"<[^>]+>", " ")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        t = F.replace(t, F.lit(entity), F.lit(char))
    return collapse(t)


def canon_fact(c: Column, ascii_only: bool = False) -> Column:
    """Canonical fact text: lower case, no thousands commas, no currency signs; decimal points, number signs and percent signs stay; all else is a space.

    ``ascii_only`` leaves out entity and compatibility normalisation, which need Python.
    """
    t = F.lower(c if ascii_only else unescape_nfkc(c))
    t = F.regexp_replace(t, r"(?<=\d),(?=\d{3}(?!\d))", "")
    t = F.regexp_replace(t, r"[$€£¥]", "")
    keep = r"(?<=\d)\.(?=\d)|(?<!\d)-(?=\d)|(?<=\d)%"
    t = F.regexp_replace(t, rf"(?U)(?!{keep})[^\p{{L}}\p{{N}}]", " ")
    return collapse(t)


def contains_value(value: Column, text: Column) -> Column:
    """On canonical text: a substring between token boundaries; an empty value is nowhere."""
    sp = F.lit(" ")
    return (value != "") & F.contains(F.concat(sp, text, sp), F.concat(sp, value, sp))


def find_values(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(doc_id, item_id) of the documents (doc_id, t) that hold a value (item_id, v), both canonical.

    A value is looked up by the rarest of its words: only documents with that word are tested.
    """
    asked = wanted.select("item_id", "v", F.explode(F.array_distinct(F.split("v", " "))).alias("word"))
    words = docs.select("doc_id", F.explode(F.array_distinct(F.split("t", " "))).alias("word")).join(asked.select("word").distinct(), "word", "left_semi")
    seen = words.groupBy("word").agg(F.count("*").alias("df"))
    rare = asked.join(seen, "word").groupBy("item_id", "v").agg(F.min_by("word", F.struct("df", "word")).alias("word"), F.count("*").alias("__found"))
    whole = rare.where(F.col("__found") == F.size(F.array_distinct(F.split("v", " ")))).drop("__found")  # a word that no document has rules a value out
    near = words.join(whole, "word").select("doc_id", "item_id", "v")
    return near.join(docs.select("doc_id", "t"), "doc_id").where(contains_value(F.col("v"), F.col("t"))).select("doc_id", "item_id")


def critical_tokens(text: Column) -> Column:
    """Distinct canonical tokens with a digit."""
    return F.array_distinct(F.filter(F.split(text, " "), lambda t: t.rlike(r"\d")))


def crosscheck(primary: DataFrame, verifier: DataFrame, min_missing: int = 1, ascii_only: bool = False) -> DataFrame:
    """doc_id, missing_tokens, missing_count, flagged: digit tokens that the verifier read and the primary never.

    A distinct-and-anti-join on (doc, token): no document's text is put together.
    """
    words = lambda df: df.select("doc_id", F.explode(F.split(canon_fact(F.col("text"), ascii_only), " ")).alias("token"))
    missing = words(verifier).where(F.col("token").rlike(r"\d")).distinct().join(words(primary), ["doc_id", "token"], "left_anti")
    counted = missing.groupBy("doc_id").agg(F.array_sort(F.collect_list("token")).alias("missing_tokens"))
    docs = verifier.select("doc_id").distinct()
    out = docs.join(counted, "doc_id", "left").withColumn("missing_tokens", F.coalesce("missing_tokens", F.array().cast("array<string>")))
    n = F.size("missing_tokens")
    return out.withColumns({"missing_count": n, "flagged": n >= min_missing})


def invented_token_ratio(original: DataFrame, ocr: DataFrame) -> DataFrame:
    """doc_id, ratio: share of OCR tokens, repeats counted, that the original never has; 0 without tokens."""
    words = lambda df: df.select("doc_id", F.explode(tokens(F.col("text"))).alias("token"))
    counts = words(ocr).groupBy("doc_id", "token").agg(F.count("*").alias("n"))
    known = words(original).distinct().withColumn("known", F.lit(1))
    sums = counts.join(known, ["doc_id", "token"], "left").groupBy("doc_id").agg((F.sum(F.when(F.col("known").isNull(), F.col("n")).otherwise(0)) / F.sum("n")).alias("ratio"))
    return ocr.select("doc_id").distinct().join(sums, "doc_id", "left").na.fill(0.0, ["ratio"])


_FACT = re.compile(rf"<({'|'.join(FACT_KINDS)})\b[^>]*>(.*?)</\1\s*>", re.I | re.S)


@arrow("array<struct<n:int,kind:string,value:string,before:string,after:string>>")
def tagged_facts(text: pd.Series) -> pd.Series:
    """Tagged facts with the raw text around them (four times the context, as markup takes room)."""
    return pd.Series([[{"n": i, "kind": m[1].lower(), "value": m[2], "before": t[max(0, m.start() - 1200) : m.start()], "after": t[m.end() : m.end() + 1200]} for i, m in enumerate(_FACT.finditer(t))] for t in text.fillna("")])


def gold_facts(pages: DataFrame, context: int = 300) -> DataFrame:
    """doc_id, n, kind, value, context of every tagged fact with a value."""
    found = pages.select("doc_id", F.explode(tagged_facts("text")).alias("f")).select("doc_id", "f.*")
    return found.select("doc_id", "n", "kind", strip_tags(F.col("value")).alias("value"), F.concat(F.right(strip_tags(F.col("before")), F.lit(context)), F.lit(" "), F.left(strip_tags(F.col("after")), F.lit(context))).alias("context")).where("value <> ''")


def fact_outcomes(facts: DataFrame, blocks: DataFrame, window: int = NEIGHBOURHOOD, ascii_only: bool = False) -> DataFrame:
    """doc_id, n, kind, in_document, located, confidence, garbled of every measurable fact.

    A fact survives if its canonical value stands in a block or in the blocks ``window`` around one. Its pair
    is the block with the value, else the one whose rare tokens best match the context (two hits at least).
    """
    near = Window.partitionBy("doc_id").orderBy("pos").rowsBetween(-window, window)
    canon = blocks.select("doc_id", "pos", "text", "confidence", canon_fact(F.col("text"), ascii_only).alias("c"))
    canon = canon.withColumns({"around": F.array_join(F.collect_list("c").over(near), " ")})
    asked = facts.select("doc_id", "n", "kind", canon_fact(F.col("value"), ascii_only).alias("v"), canon_fact(F.col("context"), ascii_only).alias("x")).where("v <> ''")
    both = asked.join(canon.select("doc_id", "pos", "c", "around"), "doc_id")
    direct, wide = contains_value(F.col("v"), F.col("c")), contains_value(F.col("v"), F.col("around"))
    lead = contains_value(F.split("v", " ")[0], F.col("c"))
    held = both.groupBy("doc_id", "n").agg(F.min(F.when(direct, F.col("pos"))).alias("d"), F.min(F.when(wide, F.col("pos"))).alias("w"), F.array_sort(F.collect_list(F.when(lead, F.col("pos")))).alias("l"))
    inside = F.try_element_at(F.filter("l", lambda p: (p >= F.col("w") - window) & (p <= F.col("w") + window)), F.lit(1))
    value_at = held.select("doc_id", "n", F.coalesce("d", F.when(F.col("w").isNotNull(), F.coalesce(inside, "w"))).alias("vpos"))
    terms = F.array_except(F.array_distinct(tokens(F.col("x"))), tokens(F.col("v")))
    wanted = asked.select("doc_id", "n", F.size(terms).alias("terms"), F.explode(terms).alias("token"))
    held_by = canon.select("doc_id", "pos", F.explode(F.array_distinct(tokens(F.col("c")))).alias("token"))
    weight = held_by.groupBy("doc_id", "token").agg((1 / (1 + F.count("*"))).alias("weight"))
    match = wanted.join(held_by, ["doc_id", "token"]).join(weight, ["doc_id", "token"]).groupBy("doc_id", "n", "terms", "pos").agg(F.sum("weight").alias("score"), F.count("*").alias("hits"))
    located = match.groupBy("doc_id", "n", "terms").agg(F.min_by(F.struct("pos", "hits"), F.struct(-F.round("score", 12), F.col("pos"))).alias("b")).where(F.col("b.hits") >= F.least(F.lit(2), F.col("terms"))).select("doc_id", "n", F.col("b.pos").alias("xpos"))
    paired = asked.join(value_at, ["doc_id", "n"], "left").join(located, ["doc_id", "n"], "left").withColumn("pos", F.coalesce("vpos", "xpos"))
    out = paired.join(canon.select("doc_id", "pos", "confidence", is_garbled(F.col("text")).alias("garbled")), ["doc_id", "pos"], "left")
    return out.select("doc_id", "n", "kind", F.col("vpos").isNotNull().alias("in_document"), F.col("pos").isNotNull().alias("located"), "confidence", "garbled")


def omission_by_kind(outcomes: DataFrame) -> DataFrame:
    """Per kind and in total (kind null): gold, omitted, omission_rate, scored, accuracy."""
    return outcomes.rollup("kind").agg(
        F.count("*").alias("n_gold"), F.count_if(~F.col("in_document")).alias("n_omitted"), F.avg((~F.col("in_document")).cast("double")).alias("omission_rate"),
        F.count_if("located").alias("n_scored"), F.avg(F.when(F.col("located"), F.col("in_document").cast("double"))).alias("accuracy"),
    )


def reliability(pairs: DataFrame, confidence: str, ok: str, edges: tuple[float, ...] = BIN_EDGES) -> DataFrame:
    """lo, hi, n, accuracy per confidence bin; the last bin is closed on the right, empty bins have no accuracy."""
    c, bins = F.col(confidence), list(zip(edges, edges[1:]))
    at = F.lit(None).cast("int")
    for i, (lo, hi) in enumerate(bins):
        at = F.when((c >= lo) & ((c < hi) | ((c == hi) & F.lit(i == len(bins) - 1))), i).otherwise(at)
    frame = pairs.sparkSession.createDataFrame([(i, lo, hi) for i, (lo, hi) in enumerate(bins)], "bin int, lo double, hi double")
    sums = pairs.groupBy(at.alias("bin")).agg(F.count("*").alias("n"), F.avg(F.col(ok).cast("double")).alias("accuracy"))
    return frame.join(sums, "bin", "left").na.fill(0, ["n"]).drop("bin")


def threshold_for_accuracy(pairs: DataFrame, confidence: str, ok: str, target: float, candidates: tuple[float, ...] = BIN_EDGES, min_n: int = 30) -> DataFrame:
    """One row: the smallest candidate whose pairs at or above it are enough and accurate enough, else null. One pass."""
    at = lambda c: F.when(F.col(confidence) >= c, F.col(ok).cast("double"))
    sums = pairs.agg(*[x for i, c in enumerate(candidates) for x in (F.count(at(c)).alias(f"n{i}"), F.avg(at(c)).alias(f"a{i}"))])
    good = F.coalesce(*[F.when((F.col(f"n{i}") >= min_n) & (F.col(f"a{i}") >= target), F.lit(c)) for i, c in sorted(enumerate(candidates), key=lambda x: x[1])], F.lit(None).cast("double"))
    return sums.select(good.alias("threshold"))


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    """n, r: population correlation; null below two rows or without variance. With a 0/1 column, the point-biserial one."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    c = df.agg(F.count("*").alias("n"), F.var_pop(a).alias("vx"), F.var_pop(b).alias("vy"), F.covar_pop(a, b).alias("c"))
    return c.select("n", F.when((F.col("n") >= 2) & (F.col("vx") > 0) & (F.col("vy") > 0), F.col("c") / F.sqrt(F.col("vx") * F.col("vy"))).alias("r"))


# ---- geometry


def overlaps(a: str, b: str) -> Column:
    """Strict overlap of two boxes given as columns or structs with x0, y0, x1, y1."""
    g = lambda s, k: F.col(f"{s}.{k}")
    return (g(a, "x0") < g(b, "x1")) & (g(b, "x0") < g(a, "x1")) & (g(a, "y0") < g(b, "y1")) & (g(b, "y0") < g(a, "y1"))


def overlap_share(a: str, b: str) -> Column:
    """Share of box a's own area inside box b; 0 for an empty box."""
    g = lambda s, k: F.col(f"{s}.{k}")
    w = F.least(g(a, "x1"), g(b, "x1")) - F.greatest(g(a, "x0"), g(b, "x0"))
    h = F.least(g(a, "y1"), g(b, "y1")) - F.greatest(g(a, "y0"), g(b, "y0"))
    area = (g(a, "x1") - g(a, "x0")) * (g(a, "y1") - g(a, "y0"))
    return F.when((w > 0) & (h > 0) & (area > 0), w * h / area).otherwise(0.0)


def blocks_in_zones(blocks: DataFrame, zones: DataFrame, scale: float = 1.0) -> DataFrame:
    """Adds ``in_zone``: whether a block's box overlaps any zone (doc_id, page, x0..y1) of its page; equal pages join, boxes are the residual."""
    z = zones.select("doc_id", F.col("page").alias("zpage"), F.struct(*[(F.col(k) * scale).alias(k) for k in ("x0", "y0", "x1", "y1")]).alias("zone"))
    boxed = blocks.where(F.col("bbox").isNotNull())
    hit = boxed.select("doc_id", "block_id", "bbox", F.col("bbox.page").alias("zpage")).join(z, ["doc_id", "zpage"]).where(overlaps("bbox", "zone")).select("doc_id", "block_id").distinct().withColumn("__hit", F.lit(True))
    return boxed.join(hit, ["doc_id", "block_id"], "left").withColumn("in_zone", F.coalesce("__hit", F.lit(False))).drop("__hit")


def zone_stats(marked: DataFrame) -> DataFrame:
    """in_zone, n, mean confidence, garble ratio."""
    return marked.groupBy("in_zone").agg(F.count("*").alias("n"), F.avg("confidence").alias("mean_confidence"), F.avg(is_garbled(F.col("text")).cast("double")).alias("garble_ratio"))


@arrow("double")
def union_share(region: pd.DataFrame, boxes: pd.Series) -> pd.Series:
    """Share of a region's area under the union of boxes (x0, y0, x1, y1), exact by coordinate cells; 1 for an empty region."""
    out = []
    for x0, y0, x1, y1, bs in zip(region.x0, region.y0, region.x1, region.y1, boxes):
        area = (x1 - x0) * (y1 - y0)
        if area <= 0:
            out.append(1.0)
            continue
        b = np.array([[max(r["x0"], x0), max(r["y0"], y0), min(r["x1"], x1), min(r["y1"], y1)] for r in (bs if bs is not None else [])], float).reshape(-1, 4)
        b = b[(b[:, 0] < b[:, 2]) & (b[:, 1] < b[:, 3])]
        if not len(b):
            out.append(0.0)
            continue
        xs, ys = np.unique(b[:, [0, 2]]), np.unique(b[:, [1, 3]])
        grid = np.zeros((len(xs) - 1, len(ys) - 1), bool)
        for p, q, r, s in b:
            grid[np.searchsorted(xs, p) : np.searchsorted(xs, r), np.searchsorted(ys, q) : np.searchsorted(ys, s)] = True
        out.append(float((np.diff(xs)[:, None] * np.diff(ys)[None] * grid).sum() / area))
    return pd.Series(out)


def region_fill(regions: DataFrame, blocks: DataFrame, dilate: float = 0.0, uncovered_below: float = 0.5) -> DataFrame:
    """Adds fill (share of the region under its page's dilated block boxes) and uncovered. ``regions``: doc_id, page, region_id, x0..y1."""
    side = lambda k, d: (F.col(f"bbox.{k}") + d).alias(k)
    boxes = blocks.where(F.col("bbox").isNotNull()).select("doc_id", F.col("bbox.page").alias("page"), F.struct(side("x0", -dilate), side("y0", -dilate), side("x1", dilate), side("y1", dilate)).alias("box"))
    r = regions.withColumn("__r", F.struct("x0", "y0", "x1", "y1"))
    near = r.join(boxes, ["doc_id", "page"]).where(overlaps("__r", "box")).groupBy("doc_id", "page", "region_id").agg(F.collect_list("box").alias("__boxes"))
    full = r.join(near, ["doc_id", "page", "region_id"], "left").withColumn("fill", union_share("__r", "__boxes"))
    return full.withColumn("uncovered", F.col("fill") < uncovered_below).drop("__r", "__boxes")


def layout_omission(filled: DataFrame) -> DataFrame:
    """doc_id, regions, n_uncovered_regions, layout_omission_score: area-weighted share of uncovered regions."""
    area = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    return filled.groupBy("doc_id").agg(F.count("*").alias("regions"), F.count_if("uncovered").alias("n_uncovered_regions"), F.coalesce(F.try_divide(F.sum(F.when(F.col("uncovered"), area).otherwise(0.0)), F.sum(area)), F.lit(0.0)).alias("layout_omission_score"))


def page_coverage_rollup(pages: DataFrame) -> DataFrame:
    """Ink-weighted coverage of documents from pages (doc_id, page, ink_px, covered_px)."""
    page = F.when(F.col("ink_px") > 0, F.col("covered_px") / F.col("ink_px")).otherwise(1.0)
    total = F.when(F.sum("ink_px") > 0, F.sum("covered_px") / F.sum("ink_px")).otherwise(1.0)
    return pages.groupBy("doc_id").agg(F.count("*").alias("n_pages"), total.alias("ink_coverage"), (1 - total).alias("uncovered_ink_ratio"), F.min(page).alias("min_page_coverage"), F.max(page).alias("max_page_coverage"))


def otsu(histogram: DataFrame) -> DataFrame:
    """page_id, threshold from (page_id, level 0-255, n): the level of the largest between-class variance; 128 without pixels."""
    up = Window.partitionBy("page_id").orderBy("level")
    all_ = Window.partitionBy("page_id")
    n, s = F.col("n").cast("double"), F.col("n") * F.col("level").cast("double")
    h = histogram.withColumns({"w0": F.sum(n).over(up), "s0": F.sum(s).over(up), "w": F.sum(n).over(all_), "s": F.sum(s).over(all_)})
    w1 = F.col("w") - F.col("w0")
    gap = F.col("s0") / F.col("w0") - (F.col("s") - F.col("s0")) / w1
    var = F.when((F.col("w0") > 0) & (w1 > 0), F.col("w0") * w1 * gap * gap).otherwise(-1.0)
    return h.withColumn("v", var).groupBy("page_id").agg(F.when(F.max("v") > 0, F.min_by("level", F.struct(-F.col("v"), F.col("level")))).otherwise(128).alias("threshold"))


@arrow("struct<ink_px:long,covered_px:long>")
def ink_under_boxes(raster: pd.Series, width: pd.Series, threshold: pd.Series, boxes: pd.Series) -> pd.DataFrame:
    """Dark pixels of grey rasters (bytes, row by row) and how many of them lie under boxes, which are floored, ceiled and clamped."""
    rows = []
    for data, w, t, bs in zip(raster, width, threshold, boxes):
        grey = np.frombuffer(data, np.uint8).reshape(-1, w) if data else np.empty((0, max(1, w)), np.uint8)
        ink, mask = grey <= t, np.zeros(grey.shape, bool)
        for b in bs if bs is not None else []:
            y, x = max(0, int(np.floor(b["y0"]))), max(0, int(np.floor(b["x0"])))
            mask[y : max(y, int(np.ceil(b["y1"]))), x : max(x, int(np.ceil(b["x1"])))] = True
        rows.append((int(ink.sum()), int((ink & mask).sum())))
    return pd.DataFrame(rows, columns=["ink_px", "covered_px"])


def zone_density(pages: DataFrame) -> DataFrame:
    """Mean densities in and out of zones over pages (inside, outside), and their ratio; nulls are left out."""
    return pages.agg(F.avg("inside").alias("mean_in"), F.avg("outside").alias("mean_out"), F.count("inside").alias("n")).withColumn("ratio", F.try_divide("mean_in", "mean_out"))


# ---- signatures

#: What closes a letter, what announces a signature, a typed personal name, and the signals' weights.
CLOSING = r"(?i)\b(sincerely|best regards|regards|very truly yours|truly yours|yours truly|cordially|respectfully|yours faithfully|faithfully)\b"
SIGNATURE_WORD = r"(?i)/s/|duly authorized|authorized (?:signature|representative)|\bby:"
NAME_LINE = r"^\s*(?:(?:[A-Z]\.|[A-Z][a-z]+\.?)\s+){1,3}[A-Z][a-z]{2,}[.,]?\s*$"
SIGNAL_WEIGHTS = {"closing": 0.90, "sigword": 0.80, "sigblock": 0.75}
GAP, SIDE, LOW_CONFIDENCE, SIGNED_FROM, NO_SIGNAL = 300.0, 400.0, 0.85, 0.5, 0.2


def detect_signatures(blocks: DataFrame, closing: str = CLOSING, sigword: str = SIGNATURE_WORD) -> DataFrame:
    """doc_id, closing, sigword, sigblock, confidence, signed.

    Words are conditional aggregates; the name line with a faint token above it is a band self-join of the
    lower half's name lines with the document's faint blocks.
    """
    boxed = blocks.where(F.col("bbox").isNotNull())
    bottom = boxed.groupBy("doc_id").agg(F.max("bbox.y1").alias("bottom"))
    names = boxed.where(F.trim("text").rlike(NAME_LINE)).join(bottom, "doc_id").where((F.col("bottom") > 0) & (F.col("bbox.y0") > 0.5 * F.col("bottom"))).select("doc_id", F.col("block_id").alias("name_id"), F.col("bbox.x0").alias("nx"), F.col("bbox.y0").alias("ny"))
    faint = boxed.where(F.col("confidence") < LOW_CONFIDENCE).select("doc_id", "block_id", F.col("bbox.x0").alias("x"), F.col("bbox.y0").alias("y"))
    gap = F.col("ny") - F.col("y")
    band = names.join(faint, "doc_id").where((F.col("block_id") != F.col("name_id")) & (gap > 0) & (gap < GAP) & (F.abs(F.col("x") - F.col("nx")) < SIDE))
    signed = band.select("doc_id").distinct().withColumn("__band", F.lit(True))
    word = blocks.groupBy("doc_id").agg(F.bool_or(F.col("text").rlike(closing)).alias("closing"), F.bool_or(F.col("text").rlike(sigword)).alias("sigword"))
    all_ = word.join(signed, "doc_id", "left").withColumn("sigblock", F.coalesce("__band", F.lit(False))).drop("__band")
    unsigned = F.lit(1.0)
    for s, w in SIGNAL_WEIGHTS.items():
        unsigned = unsigned * F.when(F.col(s), 1 - w).otherwise(1.0)
    any_ = F.col("closing") | F.col("sigword") | F.col("sigblock")
    out = all_.withColumn("confidence", F.when(any_, F.round(1 - unsigned, 4)).otherwise(NO_SIGNAL))
    return out.withColumn("signed", any_ & (F.col("confidence") >= SIGNED_FROM))


def page_boxes(blocks: DataFrame, box_dpi: float = 300.0, render_dpi: float = 300.0) -> DataFrame:
    """doc_id, block_id, page, x0, y0, x1, y1 in pixels of the rendering, of blocks that have a box."""
    at = lambda c: (F.col(f"bbox.{c}") * (render_dpi / box_dpi)).alias(c)
    return blocks.where("bbox is not null").select("doc_id", "block_id", "bbox.page", *[at(c) for c in ("x0", "y0", "x1", "y1")])


def page_numbers(blocks: DataFrame) -> DataFrame:
    """doc_id, pages: the pages with boxes, in order."""
    return blocks.where("bbox is not null").groupBy("doc_id").agg(F.array_sort(F.collect_set("bbox.page")).alias("pages"))


REGION = "struct<label:string,score:double,box:array<double>>"


def detected_regions(pages: DataFrame) -> DataFrame:
    """doc_id, page, label, score, box from a detector's ``boxes`` (array of label, score, coordinate); an unnamed one is a region of score 0."""
    b = F.col("b")
    rows = pages.select("doc_id", "page", F.explode("boxes").alias("b"))
    return rows.select("doc_id", "page", F.coalesce(b["label"], F.lit("region")).alias("label"), F.coalesce(b["score"].cast("double"), F.lit(0.0)).alias("score"), b["coordinate"].cast("array<double>").alias("box"))


def legacy_regions(pages: DataFrame) -> DataFrame:
    """The same from the older detector's ``items`` (array of type, bbox), which has no scores; items without four numbers are left out."""
    b = F.col("b")
    rows = pages.select("doc_id", "page", F.explode("items").alias("b")).where(F.size(b["bbox"]) == 4)
    return rows.select("doc_id", "page", F.coalesce(b["type"], F.lit("region")).alias("label"), F.lit(1.0).alias("score"), b["bbox"].cast("array<double>").alias("box"))
