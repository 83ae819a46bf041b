"""Replies, seams, health checks, agents, evaluation summaries, damaged scans and the files of evaluation sets."""

import base64
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.operators import agent, constrained, evaluate, healthcheck, metrics, observe, parse, pii, retrieval, scans, seams
from paperloom.sources import files

GOOD = {"value": "Ohio", "source_block_id": "#b1", "confidence": 0.5}
FIELDS = ("law", "value")


@pytest.mark.parametrize("reply, fact, repairs", [
    (json.dumps({"law": GOOD}), ("Ohio", "#b1", 0.5), {}),
    ("```json\n" + json.dumps({"law": GOOD}) + "\n```", ("Ohio", "#b1", 0.5), {"fence_strip": 1}),
    (json.dumps({"Facts": {"law": GOOD}}), ("Ohio", "#b1", 0.5), {"unwrap_root": 1}),
    (json.dumps({"law": {"Clause": GOOD}}), ("Ohio", "#b1", 0.5), {"unwrap_field": 1}),
    (json.dumps({"law": {**GOOD, "source_block_id": "b1"}}), ("Ohio", "#b1", 0.5), {"hash_prefix": 1}),
    (json.dumps({"law": {**GOOD, "source_block_id": "b7"}}), ("Ohio", "b7", 0.5), {}),
    (json.dumps({"law": {**GOOD, "value": 3}}), ("", None, 0.0), {"field_dropped": 1}),
    (json.dumps({"law": {**GOOD, "confidence": 7}}), ("", None, 0.0), {"field_dropped": 1}),
    (json.dumps({"law": {"Clause": {"value": 3}}}), ("", None, 0.0), {}),
    (json.dumps({"law": None}), ("", None, 0.0), {}),
    ("no json", ("", None, 0.0), {"payload_invalid": 1}),
    ("[1]", ("", None, 0.0), {"payload_invalid": 1}),
    (None, ("", None, 0.0), {"payload_invalid": 1}),
])
def test_replies_are_repaired_and_counted(reply, fact, repairs):
    facts, counted = constrained.read_reply(reply, FIELDS, ["#b1"])
    assert facts == [("law", *fact), ("value", "", None, 0.0)] and dict(counted) == repairs


def test_context_and_schema(make_blocks, spark):
    assert constrained.context(make_blocks(("title", "T"), ("paragraph", "x"))).first().context == "[b0] T\n\n[b1] x"
    schema = constrained.strict_schema(FIELDS)
    assert schema["required"] == list(FIELDS) and "default" not in json.dumps(schema) and not schema["properties"]["law"]["additionalProperties"]


def test_seams_turn_errors_into_rows(spark):
    calls = spark.createDataFrame([(1, "2"), (2, "x"), (3, None)], "id int, v string")
    got = {r.id: (r.n, r.error) for r in seams.call_each(calls, "v", int, "n long", attempts=2).collect()}
    assert got[1] == (2, None) and got[2][0] is None and got[2][1].startswith("ValueError") and got[3][1].startswith("TypeError")
    assert seams.attempt(lambda _: __import__("time").sleep(2), 1, 1, 0, 0.1)[1].startswith("TimeoutError")
    tries = []
    assert seams.attempt(lambda v: tries.append(v) or (1 / 0 if len(tries) < 3 else "ok"), 1, 3, 0, None) == ("ok", None) and len(tries) == 3
    with pytest.raises(ValueError, match="unknown embedder"):
        seams.embedder("none")


def test_rerank_keeps_the_order_of_queries_whose_calls_fail(spark):
    hits = spark.createDataFrame([(1, "q", "bb", 0), (1, "q", "a", 1), (2, "q", "bb", 0), (2, "q", None, 1)], "query_id int, query string, text string, rank int")
    got = {(r.query_id, r["rank"]): (r.text, r.degraded) for r in seams.rerank(hits, lambda ask: -len(ask["text"])).collect()}
    assert got == {(1, 0): ("a", False), (1, 1): ("bb", False), (2, 0): ("bb", True), (2, 1): (None, True)}
    named = seams.reorder(hits.where("query_id = 1"), F.array(F.lit(1), F.lit(9))).orderBy("rank").collect()
    assert [r.text for r in named] == ["a", "bb"]


def test_reports_have_names_of_their_own(spark):
    docs = spark.createDataFrame([(n,) for n in ("a.docx", "a.pdf", "a.PDF", "b.pdf", ".pdf", "a.txt")], "filename string")
    names = [r.report for r in healthcheck.report_names(docs).collect()]
    assert len(set(names)) == 6 and {"b.html", "doc.html"} < set(names)


def test_health_check_isolates_failures(spark):
    docs = spark.createDataFrame([("a", "5"), ("b", "zero")], "doc_id string, v string")
    done = healthcheck.process(docs, lambda v: {"quality_score": 1 / int(v), "needs_review": False}, "v", "struct<quality_score:double,needs_review:boolean>", timeout=5.0)
    assert {r.doc_id: r.reason is None for r in done.collect()} == {"a": True, "b": False}
    s = healthcheck.summary(done).first()
    assert (s.n_docs, s.n_failures, s.mean_quality) == (1, 1, 0.2)
    page = healthcheck.html_rows(spark.createDataFrame([("d", "f", "<b>&")], "doc_id string, field string, value string"), ["field", "value"], "R&D").first().page
    assert "<td>&lt;b&gt;&amp;</td>" in page and "<title>R&amp;D</title>" in page


def test_compare_versions(spark):
    facts = lambda v: spark.createDataFrame([("d", "law", v, "#1", 0.7)], "doc_id string, field string, value string, source_block_id string, confidence double")
    r = healthcheck.compare_versions(facts(""), facts("Ohio"), facts("").select("doc_id", "field", F.lit(True).alias("passed")), spark.createDataFrame([("law", "high")], "field string, risk string")).first()
    assert (r.dirty_value, r.cleaned_value, r.verified, r.risk) == ("", "Ohio", True, "high")


def test_agent_runs_end():
    tools = {"ok": lambda v: v, "bad": lambda v: 1 / 0}
    plan = lambda *calls: lambda task, steps: calls[len(steps)] if len(steps) < len(calls) else None
    assert agent.run_steps({}, plan(("ok", 1)), tools) == ("answered", [("ok", 1, 1, None)])
    assert agent.run_steps({}, plan(("none", 1)), tools) == ("failed", [("none", 1, None, "unknown_tool")])
    assert agent.run_steps({}, plan(("bad", 1), ("ok", 1)), tools)[1][0][3] == "division by zero"
    assert len(agent.run_steps({}, lambda t, s: ("ok", 0), tools, max_steps=4)[1]) == 4
    assert agent.tool_choice('{"tool": "ok", "input": 2}', tools) == ("ok", 2) and agent.tool_choice("?", tools) is None


def test_counters_and_spans(spark):
    c = observe.Counters()
    c.add("a")
    c.add("a", 2)
    assert (c.value("a"), c.value("b"), c.snapshot()) == (3, 0, {"a": 3})
    now = iter([1.0, 1.5, 2.0, 2.25])
    t = observe.Tracer("d", "t", clock=lambda: next(now))
    with t.span("one") as row:
        row["tokens"] = 4
    with pytest.raises(TimeoutError), t.span("two"):
        raise TimeoutError
    spans = observe.spans(t.frame(spark)).orderBy("name").collect()
    assert [(s.name, s.duration_ms, s.status, s.tokens) for s in spans] == [("one", 500.0, "ok", 4), ("two", 250.0, "timeout", 0)]
    assert [r.line for r in observe.span_lines(observe.spans(t.frame(spark))).orderBy("line").collect()][1].endswith("$0.00000 [timeout:TimeoutError]")


def test_percentiles_are_nearest_rank(spark):
    rows = spark.createDataFrame([("a", float(v)) for v in (5, 1, 1, 9, 7)] + [("b", 2.0)], "k string, v double")
    got = {r.k: (r.p10, r.p50) for r in evaluate.ranked_value(rows, "k", "v", {"p10": 0.1, "p50": 0.5}).collect()}
    assert got == {"a": (1.0, 5.0), "b": (2.0, 2.0)}


@pytest.mark.parametrize("level", list(scans.LEVELS))
def test_damaged_pages_are_seeded(spark, level):
    page = np.full((40, 30), 255, np.uint8)
    page[10:14, 4:26] = 0
    rows = spark.createDataFrame([("d", p, 30, bytearray(page.tobytes())) for p in (1, 2)] + [("e", 1, 30, None)], "doc_id string, page int, width int, raster binary")
    out = {(r.doc_id, r.page): bytes(r.raster) for r in scans.degrade(rows, level, seed=3).collect()}
    again = {(r.doc_id, r.page): bytes(r.raster) for r in scans.degrade(rows, level, seed=3).collect()}
    assert out == again and out["d", 1] != out["d", 2] and len(out["d", 1]) == 1200 and out["e", 1] == b""
    grey = np.frombuffer(out["d", 1], np.uint8).reshape(40, 30)
    assert grey[10:14, 8:22].mean() < grey[25:, 8:22].mean() - (5 if level == "shred" else 40)


def test_steps_of_damage():
    page = np.arange(64, dtype=np.uint8).reshape(8, 8) * 3
    assert (scans.askew(page, 0.0) == page).all() and (scans.resized(page, 8, 8) == page).all()
    assert np.abs(scans.lossy(page, 95).astype(int) - page).max() <= 4
    assert scans.otsu_level(np.array([[0, 0, 200, 200]], np.uint8)) in range(0, 200) and scans.otsu_level(np.empty((0, 1), np.uint8)) == 128
    assert (scans.show_through(np.full((2, 4), 255, np.uint8), 0.5) == 255).all()
    with pytest.raises(KeyError):
        scans.degrade(None, "unknown")


def test_pages_with_gold_and_indexes(spark, tmp_path):
    data = base64.b64encode(b"PNG").decode()
    (tmp_path / "raw_input.csv").write_text(f'id,image\n2,"data:image/png;base64,{data}"\n1,{data}\n3,{data}\n')
    (tmp_path / "gold_annotation_html").mkdir()
    for i in (1, 2):
        (tmp_path / "gold_annotation_html" / f"gold_{i}.txt").write_text(f"<p>{i}</p>\n")
    got = files.labelled_pages(spark, str(tmp_path), cap=2).collect()
    assert [(r.page_id, bytes(r.image), r.gold_html.strip()) for r in got] == [(1, b"PNG", "<p>1</p>"), (2, b"PNG", "<p>2</p>")]
    index = spark.createDataFrame([(0, "e", "f", "mixed", "3"), (1, "e", "f", "scanned", "4"), (2, "e", "g", "scanned", "x")], "line int, entity string, filename string, format string, pages string")
    docs = files.physical_documents(index, "line")
    assert {(r.rel_path, r.format, r.pages) for r in docs.collect()} == {("by_entity/e/f", "mixed", 3), ("by_entity/e/g", "scanned", 0)}
    assert [r.filename for r in files.mixed_documents(docs).collect()] == ["f"]
    assert [r.filename for r in files.mixed_documents(docs.where("format = 'scanned'"), cap=1).collect()] == ["g"]
    for name in ("b.PNG", "a.pdf", "c.doc"):
        (tmp_path / name).write_bytes(b"x")
    assert [r.name for r in files.scan_images(spark, str(tmp_path)).collect()] == ["a.pdf", "b.PNG"]


def test_facts_objects(spark, tmp_path):
    rows = spark.createDataFrame([("d", "b", "1"), ("d", "a", "2")], "doc_id string, field string, value string")
    files.write_facts_object(rows, spark.createDataFrame([("d", 2)], "doc_id string, total int"), str(tmp_path / "o"))
    r = spark.read.json(str(tmp_path / "o")).first()
    assert [f.field for f in r.facts] == ["a", "b"] and r.stp.total == 2


def test_ingest_redacts_unless_told_otherwise(make_blocks):
    blocks = make_blocks(("paragraph", "write to a@b.com"))
    assert "a@b.com" not in parse.ingest(blocks).first().text and "a@b.com" in parse.ingest(blocks, redact=False).first().text


def test_section_words_count_however_far_they_stand():
    assert pii.find("Section" + " " * 90 + "1.2.3.4", ("ip",)) == [] and pii.find("Sec. 1.2.3.4", ("ip",)) == []
    assert len(pii.find("host" + " " * 90 + "1.2.3.4", ("ip",))) == 1 and len(pii.find("1.2.3.4", ("ip",))) == 1


def test_searches_without_hits_are_filled_in_order(spark):
    items = spark.createDataFrame([(i, i, "alpha beta" if i == 3 else f"word{i}") for i in range(6)], "id int, pos int, text string")
    queries = spark.createDataFrame([(1, "alpha"), (2, "nothing at all"), (3, "")], "query_id int, query string")
    found = retrieval.top(retrieval.dense(items, queries, k=3), 3).collect()
    by = {q: [r.id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == q] for q in (1, 2, 3)}
    assert by[1] == [3, 0, 1] and by[3] == [0, 1, 2] and len(by[2]) == 3


def test_nearest_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    v = np.round(rng.standard_normal((60, 5)), 1)
    v[7], v[9] = 0, v[8]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], "id long, v array<double>")
    queries = df.where("id % 6 = 0").toDF("query_id", "q")
    norm = np.where(np.linalg.norm(v, axis=1) > 0, np.linalg.norm(v, axis=1), 1)
    score = np.round((v @ v.T) / norm[:, None] / norm[None], 9)
    got = retrieval.nearest(df, queries, 4, item_block=17, query_block=3).collect()
    for q in range(0, 60, 6):
        want = sorted(range(60), key=lambda i: (-score[q, i], i))[:4]
        assert [r.id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] == want


def test_permutations_see_a_difference(spark):
    row = lambda i, ok: (str(i), "f", ok, True, True)
    make = lambda oks: spark.createDataFrame([row(i, ok) for i, ok in enumerate(oks)], "doc_id string, field string, correct boolean, filled boolean, gold_filled boolean")
    a, b = make([True] * 40), make([i < 15 for i in range(40)])
    p = metrics.permutation_test(a, b, n_perm=60).first()
    assert p.observed_diff > 0.5 and p.p_value < 0.05
    boot = metrics.bootstrap_f1(b, n_boot=80).first()
    assert boot.lo < boot.point < boot.hi
    with pytest.raises(ValueError, match="same documents"):
        metrics.permutation_test(a, make([True] * 39))
