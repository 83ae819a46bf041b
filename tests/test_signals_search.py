import pytest
from pyspark.sql import functions as F

from paperloom.model import TRACES
from paperloom.operators import agent, observe, parse, report, retrieval, security, signals, versioning
from paperloom.sources import files


def docs(spark, *texts):
    return spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "id int, pos int, text string")


def ask(spark, *queries):
    return spark.createDataFrame(list(enumerate(queries)), "query_id int, query string")


def test_search(spark):
    items = docs(spark, "governing law of the State of New York", "payment of fees", "terminate the agreement on notice")
    top = retrieval.top(retrieval.bm25(items, ask(spark, "governing law New York", "zzzzz qqqqq")), 3).collect()
    assert [(r.query_id, r.id) for r in top if r["rank"] == 0] == [(0, 0)] and all(r.query_id == 0 for r in top)
    norms = retrieval.hashed_vectors(items).groupBy("id").agg(F.sum(F.col("w") * F.col("w")).alias("n")).collect()
    assert all(r.n == pytest.approx(1) for r in norms)
    best = retrieval.hybrid_search(items, ask(spark, "terminate the agreement on notice"), 1).first()
    assert best.id == 2
    tagged = items.withColumn("tags", F.array(F.when(F.col("id") == 1, "finance").otherwise("general")))
    found = retrieval.hybrid_search(tagged, ask(spark, "governing law payment"), 5, tags="tags", allowed=["finance"]).collect()
    assert [r.id for r in found] == [1]
    assert retrieval.hybrid_search(tagged, ask(spark, "governing law"), 5, tags="tags", allowed=[]).count() == 0


def test_leaks_and_gate(spark):
    rows = spark.createDataFrame([(["restricted"], ["general"]), (["general"], ["general"])], "permission_tags array<string>, allowed array<string>")
    assert security.leak_rate(rows).first().leaks == 1
    with pytest.raises(Exception, match="leak"):
        security.guarded(rows).collect()
    for ok in ("http://127.0.0.1:1/v1", "http://box.internal/v1"):
        security.assert_backend_allowed("local", ok)
    for name, url in (("local", "http://example.com"), ("local", None), ("openai", None)):
        with pytest.raises(PermissionError):
            security.assert_backend_allowed(name, url)


def test_traces(spark):
    span = lambda n, d, s="ok", tok=500, c=0.0025: (n, float(d), s, None, tok, c)
    rows = [("1", "d", [span("parse", 10), span("extract", 5)]), ("2", "d", [span("parse", 20), span("extract", 5, "error")]), ("3", "d", [span("parse", 30), span("extract", 5)])]
    t = spark.createDataFrame(rows, TRACES)
    m = observe.trace_metrics(t).first()
    assert m.error_rate == pytest.approx(1 / 3) and m.cost_per_request == pytest.approx(0.005) and m.total_tokens == 3000
    assert {r.name: r.p50_ms for r in observe.stage_metrics(observe.spans(t)).collect()}["parse"] == 20.0
    assert not {r.metric: r.ok for r in observe.check_slo(t).collect()}["error_rate"]
    assert all(r.ok for r in observe.check_slo(t.where("false"), end_to_end=True).collect())


def test_fact_text(spark):
    rows = spark.createDataFrame([("$1,200.50",), ("(5%) -3 to 4-5",), ("AT&amp;T",)], "t string").select(signals.canon_fact(F.col("t")).alias("c")).collect()
    assert [r.c for r in rows] == ["1200.50", "5% -3 to 4 5", "at t"]


def test_fact_survival(spark, make_blocks):
    page = spark.createDataFrame([("d", "Net revenue rose to <number>1,200</number> million while margin was <number>77%</number> this year")], "doc_id string, text string")
    facts = signals.gold_facts(page)
    got = {r.n: r for r in signals.fact_outcomes(facts, make_blocks(("paragraph", "net revenue rose to $1200"), ("paragraph", "margin was low this year"))).collect()}
    assert got[0].in_document and got[0].located and not got[1].in_document and got[1].located


def test_crosscheck(make_blocks):
    row = signals.crosscheck(make_blocks(("paragraph", "total 1,200")), make_blocks(("paragraph", "total $1200 and 77%"))).first()
    assert row.missing_tokens == ["77%"] and row.flagged


def test_geometry(spark, make_blocks):
    blocks = make_blocks({"type": "paragraph", "text": "x", "bbox": (1, 0.0, 0.0, 10.0, 5.0)}, {"type": "paragraph", "text": "y", "bbox": (1, 5.0, 0.0, 10.0, 10.0)})
    region = spark.createDataFrame([("d", 1, "r", 0.0, 0.0, 10.0, 10.0), ("d", 1, "e", 50.0, 50.0, 60.0, 60.0)], "doc_id string, page int, region_id string, x0 double, y0 double, x1 double, y1 double")
    fill = {r.region_id: r.fill for r in signals.region_fill(region, blocks).collect()}
    assert fill == {"r": 0.75, "e": 0.0}
    assert signals.layout_omission(signals.region_fill(region, blocks)).first().layout_omission_score == 0.5


def test_signature(make_blocks):
    sign = lambda *b: signals.detect_signatures(make_blocks(*b)).first()
    assert sign(("paragraph", "Sincerely,")).confidence == pytest.approx(0.9)
    assert sign(("paragraph", "hello")).confidence == 0.2
    band = sign({"type": "paragraph", "text": "R. M. Neel", "bbox": (1, 100.0, 900.0, 300.0, 1000.0)}, {"type": "paragraph", "text": "~", "bbox": (1, 120.0, 800.0, 200.0, 850.0), "confidence": 0.5})
    assert band.signed and band.sigblock


def test_markdown(spark):
    md = "# Title\nintro a\nintro b\n\n## Part\n- item\n| a | b |\n| 1 | 2 |\n### Deep\ntext\n## Next\nend"
    rows = parse.markdown_blocks(spark.createDataFrame([("d", md)], "doc_id string, text string")).orderBy("pos").collect()
    assert [(r.type, r.text) for r in rows] == [("title", "Title"), ("paragraph", "intro a intro b"), ("heading", "Part"), ("list_item", "item"), ("table", "| a | b |\n| 1 | 2 |"), ("heading", "Deep"), ("paragraph", "text"), ("heading", "Next"), ("paragraph", "end")]
    assert [r.parent_id for r in rows] == [None, "#/vlm/0", "#/vlm/0", "#/vlm/2", "#/vlm/2", "#/vlm/2", "#/vlm/5", "#/vlm/0", "#/vlm/7"]


def test_segments_and_merge(spark, make_blocks):
    pages = spark.createDataFrame([("d", p, t) for p, t in enumerate(["text", "", "", "more"], 1)], "doc_id string, page int, text string")
    seg = parse.segments(parse.page_routes(parse.probe_pages(pages))).orderBy("segment").collect()
    assert [(s.engine, s.pages) for s in seg] == [("docling", [1]), ("paddleocr", [2, 3]), ("docling", [4])]
    blocks = make_blocks({"type": "paragraph", "text": "x", "block_id": "##/a", "bbox": (2, 0.0, 0.0, 1.0, 1.0)}).withColumn("segment", F.lit(1).cast("bigint"))
    row = parse.merge_segments(blocks, parse.segments(parse.page_routes(parse.probe_pages(pages)))).first()
    assert row.block_id == "#s1:/a" and row.bbox.page == 3


def test_exports_and_versions(spark, tmp_path):
    rows = spark.createDataFrame([("=1+1",), ("safe",)], "v string").select(report.csv_safe(F.col("v")).alias("v")).collect()
    assert [r.v for r in rows] == ["'=1+1", "safe"]
    g = files.gold_frame(spark, [("a", "f", "1"), ("b", "f", "2")])
    assert versioning.version_id(g).first().version == versioning.version_id(g.orderBy(F.desc("doc_id"))).first().version
    with pytest.raises(ValueError):
        report.facts_rows(g, g, "nowhere")


def test_sources(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text("one\n\n two \n\n\n")
    (tmp_path / "in/b.md").write_text("no")
    assert [r.name for r in files.list_documents(spark, str(tmp_path / "in")).collect()] == ["a.txt"]
    assert [(r.doc_id, r.pos, r.text) for r in files.text_blocks(spark, str(tmp_path / "in")).orderBy("pos").collect()] == [("a", 0, "one"), ("a", 1, "two")]
    import lzma

    (tmp_path / "in.tsv.xz").write_bytes(lzma.compress(b"x.pdf\trest\ny.pdf\trest\n"))
    (tmp_path / "expected.tsv").write_text("party=Acme_Inc. party=Bob term=2_years\njurisdiction=New_York\n")
    got = {(r.doc_id, r.field): r.value for r in files.expected_facts(files.zipped_lines(spark, str(tmp_path / "in.tsv.xz"), str(tmp_path / "expected.tsv"))).collect()}
    assert got["x.pdf", "party"] == "Acme Inc.; Bob" and got["y.pdf", "governing_law"] == "New York" and got["y.pdf", "term"] == ""
    assert files.resolve_columns(["Document Name", "Parties"], {"doc_id": "document name", "counterparty": "part"}) == {"doc_id": "Document Name", "counterparty": "Parties"}
    with pytest.raises(KeyError):
        files.resolve_columns(["a"], {"x": "zz"})


def test_search_keeps_the_best_in_place(spark, monkeypatch):
    rows = [(i, i, None if i == 7 else " ".join(f"w{(i * j) % 13}" for j in range(1, i % 9 + 1))) for i in range(60)]
    items = spark.createDataFrame(rows, "id long, pos long, text string").repartition(5)
    queries = spark.createDataFrame([(0, "w1 w2 w2"), (1, "w5 nowhere"), (2, "nowhere"), (3, None)], "query_id long, query string")
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", 3)
    monkeypatch.setattr(retrieval, "CHUNK", 4)
    got = lambda df: [(r.query_id, r.id, r["rank"], round(r.score, 9)) for r in retrieval.top(df, 6).orderBy("query_id", "rank").collect()]
    assert got(retrieval.bm25(items, queries, k=6)) == got(retrieval.bm25(items, queries))
    scoped = retrieval.dense(items.withColumn("s", F.lit(1)), queries.withColumn("s", F.lit(1)), scope=("s",), k=6)
    best = retrieval.dense(items, queries, k=6)
    assert got(best) == got(scoped) and len(got(best)) == 24
    assert "Exchange hashpartitioning" not in best._jdf.queryExecution().executedPlan().toString()


def test_search_within_scopes_shuffles_no_terms(spark):
    rows = [(s, f"{s}-{i}", None if i == 5 else i, None if i == 7 else " ".join(f"W{(i * j + s) % 11}" for j in range(1, i % 9 + 1)), ["x"] if i % 3 else None) for s in range(3) for i in range(30)]
    items = spark.createDataFrame(rows, "s int, id string, pos int, text string, tags array<string>")
    asked = [(0, 0, "w1 w2 w2"), (0, 1, "w5 nowhere"), (1, 2, "nowhere"), (1, 3, None), (2, 4, "w3 w4"), (9, 5, "w1")]
    queries = spark.createDataFrame(asked, "s int, query_id int, query string")
    got = lambda df: sorted((r.s, r.query_id, r["rank"], r.id, round(r.score, 9)) for r in df.collect())
    found = retrieval.hybrid_search(items, queries, 25, scope=("s",))
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 2  # the items and the queries
    by_joins = retrieval.fuse(retrieval.bm25(items, queries, scope=("s",)), retrieval.dense(items, queries, scope=("s",)), ("s",))
    assert got(found) == got(by_joins.where("rank < 25")) and len(got(found)) >= 5 * 20
    for more in ({"tags": "tags", "allowed": ["x"]}, {"rerank": True}):
        each = [retrieval.hybrid_search(items.where(F.col("s") == s), queries.where(F.col("s") == s), 4, **more).withColumn("s", F.lit(s)) for s in range(3)]
        assert got(retrieval.hybrid_search(items, queries, 4, scope=("s",), **more)) == sorted(x for e in each for x in got(e))


def test_tasks_meet_their_document_where_it_is(spark):
    chunks = spark.createDataFrame([(d, f"{d}#c{n}", n, t, ["legal"]) for d in "ab" for n, t in enumerate(["laws of Texas", "fees of $5"])], "doc_id string, chunk_id string, n int, text string, permission_tags array<string>")
    facts = spark.createDataFrame([("a", "governing_law", "Texas", 0.7), ("a", "total_value", "$5", 0.4), ("a", "total_value", "$6", 0.9)], "doc_id string, field string, value string, confidence double")
    tasks = spark.createDataFrame([("1", "a", "Which governing law?"), ("2", "a", "What amount?"), ("3", "b", "Which governing law?"), ("4", "none", "Hello?")], "task_id string, doc_id string, question string")
    chunks, facts, tasks = (df.repartition(4, "doc_id") for df in (chunks, facts, tasks))
    runs = agent.run_tasks(tasks, chunks, facts)
    plan = runs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == plan.count("REPARTITION_BY_NUM") == 3
    assert sorted((r.task_id, r.answer, r.reason, len(r.citations or ())) for r in runs.collect()) == [
        ("1", "Texas", None, 2), ("2", "$5", "low_confidence", 2), ("2", "$6", "unattributed", 2), ("3", "", "empty", 2), ("4", "", "empty", 0),
    ]
