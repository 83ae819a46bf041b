import pytest
from pyspark.sql import functions as F

from paperloom.functions import legal as L
from paperloom.operators import definitions, extract, metrics, pii, verify, verticals
from paperloom.sources import files


def one(spark, fn, *values):
    return [r.v for r in spark.createDataFrame([(v,) for v in values], "t string").select(fn(F.col("t")).alias("v")).collect()]


def test_legal_columns(spark):
    assert one(spark, L.party_entities, "by and between Acme, Inc. and Beta Systems LLC, a Delaware limited liability company") == [["Acme, Inc", "Beta Systems LLC"]]
    assert one(spark, L.jurisdiction_in, "State of West Virginia", "nowhere") == ["West Virginia", ""]
    assert one(spark, L.canonical_date, "the 6th day of January, 2012", "April 6th , 2005", "6 January 2012", "5/12/09", "2001-2-3", "none", "12/31/1999") == ["2012-01-06", "2005-04-06", "2012-01-06", "2009-05-12", "2001-02-03", "", "1999-12-31"]
    assert one(spark, L.duration_in, "two (2) years", "three years", "thirty-one years", "none") == ["2 years", "3 years", "", ""]
    assert one(spark, L.days_in, "ninety (90) days", "(30)", "no") == ["90", "30", ""]
    assert one(spark, L.money_digits, "$1,250,000.00") == ["1250000"]


def test_gold_normalisers(spark):
    g = files.gold_frame(spark, [("d", "governing_law", "['laws of the State of New York']"), ("d", "counterparty", "['Acme Inc.', 'MA', 'Acme Inc.']"), ("d", "termination_notice_days", "ninety (90) days"), ("d", "auto_renewal", "['Renews once.']"), ("d", "effective_date", "")])
    got = {r.field: r.value for r in extract.CONTRACT.normalize_gold(g).collect()}
    assert got == {"governing_law": "New York", "counterparty": "Acme Inc", "termination_notice_days": "90", "auto_renewal": "no", "effective_date": ""}


def test_nda_preamble_and_letter_date(make_blocks):
    facts = {r.field: r for r in extract.nda_facts(make_blocks(("paragraph", "December 11, 2014"), ("paragraph", "Agreement between Acme Inc. and Beta LLC about things."))).collect()}
    assert facts["disclosing_party"].value == "Acme Inc" and facts["disclosing_party"].confidence == 0.5
    assert facts["receiving_party"].value == "Beta LLC"
    assert facts["effective_date"].value == "December 11, 2014" and facts["effective_date"].confidence == 0.4
    assert facts["term"].value == "" and facts["term"].source_block_id is None


def facts_frame(spark, *rows):
    return spark.createDataFrame([("d", *r) for r in rows], "doc_id string, field string, value string, source_block_id string, confidence double")


def test_verify_and_reattribute(spark, make_blocks):
    blocks = make_blocks(("paragraph", "nothing"), ("paragraph", "laws of Texas"), ("paragraph", "Acme Inc. signs"))
    facts = facts_frame(spark, ("governing_law", "Texas", "b0", 0.7), ("counterparty", "Acme Inc; Ghost LLC", "b2", 0.7), ("total_value", "$5", "b0", 0.4), ("auto_renewal", "yes", "b0", 0.7), ("effective_date", "", None, 0.0))
    checks = {r.field: r for r in verify.verify(facts, blocks, extract.CONTRACT).collect()}
    assert checks["governing_law"].reasons == ["unattributed"]
    assert checks["counterparty"].reasons == ["unattributed"]
    assert checks["total_value"].reasons == ["unattributed", "low_confidence"]
    assert checks["auto_renewal"].passed and checks["effective_date"].reasons == ["empty"]
    moved = {r.field: r for r in verify.reattribute(facts, blocks, extract.CONTRACT).collect()}
    assert moved["governing_law"].source_block_id == "b1" and moved["governing_law"].repaired
    assert moved["counterparty"].source_block_id == "b2" and not moved["counterparty"].repaired


def test_metrics_leave_out_fields_without_gold(spark, make_blocks):
    blocks = make_blocks(("paragraph", "Acme Inc. under the laws of Texas on May 1, 2020"))
    facts = facts_frame(spark, ("counterparty", "Acme Inc", "b0", 0.7), ("governing_law", "", None, 0.0), ("total_value", "$9", "b0", 0.4))
    gold = files.gold_frame(spark, [("d", "counterparty", "Acme, Inc; Beta LLC"), ("d", "governing_law", "Texas")])
    rows = metrics.score_rows(facts, gold, blocks, extract.CONTRACT)
    labels = {r.field: r.label for r in rows.collect()}
    assert labels["counterparty"] == "invention" or labels["counterparty"] == "correct"
    assert labels["governing_law"] == "omission" and labels["total_value"] == "unscored" and labels["effective_date"] is None
    whole = metrics.summarize(rows).where("tier is null").first()
    assert whole.predicted == 1 and whole.gold == 2


def test_bootstrap_is_seeded(spark, make_blocks):
    rows = spark.createDataFrame([(str(i), "f", i % 3 > 0, True, True, True) for i in range(12)], "doc_id string, field string, correct boolean, source_ok boolean, filled boolean, gold_filled boolean")
    a, b, c = (metrics.bootstrap_f1(rows, n_boot=50, seed=s).first() for s in (1, 1, 2))
    assert a == b and a.lo <= a.point <= a.hi and a.point == pytest.approx(8 / 12)
    p = metrics.permutation_test(rows, rows, n_perm=20).first()
    assert p.observed_diff == 0 and p.p_value == 1.0


def test_stratified(spark):
    items = spark.createDataFrame([(i, "a" if i < 8 else "b") for i in range(10)], "id int, s string")
    assert {r.s: r.quota for r in metrics.stratified_quotas(items, "s", 5).collect()} == {"a": 4, "b": 1}
    assert metrics.stratified_sample(items, "s", "id", 5).count() == 5


def test_pii(spark):
    texts = ["write to jane@acme.com now", "host 192.168.100.200 555-0199 end", "from alice@x.com to 123-45-6789", "Section 1.2.3.4 and 300.1.1.1 and 1.2.3.4.5", "", None]
    rows = pii.with_pii(spark.createDataFrame(list(enumerate(texts)), "i int, text string")).orderBy("i").collect()
    assert [r.redacted for r in rows] == ["write to [REDACTED:EMAIL] now", "host [REDACTED:IP] end", "from [REDACTED:EMAIL] to [REDACTED:SSN]", texts[3], "", None]
    assert [len(r.pii) for r in rows] == [1, 2, 2, 0, 0, 0]
    assert pii.mask("abcdef", [(0, 3, "ip"), (2, 5, "phone"), (5, 6, "email")]) == "[REDACTED:IP][REDACTED:EMAIL]"


def test_definitions(make_blocks):
    blocks = make_blocks(("paragraph", '"Fee" means ten dollars. “Party” refers to each signer. Then more.'), ("heading", "Definitions"), ("paragraph", "Net Sales: gross less returns"))
    got = [(r.term, r.definition, r.block_id) for r in definitions.extract_definitions(blocks).orderBy("ord").collect()]
    assert got == [("Fee", "means ten dollars.", "b0"), ("Party", "refers to each signer.", "b0"), ("Net Sales", "gross less returns", "b2")]


def test_usage_plural(spark):
    rows = spark.createDataFrame([("both Parties agree", "Party"), ("a party agrees", "Party"), ("the Fee's size", "Fee")], "x string, t string")
    assert [r.u for r in rows.select(definitions.term_used(F.col("x"), F.col("t")).alias("u")).collect()] == [True, False, True]


def test_registry():
    assert verticals.get("nda").name == "nda" and verticals.get().name == "contract"
    with pytest.raises(KeyError):
        verticals.get("none")


def test_amounts_are_not_found_in_years_or_names(spark, make_blocks):
    blocks = make_blocks(("paragraph", "effective as of April 1, 1998"), ("paragraph", "Customer 1998 Inc"), ("paragraph", "fees are $1998."), ("paragraph", "again $1998."))
    facts = facts_frame(spark, ("total_value", "$1998", "b0", 0.4), ("effective_date", "April 1, 1998", "b0", 0.65))
    moved = {r.field: (r.source_block_id, r.repaired) for r in verify.reattribute(facts, blocks, extract.CONTRACT).collect()}
    assert moved == {"total_value": ("b2", True), "effective_date": ("b0", False)}
    held = {r.source_block_id: r.repaired for r in verify.reattribute(facts_frame(spark, ("total_value", "$1998", "b3", 0.4)), blocks, extract.CONTRACT).collect()}
    assert held == {"b3": False}
    bare = make_blocks(("paragraph", "fees are 1998"), ("paragraph", "Customer 1998 Inc"))
    assert not verify.reattribute(facts_frame(spark, ("total_value", "$1998", "b0", 0.4)), bare, extract.CONTRACT).first().repaired


def test_pii_counts_count_quads_after_section_words(spark, tmp_path):
    from paperloom.plans.queries import QUERIES

    spark.createDataFrame([(1, "la no. 85.100.119.253 Ja"), (2, "no. 385.1.1.1")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert {r.doc_id: r.n_ip for r in QUERIES["pii_counts"](spark, str(tmp_path)).collect()} == {1: 1, 2: 0}
    assert pii.find("la no. 85.100.119.253 Ja", ("ip",)) == []


def test_pii_counts_are_those_of_the_sql(spark, tmp_path):
    import duckdb

    from paperloom.plans.queries import ORACLE, QUERIES

    texts = [
        "1.2.3.4 5.6.7.8", "1.2.3.4,5.6.7.8,9.9.9.9", "1.2.3.4  5.6.7.8", "300.1.1.1 2.2.2.2", "1.2.3.4\n", "1.2.3.4.5", "٣٣.2.3.4 x", "555-123-4567é", "555-123-4567_", "555-123-4567\n",
        "٥٥٥-123-4567", "555\u00a0123\u00a04567", "555\x0b123\x0b4567", "+1 (555) 123-4567 555.123.4567", "5551234567(555)1234567", "a@b.co,c@d.eux@e.fr", "",
    ]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    got = {tuple(r) for r in QUERIES["pii_counts"](spark, str(tmp_path)).collect()}
    assert got == set(con.execute(ORACLE["pii_counts"]).fetchall()) and (0, 0, 1, 0) in got and (7, 0, 0, 1) in got


def test_kleister_reads_the_blocks_once(spark, make_blocks):
    blocks = make_blocks(("paragraph", 'entered into by and between Acme Inc. ("Disclosing Party") and Beta LLC ("Receiving Party").'), ("paragraph", "effective as of May 1, 2020."))
    out = extract.kleister_facts(blocks)
    got = {r.field: (r.value, r.source_block_id, r.confidence) for r in out.collect()}
    assert got == {"party": ("Acme Inc; Beta LLC", "b0", 0.7), "effective_date": ("May 1, 2020", "b1", 0.65), "term": ("", None, 0.0), "governing_law": ("", None, 0.0)}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 1
