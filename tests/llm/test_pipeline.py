"""The pipeline over a small corpus, stage by stage against plain versions."""

import random

import corpus_pipeline
from paperloom.llm import decontam

WORDS = "the of and stone river lamp cloud paper seven north glass table green under".split()


def test_stages(spark, tmp_path):
    rng = random.Random(3)
    prose = lambda n: " ".join(rng.choice(WORDS) + rng.choice(["", "a", "en"]) for _ in range(n))
    texts, toxic = [], []
    for i in range(300):
        w = prose(60).split()
        if i % 6 == 0:
            for _ in range(3):
                w.insert(rng.randrange(60), "gruk" + rng.choice(["a", "en", "ist"]))
        texts.append(" ".join(w))
        toxic.append(int(i % 6 == 0))
    passage = prose(30)
    texts += [texts[1], texts[1] + " more", prose(20) + " " + passage + " end", 'token = "0123456789abcdef0123456789abcdef" ' + prose(20), None, ""]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    sf = str(tmp_path)
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(0, passage)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    seen, df = {}, spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = stage(spark, df, sf)
        df = spark.createDataFrame(df.toPandas(), docs.schema)
        assert df.columns == docs.columns
        seen[name] = {r.doc_id: r.text for r in df.collect()}
    gone = set(range(len(texts))) - set(seen["toxicity"])
    assert len(gone ^ {i for i, t in enumerate(toxic) if t}) <= 6
    assert {300, 301} & set(seen["ngram_join"]) == set() and 1 in seen["ngram_join"] and {304, 305} <= set(seen["ngram_join"])
    assert set(seen["ngram_join"]) - set(seen["decontamination"]) == {i for i, t in seen["ngram_join"].items() if t and decontam.normalise(passage) in decontam.normalise(t)} == {302}
    assert seen["secrets"][303].startswith("[CREDENTIAL:assign]") and set(seen["secrets"]) == set(seen["decontamination"])
    packed = corpus_pipeline.run(spark, sf)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == set(seen["secrets"])
    (tmp_path / "empty").mkdir()
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf}/{t}.parquet").where("false").write.parquet(f"{sf}/empty/{t}.parquet")
    assert corpus_pipeline.run(spark, f"{sf}/empty").count() == 0


def test_stages_on_awkward_rows(spark, tmp_path):
    """Repeated rows, ids that several texts share, rows without an id, very long texts, and columns with the stages' own names."""
    rng = random.Random(5)
    prose = lambda n: " ".join(rng.choice(WORDS) + rng.choice(["", "a", "en", "ly", "s"]) for _ in range(n))
    base, other, long = prose(60), prose(70), prose(40_000)
    rows = [(1, base), (1, base), (1, other), (2, base + " more"), (3, other + " more"), (4, long), (5, long + " end"), (None, base), (None, None), (6, None), (7, ""), (7, "")]
    plain = [(100 + i, prose(50)) for i in range(60)]
    docs = spark.createDataFrame([(i, t, "en", None, None, "mine", 1.5, "h") for i, t in rows + plain], "doc_id long, text string, lang string, source string, n_chars long, spans string, __toxicity double, __hash string")
    sf = str(tmp_path)
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in plain], "doc_id long, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(0, prose(30)), (1, None)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["ngram_join"](spark, docs, sf)
    assert kept.columns == docs.columns and {(r.spans, r["__toxicity"], r["__hash"]) for r in kept.collect()} == {("mine", 1.5, "h")}
    left = sorted(((r.doc_id, r.text) for r in kept.collect() if r.doc_id is None or r.doc_id < 100), key=repr)
    assert left == sorted([(1, base), (1, other), (4, long), (None, base), (None, None), (6, None), (7, "")], key=repr)
    for name in ("toxicity", "decontamination", "secrets"):
        out = stages[name](spark, docs, sf)
        assert out.columns == docs.columns and {(r.spans, r["__toxicity"], r["__hash"]) for r in out.collect()} == {("mine", 1.5, "h")}
        assert sum(r.doc_id is None for r in out.collect()) == 2
    packed = stages["packing"](spark, docs, sf)
    assert packed.where("doc_id is null and piece = 0").count() == 2 and packed.where("doc_id = 1 and piece = 0").count() == 3 and packed.where("doc_id = 4").count() > 5
