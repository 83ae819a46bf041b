"""Every operator against a brute-force version or a round trip, and on awkward rows."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from paperloom.llm import chat, common, decontam, embed_dedup, graph, lmscore, ngram_join, packed, packing, queries, secrets, toxicity, url_filter, warc

DOCS = "doc_id long, text string, lang string, spans string, score double"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
WORDS = "the of and stone river lamp cloud paper seven north glass table green under".split()


def frame(spark, texts, ids=None):
    """Documents with further columns whose names clash with operators' own."""
    return spark.createDataFrame([(i if ids is None else ids[i], t, "en", "own", 1.0) for i, t in enumerate(texts)], DOCS)


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "a", "en", "ly"]) for _ in range(n))


AWKWARD = [None, "", " \n\t ", "one", "one two three", "one two three", "x " * 3000, "ünï çødé ﬁ \x1c \x85 𝔘 end", "A" * 20000]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def reach(nodes, links):
    name = {n: n for n in nodes}
    again = True
    while again:
        again = False
        for a, b in links:
            low = min(name[a], name[b])
            again |= name[a] != low or name[b] != low
            name[a] = name[b] = low
    return name


# ---- 1


def brute_join(texts):
    sets = []
    for t in texts:
        w = words(t)
        sets.append({tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    name = reach(range(len(texts)), links)
    return [(i, len(s), name[i]) for i, s in enumerate(sets)]


@pytest.mark.parametrize("block, flush", [(1 << 18, 1_000_000), (150, 40)])
def test_join_equals_brute_force(spark, monkeypatch, block, flush):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "FLUSH", flush)
    rng = random.Random(5)
    passage = prose(rng, 40)
    texts = list(AWKWARD)
    for _ in range(6):
        base = prose(rng, rng.choice([8, 30, 120])).split()
        texts.append(" ".join(base))
        for _ in range(rng.randrange(12)):
            copy = list(base)
            for _ in range(rng.randrange(1, 5)):
                copy[rng.randrange(len(copy))] = "edit%d" % rng.randrange(99)
            texts.append(" ".join(copy))
    texts += [passage + " " + prose(rng, 30) for _ in range(25)] + [texts[-1]] * 3
    base = prose(rng, 60).split()  # one large group, in many blocks
    for i in range(60):
        copy = list(base[: rng.randrange(45, 61)])
        for _ in range(rng.randrange(4)):
            copy[rng.randrange(len(copy))] = f"e{i}x{rng.randrange(9)}"
        texts.append(" ".join(copy))
    got = sorted(tuple(r) for r in ngram_join.link_documents(frame(spark, texts)).collect())
    assert got == brute_join(texts)


@pytest.mark.parametrize("turned", [False, True])
def test_join_of_rows_that_share_an_id(spark, turned):
    a, b = ([f"{x}{i}" for i in range(40)] for x in "ab")
    rows = [(1, a), (1, b), (2, [*a, "end"]), (3, [*b, "end"]), (2, ["other", *b[:20]]), (1, a)]
    rows = [(i, " ".join(t)) for i, t in rows]
    docs = spark.createDataFrame([(i, t, "x", "y", 1.0) for i, t in (rows[::-1] if turned else rows)], DOCS)
    got = Counter(tuple(r) for r in ngram_join.link_documents(docs).collect())
    assert got == Counter({(1, 36, 1): 3, (2, 37, 1): 1, (3, 37, 1): 1, (2, 17, 2): 1})
    kept = sorted((r.doc_id, r.text) for r in ngram_join.one_per_group(docs).collect())
    assert kept == sorted([rows[0], rows[1], rows[4]])


def test_credits_survive_batch_borders():
    rng = random.Random(2)
    rows = sorted({(rng.randrange(12), rng.randrange(4)) for _ in range(30)}) + [(20, 1), (21, 1), (21, 1), (22, 3)]
    sizes = Counter(k for k, _ in set(rows))
    want = Counter(n for k, n in set(rows) if sizes[k] > 1) + Counter({7: 5, 2: 1})
    for cut in (1, 2, 3, 100):
        frames = [ngram_join.pd.DataFrame({"key": [30, 31, 31], "name": [7, 2, 5], "credit": [5, 0, -1]})]
        frames = [ngram_join.pd.DataFrame({"key": [k for k, _ in part], "name": [n for _, n in part], "credit": 0}) for part in (rows[i : i + cut] for i in range(0, len(rows), cut))] + frames
        got = Counter()
        for out in ngram_join.credits_of(iter(frames)):
            for n, c in zip(out.name, out.credit):
                got[n] += c
        assert got == want


def test_join_of_chains_and_empty_table(spark):
    base = [f"w{i}" for i in range(60)]
    texts = [" ".join(base[k : k + 40]) for k in range(0, 20, 2)]
    assert sorted(tuple(r) for r in ngram_join.link_documents(frame(spark, texts)).collect()) == brute_join(texts)
    assert ngram_join.link_documents(frame(spark, [])).count() == 0
    assert ngram_join.link_documents(frame(spark, ["a b c"], [None])).first().component_id is None


def test_bitmap_bound_never_excludes_a_link():
    rng = np.random.default_rng(2)
    for width in (64, 256, 1024):
        for _ in range(70):
            a = np.unique(rng.integers(-(1 << 63), 1 << 63, rng.integers(1, 400)))
            b = np.unique(np.concatenate([rng.permutation(a)[: int(len(a) * rng.uniform(0.6, 1))], rng.integers(-(1 << 63), 1 << 63, rng.integers(0, 40))]))
            p, q = ngram_join.bitmaps(np.concatenate([a, b]), np.repeat([0, 1], [len(a), len(b)]), 2, width)
            bound, both = np.bitwise_count(p ^ q).sum(dtype=np.int64), len(np.intersect1d(a, b))
            assert bound <= len(np.setxor1d(a, b))
            assert ngram_join.may_link(bound, len(a), len(b), 75) or 100 * both < 75 * (len(a) + len(b) - both)


def test_components_of_a_path(spark):
    rng = random.Random(1)
    order = rng.sample(range(300), 300)
    edges = spark.createDataFrame(list(zip(order, order[1:])), "a long, b long")
    assert {r.component for r in graph.components(edges).collect()} == {0}


def test_word_hashes_know_words():
    texts = ["The the THE tHe", "ab ba ab", "", None, "x\x0by\x0cz"]
    hashes, counts = common.hash_words(texts)
    assert counts.tolist() == [4, 3, 0, 0, 3]
    assert len(set(hashes[:4].tolist())) == 1 and hashes[4] == hashes[6] != hashes[5]
    assert [h.tolist() for h in common.batched_words(texts, 3)] == [h.tolist() for h in common.batched_words(texts)]


# ---- 2


def test_tokens_equal_the_library():
    whole, mine = Tokenizer.from_file(VOCABULARY), packing.ChunkTokenizer(VOCABULARY)
    for t in [*AWKWARD, "Don't I'LL <|endoftext|> a<|startoftext|>b ½ 12³ Σίσυφος ΌΣ é'"]:
        ids = whole.encode(t or "", add_special_tokens=False).ids
        assert mine.ids(t) == np.array(ids, "<u4").tobytes(), t


def test_packing_holds_every_token_once(spark):
    rng = random.Random(0)
    texts = [*AWKWARD, *[prose(rng, rng.choice([3, 50, 700, 3000])) for _ in range(60)]]
    rows = packing.pack(frame(spark, texts), VOCABULARY).toPandas()
    whole = Tokenizer.from_file(VOCABULARY)
    for i, t in enumerate(texts):
        ids = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        mine = rows[rows.doc_id == i].sort_values("piece")
        assert mine.length.sum() == len(ids) and mine.start.tolist() == list(range(0, len(ids), 4096))
        assert mine.ids_crc32.tolist() == [zlib.crc32(ids[s : s + 4096].tobytes()) for s in mine.start]
    for _, group in rows.sort_values("offset").groupby("sequence_id"):
        ends = (group.offset + group.length).tolist()
        assert group.offset.tolist() == [0, *ends[:-1]] and ends[-1] <= 4096
    assert rows.sequence_id.nunique() <= -(-rows.length.sum() // 4096) + 1
    assert packing.pack(frame(spark, []), VOCABULARY).count() == 0


def test_plan_is_close_to_the_bound():
    rng = random.Random(3)
    lengths = Counter(min(4096, int(rng.lognormvariate(6, 1))) or 1 for _ in range(30000))
    made = Counter()
    for pattern, n in (plan := packing.plan(lengths)):
        assert sum(pattern) <= 4096
        made.update({k: m * n for k, m in Counter(pattern).items()})
    assert made == lengths
    assert sum(n for _, n in plan) <= 1.002 * sum(k * v for k, v in lengths.items()) / 4096 + 1


@pytest.mark.parametrize("share, fewest", [(1, 3600), (8, 450)])
def test_plan_keeps_fillings_that_leave_room(share, fewest):
    lengths = {2080: 2400 // share, 1124: 2400 // share, 1069: 2400 // share, 894: 4800 // share}  # no filling exceeds 4043
    made = Counter()
    for pattern, n in (plan := packing.plan(lengths)):
        assert sum(pattern) <= 4096
        made.update({k: m * n for k, m in Counter(pattern).items()})
    assert made == lengths and sum(n for _, n in packing.best_fit(lengths, 4096)) > 1.2 * fewest
    assert sum(n for _, n in plan) <= 1.03 * fewest


@pytest.mark.parametrize("lengths, fewest, by_best_fit", [
    ({1366: 3000, 1365: 3000, 1400: 2000, 1300: 2000, 2049: 500, 2047: 500}, 3880, 4167),
    (dict.fromkeys([700, 811, 902, 1033, 1207, 1333, 1511, 1808, 2111, 2405], 2000), 6950, 7100),
])
def test_program_beats_best_fit(lengths, fewest, by_best_fit):
    made, bound = packing.by_program(lengths, 4096, 100_000)
    count = Counter()
    for pattern, n in made:
        assert sum(pattern) <= 4096
        count.update({k: m * n for k, m in Counter(pattern).items()})
    assert count == lengths
    assert bound <= sum(n for _, n in made) <= fewest < by_best_fit <= sum(n for _, n in packing.best_fit(lengths, 4096))
    assert packing.plan(lengths) == made


def test_program_places_many_lengths(monkeypatch):
    rng = random.Random(7)
    lengths = Counter(min(4096, int(rng.lognormvariate(6, 1))) or 1 for _ in range(30000))
    assert len(lengths) > 2500
    plain, fewest = packing.best_fit, sum(n for _, n in packing.best_fit(lengths, 4096))
    rests = []
    monkeypatch.setattr(packing, "best_fit", lambda left, capacity: rests.append(sum(k * v for k, v in left.items())) or plain(left, capacity))
    made, bound = packing.by_program(lengths, 4096, 100_000)
    count = Counter()
    for pattern, n in made:
        assert sum(pattern) <= 4096
        count.update({k: m * n for k, m in Counter(pattern).items()})
    assert count == lengths and bound <= sum(n for _, n in made) <= fewest
    assert rests[-1] <= 0.05 * sum(k * v for k, v in lengths.items())  # what best fit packs
    assert packing.plan(lengths) == made


def fewest_sequences(lengths, capacity):
    """By trying, for each piece in turn, every open sequence and a new one."""
    best = len(lengths)

    def put(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for k in {r: k for k, r in enumerate(rooms) if r >= lengths[i]}.values():
            put(i + 1, rooms[:k] + [rooms[k] - lengths[i]] + rooms[k + 1 :])
        put(i + 1, [*rooms, capacity - lengths[i]])

    put(0, [])
    return best


def test_plan_is_the_fewest_on_small_histograms():
    rng = random.Random(12)
    over = 0
    for _ in range(60):
        lengths = sorted((rng.randrange(3, 30) for _ in range(rng.randrange(1, 10))), reverse=True)
        made, bound = packing.by_program(Counter(lengths), 40, 20_000)
        fewest = fewest_sequences(lengths, 40)
        assert math.ceil(bound - 1e-9) <= fewest
        got = sum(n for _, n in packing.plan(Counter(lengths), 40))
        assert fewest <= got <= fewest + 1
        over += got - fewest
    assert over <= 3


def test_knapsack_keeps_counts():
    rng = random.Random(13)
    for _ in range(100):
        lengths = rng.sample(range(1, 20), rng.randrange(1, 5))
        counts = [rng.randrange(1, 5) for _ in lengths]
        prices = np.array([rng.random() for _ in lengths])
        fill, price = packing.Knapsack(lengths, counts, 30).dearest(prices)
        assert all(fill[k] <= counts[k] for k in fill) and sum(lengths[k] * m for k, m in fill.items()) <= 30
        options = [0.0]
        for many in itertools.product(*(range(c + 1) for c in counts)):
            if sum(m * x for m, x in zip(many, lengths)) <= 30:
                options.append(float(np.dot(many, prices)))
        assert math.isclose(price, max(options)) and math.isclose(price, sum(prices[k] * m for k, m in fill.items()), abs_tol=1e-12)


# ---- 3


def test_urls_equal_sql_and_edges(spark):
    urls = ["http://www.Example.com/en/x", "https://a.example.com/en/", "http://example.com/en", "http://x.net/es/?q", "http://com/", "http://net", "nourl", None, "", "http://b.xexample.com/en/1#f", "ftp://q.net/fr/#a://b", "http://x.net/es/", "http://x.net/es/"]
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    got = url_filter.filter_urls(pages, url_filter.parse_rules(queries.RULES)).drop("url").toPandas().sort_values("page_id")
    con = duckdb.connect()
    con.register("pages", pages.toPandas())
    want = con.sql(queries.OP3_SQL).df().sort_values("page_id")
    for c in ("page_id", "host", "path", "rule", "verdict"):
        assert [None if x != x else x for x in got[c].tolist()] == [None if x != x else x for x in want[c].tolist()], c


def test_cascade_is_exact_over_its_universe(spark):
    keys = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = keys.where("substr(key, 2) % 97 = 0")
    cascade = url_filter.build_cascade(common.materialize(listed, "l"), common.materialize(keys, "u"))
    wrong = keys.where(cascade.contains(F.col("key")) != (F.expr("substr(key, 2) % 97 = 0")))
    assert wrong.count() == 0 and len(cascade.levels) >= 2
    assert not url_filter.build_cascade(listed.where("false"), keys).levels


# ---- 4


def brute_spans(t):
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    a = [(m.start(), 0, m.end()) for m in re.finditer(assign, t, re.I | re.A) if len(m[2]) >= 6]
    b = [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    return sorted(a + b + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24])


def test_patterns_equal_their_definition():
    rng = random.Random(9)
    parts = ["password", "API_KEY", "token", "'", '"', " ", "=", ":", "abc", "short", "0123456789abcdef", "deadbeefdeadbeefdeadbeef99", "AKIA", "ABCDEFGH12345678", "é", "\n", "apikey = x1y2z3", "ſecret=aaaaaaa"]
    for _ in range(3000):
        t = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        assert sorted(secrets.pattern_spans(t)) == brute_spans(t), t


def test_scan_adds_formats_and_redacts(spark):
    rng = random.Random(4)
    key = lambda: "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(16))
    texts = [*AWKWARD, *[f"{prose(rng, 20)} {key()} and token = \"{hashlib.sha1(str(i).encode()).hexdigest()}\" end" for i in range(60)], "plain " + "zz" * 30 + " 4532756279624064"]
    docs = frame(spark, texts)
    formats = secrets.fit_formats(docs)
    rows = {r.doc_id: r for r in secrets.digest_spans(docs, formats).collect()}
    for i, t in enumerate(texts):
        base = brute_spans(t or "")
        assert rows[i].base_sha256 == hashlib.sha256(secrets.span_text(base).encode()).hexdigest()
        assert set(filter(None, secrets.span_text(base).split(","))) <= set(rows[i].spans.split(","))
    assert rows[len(texts) - 1].spans == ""
    clean = {r.doc_id: r for r in secrets.scan(docs, formats, redacted=True).collect()}
    assert not any(brute_spans(r.text) for r in clean.values() if r.text) and clean[0].text is None and clean[3].spans == "own"
    assert secrets.scan(docs, formats).schema["spans"].dataType.simpleString().startswith("array")
    empty = frame(spark, [])
    assert secrets.digest_spans(empty, secrets.fit_formats(empty)).count() == 0


def test_formats_are_found_without_patterns(spark):
    """Keys of learnt formats that no pattern catches are found, short, glued and without digits' help too; prose, numbers and long runs are not."""
    rng = random.Random(14)
    digest = lambda n: hashlib.sha1(str(rng.random()).encode()).hexdigest()[:n]
    key = lambda n=16: "AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(n))
    plain = [f"{prose(rng, 40)} +49-{rng.randrange(10**9)} {rng.randrange(10**16)} 20{rng.randrange(10, 30)}-01-{rng.randrange(10, 28)} v1.{rng.randrange(9)} {rng.choice(WORDS)}.{rng.randrange(10, 99)}" for _ in range(200)]
    known = [f"{prose(rng, 20)} {key()} and token = {digest(18)} end {digest(40)}" for _ in range(120)]
    docs = frame(spark, [*plain, *known])
    formats = secrets.fit_formats(docs)
    found = [sum(formats.is_credential(make()) for _ in range(50)) for make in (lambda: digest(18), lambda: digest(22), lambda: key(9), lambda: f"u/{digest(20)}.x", lambda: "ZZ." + key(12))]
    assert min(found) >= 45, found
    spans = {r.doc_id: r.spans for r in secrets.digest_spans(frame(spark, [f"see {digest(20)} here", *plain[:100], " ".join(WORDS).upper(), "z" * 300, "+" + "12345 " * 30, "Green_Table under.cloud PAPER"]), formats).collect()}
    assert spans[0] == "format:4:24" and not any(spans[i] for i in range(1, len(spans)))


def test_odds_are_those_of_the_best_stretch():
    formats = secrets.Formats({"hex": ["a1a11aa1" * 3] * 50}, ["xyazz", "1234"] * 50)  # classes h and d; l, h and d
    assert formats.odds("ll" + "hdhddhhd" * 3) > 12 > formats.odds("llhllllhll")
    for classes in ("hdhd", "lllhdhddhhd", "d" * 12):
        base = formats.background.costs(classes)
        gains = [x - y for x, y in zip(formats.formats[0].costs(classes), base)]
        stretches = [sum(gains[i:j]) for i in range(len(classes)) for j in range(i, len(classes) + 1)]
        assert formats.odds(classes) == pytest.approx(max(sum(gains), *stretches))


# ---- 5


def brute_distance(p, t):
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        new = [i]
        for j, d in enumerate(t, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_myers_equals_dynamic_programming():
    rng = random.Random(6)
    for _ in range(500):
        p, t = ("".join(rng.choice("abc") for _ in range(rng.randrange(1, n))) for n in (15, 40))
        k = len(p) // 2
        best = decontam.best_match(p, t, k)
        d = brute_distance(p, t)
        assert (best is None) == (d > k) and (best is None or best[0] == d), (p, t)


def test_leaks_within_budget_are_found(spark):
    rng = random.Random(8)
    items = [prose(rng, 25), prose(rng, 30), "", None]
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate([*items, items[0]])], "item_id long, text string, start string")
    edited = []
    for k in (0, 2, 5):
        s = list(items[1])
        for _ in range(k):
            s[rng.randrange(len(s))] = rng.choice(["", "q", "zz"])
        edited.append("".join(s))
    texts = [*AWKWARD, "before " + items[0].upper().replace(" ", " \n "), *[prose(rng, 5) + " " + e + " after" for e in edited], prose(rng, 300)]
    for block in (5000, 2):
        got = {(r.doc_id, r.item_id): r for r in decontam.find_items(frame(spark, texts), bench, block=block).collect()}
        want = {(i, j) for i, t in enumerate(texts) for j, p in enumerate([*items, items[0]]) if t and p and brute_distance(decontam.normalise(p), decontam.normalise(t)[:4000]) <= len(decontam.normalise(p)) // 20}
        assert set(got) == want and (9, 0) in want and (10, 1) in want
        for (i, j), r in got.items():
            assert brute_distance(decontam.normalise([*items, items[0]][j]), decontam.normalise(texts[i])) == r.distance
    kept = decontam.clean_documents(frame(spark, texts), bench)
    assert kept.count() == len(texts) - len({i for i, _ in want}) and kept.columns == frame(spark, []).columns
    assert decontam.find_items(frame(spark, []), bench).count() == 0
    assert decontam.clean_documents(frame(spark, texts), bench.where("false")).count() == len(texts)


# ---- 6


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(11)
    bad = lambda: "gruk" + rng.choice(["a", "en", "ist", "or", "um"])
    texts, toxic = [], []
    for i in range(500):
        w = prose(rng, rng.randrange(20, 120)).split()
        if i % 5 == 0:
            for _ in range(rng.randrange(2, 6)):
                w.insert(rng.randrange(len(w)), bad())
        texts.append(" ".join(w))
        toxic.append(int(i % 5 == 0))
    docs = frame(spark, texts + AWKWARD)
    labels = spark.createDataFrame([(i, t) for i, t in enumerate(toxic)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    learnable = common.crc_mod("doc_id", 4) != 2
    got = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.fit(docs, labels, learnable)).collect()}
    held = [i for i in range(500) if common.crc_mod_py(i, 4) == 2]
    assert np.mean([(got[i] >= 0.3) == bool(toxic[i]) for i in held]) >= 0.97
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == len(texts) + len(AWKWARD)
    assert {r.score for r in toxicity.score(docs, toxicity.fit(docs, labels.where("false"), learnable)).collect()} == {0.0}
    assert toxicity.score(frame(spark, []), toxicity.ToxicityModel()).count() == 0


def test_chances_add_up_to_one_and_equal_brute_force():
    rng = random.Random(5)
    make = lambda words: Counter(g for w in words for g in toxicity.grams(w))
    toxic, ordinary = (make(["".join(rng.choice("abcd") for _ in range(rng.randrange(1, 7))) for _ in range(400)]) for _ in range(2))
    pair = toxicity.KneserNeyPair(toxic, ordinary)
    alphabet = sorted({g[-1] for g in toxic + ordinary})

    def counted(counts, n):
        """Counts of order n: the grams themselves at the highest, else how many characters stand before."""
        full = {g[k:] for g in counts for k in [0]}
        for size in range(toxicity.ORDER, n, -1):
            full = {(g, g[1:]) for g in full}
            counts = Counter(short for _, short in full)
            full = set(counts)
        return counts

    def chance(gram, n, own, both):
        if n == 0:
            return 1 / (len(alphabet) + 1)
        c = counted(own if n > toxicity.SHARED else both, n)
        lower = chance(gram, n - 1, own, both)
        context = {g: x for g, x in c.items() if g[:-1] == gram[-n:-1]}
        if not context:
            return lower
        total = sum(context.values())
        return max(context.get(gram[-n:], 0) - toxicity.DISCOUNT, 0) / total + sum(min(x, toxicity.DISCOUNT) for x in context.values()) / total * lower

    seen = list(toxic)[:15] + list(ordinary)[:15] + ["zzzza", "abcdz"]
    for gram in seen:
        got = pair.chances(gram)
        # Below an unseen context the longer ones are unseen too, so the walk may stop.
        assert got == pytest.approx([chance(gram, toxicity.ORDER, own, toxic + ordinary) for own in (toxic, ordinary)])
        for side in (0, 1):
            assert sum(pair.chances(gram[:-1] + c)[side] for c in [*alphabet, "?"]) == pytest.approx(1)


def test_toxic_score_equals_its_definition():
    rng = random.Random(6)
    make = lambda words: Counter(g for w in words for g in toxicity.grams(w))
    pair = toxicity.KneserNeyPair(make(["gruk", "grukor"] * 20 + WORDS), make(WORDS * 9))
    model = toxicity.ToxicityModel(pair)
    x = np.array([-0.5, 0.1, 0.2, 0.2, 0.4, 0.9, 1.5])
    model.calibrate(x, np.array([0, 1, 0, 0, 1, 0, 1]), np.ones(7))
    assert model.shares == pytest.approx([0, 1 / 3, 1 / 2, 1]) and model.knots == pytest.approx([-0.5, 0.5 / 3, 0.65, 1.5])
    assert all(a < b for a, b in itertools.pairwise(map(model.likelihood, np.linspace(-2, 3, 50).tolist())))
    low, high = toxicity.RATES
    for t in [*AWKWARD, prose(rng, 60), prose(rng, 20) + " gruk, GRUKEN! grukor"]:
        total, tokens = 0.0, words(t)
        for w in tokens:
            w = w.strip(toxicity.TRIM.decode())
            r = min(math.prod(p / q for p, q in map(pair.chances, toxicity.grams(w))), math.exp(toxicity.STRONGEST)) if w else 1.0
            total += math.log((1 - high + high * r) / (1 - low + low * r))
        assert model.score(t) == pytest.approx(model.likelihood(total / math.sqrt(len(tokens)) if tokens else 0.0), rel=1e-9)


# ---- 7


def test_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "CELL", 64)
    monkeypatch.setattr(embed_dedup, "BLOCK", 50)
    rng = np.random.default_rng(0)
    base = rng.standard_normal((250, 24))
    near = np.repeat(base[:30], 6, axis=0) + 0.12 * rng.standard_normal((180, 24))
    v = [*base.tolist(), *near.tolist(), *[base[0].tolist()] * 5, None, [], [0.0] * 24, [math.nan] * 24, [None] * 24, [1.0, 2.0], [2.0, 4.0]]
    rows = spark.createDataFrame([(i, x, 0, 1) for i, x in enumerate(v)], "vec_id long, embedding array<double>, label int, n_links int")
    got = {r.vec_id: r for r in embed_dedup.link_vectors(rows).collect()}
    good = [i for i, x in enumerate(v) if x and all(y is not None and math.isfinite(y) for y in x) and any(x)]
    unit = {i: np.array(v[i]) / np.linalg.norm(v[i]) for i in good}
    links = [(i, j) for i in good for j in good if j < i and len(v[i]) == len(v[j]) and unit[i] @ unit[j] >= 0.9]
    name, n = reach(range(len(v)), links), Counter(x for e in links for x in e)
    assert sum(r.n_links for r in got.values()) >= 0.97 * sum(n.values())  # recall of the tables
    assert all(got[i].n_links <= n[i] for i in range(len(v)))
    assert np.mean([got[i].component_id == name[i] for i in range(len(v))]) >= 0.99
    assert all(got[i].n_links == 0 and got[i].kept for i in range(len(v)) if i not in unit)
    assert embed_dedup.link_vectors(rows.where("false")).count() == 0


def test_estimates_are_unbiased_and_bounds_hold():
    rng = np.random.default_rng(3)
    for dim in (24, 64, 100):
        coder = embed_dedup.Coder(dim, 0, 1)
        x = embed_dedup._unit(rng.standard_normal((150, dim)))
        y = embed_dedup._unit(x + 0.4 * embed_dedup._unit(rng.standard_normal((150, dim))))
        a, b = coder.code(x), coder.code(y)
        exact = x @ y.T
        reach = embed_dedup.CONFIDENCE * (np.sqrt((1 - a.factor**2) / (dim - 1))[:, None] + b.step / 2) / a.factor[:, None]
        error = a.upper(b) - reach - exact
        assert abs(error.mean()) < 0.01 and abs(np.diag(error).mean()) < 0.03
        assert (np.abs(error) <= reach).mean() > 0.999
        pairs = set(zip(*a.reaching(b, 0.9).tolist()))
        assert {(i, j) for i, j in zip(*np.nonzero(exact >= 0.9))} <= pairs and len(pairs) < exact.size * (0.3 if dim < 64 else 0.02)


@pytest.mark.parametrize("n", [6000])
def test_recall_with_long_keys(spark, monkeypatch, n):
    monkeypatch.setattr(embed_dedup, "CELL", 6)  # keys of 10 bits
    rng = np.random.default_rng(4)
    base = rng.standard_normal((n // 2, 32))
    v = np.vstack([base, base + 0.3 * rng.standard_normal(base.shape)])
    unit = embed_dedup._unit(v)
    assert embed_dedup.table_shape(n, 0.9, 0.01)[0] >= 10
    want = {(i, j) for i, j in zip(*np.nonzero(np.triu(unit @ unit.T >= 0.9, 1)))}
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], "vec_id long, embedding array<double>")
    got = embed_dedup.link_vectors(rows).toPandas()
    assert got.n_links.sum() / 2 >= 0.97 * len(want) and len(want) > 500


# ---- 8


def test_archives_round_trip(spark):
    big = "<p>" + "ä" * 800 + "</p>"
    htmls = [None, "", "small", "small", big, big, big + "x", big, "\r\n\r\nWARC/1.1\r\n" * 60, "y" * 300000]
    pages = spark.createDataFrame([(i, None if i == 1 else f"http://h/{i}\n", h, "z") for i, h in enumerate(htmls)], "page_id long, url string, html string, digest string")
    got = {r.page_id: r for r in warc.archive_round_trip(pages).collect()}
    for i, h in enumerate(htmls):
        data = (h or "").encode()
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        assert (got[i].record_type, got[i].refers_to) == (("revisit", 7) if h == big and i != 7 else ("response", None))
        assert got[i].record_type == "revisit" or got[i].payload == data
    folder = common.scratch_path(spark, "some")
    index = warc.write_archives(warc.mark_revisits(warc.with_digests(pages)), folder)
    assert {r.page_id for r in warc.read_records(index.where("page_id in (4, 9)"), folder).collect()} == {4, 9}
    assert warc.archive_round_trip(pages.where("false")).count() == 0


# ---- 9


def test_preferences_share_their_prefix(spark):
    rows = [(0, 0, "system", "be kind"), (0, 1, "user", "hi"), (0, 2, "assistant", "yes"), (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "no"), (1, 3, "user", None), (2, 0, "user", "alone"), (4, 0, "user", "x"), (5, 0, "user", "x"), (None, 0, "user", "q"), (6, None, "user", "q"), (8, 0, "user", "t"), (8, 0, "user", "t"), (9, 0, "user", "t")]
    df = spark.createDataFrame([(*r, "p") for r in rows], "conv_id long, turn long, role string, text string, part string")
    out = chat.format_pairs(chat.neighbours_as_pairs(df)).toPandas()
    pair = lambda k: [(r.part, r.turn, r.masked) for r in out[out.pair_id == k].sort_values(["part", "turn", "tie"]).itertuples()]
    assert pair(0) == [("chosen", 2, True), ("prompt", 0, False), ("prompt", 1, False), ("rejected", 2, True), ("rejected", 3, False)]
    assert pair(1) == [("chosen", 0, False)] and pair(2) == [("prompt", 0, False)] and pair(4) == [("chosen", 0, False), ("prompt", 0, False)]
    assert chat.format_pairs(chat.neighbours_as_pairs(df.where("false"))).count() == 0


# ---- 10


def test_scores_equal_brute_force(spark):
    rng = random.Random(2)
    texts = [*AWKWARD, *[prose(rng, 80) for _ in range(80)]]
    docs = frame(spark, texts)
    train = [i for i in range(len(texts)) if common.crc_mod_py(i, 7) != 2]
    got = {r.doc_id: r for r in lmscore.score(docs, docs.where(common.crc_mod("doc_id", 7) != 2), core=40, kept=60).collect()}
    c = Counter(w for i in train for w in [*words(texts[i]), ""])
    n, v = sum(c.values()), len(c)
    for i, t in enumerate(texts):
        w = [*words(t), ""]
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(w), sum(x in c for x in w), n)
        assert got[i].base_score == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), rel=1e-9)
        assert got[i].score < 0
    assert sum(got[i].score for i in range(9, len(texts))) > sum(got[i].base_score for i in range(9, len(texts)))
    alone = lmscore.score(docs, docs.where("false")).collect()
    assert all(r.n_known == 0 and r.base_score == 0 for r in alone)


def brute_scores(texts, train):
    """Backoff over all n-grams of two occurrences or more, by dictionaries."""
    seqs = [[*words(t), ""] for t in texts]
    count = lambda k: Counter(tuple(seqs[i][j : j + k]) for i in train for j in range(len(seqs[i]) - k + 1))
    one = count(1)
    kept = [None, one, *[{g: n for g, n in count(k).items() if n >= 2} for k in (2, 3)]]
    n, v = sum(one.values()), len(one)
    after = defaultdict(list)
    for g in [*kept[2], *kept[3]]:
        after[g[:-1]].append(g)

    def prob(g):
        if len(g) == 1:
            return (one[g] + 1) / (n + v + 1)
        return arc(g) if g in kept[len(g)] else weight(g[:-1]) * prob(g[1:])

    arc = lambda g: (kept[len(g)][g] - 0.5) / kept[len(g) - 1][g[:-1]]
    weights = {}

    def weight(h):
        if h not in weights:
            weights[h] = (1 - sum(map(arc, after[h]))) / (1 - sum(prob(g[1:]) for g in after[h])) if after[h] else 1.0
        return weights[h]

    return [sum(math.log10(prob(tuple(s[max(0, j - 2) : j + 1]))) for j in range(len(s))) for s in seqs]


@pytest.mark.parametrize("core, kept", [(40, 60), (5, 100), (0, 0), (10**6, 10**6)])
def test_scores_hold_every_repeated_ngram_whatever_is_broadcast(spark, core, kept):
    rng = random.Random(7)
    texts = [*AWKWARD, *[prose(rng, 60) for _ in range(60)]]
    texts += [texts[-1], texts[-2] + " never seen", "unseen " + texts[-1], texts[20] + " " + texts[21]]
    docs = frame(spark, texts)
    train = [i for i in range(len(texts)) if common.crc_mod_py(i, 7) != 2]
    got = {r.doc_id: r.score for r in lmscore.score(docs, docs.where(common.crc_mod("doc_id", 7) != 2), core=core, kept=kept).collect()}
    assert [got[i] for i in range(len(texts))] == pytest.approx(brute_scores(texts, train), rel=1e-9)


def test_scoring_reads_the_texts_four_times(spark, monkeypatch):
    passes, lean = [], lmscore.lean
    monkeypatch.setattr(lmscore, "lean", lambda run: passes.append(run) or lean(run))
    docs = frame(spark, ["a b c a b c", "a b c a b c", None, ""])
    rows = {r.doc_id: r for r in lmscore.score(docs, docs).collect()}
    assert len(passes) == 4  # words and pairs, triples, and a look-up for each of the two
    assert [rows[i].n_tokens for i in range(4)] == [7, 7, 1, 1] and rows[0].score == pytest.approx(rows[1].score)


def test_ngrams_are_shuffled_as_arrays(spark):
    rng = random.Random(9)
    seqs = [[*words(t), ""] for t in (prose(rng, 300) for _ in range(60))]
    rows = lmscore._counted(frame(spark, [" ".join(s) for s in seqs]), 6, 2).collect()
    assert len(rows) <= 3 * 2**6  # of each part its words, its pairs and its bits of the filter, and not a row for each n-gram
    sizes = lambda kind: sorted(n for r in rows if r.kind == kind for n in packed.numbers(r.data[1]).tolist())
    pairs = Counter(p for s in seqs for p in zip(s, s[1:]))
    assert sizes(lmscore.NGRAMS) == sorted(n for n in pairs.values() if n >= 2)
    assert sizes(lmscore.WORDS) == sorted(Counter(w for s in seqs for w in s).values())
    assert len({lmscore._home(task << 24, 6) for task in range(1000)}) == 64  # the first blocks of all tasks


def test_packed_tables_find_their_keys():
    rng = np.random.default_rng(3)
    keys = np.unique((rng.integers(0, 1 << 50, 400) << 2)[:, None] + np.arange(2)).astype(np.int64)  # neighbours differ in the last bit
    mixed = rng.permutation(keys)
    table = packed.Table()
    for some in (mixed[:300], mixed[300:]):
        (row,) = packed.cut(6, 0, some[packed.order_of(some)], some[packed.order_of(some)] / 2)
        table.add([packed.numbers(x) for x in row[3]])
    hit, at = table.find(np.append(mixed, keys[:5] + 2))
    assert hit.tolist() == list(range(len(keys))) and (table.columns[0][at] == mixed).all() and (table.columns[1].view(float)[at] == mixed / 2).all()
    assert len(packed.numbers(packed.planes(np.empty(0)))) == 0 and not len(packed.Table().find(keys)[0])


def test_tally_counts_keys_that_share_their_first_bits():
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 1 << 61, 3) << 2
    keys = np.concatenate([keys, keys + 1])[rng.integers(0, 6, 1000)]  # neighbours cannot be told apart by the bits that are sorted
    tally = lmscore.Tally(1)
    tally.add(keys[:600], keys[:600])
    tally.merge()
    tally.add(keys[600:], keys[600:])
    got = Counter()
    for batch in tally.take():
        for k, n in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            got[k] += n
    assert got == Counter(keys.tolist())


def test_automaton_states_add_up_to_one():
    rng = random.Random(1)
    seq = [rng.choice([0, 1, 2, 0, 1, 3]) for _ in range(4000)]
    core = np.array([Counter(seq)[i] for i in range(4)])
    pairs = Counter(a * 4 + b for a, b in zip(seq, seq[1:]))
    kept = np.array(sorted(k for k, n in pairs.items() if n > 200))
    place = {k: i for i, k in enumerate(kept.tolist())}
    triples = Counter(place[a * 4 + b] * 4 + c for a, b, c in zip(seq, seq[1:], seq[2:]) if a * 4 + b in place and b * 4 + c in place)
    t = np.array(sorted(k for k, n in triples.items() if n > 60))
    fsm = lmscore.build_automaton(core, len(seq), 4, kept, np.array([pairs[k] for k in kept.tolist()]), t, np.array([triples[k] for k in t.tolist()]))
    unseen = 1 / (len(seq) + 5)
    for history in ([], [0], [1, 0], [0, 1], [3, 2]):
        at = fsm.traverse(np.array(history, np.int64))
        total = sum(10 ** (fsm.traverse(np.array([*history, w])) - at) for w in range(4))
        total += unseen * 10 ** (fsm.traverse(np.array([*history, -1])) - at)
        assert total == pytest.approx(1, abs=1e-6)


def test_groups_survive_batch_borders():
    import pandas as pd

    rng = random.Random(0)
    rows = pd.DataFrame({"k": sorted(rng.randrange(30) for _ in range(400)), "x": range(400)})
    cuts = sorted(rng.sample(range(400), 20))
    parts = [rows.iloc[a:b] for a, b in zip([0, *cuts], [*cuts, 400])]
    whole = list(common.runs(iter(parts), ["k"]))
    assert pd.concat(whole).x.tolist() == list(range(400))
    owner = defaultdict(set)
    for i, g in enumerate(whole):
        for k in g.k:
            owner[k].add(i)
    assert all(len(o) == 1 for o in owner.values())
