"""URL filters by a Bloom filter cascade, in DataFrame functions only.

The listed rules are keys ``host`` + ``path``. Levels of the cascade encode in
turn the listed keys, their false positives over the key universe, the listed keys
that are false positives of those, and so on until none is left. Since the
universe holds every key that any URL of the table asks for, membership is exact,
and no URL is joined with the list. The first level's false positive rate follows
the universe's size, so that the cascade's bits grow with the list times the
logarithm of the universe, whatever the number of URLs.

Null URLs and URLs without ``://`` have an empty host and path; an empty table gives
an empty result. Repeated URLs are judged alike; other columns pass through.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from paperloom.llm.common import materialize


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def key(self) -> str:
        return self.host + self.path


def parse_rules(lines: list[tuple[str, str]]) -> list[Rule]:
    """From (verdict, ``host/path``) pairs; the path begins at the first slash."""
    return [Rule(text.partition("/")[0].lower(), "/" + text.partition("/")[2], verdict) for verdict, text in lines]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    ok = url.isNotNull() & (at > 0)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(ok, F.translate(host, upper, lower)).otherwise(""), F.when(ok, path).otherwise("")


def asked_keys(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The keys under which a URL could be listed, longest first.

    Only as many labels and path characters as some rule has are asked for, so their
    number is bounded by the list's shapes, not by the URL.
    """
    dots = F.length(host) - F.length(F.replace(host, F.lit(".")))
    keys = []
    for labels, chars in sorted({(r.host.count(".") + 1, len(r.path)) for r in rules}):
        suffix = F.substring_index(host, ".", -labels)
        key = F.struct((F.length(suffix) + chars).alias("n"), F.length(suffix).alias("h"), F.concat(suffix, F.substring(path, 1, chars)).alias("key"))
        keys.append(F.when((dots >= labels - 1) & (F.length(path) >= chars), key))
    return F.transform(F.sort_array(F.array_compact(F.array(*keys)), asc=False), lambda x: x["key"])


@dataclass
class Level:
    bits: int
    hashes: int
    words: list[int]


@dataclass
class Cascade:
    levels: list[Level] = field(default_factory=list)

    def contains(self, key: Column) -> Column:
        """Whether a key of the universe is listed: the first level that misses it tells."""
        inside = F.lit(len(self.levels) % 2 == 1)
        for n in range(len(self.levels), 0, -1):
            inside = F.when(_passes(key, n, self.levels[n - 1]), inside).otherwise(F.lit(n % 2 == 0))
        return inside


def _positions(key: Column, n: int, bits: int, hashes: int) -> list[Column]:
    a = F.pmod(F.xxhash64(F.lit(2 * n), key), F.lit(bits))
    b = F.pmod(F.xxhash64(F.lit(2 * n + 1), key), F.lit(bits))
    return [F.pmod(a + b * i, F.lit(bits)) for i in range(hashes)]


def _passes(key: Column, n: int, level: Level) -> Column:
    words = F.array(*[F.lit(w).cast("long") for w in level.words])
    tests = [F.getbit(F.element_at(words, (p / 64).cast("int") + 1), (p % 64).cast("int")) == 1 for p in _positions(key, n, level.bits, level.hashes)]
    return reduce(lambda x, y: x & y, tests)


def _encode(keys: DataFrame, n: int, count: int, rate: float) -> Level:
    hashes = max(1, round(math.log2(1 / rate)))
    bits = max(64, math.ceil(count * hashes / math.log(2)))
    at = F.explode(F.array(*_positions(F.col("key"), n, bits, hashes))).alias("p")
    rows = (
        keys.select(at)
        .groupBy((F.col("p") / 64).cast("int").alias("w"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % 64).cast("int"))).alias("m"))
        .collect()  # one row per word of the filter
    )
    words = [0] * (bits // 64 + 1)
    for r in rows:
        words[r["w"]] = r["m"]
    return Level(bits, hashes, words)


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """``listed`` and ``universe``: distinct non-null ``key`` columns, kept where re-reading is cheap.

    The universe is counted and filtered once; later levels see only false positives.
    """
    cascade, inside = Cascade(), listed
    outside = universe.join(listed, "key", "left_anti")
    n, size = listed.count(), max(2, outside.count())
    if not n:
        return cascade
    rate = min(0.5, n * math.sqrt(0.5) / size)
    while n:
        k = len(cascade.levels) + 1
        cascade.levels.append(level := _encode(inside, k, n, rate))
        outside, inside = inside, outside.where(_passes(F.col("key"), k, level))
        n, rate = inside.count(), 0.5
    return cascade


def filter_urls(pages: DataFrame, rules: list[Rule], default: str = "allow", url: str = "url") -> DataFrame:
    """Adds host, path, rule and verdict of every row.

    A rule fits its host and all subdomains where the URL's path starts with the
    rule's; the longest fitting rule wins. Where none fits, ``rule`` is null and the
    verdict is the default. One cascade per verdict.
    """
    spark = pages.sparkSession
    host, path = url_parts(F.col(url))
    judged = pages.withColumns({"__host": host, "__path": path})
    asked = judged.withColumn("__keys", asked_keys(F.col("__host"), F.col("__path"), rules))
    universe = materialize(asked.select(F.explode("__keys").alias("key")).distinct(), "url-universe")
    member = {}
    for verdict in sorted({r.verdict for r in rules}):
        listed = spark.createDataFrame([(k,) for k in sorted({r.key for r in rules if r.verdict == verdict})], "key string")
        member[verdict] = build_cascade(listed, universe)
    say = lambda key: F.coalesce(*[F.when(c.contains(key), F.lit(v)) for v, c in member.items()])
    hits = F.filter(F.transform("__keys", lambda k: F.struct(k.alias("rule"), say(k).alias("verdict"))), lambda x: x["verdict"].isNotNull())
    best = F.try_element_at(hits, F.lit(1))
    return asked.withColumn("__best", best).select(
        *[c for c in pages.columns if c not in ("host", "path", "rule", "verdict")],
        F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__best.rule").alias("rule"), F.coalesce("__best.verdict", F.lit(default)).alias("verdict"),
    )
