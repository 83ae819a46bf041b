"""Column helpers for text, with Python's notions of white space and tokens."""

from __future__ import annotations

import html
import unicodedata
from functools import wraps

import pandas as pd
from pyspark.sql import Column, functions as F

#: White space of Python's ``str``; Java's ``\s`` is ASCII only.
WS = r"[\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: The ASCII punctuation that canonical text leaves out.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def arrow(returns: str):
    """A vectorised function that is made when first used, as its type needs a session."""

    def mark(fn):
        @wraps(fn)
        def call(*columns):
            return F.pandas_udf(fn, returns)(*columns)

        return call

    return mark


def py_strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def collapse(c: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(c, f"{WS}+", " "))


def norm(c: Column) -> Column:
    """Lower case, white space collapsed."""
    return collapse(F.lower(c))


def canon(c: Column) -> Column:
    """Lenient canonical form: lower case, white space collapsed, ASCII punctuation left out."""
    return F.trim(F.translate(norm(c), PUNCTUATION, ""))


def tokens(c: Column) -> Column:
    """Lower-case alphanumeric tokens."""
    return F.regexp_extract_all(F.lower(c), F.lit("([a-z0-9]+)"), F.lit(1))


def words(c: Column) -> Column:
    """White-space separated words of the collapsed lower-case text."""
    return F.filter(F.split(norm(c), " "), lambda w: w != "")


def shingle_hashes(w: Column, k: int) -> Column:
    """Distinct hashes of k-word runs of an array column of words; fewer words are one run, none give none."""
    n = F.size(w)
    runs = F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.xxhash64(F.array_join(F.slice(w, i, k), " ")))
    return F.when(n == 0, F.array().cast("array<bigint>")).when(n < k, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(F.array_distinct(runs))


def jaccard(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


def ordered_distinct(items: Column, key=F.lower) -> Column:
    """First occurrences by key, order kept; the items are evaluated once."""
    start = F.struct(F.array().cast("array<string>").alias("keys"), F.array().cast("array<string>").alias("out"))
    add = lambda acc, x: F.struct(F.array_append(acc["keys"], key(x)).alias("keys"), F.array_append(acc["out"], x).alias("out"))
    return F.aggregate(items, start, lambda acc, x: F.when(F.array_contains(acc["keys"], key(x)), acc).otherwise(add(acc, x)))["out"]


def mostly_latin1_repair(c: Column) -> Column:
    """Undoes one round of UTF-8 read as Latin-1, where every character allows it and the bytes are valid UTF-8."""
    shaped = c.rlike(r"^[\x00-\xff]*$") & c.rlike(r"[\xc2-\xf4][\x80-\xbf]")
    back = F.encode(c, "ISO-8859-1").cast("string")
    return F.when(shaped & F.coalesce(F.when(shaped, F.is_valid_utf8(back)), F.lit(False)), back).otherwise(c)


def fix_mojibake(c: Column) -> Column:
    """The supported repairs: stray "Â " before a space, and UTF-8 read as Latin-1."""
    return mostly_latin1_repair(F.replace(c, F.lit("Â "), F.lit(" ")))


@arrow("string")
def nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))


@arrow("string")
def unescape_nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: None if t is None else unicodedata.normalize("NFKC", html.unescape(t)))


def round_half_even(c: Column, digits: int = 3) -> Column:
    """Half-even rounding for display; see the README for where it differs from Python's on binary ties."""
    return F.bround(c, digits)
