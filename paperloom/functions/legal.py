"""Columns that read legal text: jurisdictions, parties, dates, durations, amounts."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from paperloom.functions.text import ordered_distinct, py_strip

#: The vocabulary of jurisdictions.
JURISDICTIONS = (
    "Alabama", "Alaska", "Arizona", "Arkansas", "California", "Colorado",
    "Connecticut", "Delaware", "Florida", "Georgia", "Hawaii", "Idaho", "Illinois",
    "Indiana", "Iowa", "Kansas", "Kentucky", "Louisiana", "Maine", "Maryland",
    "Massachusetts", "Michigan", "Minnesota", "Mississippi", "Missouri", "Montana",
    "Nebraska", "Nevada", "New Hampshire", "New Jersey", "New Mexico", "New York",
    "North Carolina", "North Dakota", "Ohio", "Oklahoma", "Oregon", "Pennsylvania",
    "Rhode Island", "South Carolina", "South Dakota", "Tennessee", "Texas", "Utah",
    "Vermont", "Virginia", "Washington", "West Virginia", "Wisconsin", "Wyoming",
    "District of Columbia",
    "Ontario", "Quebec", "British Columbia", "Alberta",
    "England", "Wales", "Scotland", "Canada",
)
#: Months, number words, corporate suffixes, and the patterns made of them.
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
NUMBER_WORDS = ("one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven", "twelve")
SUFFIX = r"(?i:incorporated|inc|corporation|corp|company|co|limited|ltd|llc|l\.l\.c|llp|lp|l\.p|plc|gmbh|s\.a|n\.a)"
NAME = r"[A-Z][A-Za-z0-9&'.\-]*"
ENTITY = rf"({NAME}(?:[\s,]+(?:{NAME}|(?i:and|of|the|&))){{0,6}}?[\s,]+{SUFFIX}\b\.?)"
MONTH = "|".join(MONTHS)
ORDINAL = "(?:st|nd|rd|th)?"
DATE = rf"(?i)(?:(?:{MONTH})\s+\d{{1,2}}\s*,?\s*\d{{4}}|\d{{1,2}}/\d{{1,2}}/\d{{2,4}})"
NDA_DATE = (
    rf"(?i)\d{{1,2}}{ORDINAL}\s+day\s+of\s+(?:{MONTH})[\s,]*\d{{4}}|(?:{MONTH})\s+\d{{1,2}}{ORDINAL}\s*,?\s*\d{{4}}"
    rf"|\d{{1,2}}{ORDINAL}\s+(?:{MONTH})\s*,?\s*\d{{4}}|\d{{1,2}}/\d{{1,2}}/\d{{2,4}}|\d{{4}}-\d{{1,2}}-\d{{1,2}}"
)
DURATION = rf"(?i)\(?(\d+)\)?\s*(year|month)s?|\b(?<!-)({'|'.join(NUMBER_WORDS)})\s+(year|month)s?"
DURATION_OR_DAYS = DURATION.replace("year|month", "year|month|day")
MONEY = r"\$\s?\d[\d,]*(?:\.\d{2})?"
NOTICE_DAYS = r"(?i)(?:\b[A-Za-z]+\s+)?\(?\d+\)?\s*(?:calendar |business )?days?"
AUTO_RENEWAL = r"(?i)automatic(?:ally)?\s+renew|renew\w*\s+automatically|successive\s+(?:\S+[\s-]+){0,3}(?:term|period|year|month)|evergreen"
RETURN_MATERIALS = r"(?i)return\s+or\s+destroy|return\s+and\s+destroy|return\s+all|promptly\s+destroy|destroy\s+all"
JURISDICTION = r"\b(" + "|".join(sorted(JURISDICTIONS, key=len, reverse=True)) + r")\b"


def jurisdiction_in(c: Column) -> Column:
    """The first jurisdiction named, or an empty string."""
    return F.regexp_extract(c, JURISDICTION, 1)


def party_entities(c: Column) -> Column:
    """Corporate names, without trailing dots, first occurrences by lower case; "Delaware limited ..." is a description."""
    found = F.transform(F.regexp_extract_all(c, F.lit(ENTITY), F.lit(1)), lambda e: F.regexp_replace(e, r"\.+$", ""))  # no white space at a match's ends
    none = F.array().cast("array<string>")
    described = f"^(?i:{'|'.join(sorted(JURISDICTIONS, key=len, reverse=True))})" + r"\s+\p{Ll}"
    names = ordered_distinct(F.filter(found, lambda e: (e != "") & ~e.rlike(described)))
    return F.when(~c.rlike(rf"[\s,]{SUFFIX}\b"), none).otherwise(names)  # the suffix alone is found much faster


def first_date(c: Column) -> Column:
    return F.regexp_extract(c, DATE, 0)


def days_in(c: Column) -> Column:
    """The day count of a notice phrase: digits before "days", else in brackets, else any."""
    tries = (r"(?i)(\d+)\s*\)?\s*(?:calendar |business )?days?", r"\((\d+)\)", r"(\d+)")
    return F.coalesce(*[F.nullif(F.regexp_extract(c, t, 1), F.lit("")) for t in tries], F.lit(""))


def money_digits(c: Column) -> Column:
    """The integer digits of an amount."""
    return F.replace(F.regexp_extract(c, r"\$?\s?(\d[\d,]*)", 1), F.lit(","), F.lit(""))


def _number(word: Column) -> Column:
    return F.array_position(F.array(*[F.lit(w) for w in NUMBER_WORDS]), F.lower(word)).cast("string")


def duration_in(c: Column, pattern: str = DURATION) -> Column:
    """"two (2) years" and "two years" as "2 years"; an empty string without one."""
    g = [F.regexp_extract(c, pattern, i) for i in range(5)]
    digits = F.concat(g[1], F.lit(" "), F.lower(g[2]), F.lit("s"))
    spelt = F.concat(_number(g[3]), F.lit(" "), F.lower(g[4]), F.lit("s"))
    return F.when(g[0] == "", "").when(g[1] != "", digits).otherwise(spelt)


def canonical_duration(c: Column) -> Column:
    return duration_in(c, DURATION_OR_DAYS)


def canonical_date(c: Column) -> Column:
    """Five written forms as YYYY-MM-DD text, in a fixed order; days that do not exist survive."""

    def form(pattern: str, y: int, m: int, d: int, named: bool) -> Column:
        g = lambda i: F.regexp_extract(c, pattern, i)
        month = F.array_position(F.array(*[F.lit(x.lower()) for x in MONTHS]), F.lower(g(m))) if named else F.try_to_number(g(m), F.lit("99"))
        year = F.when(F.length(g(y)) <= 2, F.when(g(y).try_cast("int") < 40, 2000).otherwise(1900) + g(y).try_cast("int")).otherwise(g(y).try_cast("int"))
        return F.when(g(0) != "", F.format_string("%04d-%02d-%02d", year.cast("int"), month.cast("int"), g(d).try_cast("int")))

    return F.coalesce(
        form(r"\b(\d{4})-(\d{1,2})-(\d{1,2})\b", 1, 2, 3, False),
        form(rf"(?i)\b(\d{{1,2}}){ORDINAL}\s+day\s+of\s+({MONTH})[\s,]*(\d{{4}})", 3, 2, 1, True),
        form(rf"(?i)\b({MONTH})\s+(\d{{1,2}}){ORDINAL}\s*,?\s*(\d{{4}})", 3, 1, 2, True),
        form(rf"(?i)\b(\d{{1,2}}){ORDINAL}\s+({MONTH})\s*,?\s*(\d{{4}})", 3, 2, 1, True),
        form(r"\b(\d{1,2})/(\d{1,2})/(\d{2,4})\b", 3, 1, 2, False),
        F.lit(""),
    )


def auto_renewal_answer(c: Column) -> Column:
    """yes for yes, true or a renewal phrase; no for any other text."""
    yes = F.lower(c).rlike(r"\byes\b|\btrue\b") | c.rlike(AUTO_RENEWAL)
    return F.when(py_strip(c) == "", "").when(yes, "yes").otherwise("no")


def return_answer(c: Column, whole_words: bool = False) -> Column:
    """Return-of-materials answers; gold labels ask for whole words yes or true, values for substrings."""
    yes = r"\byes\b|\btrue\b|return|destroy" if whole_words else r"yes|true|return|destroy"
    return F.when(py_strip(c) == "", "").when(F.lower(c).rlike(yes), "yes").otherwise("no")
