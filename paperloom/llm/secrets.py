"""Secret scans: fixed patterns, and formats inferred from labelled credentials.

The patterns' hits are the labelled credentials. For each kind a prefix tree of
character classes is built from a bounded sample of them (``examples`` per kind, the
smallest by hash), and states whose outgoing frequencies are statistically
compatible (Hoeffding bound) are merged into a probabilistic automaton. An automaton
of the same make over ordinary tokens is the background. Every token of ``SHORTEST`` characters or more (as many as the shortest labelled
credential has) is then scored whole: the likelihood of each character under a format over that under the background, summed
over the token and over its best stretch, so that a credential glued into a longer token counts too. Tokens whose
odds reach ``ODDS`` become spans of kind ``format``; nothing else, neither length nor the characters' kinds, rules one out. Pattern spans always stay.

Labelled strings of more than ``LONGEST`` characters are no examples. Null texts count as empty; empty texts have no spans; very long
texts and tokens are read whole. Rows are scanned one by one:
repeated rows give equal spans, other columns pass through untouched (``spans`` is replaced where spans are added).
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from heapq import nsmallest

import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from paperloom.llm.common import Scratch, lean

KINDS = ("assign", "access", "hex", "format")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # 20 characters or more
HEX = re.compile(r"[0-9a-f]{24,}")  # a leftmost match is a whole run
SHORTEST = 6
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]{%d,}" % SHORTEST)
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
WORD = re.compile(r"[A-Za-z0-9+/_.=-]{4,}")
_CLASS = str.maketrans(
    {**{c: "h" for c in "abcdef"}, **{c: "l" for c in "ghijklmnopqrstuvwxyz"}, **{c: "H" for c in "ABCDEF"}, **{c: "U" for c in "GHIJKLMNOPQRSTUVWXYZ"}, **{c: "d" for c in "0123456789"}, **{c: "s" for c in "+/_.=-"}}
)
SYMBOLS = 7  # six classes and the end
LONGEST = 200  # characters of an example
ODDS = 12.0  # log-odds from which on a token is a credential: prior odds of one in e ** 12 tokens
STRAY = 0.02  # share of characters that follow no rule
REMEMBERED = 40  # characters of the class strings whose odds are remembered


def may_assign(text: str) -> bool:
    """Whether any separator follows a keyword; most texts need no further look."""
    for mark in ":=":
        at = -1
        while (at := text.find(mark, at + 1)) >= 0:
            p = at
            while p and text[p - 1] == " ":
                p -= 1
            if p and text[p - 1] in "\"'":
                p -= 1
            if text[max(0, p - 8) : p].lower().endswith(KEYWORDS):
                return True
    return False


def assignments(text: str) -> list[re.Match]:
    return [m for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6] if may_assign(text) else []


def pattern_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, kind number, end) of the fixed patterns' matches that are long enough."""
    spans = [(m.start(), 0, m.end()) for m in assignments(text)]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    return spans + [(m.start(), 2, m.end()) for m in HEX.finditer(text)]


class Automaton:
    """A probabilistic automaton merged from a prefix tree."""

    def __init__(self, strings: list[str], alpha: float = 0.05) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.count: list[dict[str, int]] = [{}]
        self.total = [0]
        for s in strings:
            state = 0
            for c in s:
                state = self._step(state, c)
            self._tally(state, "$", 1)
        self.slack = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_all()
        smooth = lambda n, total: math.log((1 - STRAY) * (n + 0.1) / (total + 0.1 * SYMBOLS) + STRAY / SYMBOLS)
        self.cost = [{c: smooth(n, self.total[q]) for c, n in counts.items()} for q, counts in enumerate(self.count)]
        self.miss = [smooth(0, t) for t in self.total]

    def _tally(self, state: int, c: str, n: int) -> None:
        self.count[state][c] = self.count[state].get(c, 0) + n
        self.total[state] += n

    def _step(self, state: int, c: str) -> int:
        self._tally(state, c, 1)
        if c not in self.next[state]:
            self.next[state][c] = len(self.next)
            self.next.append({})
            self.count.append({})
            self.total.append(0)
        return self.next[state][c]

    def _alike(self, a: int, b: int) -> bool:
        """Whether two states and all that follows them agree within the Hoeffding bound."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            na, nb = self.total[a], self.total[b]
            if not na or not nb:
                continue
            bound = self.slack * (1 / math.sqrt(na) + 1 / math.sqrt(nb))
            ca, cb = self.count[a], self.count[b]
            if any(abs(ca.get(c, 0) / na - cb.get(c, 0) / nb) > bound for c in {*ca, *cb}):
                return False
            todo += [(self.next[a][c], self.next[b][c]) for c in self.next[a].keys() & self.next[b].keys() if self.next[a][c] != self.next[b][c]]
        return True

    def _fold(self, red: int, blue: int) -> None:
        todo = [(red, blue)]
        while todo:
            a, b = todo.pop()
            for c, n in self.count[b].items():
                self._tally(a, c, n)
            for c, q in self.next[b].items():
                if c in self.next[a]:
                    todo.append((self.next[a][c], q))
                else:
                    self.next[a][c] = q

    def _merge_all(self) -> None:
        """Red states are final; a blue child is merged with a compatible red state or turns red."""
        red = [0]
        done = False
        while not done:
            done = True
            for q in red:
                for c, blue in sorted(self.next[q].items()):
                    if blue in red:
                        continue
                    same = next((r for r in red if self._alike(r, blue)), None)
                    if same is None:
                        red.append(blue)
                    else:
                        self.next[q][c] = same
                        self._fold(same, blue)
                    done = False
                    break
                if not done:
                    break
        self.states = len(red)

    def costs(self, classes: str) -> list[float]:
        """Log-likelihood of each character and of the end; from an unseen step on, the state starts anew."""
        state, out = 0, []
        for c in classes:
            out.append(self.cost[state].get(c, self.miss[state]))
            state = self.next[state].get(c, 0)
        return [*out, self.cost[state].get("$", self.miss[state])]


class Formats:
    """The kinds' automata and the background."""

    def __init__(self, labelled: dict[str, list[str]], ordinary: list[str], odds: float = ODDS) -> None:
        self.formats = [Automaton([s.translate(_CLASS) for s in strings]) for strings in labelled.values() if strings]
        self.background = Automaton([s.translate(_CLASS) for s in ordinary])
        self.least = odds
        self.memo: dict[str, bool] = {}

    def odds(self, classes: str) -> float:
        """The greatest log-odds that any format has over the background, for the whole token or for a stretch of it."""
        best, base = -math.inf, self.background.costs(classes)
        for a in self.formats:
            gains = [x - y for x, y in zip(a.costs(classes), base)]
            run = high = 0.0
            for g in gains[:-1]:
                run = max(0.0, run + g)
                high = max(high, run)
            best = max(best, sum(gains), high)
        return best

    def is_credential(self, token: str) -> bool:
        classes = token.translate(_CLASS)
        if (found := self.memo.get(classes)) is None:
            found = self.odds(classes) >= self.least
            if len(classes) <= REMEMBERED:
                if len(self.memo) > 200_000:
                    self.memo.clear()
                self.memo[classes] = found
        return found

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        base = sorted(pattern_spans(text))
        out, k = [], 0
        ends = []
        high = 0
        for b in base:
            high = max(high, b[2])
            ends.append(high)
        for m in TOKEN.finditer(text):
            s, e = m.span()
            while k < len(base) and ends[k] <= s:
                k += 1
            if (k == len(base) or base[k][0] >= e) and self.is_credential(m[0]):
                out.append((s, 3, e))
        return sorted(base + out)


def span_text(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each stretch of overlapping spans replaced by its first kind's mark."""
    out, at, i = [], 0, 0
    while i < len(spans):
        s, k, e = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < e:
            e = max(e, spans[i][2])
            i += 1
        out += [text[at:s], f"[CREDENTIAL:{KINDS[k]}]"]
        at = e
    return "".join([*out, text[at:]])


def outside(text: str) -> str:
    """The text without its pattern spans; what is labelled as a credential is no ordinary token."""
    spans = sorted(pattern_spans(text))
    return redact(text, spans) if spans else text


def fit_formats(docs: DataFrame, text: str = "text", examples: int = 400, ordinary: int = 2000) -> Formats:
    """Fits the automata on the ``examples`` credentials of each kind, and as many ordinary tokens, that have the smallest hashes."""

    most = {**dict.fromkeys(KINDS[:3], examples), "word": ordinary}

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows, words = set(), {}
            for t in pdf[text].fillna(""):
                rows.update(("assign", m[2]) for m in assignments(t) if len(m[2]) <= LONGEST)
                rows.update(("access", m[0]) for m in ACCESS.finditer(t) if len(m[0]) <= LONGEST)
                rows.update(("hex", m[0]) for m in HEX.finditer(t) if len(m[0]) <= LONGEST)
            for w in set().union(*(outside(t).split() for t in pdf[text].fillna(""))):
                words[xxhash.xxh3_64_intdigest(w)] = w
            for h in nsmallest(3 * ordinary, words):
                if len(words[h]) <= LONGEST and WORD.fullmatch(words[h]):
                    rows.add(("word", words[h]))
            words.clear()
            order = lambda x: xxhash.xxh3_64_intdigest(x[1])
            keep = [x for kind, n in most.items() for x in nsmallest(n, [r for r in rows if r[0] == kind], key=order)]
            yield pd.DataFrame(keep, columns=["kind", "value"])

    scratch = Scratch(docs.sparkSession)
    found = scratch.keep(docs.select(text).mapInPandas(lean(gather), "kind string, value string").distinct(), "credentials")
    labelled: dict[str, list[str]] = {}
    for kind, n in most.items():
        rows = found.where(F.col("kind") == kind).orderBy(F.xxhash64("value"), "value").limit(n).collect()  # bounded by n
        labelled[kind] = [r["value"] for r in rows]
    scratch.drop("credentials")
    words = [v for w in labelled.pop("word") if not pattern_spans(w) for v in dict.fromkeys((w, w.upper(), w.capitalize(), "0" * len(w)))]  # words stand in any case, and numbers beside them
    return Formats(labelled, words)


def scan(docs: DataFrame, formats: Formats, text: str = "text", redacted: bool = False) -> DataFrame:
    """Adds ``spans`` (array of start, end, kind), or with ``redacted`` replaces the text."""
    model = docs.sparkSession.sparkContext.broadcast(formats)
    schema = docs.schema if redacted else StructType([*docs.drop("spans").schema, *StructType.fromDDL("spans array<struct<start:int,end:int,kind:string>>")])
    names = [f.name for f in schema]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = model.value.spans
        for pdf in batches:
            spans = [find(t) if t else [] for t in pdf[text].fillna("")]
            if redacted:
                pdf[text] = [redact(t, s) if s else t for t, s in zip(pdf[text], spans)]
            else:
                pdf["spans"] = [[{"start": s, "end": e, "kind": KINDS[k]} for s, k, e in x] for x in spans]
            yield pdf[names]

    return docs.mapInPandas(lean(run), schema)


def digest_spans(docs: DataFrame, formats: Formats) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans as text."""
    model = docs.sparkSession.sparkContext.broadcast(formats)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        find = model.value.spans
        for pdf in batches:
            rows = []
            for doc, t in zip(pdf.doc_id, pdf.text):
                spans = find(t) if t else []
                base = [x for x in spans if x[1] < 3]
                n = [sum(x[1] == k for x in base) for k in range(3)]
                rows.append((doc, *n, hashlib.sha256(span_text(base).encode()).hexdigest(), span_text(spans)))
            yield pd.DataFrame(rows, columns=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInPandas(lean(run), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
