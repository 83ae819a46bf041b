"""Toxicity by class-conditional Kneser-Ney models of characters in words.

Two models, of toxic and of ordinary labelled texts, give each word (an expression) a
log-likelihood. Orders 5 to 3 are counted per class; orders 2 and 1 are shared continuation
counts of both, so that a rare expression is judged by the frames it shares with
known ones. The discount of 2 is the best of 0.75, 1, 1.5 and 2 on labelled texts that were held out, better than discounts
estimated from counts of counts: words repeat within a text, so that small counts come from single texts.

A toxic text is mostly ordinary words. Its words are therefore taken as drawn from the toxic model at a rate of ``RATES[1]``
and from the ordinary one otherwise, those of an ordinary text at a rate of ``RATES[0]``; what is compared is the difference of the
two log-likelihoods of the text, normalised by the root of its length in words, as which chance differences grow.
A curve that rises in this one number maps it to 0..1; it is fitted, by isotonic regression, on what models of two thirds of the sample say of the last.

Labels come from a bounded sample: the ``per_class`` documents of each class with
the smallest hashes. Rows whose label or id is null are not learnt from; a document with
several labels counts as toxic if any says so. Null and empty texts get the
curve's value at zero. Every row is scored, very long texts whole, repeated ones alike; an empty
table gives no rows. Without labelled documents of both classes all scores are 0. Other columns pass through; one
named like the result is replaced.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from paperloom.llm.common import _LOWER, Scratch, lean

ORDER, SHARED, DISCOUNT = 5, 2, 2.0
RATES, STRONGEST, FOLDS = (0.0003, 0.02), 10.0, 3
START, STOP = "\x02", "\x03"
TRIM = b".,;:!?\"'()[]"


def grams(word: str) -> list[str]:
    """All runs of ORDER characters of the word, padded at its start and ended."""
    padded = START * (ORDER - 1) + word + STOP
    return [padded[i : i + ORDER] for i in range(len(word) + 1)]


Level = tuple[dict, dict]


def _levels(counts: dict, high: int, low: int) -> list[Level]:
    """Lowest order first: what a gram's discounted count gives, and what its context leaves to the lower order. Below ``high``, continuation counts."""
    out = []
    for n in range(high, 0, -1):
        if n >= low:
            total, cut = defaultdict(float), defaultdict(float)
            for g, c in counts.items():
                total[g[:-1]] += c
                cut[g[:-1]] += min(c, DISCOUNT)
            out.append(({g: (c - DISCOUNT) / total[g[:-1]] for g, c in counts.items() if c > DISCOUNT}, {h: cut[h] / t for h, t in total.items()}))
        counts = Counter(g[1:] for g in counts)  # distinct left neighbours
    return out[::-1]


class KneserNeyPair:
    """Both classes' models over the same shared lower orders."""

    def __init__(self, toxic: Counter, ordinary: Counter) -> None:
        both = toxic + ordinary
        self.floor = 1 / (len({g[-1] for g in both}) + 1)
        self.shared = _levels(both, ORDER, 1)[:SHARED]
        self.classes = [_levels(c, ORDER, SHARED + 1) for c in (toxic, ordinary)]
        self.memo: dict[str, float] = {}

    @staticmethod
    def _lift(p: float, gram: str, order: int, levels: list[Level]) -> float:
        """Mixes the levels' discounted counts into a lower-order probability, up to the longest context that was seen."""
        at = ORDER - order
        for own, left in levels:
            if (rest := left.get(gram[at:-1])) is None:
                break
            p = own.get(gram[at:], 0.0) + rest * p
            at -= 1
        return p

    def chances(self, gram: str) -> tuple[float, float]:
        """P(last character | those before) in a toxic and in an ordinary text."""
        low = self._lift(self.floor, gram, 1, self.shared)
        return self._lift(low, gram, SHARED + 1, self.classes[0]), self._lift(low, gram, SHARED + 1, self.classes[1])

    def evidence(self, gram: str) -> float:
        if (found := self.memo.get(gram)) is None:
            if len(self.memo) > 150_000:
                self.memo.clear()
            toxic, ordinary = self.chances(gram)
            found = self.memo[gram] = math.log(toxic / ordinary)
        return found


@dataclass
class ToxicityModel:
    pair: KneserNeyPair | None = None
    knots: list[float] = field(default_factory=list)
    shares: list[float] = field(default_factory=list)
    memo: dict[bytes, float] = field(default_factory=dict)

    def evidence(self, word: bytes) -> float:
        """Difference of a word's log-likelihoods in a toxic and in an ordinary text, each a mixture of the two models."""
        if (found := self.memo.get(word)) is None:
            if len(self.memo) > 100_000:
                self.memo.clear()
            text = word.strip(TRIM).decode()
            odds = math.exp(min(sum(map(self.pair.evidence, grams(text))), STRONGEST)) - 1 if text else 0.0
            found = self.memo[word] = math.log1p(RATES[1] * odds) - math.log1p(RATES[0] * odds)
        return found

    def compared(self, text: str | None) -> float:
        """The text's normalised difference of log-likelihoods."""
        words = text.encode().translate(_LOWER).split() if text else []
        return sum(map(self.evidence, words)) / math.sqrt(len(words)) if words and self.pair else 0.0

    def score(self, text: str | None) -> float:
        return self.likelihood(self.compared(text))

    def likelihood(self, x: float) -> float:
        """The curve: shares of toxic texts between its knots, and a hundredth of a logistic curve, so that it rises everywhere."""
        if not self.knots:
            return 0.0
        return 0.99 * float(np.interp(x, self.knots, self.shares)) + 0.01 / (1 + math.exp(-max(-60.0, min(60.0, x))))

    def calibrate(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """The rising step function that is nearest to the labels (adjacent violators are pooled), linear between the steps' means. ``x`` is sorted."""
        blocks: list[list[float]] = []  # weight, weight of toxic texts, weight times x
        for u, v, w in zip(x.tolist(), y.tolist(), weight.tolist()):
            block = [w, w * v, w * u]
            while blocks and blocks[-1][1] * block[0] >= block[1] * blocks[-1][0]:
                block = [p + q for p, q in zip(blocks.pop(), block)]
            blocks.append(block)
        self.knots = [b[2] / b[0] for b in blocks]
        self.shares = [b[1] / b[0] for b in blocks]


def labelled_sample(docs: DataFrame, labels: DataFrame, learnable: Column, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, toxic, fold) of the sample, and the labelled documents per class. ``learnable`` is a condition on doc_id."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & learnable).groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    picked = [r for y in (0, 1) for r in rows.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).collect()]
    ids = docs.sparkSession.createDataFrame([(r["doc_id"], r["toxic"], i % FOLDS) for i, r in enumerate(picked)], "doc_id long, toxic int, fold int")
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id"), sizes  # at most 2 * per_class ids


def fit(docs: DataFrame, labels: DataFrame, learnable: Column, per_class: int = 3000) -> ToxicityModel:
    sample, sizes = labelled_sample(docs, labels, learnable, per_class)
    if len(sizes) < 2:
        return ToxicityModel()
    scratch = Scratch(docs.sparkSession)
    sample = scratch.keep(sample, "toxicity-sample")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for (toxic, fold), part in pdf.groupby(["toxic", "fold"]):
                words = Counter()
                for text in part.text.fillna(""):
                    words.update(w.strip(TRIM) for w in text.encode().translate(_LOWER).split())
                found = Counter()
                for word, n in words.items():
                    if word:
                        for g in grams(word.decode()):
                            found[g] += n
                yield pd.DataFrame({"toxic": int(toxic), "fold": int(fold), "gram": list(found), "n": list(found.values())})

    counted = sample.select("toxic", "fold", "text").mapInPandas(lean(count), "toxic int, fold int, gram string, n long")
    each = [(y, f) for y in (0, 1) for f in range(FOLDS)]
    rows = counted.groupBy("gram").agg(*[F.coalesce(F.sum(F.when((F.col("toxic") == y) & (F.col("fold") == f), F.col("n"))), F.lit(0)).alias(f"n{y}{f}") for y, f in each]).orderBy("gram").toPandas()  # the sample's grams

    def models(folds: list[int]) -> KneserNeyPair | None:
        own = [Counter({g: int(n) for g, n in zip(rows.gram, rows[[f"n{y}{f}" for f in folds]].sum(axis=1)) if n}) for y in (0, 1)]
        return KneserNeyPair(own[1], own[0]) if all(own) else None

    def compared(fold: int) -> pd.DataFrame:
        """What the models of the other folds say of a fold's texts."""
        if (pair := models([f for f in range(FOLDS) if f != fold])) is None:
            return pd.DataFrame({"x": [], "toxic": []})
        shared = docs.sparkSession.sparkContext.broadcast(ToxicityModel(pair))

        def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                yield pd.DataFrame({"x": [shared.value.compared(t) for t in pdf.text], "toxic": pdf.toxic.to_numpy()})

        found = sample.where(F.col("fold") == fold).select("toxic", "text").mapInPandas(lean(measure), "x double, toxic int").toPandas()  # a share of the sample
        shared.unpersist()
        return found

    pair = models(list(range(FOLDS)))
    found = pd.concat([compared(f) for f in range(FOLDS)]).sort_values(["x", "toxic"]) if pair else pd.DataFrame({"toxic": []})
    scratch.drop("toxicity-sample")
    if found.toxic.nunique() < 2:
        return ToxicityModel()
    y = found.toxic.to_numpy()
    weight = np.where(y == 1, sizes[1] / (y == 1).sum(), sizes[0] / (y == 0).sum())
    model = ToxicityModel(pair)
    model.calibrate(found.x.to_numpy(), y, weight / weight.mean())
    return model


def score(docs: DataFrame, model: ToxicityModel, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score as a further column; a column of that name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.drop(out).schema.add(out, "double")
    names = [f.name for f in schema]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf[out] = [shared.value.score(t) for t in pdf[text]]
            yield pdf[names]

    return docs.mapInPandas(lean(run), schema)
