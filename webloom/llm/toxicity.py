"""Toxicity severity by cumulative-link ordinal regression on sparse text features.

Grades are ordered: 0 not toxic, 1 mild, 2 severe. One weight vector is shared by all thresholds:
P(grade > k) = sigmoid(w x - t_k) with t_0 < t_1, and the output is the expected severity, the sum of these.

Features are the presence of words and of word beginnings, so that inflected forms of a term count as well. The
model is fitted on a bounded sample of labelled documents (``sample`` rows, chosen by hash); features are
counted in a Spark job, and the ``selected`` ones that differ most between the labels are kept. Labels are 0 or 1
only; a toxic document's grade is 2 when it holds more than the median number of strong toxic terms.

Scoring covers all documents and whole texts, partition by partition, without a shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from webloom.llm.common import release_memory

#: Labelled documents that the model is fitted on, at most.
SAMPLE = 20_000
#: Features kept, at most.
SELECTED = 4_096
#: Toxic documents of the sample that a feature must occur in.
LEAST_TOXIC = 5
#: Standard errors by which a feature's shares among toxic and clean documents differ, at least.
LEAST_GAP = 6.0
#: Lengths of word beginnings.
BEGINNINGS = (4, 5, 6, 7)
GRADES = 3
SEED = 10
#: Words whose features a scoring task remembers before its memory is emptied.
WORDS_REMEMBERED = 100_000
#: Expected severity from which a document counts as toxic.
THRESHOLD = 0.5

_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str) -> list[str]:
    """A word itself, and its beginnings (marked by a hyphen) where it is longer."""
    return [word, *(f"{word[:k]}-" for k in BEGINNINGS if len(word) > k)]


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


@dataclass
class OrdinalModel:
    """Weights by feature and ordered thresholds."""

    weights: dict[str, float] = field(default_factory=dict)
    thresholds: tuple[float, ...] = (30.0, 30.0)
    _by_word: dict[str, tuple[str, ...]] = field(default_factory=dict, repr=False)

    def present(self, words: Iterable[str]) -> set[str]:
        """The model's features among words."""
        found: set[str] = set()
        if len(self._by_word) > WORDS_REMEMBERED:
            self._by_word.clear()
        for w in words:
            known = self._by_word.get(w)
            if known is None:
                known = self._by_word[w] = tuple(f for f in word_features(w) if f in self.weights)
            if known:
                found.update(known)
        return found

    def above(self, text: str | None) -> list[float]:
        """P(grade > k) for each threshold."""
        z = sum(self.weights[f] for f in sorted(self.present(words_of(text))))
        return [1.0 / (1.0 + float(np.exp(min(t - z, 500.0)))) for t in self.thresholds]


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, n_features: int, n_grades: int = GRADES,
                l2: float = 1e-5, steps: int = 400, rate: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds that minimise the mean negative log likelihood of ordered grades, plus L2.

    ``rows`` are the feature numbers present in each document. Full-batch Adam; thresholds are a first one and
    positive gaps, so they stay ordered. Deterministic.
    """
    lengths = np.fromiter(map(len, rows), np.int64, len(rows))
    at = np.concatenate([np.zeros(0, np.int64), *rows]).astype(np.int64)
    of = np.repeat(np.arange(len(rows)), lengths)
    k = n_grades - 1
    theta = np.zeros(n_features + k)
    theta[n_features] = 2.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    sig = lambda x: 1 / (1 + np.exp(-np.clip(x, -40, 40)))
    n = len(rows)
    for step in range(1, steps + 1):
        w, raw = theta[:n_features], theta[n_features:]
        cuts = np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))
        z = np.bincount(of, w[at], minlength=n)
        # Cumulative probabilities P(y <= j), with 0 and 1 at the ends.
        upto = np.concatenate([np.zeros((n, 1)), sig(cuts[None, :] - z[:, None]), np.ones((n, 1))], axis=1)
        slope = upto * (1 - upto)
        here = np.maximum(upto[np.arange(n), grades + 1] - upto[np.arange(n), grades], 1e-12)
        high, low = slope[np.arange(n), grades + 1] / here, slope[np.arange(n), grades] / here
        dz = (high - low) / n  # of the loss by z
        dcut = np.array([(-high[grades == j]).sum() + low[grades == j + 1].sum() for j in range(k)]) / n
        draw = np.concatenate([[dcut.sum()], [dcut[j:].sum() * np.exp(raw[j]) for j in range(1, k)]])
        grad = np.concatenate([np.bincount(at, dz[of], minlength=n_features) + l2 * w, draw])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        theta = theta - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    raw = theta[n_features:]
    return theta[:n_features], np.cumsum(np.concatenate([raw[:1], np.exp(raw[1:])]))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        sample: int = SAMPLE, selected: int = SELECTED, least: int = LEAST_TOXIC, seed: int = SEED) -> OrdinalModel:
    """Fit the model on at most ``sample`` labelled documents, chosen by a seeded hash of their ids.

    A document labelled several times counts as toxic if one label says so; null labels and ids without a
    document are ignored. Without toxic (or without clean) examples the model finds nothing toxic.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(
        F.col(id_col).cast("long").alias("doc_id")).agg((F.max(label_col) > 0).cast("int").alias("toxic"))
    # At most ``sample`` pairs of numbers: bounded, so broadcast.
    chosen = known.orderBy(F.xxhash64(F.lit(seed), "doc_id"), "doc_id").limit(sample)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "doc_id")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            counts, size = (Counter(), Counter()), [0, 0]
            for text, toxic in zip(pdf["text"], pdf["toxic"], strict=True):
                size[toxic] += 1
                counts[toxic].update({f for w in words_of(text) for f in word_features(w)})
            names = list(counts[0] | counts[1])
            yield pd.DataFrame({"feature": ["", *names], "clean": [size[0], *(counts[0][x] for x in names)],
                                "bad": [size[1], *(counts[1][x] for x in names)]})
        release_memory()

    counted = rows.mapInPandas(count, "feature string, clean long, bad long").groupBy("feature").agg(
        F.sum("clean").alias("clean"), F.sum("bad").alias("bad"))
    counted = counted.persist()
    total = counted.where("feature = ''").first()
    if total is None or not total["clean"] or not total["bad"]:
        counted.unpersist()
        return OrdinalModel()
    both = total["clean"] + total["bad"]
    share = (F.col("clean") + F.col("bad")) / F.lit(float(both))
    gap = (F.col("bad") / total["bad"] - F.col("clean") / total["clean"]) / F.sqrt(
        share * (1 - share) * F.lit(1 / total["bad"] + 1 / total["clean"]))
    best = (counted.where((F.col("feature") != "") & (F.col("bad") >= least) & (share < 1))
            .select("feature", gap.alias("gap")).where(F.abs("gap") >= LEAST_GAP).orderBy(F.abs("gap").desc(), "feature").limit(selected).collect())
    counted.unpersist()
    names = [r["feature"] for r in best]
    if not names:
        return OrdinalModel()
    strong = np.array([r["gap"] > 0 for r in best])
    frame = OrdinalModel(dict.fromkeys(names, 0.0))
    number = {x: i for i, x in enumerate(names)}

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "toxic": pdf["toxic"], "at": [
                sorted(number[f] for f in frame.present(words_of(t))) for t in pdf["text"]]})

    data = sorted(rows.mapInPandas(found, "doc_id long, toxic int, at array<int>").collect())
    at = [np.array(r["at"], np.int64) for r in data]
    terms = np.array([strong[a].sum() for a in at])
    toxic = np.array([r["toxic"] for r in data])
    severe = toxic * (terms > np.median(terms[toxic == 1]))
    weights, cuts = fit_ordinal(at, (toxic + severe).astype(int), len(names))
    return OrdinalModel(dict(zip(names, map(float, weights), strict=True)), tuple(map(float, cuts)))


def severity(model: OrdinalModel, text: Column) -> Column:
    """``struct(expected double, grade int)`` of each text: the expected severity and the likeliest grade.

    Null and empty texts have no feature; their severity is what the thresholds alone give (near 0).
    """

    @F.pandas_udf("struct<expected: double, grade: int>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            above = [model.above(t) for t in texts]
            steps = np.array([[1.0, *a, 0.0] for a in above]).reshape(len(above), -1)
            yield pd.DataFrame({"expected": [sum(a) for a in above], "grade": np.argmax(steps[:, :-1] - steps[:, 1:], axis=1)})
        release_memory()

    return score(text)


def rate(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         threshold: float = THRESHOLD, **options: int) -> DataFrame:
    """One row per input row: ``doc_id, expected_severity, grade, toxic``. Other columns are ignored, repeated
    rows are rated alike, an empty table gives an empty result."""
    model = fit(docs, labels, id_col, text_col, **options)
    scored = docs.select(F.col(id_col).cast("long").alias("doc_id"), severity(model, F.col(text_col)).alias("s"))
    return scored.select("doc_id", F.col("s.expected").alias("expected_severity"), F.col("s.grade").alias("grade"),
                         (F.col("s.expected") >= threshold).alias("toxic"))
