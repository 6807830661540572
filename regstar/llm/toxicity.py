"""Toxicity: a counterfactually regularised classifier.

A logistic regression over a text's distinct words. A word brings three
features: itself and its beginnings of four and five letters, so that a word
never seen with a label is judged by its stem. Besides the log-loss and an L1
penalty (most features get no weight at all, so long texts gather no noise),
training penalises what an identity term does to a score: labelled sentences
that mention a group are copied with the term swapped for others of its kind,
and labelled sentences also get a neutral mention put in; the squared change
of the score is added to the loss. Naming a group then moves no score.

The model is fitted on a bounded sample of labelled rows (``max_rows``), all
documents are scored by it. Only the text is an input.

Defined cases: a null text is an empty text, scored by the intercept; several
labels of one document count as toxic if one is; a label without a document,
or null, is left out; without labels of both kinds the score is the smoothed
share of toxic ones for every text; repeated rows are scored alike; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regstar.llm.shared import columns, for_workers

#: Names of groups, by kind. Terms of a kind are swapped.
IDENTITY_TERMS = {
    "religion": ("muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic"),
    "religions": ("muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics"),
    "origin": ("black", "white", "asian", "latino", "african", "arab", "indian", "european", "mexican", "chinese"),
    "origins": ("immigrants", "refugees", "foreigners", "migrants", "africans", "arabs", "asians", "mexicans"),
    "gender": ("woman", "man", "girl", "boy"),
    "genders": ("women", "men", "girls", "boys"),
    "orientation": ("gay", "lesbian", "bisexual", "transgender", "straight", "queer"),
    "ability": ("disabled", "blind", "deaf", "autistic"),
    "german": ("frauen", "männer", "muslime", "christen", "juden", "ausländer", "schwule", "lesben"),
    "french": ("femmes", "hommes", "musulmans", "chrétiens", "juifs", "étrangers", "homosexuels"),
    "spanish": ("mujeres", "hombres", "musulmanes", "cristianos", "judíos", "inmigrantes", "homosexuales"),
}
_OTHERS = {t: [x for x in kind if x != t] for kind in IDENTITY_TERMS.values() for t in kind}
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> set[str]:
    """Distinct words of a whole text, in lower case."""
    return set(_WORD.findall((text or "").lower()))


def features_of(word: str) -> tuple[str, ...]:
    """The word, and its beginnings."""
    return ("w:" + word, "4:" + word[:4], "5:" + word[:5])


def counterfactuals(texts: list[set[str]], seed: int = 5) -> list[tuple[set[str], set[str]]]:
    """Pairs of word sets that should score alike: each mention swapped for
    two others of its kind, and every text with one neutral mention put in."""
    rng, terms, pairs = np.random.default_rng(seed), sorted(_OTHERS), []
    for words in texts:
        for term in sorted(words & _OTHERS.keys()):
            others = _OTHERS[term]
            for i in rng.permutation(len(others))[:2]:
                pairs.append((words, words - {term} | {others[i]}))
        pairs.append((words, words | {terms[rng.integers(len(terms))]}))
    return pairs


class _Matrix:
    """Sparse rows: for each row its features (repeats count) and signs."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]], width: int):
        self.row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
        self.col = np.concatenate([r[0] for r in rows]) if rows else np.zeros(0, np.int64)
        self.val = np.concatenate([r[1] for r in rows]) if rows else np.zeros(0)
        self.shape = (len(rows), width)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.col] * self.val, self.shape[0])

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, g[self.row] * self.val, self.shape[1])


def train(
    texts: list[set[str]], toxic: list[int], *, counterfactual: float = 1.0, sparse: float = 8e-4, rounds: int = 400
) -> tuple[dict[str, float], float]:
    """(weight by feature, intercept). Features in fewer than three of the
    texts are not learned. Toxic texts, the fewer, count threefold."""
    y = np.array(toxic, float)
    prior = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(prior / (1 - prior)))
    weight = np.where(y > 0, 3.0, 1.0)
    weight /= weight.sum()
    if not 0 < y.sum() < len(y):
        return {}, start
    seen: dict[str, int] = {}
    for words in texts:
        for f in {f for w in words for f in features_of(w)}:
            seen[f] = seen.get(f, 0) + 1
    names = sorted(f for f, n in seen.items() if n >= 3)
    for term in _OTHERS:  # known even where no labelled text mentions them
        names += [f for f in features_of(term) if seen.get(f, 0) < 3]
    names = sorted(set(names))
    number = {f: i for i, f in enumerate(names)}

    def numbers(words: set[str]) -> np.ndarray:
        return np.array([number[f] for w in words for f in features_of(w) if f in number], np.int64)

    x = _Matrix([((n := numbers(t)), np.ones(len(n))) for t in texts], len(names))
    changes = []
    for a, b in counterfactuals(texts):
        minus, plus = numbers(a - b), numbers(b - a)
        changes.append((np.concatenate((minus, plus)), np.concatenate((-np.ones(len(minus)), np.ones(len(plus))))))
    c = _Matrix(changes, len(names))
    # Accelerated proximal gradient, each feature scaled by its frequency so
    # that words of every text do not slow down the others.
    scale = 1 / np.sqrt(1.0 + np.bincount(x.col, x.val, len(names)) / 3)
    power = np.ones(len(names))
    for _ in range(8):  # largest curvature, for the step length
        power = scale * (x.back(weight * x.dot(scale * power)) / 4 + counterfactual * c.back(c.dot(scale * power)) / c.shape[0])
        curvature = np.linalg.norm(power)
        power /= curvature
    step = 1 / (1.1 * curvature + 0.25)
    u, b, seen_u, seen_b, t = np.zeros(len(names)), start, np.zeros(len(names)), start, 1.0
    for _ in range(rounds):
        w = scale * seen_u
        error = weight * (1 / (1 + np.exp(-np.clip(x.dot(w) + seen_b, -30, 30))) - y)
        gradient = x.back(error) + counterfactual * c.back(c.dot(w)) / c.shape[0]
        new = seen_u - step * scale * gradient
        new = np.sign(new) * np.maximum(np.abs(new) - step * sparse * scale, 0)
        new_b = seen_b - step * error.sum()
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        seen_u, seen_b = new + (t - 1) / t_new * (new - u), new_b + (t - 1) / t_new * (new_b - b)
        u, b, t = new, new_b, t_new
    w = scale * u
    return {names[i]: float(w[i]) for i in np.flatnonzero(w)}, float(b)


class Scorer:
    """Scores of texts; the sum of a word's features is kept by word."""

    KEEP = 400_000

    def __init__(self, weights: dict[str, float], intercept: float):
        self.weights, self.intercept, self.by_word = weights, intercept, {}

    def word(self, word: str) -> float:
        found = self.by_word.get(word)
        if found is None:
            if len(self.by_word) >= self.KEEP:
                self.by_word.clear()
            found = self.by_word[word] = sum(self.weights.get(f, 0.0) for f in features_of(word))
        return found

    def score(self, text: str | None) -> float:
        # Sorted: a sum in one order is the same wherever the text is scored.
        z = self.intercept + sum(sorted(filter(None, map(self.word, words_of(text)))))
        return float(1 / (1 + np.exp(-min(30.0, max(-30.0, z)))))


def labelled_sample(docs: DataFrame, labels: DataFrame, usable, max_rows: int) -> pd.DataFrame:
    """At most ``max_rows`` (text, toxic) of documents with a label: those
    with the smallest hashes of their doc_id, whatever the files' order."""
    known = columns(labels, "doc_id", "toxic").where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    known = known.where(usable(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # Labels of rows that are not in ``docs`` take no place of the bound.
    known = known.join(columns(docs, "doc_id"), "doc_id", "left_semi")
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    texts = columns(docs, "doc_id", "text").join(F.broadcast(some), "doc_id")
    # A document's rows beyond the first are repeats; the bound holds with them.
    return texts.orderBy(F.xxhash64("doc_id"), "doc_id", "text").select("text", "toxic").limit(max_rows).toPandas()


def score_documents(docs: DataFrame, labels: DataFrame, usable, *, max_rows: int = 4000) -> DataFrame:
    """(doc_id, score) for each row of ``docs`` (doc_id, text), by a model of
    the ``labels`` (doc_id, toxic) for whose doc_id ``usable`` holds."""
    spark = for_workers(docs.sparkSession)
    sample = labelled_sample(docs, labels, usable, max_rows)
    model = spark.sparkContext.broadcast(train([words_of(t) for t in sample.text], sample.toxic.astype(int).tolist()))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*model.value)
        for batch in batches:
            scores = [scorer.score(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return columns(docs, "doc_id", "text").mapInArrow(score, "doc_id long, score double")
