"""Toxicity: a logistic classifier whose score must not move when identity terms change.

Features are the distinct lower-case words of a text.  The model learns from a bounded
sample of labelled rows.  For every sampled text that names a group, a counterfactual text
names another group of the same kind instead; the squared change of the logit is penalised
beside the usual loss, so a neutral mention of a group cannot carry the decision, even where
the labels would make it look telling.  How many words are used, and how strongly weights
are held back, is decided on a part of the sample set aside.

Bounds, the same at every size of input: ``SAMPLE_ROWS`` labelled rows (those whose hashed
id is lowest), ``VOCABULARY_WORDS`` words (those whose use differs most between the classes,
counted by Spark).  Scoring reads whole texts, row by row, without a shuffle.

A null or empty text has no words and gets the score of the prior; null labels and labels of
unknown documents are left out; a document with several labels is toxic if one says so;
repeated rows are scored one by one; without labelled rows every score is 0.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLE_ROWS = 12_000
VOCABULARY_WORDS = 4096
MIN_DOCS = 3
COUNTERFACTUAL_PENALTY = 10.0
CHOICES = tuple((words, ridge) for words in (32, 256, VOCABULARY_WORDS) for ridge in (1e-4, 1e-3))

# Terms of one line can stand for each other.
IDENTITY_GROUPS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("girl", "boy"), ("female", "male"),
    ("gay", "straight"), ("lesbian", "heterosexual"), ("transgender", "cisgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"), ("african", "european", "american", "arab"),
    ("immigrants", "citizens"), ("immigrant", "citizen"), ("disabled", "abled"), ("old", "young"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("ausländer", "inländer"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("immigrés", "citoyens"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"), ("inmigrantes", "ciudadanos"),
)

_WORD = re.compile(r"[^\W_]+")


def _swaps() -> dict[str, str]:
    return {g[i]: g[(i + 1) % len(g)] for g in IDENTITY_GROUPS for i in range(len(g))}


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


@dataclass
class Model:
    weights: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        hits = self.weights.keys() & words_of(text)
        logit = self.bias + math.fsum(self.weights[w] for w in hits)
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, logit))))


@dataclass
class Rows:
    """Sparse 0/1 features: ``column[i]`` is set in row ``row[i]``."""

    row: np.ndarray
    column: np.ndarray
    n: int

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.column], minlength=self.n)

    def back(self, values: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.column, values[self.row], minlength=width)

    def part(self, rows: np.ndarray, width: int) -> Rows:
        """The chosen rows, with columns below ``width`` only."""
        place = np.full(self.n, -1)
        place[rows] = np.arange(len(rows))
        own = (place[self.row] >= 0) & (self.column < width)
        return Rows(place[self.row[own]], self.column[own], len(rows))


def train(
    rows: Rows, labels: np.ndarray, pairs: np.ndarray, width: int, ridge: float, penalty: float, steps: int = 300
) -> tuple[np.ndarray, float]:
    """Weights and bias.  ``pairs`` lists (term, counterpart) columns, one per counterfactual."""
    weights, share = np.zeros(width), (labels.sum() + 0.5) / (len(labels) + 1)
    bias = math.log(share / (1 - share))
    mean, square = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1):
        logit = np.clip(rows.times(weights) + bias, -50, 50)
        error = (1 / (1 + np.exp(-logit)) - labels) / len(labels)
        slope = rows.back(error, width) + ridge * weights
        if len(pairs):
            change = 2 * penalty / len(pairs) * (weights[pairs[:, 0]] - weights[pairs[:, 1]])
            slope += np.bincount(pairs[:, 0], change, minlength=width) - np.bincount(
                pairs[:, 1], change, minlength=width
            )
        slope = np.append(slope, error.sum())
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        move = 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-9)
        weights -= move[:-1]
        bias -= move[-1]
    return weights, float(bias)


def _loss(rows: Rows, labels: np.ndarray, weights: np.ndarray, bias: float) -> float:
    logit = np.clip(rows.times(weights) + bias, -50, 50)
    return float(np.mean(np.logaddexp(0, logit) - labels * logit))


def _word_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = [sorted(set(words_of(t))) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(lists, pa.list_(pa.string()))], ["key", "label", "words"]
        )


def labelled_sample(
    docs: DataFrame, labels: DataFrame, usable: Callable, key: str, text: str, label: str, rows: int
) -> DataFrame:
    """``key, label, words`` of at most ``rows`` labelled documents that ``usable(key)`` admits."""
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("key").isNotNull() & F.col("label").isNotNull() & usable(F.col("key")))
    known = known.groupBy("key").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64(F.col("key")), "key").limit(rows)
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    found = texts.join(F.broadcast(chosen), "key").groupBy("key").agg(
        F.min("label").alias("label"), F.min("text").alias("text")
    )
    listed = found.select("key", "label", "text").mapInArrow(
        _word_lists, f"key {docs.schema[key].dataType.simpleString()}, label int, words array<string>"
    )
    return materialize(listed, "toxicity-sample")


def fit(sample: DataFrame, penalty: float = COUNTERFACTUAL_PENALTY, vocabulary: int = VOCABULARY_WORDS) -> Model | None:
    """The model learnt from ``label, words`` rows; None if there are none."""
    totals = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    n, toxic = sum(totals.values()), sum(c for v, c in totals.items() if v == 1)
    if not n:
        return None
    used = sample.select((F.col("label") == 1).cast("int").alias("y"), F.explode("words").alias("word"))
    uses = used.groupBy("word").agg(F.sum("y").alias("toxic"), F.count("*").alias("docs"))
    inside, outside = F.col("toxic") + 0.5, F.col("docs") - F.col("toxic") + 0.5
    odds = F.log(inside / (toxic + 1.0)) - F.log(outside / (n - toxic + 1.0))
    telling = F.abs(odds) / F.sqrt(1 / inside + 1 / outside)
    swaps = _swaps()
    words = uses.where((F.col("docs") >= MIN_DOCS) & ~F.col("word").isin(*swaps))
    top = [r["word"] for r in words.orderBy(telling.desc(), "word").limit(vocabulary).collect()]
    # identity terms come first, so that every choice of width holds them
    columns = {w: i for i, w in enumerate([*swaps, *top])}
    index = sample.sparkSession.createDataFrame(list(columns.items()), "word string, i int")
    listed = sample.select(F.xxhash64("key").alias("h"), "key", (F.col("label") == 1).cast("int").alias("y"), "words")
    hits = listed.select("h", "key", F.explode("words").alias("word")).join(F.broadcast(index), "word")
    hits = hits.groupBy("h", "key").agg(F.collect_list("i").alias("i"))
    table = listed.join(hits, ["h", "key"], "left").select("h", "key", "y", "i").orderBy("h", "key").toArrow()
    labels = table["y"].to_numpy().astype(float)
    lists = [sorted(x or []) for x in table["i"].to_pylist()]
    row = np.repeat(np.arange(n), [len(x) for x in lists])
    rows = Rows(row, np.array([i for x in lists for i in x], np.int64), n)
    other = np.array([columns[swaps[w]] for w in swaps], np.int64)
    named = rows.column[rows.column < len(swaps)]
    pairs = np.stack([named, other[named]], 1) if len(named) else np.zeros((0, 2), np.int64)

    held = np.arange(n) % 4 == 3
    losses = []
    for count, ridge in CHOICES if held.any() else CHOICES[:1]:
        width = len(swaps) + min(count, len(top))
        inner, outer = (rows.part(np.flatnonzero(x), width) for x in (~held, held))
        weights, bias = train(inner, labels[~held], pairs, width, ridge, penalty)
        losses.append((_loss(outer, labels[held], weights, bias) if held.any() else 0.0, width, ridge))
    _, width, ridge = min(losses)
    weights, bias = train(rows.part(np.arange(n), width), labels, pairs, width, ridge, penalty)
    return Model({w: float(weights[i]) for w, i in columns.items() if i < width}, bias)


def score_documents(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score`` of every row."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(t) if model else 0.0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["k0", "score"])

    rows = docs.select(F.col(key).alias("k0"), F.col(text).alias("text"))
    kind = rows.schema["k0"].dataType.simpleString()
    return rows.mapInArrow(score, f"k0 {kind}, score double").select(F.col("k0").alias(key), "score")


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    usable: Callable = lambda key: F.lit(True),
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``key, score`` of all documents, learnt from the labels of the keys that are ``usable``."""
    return score_documents(docs, fit(labelled_sample(docs, labels, usable, key, text, label, rows)), key, text)
