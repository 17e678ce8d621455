"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

A text's features are the distinct words it holds, in lower case and without punctuation around them, and
their first four and five characters, hashed to DIMENSIONS places; a feature is there or not. One
weight vector serves all ordered thresholds: P(grade >= k) = logistic(w.x - t_k), t_1 < t_2 < ...
Expected severity is the sum of these probabilities, and a text is toxic if P(grade >= 1) reaches
CUT.

The model is fitted on at most SAMPLE labelled documents, TOXIC_SHARE of them toxic where there
are as many, taken in the order of a hash of their ids. That share, not the smaller one among all documents, is the
prior that probabilities refer to, so that rare toxic texts are not passed over. The labels tell toxic from clean. Toxic documents are graded 2 (severe)
instead of 1 if they hold at least SEVERE different words that stand in two or more toxic and in no clean
document of the sample. Every document is scored on its whole text.

Defined results. A null or empty text has no features and the severity of the thresholds alone.
Labels that are null, or whose document is missing, are left out; of several labels of one
document the largest counts. Without toxic or without clean labelled documents nothing is toxic. A
probability equal to CUT is toxic. Repeated rows get the same. An empty table gives no rows. Rows without an
id are scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from tradeflow.llm.common import fresh, quoted

DIMENSIONS = 1 << 20
PREFIXES = (4, 5)
SAMPLE, TOXIC_SHARE = 6000, 1 / 3
SEVERE = 5
CUT = 0.5
LEAST_Z, LEAST_SHARE = 5.0, 0.01
ROUNDS, RATE, PENALTY = 500, 0.05, 0.02
CACHED = 600_000
EDGES = ".,;:!?\"'()[]{}<>*#$%&|/\\-_=+~^`"
SEED = 11


class Words(dict):
    """Place of a raw word in a table of its features: the word and its beginnings."""

    def __init__(self):
        super().__init__()
        self.table = np.zeros((1 << 14, 1 + len(PREFIXES)), dtype=np.int64)

    def __missing__(self, raw: bytes) -> int:
        at = len(self)
        if at == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        word = raw.decode().lower().strip(EDGES)
        names = [word, *(f"{n}:{word[:n]}" for n in PREFIXES)]
        self.table[at] = [xxhash.xxh64_intdigest(n, SEED) % DIMENSIONS for n in names]
        self[raw] = at
        return at


_words = Words()


def rows_of(text: str | None) -> np.ndarray:
    """Features of each distinct raw word of a text, a row each."""
    if len(_words) > CACHED:
        _words.clear()
    raw = set((text or "").encode().split())
    places = np.fromiter(map(_words.__getitem__, raw), np.int64, len(raw))
    return _words.table[places]


SAMPLED = T.StructType(
    [
        T.StructField("features", T.BinaryType()),
        T.StructField("words", T.BinaryType()),
    ]
)


@pandas_udf(SAMPLED)
def sampled_features(texts: pd.Series) -> pd.DataFrame:
    """Features of a text, and those of them that are whole words, as 32-bit integers in bytes."""
    out = {"features": [], "words": []}
    for text in texts:
        rows = rows_of(text)
        out["features"].append(np.unique(rows).astype("<i4").tobytes())
        out["words"].append(np.unique(rows[:, 0]).astype("<i4").tobytes())
    return pd.DataFrame(out)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... by row."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds - scores[:, None], -60, 60)))


def telling(columns: np.ndarray, toxic: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Which features stand in a larger share of toxic than of clean documents, beyond chance.

    Most features of a text are rare words that say nothing; fitted, they would drown the few
    that do in long texts. A feature stays if its share exceeds the other by LEAST_Z standard errors
    and is at least LEAST_SHARE, so that one group of copies does not make its words telling.
    """
    a = np.bincount(columns[toxic], minlength=DIMENSIONS)
    b = np.bincount(columns[~toxic], minlength=DIMENSIONS)
    both = (a + b) / (n_toxic + n_clean)
    error = np.sqrt(np.maximum(both * (1 - both), 1e-12) * (1 / n_toxic + 1 / n_clean))
    return (a >= LEAST_SHARE * n_toxic) & (a > 1) & (a / n_toxic - b / n_clean >= LEAST_Z * error)


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, levels: int) -> Model:
    """Weights and thresholds of largest penalised likelihood, by scaled gradient steps.

    Weights stay at zero or above: a text can hold signs of toxicity, not signs against it.
    """
    columns = np.concatenate(rows)
    lengths = np.array([len(r) for r in rows])
    known = telling(columns, np.repeat(grades > 0, lengths), (grades > 0).sum(), (grades == 0).sum())
    row = np.repeat(np.arange(len(rows)), lengths)[known[columns]]
    used, columns = np.unique(columns[known[columns]], return_inverse=True)
    n = len(used)
    # Weights and thresholds side by side; steps are scaled by running means of the gradient (Adam).
    values = np.concatenate([np.zeros(n), np.linspace(0.0, 2.0, levels)])
    mean, square = np.zeros_like(values), np.zeros_like(values)
    k = np.arange(1, levels + 1)
    for step in range(1, ROUNDS + 1):
        weights, thresholds = values[:n], values[n:]
        scores = np.bincount(row, weights[columns], len(rows))
        up = Model(weights, thresholds).at_least(scores)
        # P(grade = j) = up_j - up_(j+1); derivatives of its logarithm by the score and thresholds.
        edges = np.concatenate([np.ones((len(rows), 1)), up, np.zeros((len(rows), 1))], axis=1)
        slope = edges * (1 - edges)
        at = np.arange(len(rows))
        chance = np.maximum(edges[at, grades] - edges[at, grades + 1], 1e-9)
        by_score = (slope[at, grades] - slope[at, grades + 1]) / chance
        lower = (grades[:, None] == k) * (slope[at, grades] / chance)[:, None]
        upper = (grades[:, None] == k - 1) * (slope[at, grades + 1] / chance)[:, None]
        gradient_t = (upper - lower).sum(axis=0)
        gradient_w = np.bincount(columns, by_score[row], n) - PENALTY * weights
        gradient = np.concatenate([gradient_w, gradient_t])
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        scale = np.sqrt(square / (1 - 0.99**step)) + 1e-8
        values = values + RATE * mean / (1 - 0.9**step) / scale
        values[:n] = np.maximum(values[:n], 0.0)
        values[n:] = np.sort(values[n:])
    weights = np.zeros(DIMENSIONS)
    weights[used] = values[:n]
    return Model(weights, values[n:])


def grade(toxic: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """0 clean, 1 toxic, 2 severe, by the number of words that only toxic documents hold."""
    by = [np.zeros(DIMENSIONS, dtype=np.int32) for _ in range(2)]
    for t, w in zip(toxic, words, strict=True):
        by[int(t)][w] += 1
    marked = (by[1] >= 2) & (by[0] == 0)
    n = np.array([int(marked[w].sum()) for w in words])
    return np.where(toxic, 1 + (n >= SEVERE), 0).astype(np.int64)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> Model | None:
    """Model of the labelled documents (key, toxic); None if one of the two kinds is missing."""
    known = labels.filter("key IS NOT NULL AND toxic IS NOT NULL").groupBy("key").agg(
        (F.max("toxic") > 0).alias("toxic")
    )
    order = F.xxhash64(F.lit(SEED), "key")
    most = {True: int(SAMPLE * TOXIC_SHARE), False: SAMPLE - int(SAMPLE * TOXIC_SHARE)}
    some = [known.filter(F.col("toxic") == t).orderBy(order, "key").limit(n) for t, n in most.items()]
    some = some[0].unionByName(some[1])  # at most SAMPLE rows, so it may be broadcast
    texts = docs.select(quoted(key).alias("key"), quoted(text).alias("text"))
    chosen = (
        texts.join(F.broadcast(some), "key")
        .orderBy(order, "key", F.xxhash64("text"))
        .limit(SAMPLE)
        .select("toxic", sampled_features("text").alias("f"))
        .select("toxic", "f.*")
        .collect()
    )
    toxic = np.array([r["toxic"] for r in chosen], dtype=bool)
    if not len(toxic) or toxic.all() or not toxic.any():
        return None
    arrays = lambda name: [np.frombuffer(r[name], "<i4") for r in chosen]
    grades = grade(toxic, arrays("words"))
    return fit_ordinal(arrays("features"), grades, 2)


SCORED = T.StructType(
    [
        T.StructField("severity", T.DoubleType()),
        T.StructField("p_toxic", T.DoubleType()),
        T.StructField("toxic", T.BooleanType()),
    ]
)


def judged(text: Column, model: Model | None) -> Column:
    """severity, p_toxic and toxic of a text column, as a struct."""
    if model is None:
        none = F.struct(F.lit(0.0).alias("severity"), F.lit(0.0).alias("p_toxic"), F.lit(False).alias("toxic"))
        return F.when(text.isNull(), none).otherwise(none)

    used = np.nonzero(model.weights)[0]  # few: the rest need not travel to the tasks
    values, model = model.weights[used], Model(model.weights[:0], model.thresholds)

    @pandas_udf(SCORED)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        weights = np.zeros(DIMENSIONS)
        weights[used] = values
        for texts in batches:
            scores = np.array([weights[np.unique(rows_of(t))].sum() for t in texts], dtype=float)
            up = model.at_least(scores)
            yield pd.DataFrame(
                {"severity": up.sum(axis=1), "p_toxic": up[:, 0], "toxic": up[:, 0] >= CUT}
            )

    return score(text)


def without_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are not toxic, with the columns of docs."""
    model = fit(docs, labels, key, text)
    (found,) = fresh(docs.columns, "toxicity")
    columns = [quoted(c) for c in docs.columns]
    scored = docs.select(*columns, judged(quoted(text), model).alias(found))
    return scored.filter(~quoted(found)["toxic"]).select(*columns)


def labelled(labels: DataFrame) -> DataFrame:
    return labels.select(F.col("doc_id").alias("key"), F.col("toxic").cast("int").alias("toxic"))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Severity of every document."""
    model = fit(docs, labelled(labels))
    found = docs.select("doc_id", judged(F.col("text"), model).alias("found"))
    return found.select("doc_id", "found.*")
