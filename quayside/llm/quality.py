"""Quality classifier: ordinal cumulative-link regression on graded ratings of hashed text."""

from __future__ import annotations

import re
import string
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice
from operator import eq
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.shared import ASCII_LOWER, free

BUCKETS = 1 << 22
TOKEN = re.compile(rb"[a-z0-9\x80-\xff]+|[!-/:-@\[-`{-~]+")  # words and runs of signs
SIGNS = frozenset(string.punctuation.encode())


def shape(words: list[bytes], signs: int) -> list[bytes]:
    """Pseudo-words for the form of a text: how many words differ, repeat the last one, or are signs, in tenths."""
    count = len(words)
    repeats = sum(map(eq, words, islice(words, 1, None)))
    return [b"~different %d" % (10 * len(set(words)) // count), b"~again %d" % (10 * repeats // count), b"~signs %d" % (10 * signs // count)]


def buckets(text: bytes | None) -> np.ndarray:
    """The hash buckets of the different words and sign runs of a text, A to Z lower-cased, and of its shape."""
    words = TOKEN.findall((text or b"").translate(ASCII_LOWER))
    if not words:
        return np.empty(0, dtype=np.int32)
    tokens = set(words)
    tokens.update(shape(words, sum(len(w) > 1 and w[0] in SIGNS for w in words)))
    return np.unique(np.fromiter((crc32(token) % BUCKETS for token in tokens), dtype=np.int32, count=len(tokens)))


@dataclass(frozen=True)
class Model:
    """P(grade > grades[j]) = sigmoid(sum of the text's weights - thresholds[j]), thresholds ascending."""

    grades: tuple[float, ...]
    thresholds: tuple[float, ...]
    where: bytes  # buckets with a weight, int32, ascending
    weights: bytes  # their weights, float32


@lru_cache(maxsize=2)
def dense(where: bytes, weights: bytes) -> np.ndarray:
    table = np.zeros(BUCKETS, dtype=np.float32)
    table[np.frombuffer(where, dtype=np.int32)] = np.frombuffer(weights, dtype=np.float32)
    return table


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit(rows: np.ndarray, features: np.ndarray, grades: np.ndarray, count: int, ridge: float, rounds: int):
    """Weights per feature and ascending thresholds that minimise the mean negative log likelihood.

    ``rows`` and ``features`` list the ones of the sparse matrix, ``grades`` has the grade number of each
    row. Thresholds are the first one and the logarithms of the steps; all are found by Adam.
    """
    levels = int(grades.max()) + 1
    n = len(grades)
    above = np.array([np.clip((grades > j).mean(), 0.5 / n, 1 - 0.5 / n) for j in range(levels - 1)])
    start = -np.log(above / (1 - above))
    value = np.concatenate([np.zeros(count), start[:1], np.log(np.maximum(np.diff(start), 1e-3))])
    first, second = np.zeros_like(value), np.zeros_like(value)
    onehot = np.eye(levels)[grades]
    for step in range(1, rounds + 1):
        w, t = value[:count], np.cumsum(np.concatenate([value[count : count + 1], np.exp(value[count + 1 :])]))
        score = np.bincount(rows, weights=w[features], minlength=n)
        below = sigmoid(t[None, :] - score[:, None])  # P(grade <= j)
        slope = below * (1 - below)
        cumulative = np.hstack([np.zeros((n, 1)), below, np.ones((n, 1))])
        chance = np.maximum(np.diff(cumulative, axis=1), 1e-9)
        pull = onehot / chance  # d log likelihood / d P(grade = j)
        by_threshold = (pull[:, :-1] - pull[:, 1:]) * slope
        by_score = by_threshold.sum(axis=1)  # minus its derivative
        gradient = np.empty_like(value)
        gradient[:count] = np.bincount(features, weights=by_score[rows], minlength=count) / n + ridge * w
        steps = -by_threshold.mean(axis=0)
        gradient[count] = steps.sum()
        gradient[count + 1 :] = np.cumsum(steps[::-1])[::-1][1:] * np.exp(value[count + 1 :])
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        value = value - 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return value[:count], np.cumsum(np.concatenate([value[count : count + 1], np.exp(value[count + 1 :])]))


def associated(rows: np.ndarray, features: np.ndarray, seen: np.ndarray, grades: np.ndarray) -> np.ndarray:
    """How far the mean grade of the rows with a feature is off that of all, in standard deviations: the
    larger of this figure for each cut of the grades in two."""
    n, most = len(grades), np.zeros(len(seen))
    for level in range(1, int(grades.max()) + 1):
        above = (grades >= level).astype(float)
        off = np.bincount(features, weights=(above - above.mean())[rows], minlength=len(seen))
        spread = np.sqrt(np.maximum(seen * (1 - seen / n), 1e-9) * max(above.var(), 1e-9))
        most = np.maximum(most, np.abs(off) / spread)
    return most


def train(
    docs: DataFrame, ratings: DataFrame, id: str = "doc_id", text: str = "text", grade: str = "grade",
    train_rows: int = 8192, least_z: float = 4.5, ridge: float = 2e-5, rounds: int = 600,
) -> Model:
    """Fit on ``train_rows`` rated documents: of the ``train_rows`` ids with the smallest hash, the texts with the smallest.

    The bound is what may come to the driver; with fewer ratings and documents all take part. Rows of one id and
    text count as one document, so repeated rows weigh nothing. ``ratings`` has an id and a numeric grade. Several grades of one id count as the lowest; NULL grades or ids, and ratings
    without a document, count for nothing. A bucket gets a weight if its presence goes with the grade by
    ``least_z`` standard deviations, as a rare word tells nothing. With fewer than two different grades the model gives that grade (none: NULL) to everything.
    """
    rated = ratings.select(F.col(id).alias("_id"), F.col(grade).cast("double").alias("_grade")).dropna()
    chosen = rated.groupBy("_id").agg(F.min("_grade").alias("_grade")).orderBy(F.xxhash64("_id"), "_id").limit(train_rows)
    listed = [(row["_id"], row["_grade"]) for row in chosen.collect()]
    if not listed:
        return Model((), (), b"", b"")
    known = docs.sparkSession.createDataFrame(listed, chosen.schema)
    marks = ["_version", "_check"]
    rows = docs.select(F.col(id).alias("_id"), F.col(text).cast("binary").alias("_text"))
    rows = rows.join(F.broadcast(known), "_id").withColumns({"_version": F.xxhash64("_text"), "_check": F.hash("_text")})
    texts = rows.select("_id", *marks).distinct().orderBy(F.xxhash64("_id", *marks), "_id", *marks).limit(train_rows)
    texts = docs.sparkSession.createDataFrame([tuple(row) for row in texts.collect()], texts.schema)

    @F.pandas_udf("array<int>")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([buckets(x) for x in texts])

    sample = rows.join(F.broadcast(texts), ["_id", *marks], "left_semi").dropDuplicates(["_id", *marks])
    sample = sample.select("_id", *marks, "_grade", hashed("_text").alias("_buckets"))
    table = sample.toArrow().combine_chunks()
    found = table["_grade"].to_numpy()
    grades, numbers = np.unique(found, return_inverse=True)
    if len(grades) < 2:
        return Model(tuple(map(float, grades)), (), b"", b"")
    place = np.empty(len(found), dtype=np.int32)
    place[np.lexsort((*(table[c].to_numpy() for c in marks), found, table["_id"].to_numpy()))] = np.arange(len(found))  # the same sums in any order of arrival
    lists = table["_buckets"].combine_chunks()
    rows = np.repeat(place, np.diff(lists.offsets.to_numpy()))
    order = np.argsort(rows, kind="stable").astype(np.int32)
    rows, hashes = rows[order], lists.values.to_numpy()[order]
    del table, lists, order
    numbers = numbers[np.argsort(place)]
    where, seen = np.unique(hashes, return_counts=True)
    features = np.searchsorted(where, hashes).astype(np.int32)
    telling = associated(rows, features, seen, numbers) >= least_z
    used = telling[features]
    rows, features = rows[used], (np.cumsum(telling) - 1)[features[used]]
    weights, thresholds = fit(rows, features, numbers, int(telling.sum()), ridge, rounds)
    return Model(
        tuple(map(float, grades)), tuple(map(float, thresholds)),
        where[telling].astype(np.int32).tobytes(), weights.astype(np.float32).tobytes(),
    )


def text_score(text: str, model: Model) -> Column:
    """The sum of the weights of a text's words; zero for a NULL text or one without words."""
    where, weights = model.where, model.weights

    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        table = dense(where, weights)
        return pd.Series([float(table[buckets(x)].sum(dtype=np.float64)) for x in texts], dtype="float64")

    return of(F.col(text).cast("binary"))


def graded(docs: DataFrame, model: Model, keep_grade: float, text: str = "text") -> DataFrame:
    """``docs`` with ``expected_grade``, ``tails`` and ``keep``.

    ``tails`` has P(grade >= g) for each grade but the lowest, in order. ``keep`` is true if the chance
    of ``keep_grade`` or better is a half at least. Each row is judged by its text alone, so repeated
    rows agree; a NULL or empty text has no words and is judged by the thresholds. A model without
    grades gives NULLs and keeps everything. Columns of the same names are replaced.
    """
    score = free(docs, "score")
    tails = [F.expr(f"1 / (1 + exp({t!r}D - `{score}`))") for t in model.thresholds]
    lowest = F.lit(model.grades[0] if model.grades else None).cast("double")
    expected = lowest
    for tail, low, high in zip(tails, model.grades, model.grades[1:]):
        expected = expected + tail * (high - low)
    better = [j for j, g in enumerate(model.grades) if g >= keep_grade]
    if not model.grades or better[:1] == [0]:
        keep = F.lit(True)
    else:
        keep = tails[better[0] - 1] >= 0.5 if better else F.lit(False)
    scored = docs.withColumn(score, text_score(text, model))
    out = scored.withColumns({"expected_grade": expected, "tails": F.array(*tails).cast("array<double>"), "keep": keep})
    return out.drop(score)


def ratings(labels: DataFrame) -> DataFrame:
    """Grades from the columns of ``labels``: 0 toxic, 1 of low quality, 2 good. NULL where both are unknown."""
    toxic, quality = F.col("toxic") == 1, F.col("quality")
    return labels.select("doc_id", F.when(toxic, 0).when(quality == 0, 1).when(quality == 1, 2).alias("grade"))
