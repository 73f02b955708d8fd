"""Quality classifier: hashed word n-grams, logistic regression learnt with FTRL-proximal updates.

A text is cut into words, numbers and runs of symbols; case is kept. A token equal to the one before,
or to the one before that, makes a mark instead of a bigram, so that repetition looks alike for every word. Unigrams and
bigrams are hashed to ``DIMENSIONS`` weights. A document's score is the logistic function of the sum
of its weights over the square root of its token count: a sparse dot product, done for a whole Arrow
batch at once.

Learning sees at most ``max_rows`` labelled documents (parameter, default ``MAX_ROWS``). Their
features are made by many tasks and learnt from by one, in an order given by a hash of the id. Only
the non-zero weights come back. Every document is scored.

A null or empty text scores the bias alone. With no labelled rows at all every score is 0.5. Rows without an id never
train and are not held out; rows that repeat have repeated scores and train once (of several texts of one id the smallest).
A text is scored whole, in memory in proportion to its length; equal tokens at the border of two texts of a batch do not
meet. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderloom.llm.common import WordHashes, fold, mix, prepare, remembers, serve, sigmoid, training_rows

DIMENSIONS = 1 << 20
MAX_ROWS = 12_000
EPOCHS = 2
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
ALPHA, BETA, L1, L2 = 0.15, 1.0, 0.3, 0.5
TOKEN = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
_HASHES = WordHashes()
remembers("quality_model", _HASHES.clear)


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of all texts end to end, and the number of n-grams of each text."""
    serve("quality_model")
    words = [TOKEN.findall(text) if text else [] for text in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    codes = _HASHES.of([word for doc in words for word in doc])
    single = mix(codes + np.uint64(0x9E3779B97F4A7C15))
    if not len(codes):
        return np.empty(0, np.int64), counts
    before = np.concatenate([codes[:1], codes[:-1]])
    same = before == codes
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])[counts > 0]
    first = np.zeros(len(codes), bool)
    first[starts] = True
    double = mix(before * np.uint64(0xD6E8FEB86659FD93) + codes)
    # Not for the second token of a text, which has no token two before it.
    double[2:][(codes[2:] == codes[:-2]) & ~first[1:-1]] = np.uint64(3)
    double[same] = np.uint64(1)
    double[first] = np.uint64(2)
    out = np.empty(2 * len(codes), np.uint64)
    out[0::2], out[1::2] = single, double
    return (out & np.uint64(DIMENSIONS - 1)).astype(np.int64), 2 * counts


def learn(rows: list[tuple[np.ndarray, int]], epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and bias after FTRL-proximal passes over (n-grams, label) rows."""
    z, n = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)

    def weights(at):
        zi = z[at]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        w[np.abs(zi) <= L1] = 0.0
        return w

    for _ in range(epochs):
        for grams, label in rows:
            at, times = np.unique(grams, return_counts=True)
            at = np.append(at, DIMENSIONS)
            x = np.append(times / np.sqrt(max(len(grams), 1)), 1.0)
            w = weights(at)
            g = (sigmoid(w @ x) - label) * x
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    w = weights(np.arange(DIMENSIONS + 1))
    return w[:-1].astype(np.float32), float(w[-1])


def scores(texts: list[str | None], weights: np.ndarray, bias: float) -> np.ndarray:
    grams, counts = features(texts)
    ends = np.concatenate([[0.0], np.cumsum(weights[grams], dtype=np.float64)])
    stops = np.cumsum(counts)
    sums = ends[stops] - ends[stops - counts]
    return sigmoid(sums / np.sqrt(np.maximum(counts, 1)) + bias)


def _as_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").to_pylist()
        grams, counts = features(texts)
        parts = np.split(grams.astype(np.int32), np.cumsum(counts)[:-1])
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array([p.tobytes() for p in parts], pa.binary())],
            ["doc_id", "label", "grams"],
        )


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        rows += zip(*(batch.column(c).to_pylist() for c in ("doc_id", "label", "grams")), strict=True)
    rows.sort(key=lambda r: (int(mix(np.array([r[0]], np.int64).view(np.uint64))[0]), r[2]))
    weights, bias = learn([(np.frombuffer(g, np.int32), label) for _, label, g in rows])
    at = np.flatnonzero(weights)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([at.astype(np.int32).tobytes()], pa.binary()),
            pa.array([weights[at].tobytes()], pa.binary()),
            pa.array([bias], pa.float64()),
        ],
        ["at", "weight", "bias"],
    )


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> tuple[np.ndarray, float]:
    """Learn ``labels.quality`` from a bounded choice of the documents outside the held-out fold."""
    rows = training_rows(docs, labels, "quality", FOLDS, HELD_OUT, max_rows)
    made = rows.withColumn("doc_id", F.col("doc_id").cast("bigint")).mapInArrow(
        _as_features, "doc_id bigint, label int, grams binary"
    )
    got = made.repartition(1).mapInArrow(_train, "at binary, weight binary, bias double").collect()
    weights = np.zeros(DIMENSIONS, np.float32)
    if not got:
        return weights, 0.0
    weights[np.frombuffer(got[0]["at"], np.int32)] = np.frombuffer(got[0]["weight"], np.float32)
    return weights, got[0]["bias"]


def scorer(spark: SparkSession, model: tuple[np.ndarray, float]) -> Callable[[Column], Column]:
    """A column expression that scores texts by a fitted model."""
    held = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(scores([t if isinstance(t, str) else None for t in texts], *held.value))

    return score


def quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; one row out per row in."""
    score = scorer(prepare(spark), fit(docs, labels, max_rows))
    return docs.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        score(F.col("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
