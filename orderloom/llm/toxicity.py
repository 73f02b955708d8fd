"""Toxicity: a factorisation machine over hashed terms.

score = logistic(b + sum_i w_i + sum_{i<j} <v_i, v_j>) over the distinct lower-cased words of a text
and over the beginnings of long ones (``BEGINNINGS`` letters), which inflected and compounded forms
share, hashed to ``DIMENSIONS`` places. The pair sum is taken as half of |sum v|^2 - sum |v|^2, so its cost is
linear in the number of terms. Linear weights are learnt by FTRL-proximal updates, whose L1 part
leaves most of them at zero; a term gets its factor vector (learnt by AdaGrad) only once its linear
weight is not zero and it was seen in ``MIN_SEEN`` training documents, so that rare terms add no noise.
Any text, long or short, is decided by the few terms that carry weight; case and the symbols around a
word make no difference.

Learning sees at most ``max_rows`` labelled documents (parameter, default ``MAX_ROWS``) from outside
the held-out fold; every document is scored. A null or empty text scores the bias alone; without any
labelled rows every score is next to 0, so that nothing is rejected. Rows without an id never train and are not held out;
rows that repeat have repeated scores and train once (of several texts of one id the smallest). An empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderloom.llm.common import fold, mix, prepare, remembers, serve, sigmoid, training_rows

DIMENSIONS = 1 << 18
FACTORS = 8
MAX_ROWS = 12_000
MIN_SEEN = 20
EPOCHS = 3
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
UNTAUGHT = -35.0
ALPHA, BETA, L1, L2 = 1.0, 1.0, 5.0, 0.1
FACTOR_STEP, FACTOR_L2 = 0.02, 0.01
WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = (5, 7)


class Terms(dict):
    """Word to the number of its row in ``table``, which holds the places of its terms."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most, self.table, self.chars = most, np.zeros((most, 1 + len(BEGINNINGS)), np.int32), 0

    def clear(self) -> None:
        super().clear()
        self.chars = 0

    def __missing__(self, word: str) -> int:
        at = self[word] = len(self)
        self.chars += len(word)
        self.table[at] = zlib.crc32(word.encode("utf-8", "surrogatepass")) % DIMENSIONS
        for k, size in enumerate(BEGINNINGS, 1):
            if len(word) > size:
                self.table[at, k] = zlib.crc32(f"{word[:size]}-".encode("utf-8", "surrogatepass")) % DIMENSIONS
        return at

    def of(self, words: set[str]) -> np.ndarray:
        """Distinct places of a text's words."""
        if len(self) + len(words) > self.most or self.chars > 16 * self.most:
            self.clear()
            if len(words) > self.most:
                self.most = 2 * len(words)
                self.table = np.zeros((self.most, 1 + len(BEGINNINGS)), np.int32)
        return np.unique(self.table[np.fromiter(map(self.__getitem__, words), np.int64, len(words))])


_TERMS = Terms()
remembers("toxicity", _TERMS.clear)


def terms(text: str | None) -> np.ndarray:
    """The distinct places of a text's terms, in order."""
    serve("toxicity")
    return _TERMS.of(set(WORD.findall(text.lower()))) if text else np.empty(0, np.int32)


class Machine:
    """Weights of the machine, for learning and scoring."""

    def __init__(self):
        self.w = np.zeros(DIMENSIONS, np.float32)
        self.v = np.zeros((1, FACTORS), np.float32)  # row 0 belongs to terms without factors
        self.row = np.zeros(DIMENSIONS, np.int32)
        self.bias = 0.0

    def score(self, texts: list[str | None]) -> np.ndarray:
        each = [at[self.w[at] != 0] for at in map(terms, texts)]
        doc = np.repeat(np.arange(len(texts)), list(map(len, each)))
        at = np.concatenate(each) if each else np.empty(0, np.int32)
        linear = np.bincount(doc, self.w[at], len(texts))
        v = self.v[self.row[at]]
        total, squares = np.zeros((len(texts), FACTORS)), np.zeros(len(texts))
        np.add.at(total, doc, v)
        np.add.at(squares, doc, (v * v).sum(1))
        return sigmoid(self.bias + linear + 0.5 * ((total * total).sum(1) - squares))


def learn(rows: list[tuple[np.ndarray, int]], epochs: int = EPOCHS) -> Machine:
    """Fit a machine on (distinct terms, label) rows, one after the other."""
    size = DIMENSIONS + 1
    z, n = np.zeros(size), np.zeros(size)
    seen = np.bincount(np.concatenate([at for at, _ in rows] or [np.empty(0, np.int64)]), minlength=size)
    start = np.random.default_rng(7)
    v, g2 = np.zeros((size, FACTORS)), np.zeros((size, FACTORS))
    has = np.zeros(size, bool)

    def weights(at):
        zi = z[at]
        free = np.append(np.full(len(at) - 1, L1), 0.0)  # the bias, last, is not held back
        w = -(zi - np.sign(zi) * free) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        w[np.abs(zi) <= free] = 0.0
        return w

    for _ in range(epochs):
        for at, label in rows:
            at = np.append(at, DIMENSIONS)
            w = weights(at)
            new = at[(w != 0) & ~has[at] & (seen[at] >= MIN_SEEN)]
            v[new], has[new] = start.normal(0, 0.05, (len(new), FACTORS)), True
            pairs = at[has[at] & (w != 0)]
            vs = v[pairs]
            total = vs.sum(0)
            miss = sigmoid(w.sum() + 0.5 * (total @ total - (vs * vs).sum())) - label
            step = (np.sqrt(n[at] + miss * miss) - np.sqrt(n[at])) / ALPHA
            z[at] += miss - step * w
            n[at] += miss * miss
            g = miss * (total - vs) + FACTOR_L2 * vs
            g2[pairs] += g * g
            v[pairs] -= FACTOR_STEP * g / (np.sqrt(g2[pairs]) + 1e-6)
    made = Machine()
    w = weights(np.arange(size))
    made.w, made.bias = w[:-1].astype(np.float32), float(w[-1])
    live = np.flatnonzero(has[:-1] & (made.w != 0))
    made.row[live] = np.arange(1, len(live) + 1)
    made.v = np.concatenate([np.zeros((1, FACTORS)), v[live]]).astype(np.float32)
    return made


def _as_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [terms(text).tobytes() for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), pa.array(parts, pa.binary())],
            ["doc_id", "label", "terms"],
        )


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        rows += zip(*(batch.column(c).to_pylist() for c in ("doc_id", "label", "terms")), strict=True)
    if not rows:
        return
    rows.sort(key=lambda r: (int(mix(np.array([r[0]], np.int64).view(np.uint64))[0]), r[2]))
    made = learn([(np.frombuffer(t, np.int32), label) for _, label, t in rows])
    at = np.flatnonzero(made.w)
    parts = [at.astype(np.int32), made.w[at], made.row[at], made.v]
    yield pa.RecordBatch.from_arrays(
        [pa.array([p.tobytes()], pa.binary()) for p in parts] + [pa.array([made.bias])],
        ["at", "w", "row", "v", "bias"],
    )


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> Machine:
    """Learn ``labels.toxic`` from a bounded choice of the documents outside the held-out fold."""
    rows = training_rows(docs, labels, "toxic", FOLDS, HELD_OUT, max_rows)
    made = rows.withColumn("doc_id", F.col("doc_id").cast("bigint")).mapInArrow(
        _as_terms, "doc_id bigint, label int, terms binary"
    )
    schema = "at binary, w binary, row binary, v binary, bias double"
    machine = Machine()
    machine.bias = UNTAUGHT
    for got in made.repartition(1).mapInArrow(_train, schema).collect():
        at = np.frombuffer(got["at"], np.int32)
        machine.w[at] = np.frombuffer(got["w"], np.float32)
        machine.row[at] = np.frombuffer(got["row"], np.int32)
        machine.v = np.frombuffer(got["v"], np.float32).reshape(-1, FACTORS)
        machine.bias = got["bias"]
    return machine


def scorer(spark: SparkSession, machine: Machine) -> Callable[[Column], Column]:
    """A column expression that scores texts by a fitted machine."""
    held = spark.sparkContext.broadcast(machine)

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(held.value.score([t if isinstance(t, str) else None for t in texts]))

    return score


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; one row out per row in."""
    score = scorer(prepare(spark), fit(docs, labels, max_rows))
    return docs.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        score(F.col("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
