"""Ordinal quality classifier: cumulative-link regression on graded ratings.

P(grade <= k) = sigmoid(threshold_k - score): all grades share one weight per hashed feature of the text, and the thresholds are
ordered. The score gives an expected grade and the probability of the top grades, by which documents are selected.

Fitting reads a bounded sample of rated documents. Each step of the optimizer is one Spark job over the stored features of that sample: tasks add up
loss and gradient of their rows, the driver holds weights only. Scoring reads every document.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.helpers import store, text_or_empty

BUCKETS = 1 << 16
SAMPLE = 20_000      # rated documents used to fit, about; the bound of the training sample
FIT_TASKS = 8        # that hold the sample; each gives one gradient a step
RIDGE = 0.5
STEPS = 40
CUTOFF = 0.5         # least probability of the top grade
SEED = 29
TOKEN = re.compile(r"[^\W\d_]+|[^\w\s]+|\d+")


class Buckets(dict):
    """Bucket of each token met so far."""

    def __missing__(self, token: str) -> int:
        value = self[token] = zlib.crc32(token.encode("utf-8", "surrogatepass")) % BUCKETS
        return value


def features(text: str, memo: Buckets) -> np.ndarray:
    """Distinct buckets of a whole text: its lower-cased words, numbers and marks, and the tenths of words in capitals and of marks."""
    tokens = TOKEN.findall(text)
    seen = {memo[t] for t in set(map(str.lower, tokens))}
    if tokens:
        capitals = sum(map(str.isupper, tokens)) * 10 // len(tokens)
        marks = sum(not t.isalnum() for t in tokens) * 10 // len(tokens)
        seen |= {memo[f"<capitals {capitals}>"], memo[f"<marks {marks}>"]}
    if len(memo) > 1 << 20:
        memo.clear()
    return np.fromiter(seen, dtype=np.int64, count=len(seen))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending; grade 0 lies below the first

    def score(self, buckets: np.ndarray) -> float:
        return float(self.weights[buckets].sum())

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ...; one row per score."""
        return sigmoid(scores[:, None] - self.thresholds[None, :])


def unpack(params: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights, and thresholds from the first one and the logarithms of the gaps."""
    w, t = params[:BUCKETS], params[BUCKETS:]
    return w, t[0] + np.r_[0.0, np.cumsum(np.exp(t[1:]))]


def loss_and_gradient(rows: np.ndarray, buckets: np.ndarray, grades: np.ndarray, params: np.ndarray) -> tuple[float, np.ndarray]:
    """Negative log-likelihood of documents (their features as ``rows``, ``buckets`` pairs) and its gradient in ``params``."""
    w, thresholds = unpack(params)
    s = np.bincount(rows, weights=w[buckets], minlength=len(grades))
    edges = np.r_[-np.inf, thresholds, np.inf]
    hi, lo = sigmoid(edges[grades + 1] - s), sigmoid(edges[grades] - s)
    p = np.maximum(hi - lo, 1e-12)
    by_score = 1 - hi - lo  # of the loss
    grad = np.zeros_like(params)
    grad[:BUCKETS] = np.bincount(buckets, weights=by_score[rows], minlength=BUCKETS)
    at = np.zeros(len(edges))
    np.add.at(at, grades + 1, -hi * (1 - hi) / p)
    np.add.at(at, grades, lo * (1 - lo) / p)
    inner = at[1:-1]  # by threshold
    tail = np.cumsum(inner[::-1])[::-1]
    grad[BUCKETS] = tail[0]
    grad[BUCKETS + 1:] = tail[1:] * np.exp(params[BUCKETS + 1:])
    return float(-np.log(p).sum()), grad


def minimize(f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """L-BFGS with backtracking; ``f`` gives value and gradient."""
    value, grad = f(x)
    past: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        q, alphas = grad.copy(), []
        for s, y, r in reversed(past):
            alphas.append(r * (s @ q))
            q -= alphas[-1] * y
        q *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1]) if past else 1 / max(1.0, np.abs(grad).sum() ** 0.5)
        for (s, y, r), a in zip(past, reversed(alphas)):
            q += (a - r * (y @ q)) * s
        slope, step = grad @ q, 1.0
        for _ in range(12):
            after = x - step * q
            new_value, new_grad = f(after)
            if new_value <= value - 1e-4 * step * slope:
                break
            step /= 4
        else:
            return x
        s, y = after - x, new_grad - grad
        if s @ y > 1e-12:
            past = [*past, (s, y, 1 / (s @ y))][-memory:]
        done = value - new_value <= 1e-5 * max(1.0, abs(value))
        x, value, grad = after, new_value, new_grad
        if done:
            break
    return x


def rated_features(docs: DataFrame, ratings: DataFrame, sample: int = SAMPLE, seed: int = SEED) -> DataFrame:
    """Stored (grade, buckets) of about ``sample`` rated documents; ``ratings``: (doc_id, grade), null grades and ids left out.

    The sample is drawn by a hash of the id, so it is the same in every run; its ids (at most a few hundred kilobytes) go to all executors.
    """
    known = ratings.filter(F.col("doc_id").isNotNull() & F.col("grade").isNotNull()).groupBy("doc_id").agg(
        F.min("grade").cast("int").alias("grade"))
    known = store(known, "ratings")
    share = min(1.0, sample / max(known.count(), 1))
    drawn = known.filter(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 62)) < int(share * (1 << 62))).select(
        F.col("doc_id").alias("_id"), "grade")
    schema = "grade int, buckets array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Buckets()
        for b in batches:
            made = [features(x.as_py(), memo).astype(np.int32) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.list_(pa.int32()))], ["grade", "buckets"])

    rows = docs.select("doc_id", text_or_empty().alias("t")).join(F.broadcast(drawn), F.col("doc_id") == F.col("_id"))
    # Few files, however many tasks read the documents: a step sends FIT_TASKS gradients to the driver.
    return store(rows.select("grade", "t").mapInArrow(run, schema).repartition(FIT_TASKS), "features")


def fit(docs: DataFrame, ratings: DataFrame, grades: int, sample: int = SAMPLE, ridge: float = RIDGE, steps: int = STEPS) -> Model:
    """A model of ``grades`` grades (0 the worst). Without rated documents every text scores zero."""
    if grades < 2:
        raise ValueError("two grades are needed")
    rated = rated_features(docs, ratings, sample)

    def f(params: np.ndarray) -> tuple[float, np.ndarray]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            value, grad = 0.0, np.zeros_like(params)
            for b in batches:
                if not b.num_rows:
                    continue
                lists = b.column(1)
                sizes = np.diff(lists.offsets.to_numpy())
                one, part = loss_and_gradient(
                    np.repeat(np.arange(b.num_rows), sizes), lists.flatten().to_numpy(), b.column(0).to_numpy(), params)
                value, grad = value + one, grad + part
            yield pa.RecordBatch.from_arrays([pa.array([value]), pa.array([grad.tobytes()], pa.binary())], ["value", "grad"])

        # One row per task, of which there are about FIT_TASKS: its loss and a gradient of the model's size.
        parts = rated.mapInArrow(run, "value double, grad binary").collect()
        w = params[:BUCKETS]
        grad = sum((np.frombuffer(p["grad"]) for p in parts), np.zeros_like(params))
        grad[:BUCKETS] += ridge * w
        return sum(p["value"] for p in parts) + ridge / 2 * float(w @ w), grad

    start = np.zeros(BUCKETS + grades - 1)
    start[BUCKETS] = 1 - grades / 2
    weights, thresholds = unpack(minimize(f, start, steps) if not rated.isEmpty() else start)
    return Model(weights, thresholds)


def scored(docs: DataFrame, model: Model, cutoff: float = CUTOFF) -> DataFrame:
    """One row per document: doc_id, score, expected_grade, p_top, grade (the likeliest), kept (p_top at least ``cutoff``).

    A missing text is empty and scores zero. Rows given twice are scored twice.
    """
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("score", T.DoubleType()),
        T.StructField("expected_grade", T.DoubleType()), T.StructField("p_top", T.DoubleType()), T.StructField("grade", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Buckets()
        for b in batches:
            score = np.array([model.score(features(x.as_py(), memo)) for x in b.column(1)], dtype=float)
            tails = model.tails(score)
            each = -np.diff(np.c_[np.ones(len(score)), tails, np.zeros(len(score))], axis=1)
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(score), pa.array(tails.sum(axis=1)), pa.array(tails[:, -1]),
                pa.array(each.argmax(axis=1).astype(np.int32))], schema.names)

    return docs.select("doc_id", text_or_empty().alias("t")).mapInArrow(run, schema).withColumn(
        "kept", F.col("p_top") >= cutoff)
