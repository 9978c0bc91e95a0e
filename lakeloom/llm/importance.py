"""Resampling towards a target distribution: array-scored weights, ranks by a distributed radix sort.

Words are hashed into buckets; the documents' and the target's bucket counts give every bucket a gain, and a document's weight is the sum of
the gains of its words, looked up in one array. With Gumbel noise from a hash of the id, the highest scores are a sample without
replacement by weight. Ranks come from a least-significant-digit radix sort over the digits of (score, id): each pass counts digits
per part of the table, turns the counts into offsets by prefix sums, and so gives every row its next place; parts are then
cut anew from the places. A part has a bounded number of rows whatever the digits are.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.helpers import pieces, store, text_or_empty

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NO_WORD = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10
DIGIT_BITS = 11
PART_BITS = 14              # 2**PART_BITS places form one part
MEMO_BYTES = 32 << 20       # words and buckets that a task keeps
MEMO_WORD = 64              # longer words are hashed each time


class WordBuckets(dict):
    """Bucket of each word met so far, within ``MEMO_BYTES``."""

    held = 0

    def __missing__(self, word: bytes) -> int:
        bucket = zlib.crc32(word) % BUCKETS
        if len(word) <= MEMO_WORD:
            if self.held > MEMO_BYTES:
                self.clear()
                self.held = 0
            self[word] = bucket
            self.held += len(word) + 150
        return bucket


def features(texts: DataFrame, *columns: str) -> DataFrame:
    """The named columns and ``buckets``, the bucket of every word of the text in order (unsigned 16-bit numbers)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordBuckets()
        for b in batches:
            found = []
            for x in b.column(b.num_columns - 1):
                parts = [np.fromiter(map(memo.__getitem__, w := WORD.findall(p)), "<u2", len(w))
                         for p in pieces(x.as_py().lower(), NO_WORD)]
                found.append(b"".join(p.tobytes() for p in parts))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(found, pa.binary())], [*columns, "buckets"])

    schema = texts.select(*columns).schema.add("buckets", "binary")
    return texts.select(*columns, text_or_empty().cast("binary").alias("b")).mapInArrow(run, schema)


def bucket_counts(rows: DataFrame) -> np.ndarray:
    """Number of features in each bucket; a task adds up its own rows, the driver gets one row per bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for b in batches:
            for x in b.column(0):
                total += np.bincount(np.frombuffer(x.as_py(), "<u2"), minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["bucket", "n"])

    out = np.zeros(BUCKETS, dtype=np.int64)
    for bucket, n in rows.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What a word of each bucket adds to a weight: the log ratio of its smoothed shares, in thousandths, rounded down."""
    s_all, t_all = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all)))
                     for s, t in zip(source.astype(float).tolist(), target.astype(float).tolist())], dtype=np.int64)


def noise(doc_id: int | None) -> int:
    """Gumbel noise of an id, in thousandths; a missing id is written as nothing."""
    h = int(hashlib.sha256(f"{SEED}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_features, weight, score) of rows (doc_id, buckets)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [np.frombuffer(x.as_py(), "<u2") for x in b.column(1)]
            weight = np.array([gain[f].sum() for f in found], dtype=np.int64)
            extra = np.array([noise(x.as_py()) for x in b.column(0)], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([len(f) for f in found], pa.int64()), pa.array(weight), pa.array(weight + extra)],
                ["doc_id", "n_features", "weight", "score"])

    return rows.mapInArrow(run, "doc_id long, n_features long, weight long, score long")


def counting_pass(rows: DataFrame, digit: Column) -> DataFrame:
    """``rows`` with the places they have after a stable sort by ``digit``: new ``pos`` (from 0) and ``part``.

    The offset of a (part, digit) is the number of rows with a smaller digit and of those with this digit in earlier parts. Rows are
    shuffled once, by (part, digit), which both the count within the part and the join of the offset need.
    """
    rows = rows.withColumn("digit", digit)
    counts = rows.groupBy("part", "digit").agg(F.count("*").alias("n"))
    totals = counts.groupBy("digit").agg(F.sum("n").alias("n"))  # at most 2**DIGIT_BITS rows
    before = totals.select("digit", (F.sum("n").over(Window.orderBy("digit")) - F.col("n")).alias("smaller"))
    earlier = F.sum("n").over(Window.partitionBy("digit").orderBy("part")) - F.col("n")
    offsets = counts.withColumn("earlier", earlier).join(before, "digit").select(
        "part", "digit", (F.col("smaller") + F.col("earlier")).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("part", "digit").orderBy("pos")) - 1
    placed = rows.withColumn("inside", inside).join(offsets, ["part", "digit"]).withColumn("pos", F.col("offset") + F.col("inside"))
    return placed.withColumn("part", F.shiftright("pos", PART_BITS)).drop("digit", "inside", "offset")


def radix_sorted(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with ``pos``, their place (from 0) in ascending order of ``keys``, non-negative whole numbers, the first one leading.

    Passes go from the last digit of the last key to the first of the first; only as many digits as the largest value has. Every pass is
    stored, so that a lost executor costs no earlier one.
    """
    most = rows.agg(*[F.coalesce(F.max(k), F.lit(0)).alias(k) for k in keys]).first()
    # Places of the first pass: rows as they are stored, a part holds rows of one file split alone.
    order = F.monotonically_increasing_id()
    rows = store(rows.withColumn("pos", order).withColumn("part", F.shiftright("pos", PART_BITS)), "places")
    for key in reversed(keys):
        for low in range(0, int(most[key]).bit_length(), DIGIT_BITS):
            digit = F.shiftright(key, low).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1)).cast("int")
            rows = store(counting_pass(rows, digit), "places")
    return rows


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least: int = LEAST_WORDS) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank.

    ``percent`` of the documents with at least ``least`` words are drawn, the highest scores first, ties by the smaller id; rank
    is null for all others. ``target`` (text) sets the distribution to approach. Ids are whole numbers; a row without id comes
    last among equal scores; rows that repeat an id are drawn each for itself. A missing text has no words.
    """
    words = store(features(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id"), "features")
    gain = gains(bucket_counts(words), bucket_counts(features(target)))
    rows = store(scored(words, gain), "scores")
    fit = rows.filter(F.col("n_features") >= least)
    n, top, low, high = fit.agg(F.count("*"), F.max("score"), F.min("doc_id"), F.max("doc_id")).first()
    low, high = low or 0, high or 0
    keyed = fit.withColumn("by_score", F.lit(top) - F.col("score")).withColumn(
        "by_id", F.coalesce(F.col("doc_id") - low, F.lit(high - low + 1)))
    rank = F.when(F.col("pos") < percent * n // 100, F.col("pos") + 1)
    columns = ["doc_id", "n_features", "weight", "score"]
    placed = radix_sorted(keyed, ["by_score", "by_id"]).select(*columns, rank.alias("rank"))
    rest = rows.filter(F.col("n_features") < least).select(*columns, F.lit(None).cast("long").alias("rank"))
    return placed.unionByName(rest)
