"""Packs tokenized documents into sequences by vector best fit.

A sequence has three capacities: tokens, documents, and attention cost (the sum of squared piece lengths). Pieces go, longest first, to
the sequence that every capacity admits and whose weighted residual norm is least afterwards.

Documents are tokenized once; what is stored and packed is one short row per piece. Each task packs the pieces of its part of that table, a bounded
number at a time, so nothing is shuffled and at most the last sequences of a round stay open.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lakeloom.llm.helpers import store, text_or_empty
from lakeloom.llm.tokens import worker_encoder

LENGTH = 2048
DOCUMENTS = 2048         # as many as tokens: one-token pieces fill a sequence
COST = LENGTH * LENGTH   # one full piece
WEIGHTS = (1.0, 0.001, 0.001)  # tokens decide, the others break ties
ROUND = 16384            # shorter pieces packed together
HELD = 8 * ROUND         # pieces of any length that a task holds
SEPARATOR = 0


def cut(n: int, longest: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: full ones, and before them what is left over."""
    first = n % longest
    starts = ([0] if first else []) + list(range(first, n, longest))
    return [(a, z - a) for a, z in zip(starts, [*starts[1:], n])]


def pieces(docs: DataFrame, longest: int = LENGTH, path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the ids of each whole text, closed by id 0, cut into pieces."""
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType())])
    end = np.array([SEPARATOR], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(path)
        for b in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, x in enumerate(b.column(1)):
                ids = memoryview(encoder.encode(x.as_py()) + end)
                for k, (a, n) in enumerate(cut(len(ids) // 4, longest)):
                    row.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(n)
                    crc.append(zlib.crc32(ids[4 * a:4 * (a + n)]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row, pa.int32())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())], schema.names)

    return docs.select("doc_id", text_or_empty().alias("t")).mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, tokens: int = LENGTH, documents: int = DOCUMENTS, cost: int = COST,
             weights: tuple[float, float, float] = WEIGHTS) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset) of each piece, and the number of bins. Every piece fits an empty bin."""
    scale = np.array(weights) / np.array([tokens, documents, cost], dtype=float) ** 2
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    least = int(lengths.min()) if len(lengths) else 0
    ids = np.zeros(len(lengths) + 1, dtype=np.int64)       # open bins, with what is left of each capacity
    left = np.zeros((3, len(lengths) + 1), dtype=np.int64)
    n_open = n = 0
    closed = 0
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        need = (size, 1, size * size)
        t, d, c = left[:, :n_open]
        fits = np.flatnonzero((t >= size) & (d >= 1) & (c >= need[2]))
        if len(fits):
            rest = left[:, fits] - np.array(need)[:, None]
            at = int(fits[np.argmin(scale @ (rest * rest.astype(float)))])
        else:
            at, ids[n_open], left[:, n_open] = n_open, n, (tokens, documents, cost)
            n, n_open = n + 1, n_open + 1
        bins[i], offsets[i] = ids[at], tokens - left[0, at]
        left[:, at] -= need
        closed += bool(left[0, at] < least or left[1, at] < 1 or left[2, at] < least * least)
        if closed > 64 and closed > n_open // 4:  # bins that take nothing more are looked at no longer
            on = np.flatnonzero((left[0, :n_open] >= least) & (left[1, :n_open] >= 1) & (left[2, :n_open] >= least * least))
            ids[:len(on)], left[:, :len(on)], n_open, closed = ids[on], left[:, on], len(on), 0
    return bins, offsets, n


def pack(docs: DataFrame, length: int = LENGTH, documents: int = DOCUMENTS, cost: int = COST,
         weights: tuple[float, float, float] = WEIGHTS, path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    An empty or missing text is the single id 0. Rows given twice are packed twice. No piece is longer than the
    attention cost of a sequence allows.
    """
    longest = min(length, isqrt(cost))
    if longest < 1 or documents < 1:
        raise ValueError("a sequence must have room for a piece")
    rows = store(pieces(docs, longest, path), "pieces")
    schema = T.StructType([*rows.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = TaskContext.get().partitionId() << 36  # sequences of a task are numbered from here
        held: list[pa.RecordBatch] = []
        n = rows = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal used
            table = pa.Table.from_batches(held).combine_chunks()
            bins, offsets, made = best_fit(table.column("length").to_numpy(), length, documents, cost, weights)
            table = table.append_column("sequence_id", pa.array(bins + used)).append_column("offset", pa.array(offsets))
            used += made
            yield from table.to_batches()

        for b in batches:
            held.append(b)
            n += int((b.column(3).to_numpy() < longest).sum())
            rows += b.num_rows
            if n >= ROUND or rows >= HELD:
                yield from flush()
                held, n, rows = [], 0, 0
        if held:
            yield from flush()

    return rows.mapInArrow(run, schema)
