"""Ranked lexical search: accumulators for short posting lists, document-at-a-time skipping over long ones.

Documents are indexed where they lie: a task turns its rows into small inverted indexes of bounded size and answers
every query on each. On one index a query first adds up its short lists, term by term, into accumulators. Their sums then act as a single
list with a bound per range of documents, next to the long lists with theirs; ranges are taken in the order of documents, those whose
bounds cannot reach the best results so far are skipped, and within the others the long lists are probed only at documents that still
can. Results of the indexes are merged by score. Scores are exact integers, so the skipping changes no result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.helpers import pieces, store, text_or_empty

TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
NO_TERM = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
BEST = 50
ROUND = 1 << 18             # (item, term) pairs answered in one pass over the documents
INDEX_POSTINGS = 1 << 20    # of one index; it holds at least one document
INDEX_DOCS = 1 << 14
RANGE = 128                 # documents that share a bound
SHORT = 64                  # a list is short if it holds at most one in so many documents of the index
SLICES = 128                # groups of tasks whose results are merged first
NO_ID = np.iinfo(np.int64).max


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term) without repeats. Rows with one item_id are one item; a missing text has no terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, x in enumerate(b.column(1)):
                for piece in pieces(x.as_py().lower(), NO_TERM):
                    terms = sorted(set(TERM.findall(piece)))
                    yield pa.RecordBatch.from_arrays([
                        pa.array([b.column(0)[i].as_py()] * len(terms), pa.int64()), pa.array(terms, pa.binary())], ["item_id", "term"])

    text = text_or_empty().cast("binary").alias("b")
    return items.select(F.col("item_id").cast("long"), text).mapInArrow(run, "item_id long, term binary").distinct()


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tf) per row: number of all terms, the numbers of those in ``vocabulary`` and how often each occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, terms, tf = [], [], []
            for x in b.column(1):
                count, found = 0, Counter()
                for piece in pieces(x.as_py().lower(), NO_TERM):
                    words = TERM.findall(piece)
                    count += len(words)
                    found.update(map(vocabulary.get, words))
                found.pop(None, None)
                n.append(count)
                terms.append(np.fromiter(found.keys(), "<u4", len(found)).tobytes())
                tf.append(np.fromiter(found.values(), "<u4", len(found)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(terms, pa.binary()), pa.array(tf, pa.binary())],
                ["doc_id", "n", "terms", "tf"])

    text = text_or_empty().cast("binary").alias("b")
    return docs.select(F.col("doc_id").cast("long"), text).mapInArrow(run, "doc_id long, n long, terms binary, tf binary")


def document_counts(rows: DataFrame, n_terms: int) -> np.ndarray:
    """Number of documents that hold each term; a task adds up its own rows first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, dtype=np.int64)
        for b in batches:
            found = np.frombuffer(b"".join(x.as_py() for x in b.column(0)), "<u4")
            total += np.bincount(found, minlength=n_terms)
        term = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(total[term], pa.int64())], ["term", "df"])

    out = np.zeros(n_terms, dtype=np.int64)
    for term, df in rows.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df")).collect():
        out[term] = df
    return out


@dataclass
class Statistics:
    """What a score needs of the whole table."""

    n_docs: int     # with a term
    n_terms: int    # with repeats
    weight: np.ndarray

    def length_norm(self, n: np.ndarray) -> np.ndarray:
        if not self.n_terms:
            return np.full(len(n), 50, dtype=np.int64)
        if 50 * int(n.max(initial=0)) * self.n_docs < 1 << 62:
            return 50 + (50 * n * self.n_docs) // self.n_terms
        return np.array([50 + (50 * int(x) * self.n_docs) // self.n_terms for x in n], dtype=np.int64)


def statistics(rows: DataFrame, n_terms: int) -> Statistics:
    docs, terms = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = document_counts(rows, n_terms)
    weight = [math.floor(1000 * math.log((2 * docs + 2) / (2 * x + 1))) for x in df.tolist()]
    return Statistics(docs, terms, np.array(weight, dtype=np.int64))


class Best:
    """The best (score, id) pairs so far; equal scores by ascending id."""

    def __init__(self, k: int):
        self.k, self.score, self.doc = k, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

    @property
    def least(self) -> int:
        """Scores below this one cannot enter."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc: np.ndarray) -> None:
        score, doc = np.concatenate([self.score, score]), np.concatenate([self.doc, doc])
        order = np.lexsort((doc, -score))[:self.k]
        self.score, self.doc = score[order], doc[order]


class Index:
    """Posting lists of some documents, which are numbered in the order of their ids, with impacts and bounds."""

    def __init__(self, doc: np.ndarray, n: np.ndarray, terms: list[np.ndarray], tf: list[np.ndarray], stats: Statistics):
        order = np.argsort(doc, kind="stable")
        self.doc, place = doc[order], np.empty(len(doc), dtype=np.int64)
        place[order] = np.arange(len(doc))
        held = np.repeat(place, [len(t) for t in terms])
        term, count = np.concatenate(terms).astype(np.int64), np.concatenate(tf).astype(np.int64)
        by = np.lexsort((held, term))
        term, self.at, count = term[by], held[by], count[by]
        norm = stats.length_norm(n[order])
        self.impact = stats.weight[term] * ((1_000_000_000 * count) // (1000 * count + 20 * norm[self.at]))
        first = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, dtype=np.int64)
        self.lists = dict(zip(term[first].tolist(), zip(first.tolist(), np.r_[first[1:], len(term)].tolist())))
        self.ranges = -(-len(doc) // RANGE)
        self.bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.scored = 0  # postings of long lists that were looked at

    def bound(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """Of a list: where each range starts, and its highest impact there."""
        if term not in self.bounds:
            a, z = self.lists[term]
            start = np.searchsorted(self.at[a:z], np.arange(self.ranges + 1) * RANGE)
            high, full = np.zeros(self.ranges, dtype=np.int64), np.flatnonzero(start[1:] > start[:-1])
            high[full] = np.maximum.reduceat(self.impact[a:z], start[full])
            start += a
            self.bounds[term] = start, high
        return self.bounds[term]

    def answer(self, terms: list[int], best: Best) -> None:
        """Put what this index has for a query into ``best``."""
        here = [t for t in terms if t in self.lists]
        size = {t: self.lists[t][1] - self.lists[t][0] for t in here}
        long = [t for t in here if size[t] * SHORT > len(self.doc)]
        # Term at a time: the sums of the short lists.
        held = np.zeros(self.ranges * RANGE, dtype=np.int64)
        for t in here:
            if size[t] * SHORT <= len(self.doc):
                a, z = self.lists[t]
                held[self.at[a:z]] += self.impact[a:z]
        # One bounded list of sums beside the long ones. What a document has from the short lists alone it has at least.
        bound = held.reshape(-1, RANGE).max(axis=1)
        least = best.least
        if np.count_nonzero(held) >= best.k:
            least = max(least, int(np.partition(held, -best.k)[-best.k]))
        if long:
            long.sort(key=lambda t: -int(self.bound(t)[1].max()))
            tops = np.array([self.bound(t)[1] for t in long])
            rest = np.vstack([tops[::-1].cumsum(axis=0)[::-1], np.zeros((1, self.ranges), dtype=np.int64)])  # of list i and after
            bound = bound + rest[0]
        # Document at a time, over the ranges that may hold a result.
        for r in np.flatnonzero(bound >= least):
            if bound[r] < max(least, best.least):
                continue
            score = held[r * RANGE:(r + 1) * RANGE]
            need = max(least, best.least)
            for i, t in enumerate(long):
                alive = score + rest[i, r] >= need
                if not alive.any():
                    break
                a, z = self.bound(t)[0][r:r + 2]
                at = self.at[a:z] - r * RANGE
                on = alive[at]
                score[at[on]] += self.impact[a:z][on]
                self.scored += int(on.sum())
            found = np.flatnonzero((score >= need) & (score > 0))
            found = found[found + r * RANGE < len(self.doc)]
            if len(found):
                best.add(score[found], self.doc[found + r * RANGE])


def indexes(batches: Iterator[pa.RecordBatch], stats: Statistics) -> Iterator[Index]:
    """The rows (doc_id, n, terms, tf) as indexes of bounded size; documents without a term of the queries are left out."""
    doc, n, terms, tf, postings = [], [], [], [], 0
    for b in batches:
        for d, count, t, f in zip(*(b.column(i) for i in range(4))):
            t = np.frombuffer(t.as_py(), "<u4")
            if not len(t):
                continue
            if doc and (postings + len(t) > INDEX_POSTINGS or len(doc) == INDEX_DOCS):
                yield Index(np.array(doc), np.array(n), terms, tf, stats)
                doc, n, terms, tf, postings = [], [], [], [], 0
            doc.append(NO_ID if d.as_py() is None else d.as_py())
            n.append(count.as_py())
            terms.append(t)
            tf.append(np.frombuffer(f.as_py(), "<u4"))
            postings += len(t)
    if doc:
        yield Index(np.array(doc), np.array(n), terms, tf, stats)


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each item, ranked; first within slices of the tasks, so that no task gets more than a bounded number."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    sliced = found.withColumn("_slice", F.pmod(F.spark_partition_id(), F.lit(SLICES)))
    part = sliced.withColumn("_r", F.row_number().over(Window.partitionBy("item_id", "_slice").orderBy(*order))).filter(F.col("_r") <= k)
    return part.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order))).filter(F.col("rank") <= k).select(
        "item_id", "rank", "doc_id", "score")


def answered(queries: list[tuple[int | None, bytes]], docs: DataFrame, k: int) -> DataFrame:
    """The ``k`` best documents of each task for the items of one round."""
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, t in queries}))}
    items: dict[int | None, list[int]] = {}
    for item, term in queries:
        items.setdefault(item, []).append(vocabulary[term])
    rows = store(counted(docs, vocabulary), "postings")
    stats = statistics(rows, len(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {item: Best(k) for item in items}
        for index in indexes(batches, stats):
            for item, terms in items.items():
                index.answer(terms, best[item])
        for item, b in best.items():
            yield pa.RecordBatch.from_arrays([
                pa.array([item] * len(b.doc), pa.int64()), pa.array(b.doc, pa.int64(), mask=b.doc == NO_ID),
                pa.array(b.score, pa.int64())], ["item_id", "doc_id", "score"])

    return rows.mapInArrow(run, "item_id long, doc_id long, score long")


def search(items: DataFrame, docs: DataFrame, k: int = BEST, pairs: int = ROUND) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of ``docs`` for each of ``items`` (item_id, text).

    Every row is a document, also where an id repeats; a missing text has no terms, a missing id comes last among equal scores.
    Ids are integers. Items are taken in rounds of about ``pairs`` terms, a pass over the documents each, so that what a
    task holds of the queries does not grow with their number.
    """
    asked = store(item_terms(items), "terms")
    rounds = max(1, -(-asked.count() // pairs))
    found = []
    for i in range(rounds):
        queries = [tuple(r) for r in asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(rounds)) == i).collect()]
        found.append(answered([(item, bytes(term)) for item, term in queries], docs, k))
    return best_of(reduce(DataFrame.unionByName, found), k)
