"""Finds secrets: three fixed patterns, and strings that look random to character Markov models.

Two first-order character models are compared: of random strings (hexadecimal, base-32, base-64, letters and digits of a seeded
generator) and of ordinary words (the long words of all documents outside the patterns' matches). Keys hardly ever occur in two
different texts, so a word of one text alone does not count as ordinary; the others count once per document. A candidate is a run
of key characters that no pattern claimed; it is a secret if its log-likelihood ratio per character is above a threshold that
ordinary words almost never reach, each scored by a model that has not seen it, and that nearly all random strings pass. Strings
without lower-case letters are compared in lower case, so that words in capitals are read like any other.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.helpers import store, text_or_empty

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16
LONG_HEX = re.compile(r"[0-9a-f]{16,}")  # a run of hexadecimal digits is a match whole or not at all

KINDS = ("assign", "access", "hex", "random")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")

ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
SAMPLE_STRINGS = 20_000  # random strings
SMOOTHING = 0.5
FALSE_RATE = 0.0005      # of ordinary words above the threshold
MISS_RATE = 0.01         # of fresh random strings below it, at most
FOLDS = 5                # parts of the ordinary words, each scored by a model of the others
BIN = 1 / 1024           # width of the scores' histogram
SEED = 23
CODE = np.full(128, -1, dtype=np.int64)
CODE[[ord(c) for c in ALPHABET]] = np.arange(len(ALPHABET))
START = len(ALPHABET)


def read_as(string: str) -> str:
    """How the models see a string: one without lower-case letters in lower case."""
    return string.lower() if string.isupper() else string


def codes(strings: Iterable[str]) -> np.ndarray:
    """Codes of all characters of the strings, one after the other."""
    return CODE[np.frombuffer("".join(map(read_as, strings)).encode("ascii"), dtype=np.uint8)]


@dataclass(frozen=True)
class Model:
    """Log-likelihood ratios of each character after each other one (row ``START``: the first), and the threshold on their mean."""

    ratio: np.ndarray
    threshold: float

    def score(self, string: str) -> float:
        at = codes([string])
        return float(self.ratio[np.r_[START, at[:-1]], at].mean())


def transitions(counts: np.ndarray) -> np.ndarray:
    """Smoothed log probabilities of the next character."""
    p = counts + SMOOTHING
    return np.log(p / p.sum(axis=1, keepdims=True))


def count_pairs(strings: Iterable[str]) -> np.ndarray:
    counts = np.zeros((START + 1, START))
    for s in strings:
        at = codes([s])
        np.add.at(counts, (np.r_[START, at[:-1]], at), 1)
    return counts


def random_strings(n: int, seed: int) -> list[str]:
    """Labelled sample of secrets: keys of the usual alphabets and lengths."""
    rng = random.Random(seed)
    upper, lower, digits = ALPHABET[26:52], ALPHABET[:26], ALPHABET[52:62]
    kinds = [digits + "abcdef", digits + "ABCDEF", upper + "234567", upper + digits, lower + digits,
             lower + upper + digits, lower + upper + digits + "+/", lower + upper + digits + "-_"]
    return ["".join(rng.choices(kinds[i % len(kinds)], k=rng.randint(16, 64))) for i in range(n)]


def threshold(ratio: np.ndarray, ordinary: dict[int, int], seed: int) -> float:
    """What ``FALSE_RATE`` of the ordinary words reach (``ordinary``: words by bin of their score), but ``MISS_RATE`` of random strings fail."""
    left, top = FALSE_RATE * sum(ordinary.values()), 0.0
    for k in sorted(ordinary, reverse=True):
        left -= ordinary[k]
        if left < 0:
            top = (k + 1) * BIN
            break
    fresh = Model(ratio, 0.0)
    low = float(np.quantile([fresh.score(x) for x in random_strings(SAMPLE_STRINGS // 4, seed + 1)], MISS_RATE))
    return min(max(0.0, top) + 1e-9, low)


def trained(ordinary: list[str], held_out: list[str], seed: int = SEED) -> Model:
    """The two models and their threshold. Without ordinary strings every character is as likely, and only certain keys pass."""
    ratio = transitions(count_pairs(random_strings(SAMPLE_STRINGS, seed))) - transitions(count_pairs(ordinary))
    model = Model(ratio, 0.0)
    return Model(ratio, threshold(ratio, Counter(math.floor(model.score(x) / BIN) for x in held_out), seed))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, leftmost matches of each kind; too short ones are dropped after matching."""
    spans = []
    if ":" in text or "=" in text:
        spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGN]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(spans)


def candidates(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Runs of key characters that touch no base span."""
    yield from outside(CANDIDATE, text, base)


def outside(pattern: re.Pattern, text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Matches that touch no span of ``base``, in one sweep: ``reach`` is the furthest end of the spans that start before a match ends."""
    at, reach = 0, 0
    for m in pattern.finditer(text):
        while at < len(base) and base[at][0] < m.end():
            reach = max(reach, base[at][2])
            at += 1
        if reach <= m.start():
            yield m.span()


def spans_of(text: str, model: Model) -> list[tuple[int, int, int]]:
    """Base spans and random-looking runs, by start and then kind."""
    base = base_spans(text)
    found = [(a, 3, z) for a, z in candidates(text, base) if model.score(text[a:z]) > model.threshold]
    return sorted(base + found)


def written(spans: Iterable[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{z}" for a, k, z in spans)


def ordinary_words(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(word, n, fold): long words of at least two different texts, with the number of their documents."""
    word = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
    schema = "word string, n long, lo long, hi long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found: dict[str, tuple[int, int, int]] = {}
            for h, x in zip(b.column(0).to_pylist(), b.column(1)):
                t = x.as_py()
                base = base_spans(t)
                for w in {t[a:z] for a, z in outside(word, t, base)}:
                    n, lo, hi = found.get(w, (0, h, h))
                    found[w] = (n + 1, min(lo, h), max(hi, h))
            counts = zip(*found.values()) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), *(pa.array(c, pa.int64()) for c in counts)], ["word", "n", "lo", "hi"])

    text = text_or_empty()
    words = docs.select(F.xxhash64(text).alias("h"), text.alias("t")).mapInArrow(run, schema)
    return words.groupBy("word").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter(
        "lo != hi").select("word", "n", F.pmod(F.xxhash64(F.lit(seed), "word"), F.lit(FOLDS)).cast("int").alias("fold"))


def pairs_in(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(starts, lengths, last, next): where the words of a batch start in the codes of all their characters, and its character pairs."""
    words = b.column(0).to_pylist()
    lengths = np.array([len(w) for w in words])
    starts = np.cumsum(lengths) - lengths
    at = codes(words)
    last = np.r_[START, at[:-1]]
    last[starts] = START
    return starts, lengths, last, at


def fold_pairs(words: DataFrame) -> np.ndarray:
    """Character pairs of all words by fold, added up in the tasks."""
    shape = (FOLDS, START + 1, START)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(math.prod(shape), dtype=np.int64)
        for b in batches:
            if b.num_rows:
                _, lengths, last, at = pairs_in(b)
                n, fold = (np.repeat(b.column(i).to_numpy(), lengths) for i in (1, 2))
                np.add.at(counts, np.ravel_multi_index((fold, last, at), shape), n)
        pair = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(counts[pair])], ["pair", "n"])

    out = np.zeros(math.prod(shape))
    for pair, n in words.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n")).collect():
        out[pair] = n
    return out.reshape(shape)


def score_counts(words: DataFrame, ratios: np.ndarray) -> dict[int, int]:
    """Words, by documents, per bin of their score under the ratios of their fold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for b in batches:
            if b.num_rows:
                starts, lengths, last, at = pairs_in(b)
                fold = np.repeat(b.column(2).to_numpy(), lengths)
                score = np.add.reduceat(ratios[fold, last, at], starts) / lengths
                for k, n in zip(np.floor(score / BIN).astype(int).tolist(), b.column(1).to_pylist()):
                    found[k] += n
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], ["bin", "n"])

    return {k: n for k, n in words.mapInArrow(run, "bin long, n long").groupBy("bin").agg(F.sum("n")).collect()}


def fit(docs: DataFrame, seed: int = SEED) -> Model:
    """A model of all documents. What comes back is sums per character pair and per score, no texts."""
    words = store(ordinary_words(docs, seed), "words")
    keys, ordinary = transitions(count_pairs(random_strings(SAMPLE_STRINGS, seed))), fold_pairs(words)
    ratios = np.stack([keys - transitions(ordinary.sum(axis=0) - part) for part in ordinary])
    ratio = keys - transitions(ordinary.sum(axis=0))
    return Model(ratio, threshold(ratio, score_counts(words, ratios), seed))


def secret_scan(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random.

    Spans are ``kind:start:end`` in code points of the whole text, end exclusive, joined by commas; base_sha256 is the SHA-256 of
    that string for the three fixed kinds. Missing and empty texts have no spans. Rows given twice are scanned twice.
    """
    model = model or fit(docs)
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType),
        *[T.StructField(n, T.LongType()) for n in ("n_assign", "n_access", "n_hex", "n_random")],
        T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [spans_of(x.as_py(), model) for x in b.column(1)]
            counts = [pa.array([sum(k == kind for _, k, _ in s) for s in found], pa.int64()) for kind in range(4)]
            base = [hashlib.sha256(written(x for x in s if x[1] < 3).encode()).hexdigest() for s in found]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *counts, pa.array(base, pa.string()), pa.array(list(map(written, found)), pa.string())], schema.names)

    return docs.select("doc_id", text_or_empty().alias("t")).mapInArrow(run, schema)
