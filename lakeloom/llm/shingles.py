"""Weighted word shingles of a text, their probability Jaccard similarity and its ProbMinHash sketch (NumPy only).

Words are the runs of other bytes than ASCII white space, lower-cased for A-Z. A shingle is ``size`` words in
a row; a shorter text is one shingle. Its weight is ``1 + ln(count)``: a line repeated a thousand times counts more
than once, and does not drown the rest.
"""

from __future__ import annotations

import numpy as np
import xxhash

MEMO_BYTES = 24 << 20  # words and hashes that a task keeps
MEMO_WORD = 64         # longer words are hashed each time
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hash of each word met so far, within ``MEMO_BYTES``."""

    held = 0

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= MEMO_WORD:
            if self.held > MEMO_BYTES:
                self.clear()
                self.held = 0
            self[word] = value
            self.held += len(word) + 160
        return value


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def weighted(words: list[bytes], memo: WordHashes, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles (ascending 64-bit hashes) and their weights."""
    if not words:
        return np.array([], dtype=np.uint64), np.array([])
    h = np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=len(words))
    k = min(size, len(h))
    s = np.full(len(h) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        s = mix(s * GOLDEN + h[i:len(h) - k + 1 + i])
    keys, counts = np.unique(s, return_counts=True)
    return keys, 1 + np.log(counts)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard: sum over common shingles i of 1 / sum_j max(a_j / a_i, b_j / b_i).

    For equal weights it is the Jaccard similarity. The inner sums come from one sort by the ratio a_j / b_j.
    """
    (ka, wa), (kb, wb) = a, b
    common, ia, ib = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    only_a, only_b = wa.sum() - wa[ia].sum(), wb.sum() - wb[ib].sum()
    x, y = wa[ia], wb[ib]
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    above = x[::-1].cumsum()[::-1] + only_a       # ratio at least that of i: a decides
    below = np.r_[0.0, y.cumsum()[:-1]] + only_b  # smaller ratio: b decides
    return float((1 / (above / x + below / y)).sum())


def sketches(docs: list[tuple[np.ndarray, np.ndarray]], m: int) -> np.ndarray:
    """ProbMinHash signatures, one row of ``m`` 32-bit components per document; each document has a shingle.

    Every shingle is a Poisson process whose rate is its weight; each arrival falls into a random component, and a component keeps
    the shingle that arrives first. A process stops when its next arrival comes after the latest component of its document.
    All processes of the batch advance together, one arrival at a time. Two documents agree in a component with the
    probability Jaccard similarity of their shingles.
    """
    key = np.concatenate([k for k, _ in docs])
    rate = np.concatenate([w for _, w in docs])
    row = np.repeat(np.arange(len(docs)), [len(k) for k, _ in docs])
    first = np.full(len(docs) * m, np.inf)
    held = np.zeros(len(docs) * m, dtype=np.uint64)
    time, state = np.zeros(len(key)), mix(key + GOLDEN)
    while len(key):
        state = state + GOLDEN
        draw = mix(state)
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)) / rate
        slot = row * m + (mix(draw ^ GOLDEN) % np.uint64(m)).astype(np.int64)
        np.minimum.at(first, slot, time)
        won = time == first[slot]
        held[slot[won]] = key[won]
        on = time < first.reshape(-1, m).max(axis=1)[row]
        key, rate, row, time, state = key[on], rate[on], row[on], time[on], state[on]
    return (mix(held) >> np.uint64(32)).astype("<u4").reshape(-1, m)
