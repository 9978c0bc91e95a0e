"""Co-occurrence in rounds and in arrays, against plain Python."""

import random
import time
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from lakeloom.operators import pairs
from lakeloom.operators import words as w
from test_words import py_pairs, random_lines


def partners(texts):
    found = defaultdict(list)
    for (first, second), n in py_pairs(texts).items():
        found[first].append((n, len(second) + 31 * ord(second[0]) + 1009 * ord(second[-1])))
    return {x: (len(v), sum(n for n, _ in v), max(n for n, _ in v), sum(n * k for n, k in v)) for x, v in found.items()}


@pytest.fixture
def small_rounds(monkeypatch):
    for name, value in (("TASK_PAIRS", 500), ("ROUND_TASKS", 2)):
        monkeypatch.setattr(w, name, value)


def test_rounds_give_each_pair_once_and_leave_no_shuffle_files(spark, lines, small_rounds):
    texts = random_lines(60, 25, 7) + ["same line here"] * 50 + [" ".join(f"w{i:b}z".replace("0", "a").replace("1", "b") for i in range(60))] + [None, ""]
    local = Path(spark._jvm.org.apache.spark.util.Utils.getLocalDir(spark._jsc.sc().conf()))
    shuffled = lambda: {p.name.split("_")[1] for p in local.parent.rglob("shuffle_*.data")}
    rounds, numbers = w.pair_counts(lines(*texts), apart=True)
    assert len(rounds) > 2
    before, setting = shuffled(), spark.conf.get(w.CLEANUP, None)
    got = {r.word: tuple(r)[1:] for r in w.partners_per_word(rounds, numbers).collect()}
    assert got == partners([t for t in texts if t])
    for _ in range(50):  # they go in the background
        if len(left := shuffled() - before) <= 4:  # of the result, which is read lazily
            break
        time.sleep(0.1)
    assert len(left) <= 4 < 2 * len(rounds) and spark.conf.get(w.CLEANUP, None) == setting


@pytest.mark.parametrize("parts", [1, 16])
def test_stripes_of_rounds_are_whole(lines, small_rounds, parts):
    texts = random_lines(60, 25, 8) + ["same line here"] * 50
    rounds = w.cooccur_stripes(lines(*texts), parts, apart=True)
    rows = [r for stripes in rounds for r in stripes.collect()]
    assert len(rounds) > 2 and len({(r.word, r.part) for r in rows}) == len(rows) and max(r.part for r in rows) < parts
    assert {(r.word, other): n for r in rows for other, n in r.stripe.items()} == py_pairs(texts)
    assert sum(len(r.stripe) for r in rows) == len(py_pairs(texts))


def test_no_lines_have_no_pairs(lines):
    for text in ("", "alone", "-- 42", None):
        assert w.partners_per_word(*w.pair_counts(lines(text, text), apart=True)).count() == 0
        assert w.cooccur_pairs(lines(text, text)).count() == 0


@pytest.mark.parametrize("spread", [0, 1, 3])
@pytest.mark.parametrize("limit", [1, 7, 10_000])
def test_arrays_match_brute_force(monkeypatch, spread, limit):
    """Every limit set low: chunks of few words, words that travel with the lines, buffers added up many times."""
    for name in ("CHUNK_WORDS", "BUFFER_PAIRS", "SENT_PAIRS", "FREQUENT"):
        monkeypatch.setattr(pairs, name, limit)
    monkeypatch.setattr(pairs, "COMMON", 3)
    monkeypatch.setattr(pairs, "TaskContext", type("T", (), {"get": staticmethod(lambda: type("C", (), {"partitionId": lambda self: 0})())}))
    texts = [[t for t in line.lower().replace("é", "e").split() if t.isalpha()] for line in random_lines(50, 30, limit)]
    copies = Counter(" ".join(sorted(t)) for t in texts)
    rows = pa.RecordBatch.from_pydict({"joined": [*copies, None], "copies": [*copies.values(), 1]})
    chunks = list(pairs.chunked(iter([rows])))
    if limit == 1:
        assert len(chunks) == len([t for t in copies if t])
    seen = Counter(x for t in copies for x in set(t.split()))
    order = {x: i for i, (x, _) in enumerate(sorted(seen.items(), key=lambda f: (-f[1], f[0])))}
    told = []
    for c in chunks:
        held = c.column("words")[0].values.to_pylist()
        told.append(c.append_column("numbers", pa.array([[order[x] for x in held]], pa.list_(pa.int32()))))
    numbered = list(pairs.numbered(4, 50)(iter(told)))
    got, common = Counter(), pa.array([x for x in order][:3])
    names = {i: x for x, i in order.items()}
    for first in (0, 2, 4):
        for key in (first, first + 1):
            sent = [b for b in pairs.dealt(6, first, [first, first + 1], spread)(iter(numbered)) if b.column("x_tile")[0].as_py() == key]
            for x, sizes, y, n, known, said in pairs.added(iter(sent), common, spread > 0):
                assert said.to_pylist() == [names[i] for i in known]
                for one, other, k in zip(np.repeat(x, sizes), y, n):
                    assert (names[one], names[other]) not in got and (spread or one > other)
                    got[names[one], names[other]] += int(k)
    expected = py_pairs([" ".join(t) for t in texts])
    assert got == (expected if spread else {(a, b): n for (a, b), n in expected.items() if order[a] > order[b]})


def test_counts_too_large_for_one_number():
    x, sizes, y, n = pairs._summed(np.array([5, 3, 5]), np.array([2, 1, 2]), np.array([1, 2, 0, 1, 2], "u4"), np.array([1 << 61, 1, 1 << 60, 2, 3]))
    assert (x.tolist(), sizes.tolist(), y.tolist(), n.tolist()) == ([3, 5], [1, 2], [0, 1, 2], [1 << 60, (1 << 61) + 2, 4])


def test_letters_of_words():
    words = pa.array(["zz", "a", "né-b", "cat"]).slice(1)
    assert pairs._letters(words).tolist() == [len(x) + 31 * ord(x[0]) + 1009 * ord(x[-1]) for x in ("a", "né-b", "cat")]
