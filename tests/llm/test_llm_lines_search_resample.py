"""Line deduplication, lexical search and importance resampling against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from test_llm_brute import docs, frame, made_texts, none, pairs_of  # noqa: F401

from lakeloom.llm import importance, lexical_search, line_dedup, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
NO_ID = -1


@pytest.fixture(scope="module")
def notices(spark):
    """Documents that share lines: one line in a third of all, some in two, some in three, some twice in one document."""
    rng = random.Random(3)
    texts = []
    for i in range(90):
        lines = [f"a line of document {i} that no other one has", "short", "", f"\tShared By Two Or So {i % 45} \x0b"]
        lines += [f"shared by three of them {i % 30}", "É: ÀNOTHER Line With Accents"] * (1 + (i % 7 == 0))
        lines += ["  This Very Common Notice IS everywhere\r"] * (i % 3 == 0) + ["this very common notice is everywhere"] * (i % 9 == 0)
        rng.shuffle(lines)
        texts.append("\n".join(lines))
    ids = list(range(90))
    ids[5], ids[60], ids[70] = None, None, 12
    return frame(spark, [*texts, None, "", "\n", "x" * 300_000], [*ids, 90, 91, 92, 93]).repartition(5)


def plain_dedup(rows, length=20, least=3):
    def key(line):
        return line.strip(" \t\n\v\f\r").translate(LOWER)

    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(NO_ID if i is None else i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < length or len(holders[key(x)]) < least
                or max(holders[key(x)]) == (NO_ID if i is None else i)]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("batches, least, length", [(4, 3, 20), (1, 3, 20), (7, 2, 3), (3, 200, 1)])
def test_line_dedup(notices, batches, least, length):
    got = line_dedup.line_dedup(notices, length, least, batches)
    rows = sorted((tuple(r) for r in got.collect()), key=repr)
    assert rows == plain_dedup(pairs_of(notices), length, least)
    assert least == 200 or sum(r[3] for r in rows) > 30


def test_line_dedup_of_repeated_rows(docs, none):  # noqa: F811
    got = sorted((tuple(r) for r in line_dedup.line_dedup(docs).collect()), key=repr)
    assert got == plain_dedup(pairs_of(docs))
    assert line_dedup.line_dedup(none).collect() == []


def test_lines_stage_keeps_columns(notices):
    got = line_dedup.keep_lines(notices)
    assert got.schema == notices.schema
    want = Counter((i, t) for i, t, *_ in plain_dedup(pairs_of(notices)))
    assert Counter((r["doc_id"], r["text"] or "") for r in got.collect()) == want
    assert got.filter("doc_id = 90").first()["text"] is None


def test_line_dedup_runs_no_python(notices):
    plan = line_dedup.line_dedup(notices)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_runs_are_levelled_and_forget_settled_lines(spark):
    runs = line_dedup.LineRuns(spark, least=2)
    for i in range(7):
        runs.add(spark.createDataFrame([(100 - i, 1, 1), (100 - i, 50 + i, 2)], "doc_id long, h long, g long"))
        assert len(runs.runs) == (i + 1).bit_count()
    assert [r.count() for r in runs.runs] == [1, 2, 5]  # the settled line is in the two oldest batches alone
    assert [tuple(r) for r in runs.repeated().collect()] == [(1, 1, 100)]
    runs.add(spark.createDataFrame([(101, 1, 1)], "doc_id long, h long, g long"))
    assert [tuple(r) for r in runs.repeated().collect()] == [(1, 1, 101)]  # a larger id is news


def plain_search(items, rows, k):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    bags = [(i, Counter(term.findall((t or "").translate(LOWER)))) for i, t in rows]
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = defaultdict(set)
    for i, t in items:
        asked[i].update(term.findall((t or "").translate(LOWER)))
    out = []
    for item, terms in asked.items():
        found = []
        for i, bag in bags:
            m = 50 + 50 * sum(bag.values()) * n_docs // n_terms if n_terms else 50
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * bag[t] // (1000 * bag[t] + 20 * m)) for t in terms if bag[t])
            if score:
                found.append((-score, i is None, i))
        for rank, (score, _, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1):
            out.append((item, rank, i, -score))
    return sorted(out, key=repr)


def items_of(spark, docs):  # noqa: F811
    texts = sorted(t for _, t in pairs_of(docs) if t)
    rows = [(i, " ".join(t.split()[:25]) + " Word, A b") for i, t in enumerate(texts[::6])]
    rows += [(1, "rare-words of one more row"), (77, None), (78, "..."), (79, "wo" + "rd" * 200_000), (None, "line ONE here")]
    return spark.createDataFrame([(t, i, "x") for i, t in rows], "text string, item_id long, score string")


@pytest.mark.parametrize("k, pairs", [(50, 1 << 18), (3, 40)])
def test_search(spark, docs, k, pairs):  # noqa: F811
    items = items_of(spark, docs)
    got = sorted((tuple(r) for r in lexical_search.search(items, docs, k, pairs).collect()), key=repr)
    want = plain_search([(r["item_id"], r["text"]) for r in items.collect()], pairs_of(docs), k)
    assert got == want and len({r[0] for r in got}) > 8


def test_search_of_nothing(spark, docs, none):  # noqa: F811
    items = items_of(spark, docs)
    assert lexical_search.search(items, none).collect() == []
    assert lexical_search.search(items.limit(0), docs).collect() == []


def test_skipping_changes_no_result_and_saves_postings(monkeypatch):
    """Small indexes, ranges and lists of both kinds; Zipf-like terms, so that long lists have low impacts."""
    monkeypatch.setattr(lexical_search, "RANGE", 8)
    monkeypatch.setattr(lexical_search, "SHORT", 12)
    rng = np.random.default_rng(4)
    n_docs, n_terms = 3000, 300
    rows = [Counter(np.minimum(rng.zipf(1.3, rng.integers(1, 60)), n_terms) - 1) for _ in range(n_docs)]
    df = Counter(t for r in rows for t in r)
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in range(n_terms)])
    n = np.array([sum(r.values()) for r in rows])
    stats = lexical_search.Statistics(n_docs, int(n.sum()), weight)
    ids = rng.permutation(n_docs)
    norm = stats.length_norm(n)
    indexes = [lexical_search.Index(
        ids[a:a + 1000], n[a:a + 1000], [np.array(list(r), "<u4") for r in rows[a:a + 1000]],
        [np.array(list(r.values()), "<u4") for r in rows[a:a + 1000]], stats) for a in (0, 1000, 2000)]
    saved = 0
    for _ in range(60):
        terms = sorted(set((np.minimum(rng.zipf(1.3, 12), n_terms) - 1).tolist()))
        best = lexical_search.Best(10)
        before = sum(i.scored for i in indexes)
        for i in indexes:
            i.answer(terms, best)
        whole = sum(i.lists[t][1] - i.lists[t][0] for i in indexes for t in terms
                    if t in i.lists and (i.lists[t][1] - i.lists[t][0]) * 12 > 1000)
        saved += whole - (sum(i.scored for i in indexes) - before)
        scores = [(-sum(int(weight[t]) * (1_000_000_000 * r[t] // (1000 * r[t] + 20 * int(m))) for t in terms if r[t]), int(d))
                  for r, m, d in zip(rows, norm, ids)]
        want = [x for x in sorted(scores)[:10] if x[0] < 0]
        assert list(zip((-best.score).tolist(), best.doc.tolist())) == want
    assert saved > 0


def plain_resample(rows, target):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def buckets(text):
        return [zlib.crc32(w.encode()) % 10_000 for w in word.findall((text or "").translate(LOWER))]

    held = [(i, buckets(t)) for i, t in rows]
    s, t = Counter(b for _, x in held for b in x), Counter(b for x in target for b in buckets(x))
    s_all, t_all = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in s}
    out = []
    for i, found in held:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in found)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(fit[:10 * len(fit) // 100], 1):
        r[4] = rank
    return sorted((tuple(r) for r in out), key=repr)


def test_resample(spark, docs, none):  # noqa: F811
    target = spark.createDataFrame([(t,) for t in made_texts()[20:30]] + [(None,)], "text string")
    got = sorted((tuple(r) for r in importance.resample(docs, target).collect()), key=repr)
    assert got == plain_resample(pairs_of(docs), [r["text"] for r in target.collect()])
    assert max(r[4] or 0 for r in got) == 10 * sum(r[1] >= 20 for r in got) // 100
    assert importance.resample(none, target).collect() == []
    assert importance.resample(docs, none).count() == docs.count()


@pytest.mark.parametrize("part_bits, digit_bits, most", [(2, 3, 1000), (14, 11, 2**40), (3, 11, 1), (1, 1, 9)])
def test_radix_sort(spark, monkeypatch, part_bits, digit_bits, most):
    monkeypatch.setattr(importance, "PART_BITS", part_bits)
    monkeypatch.setattr(importance, "DIGIT_BITS", digit_bits)
    rng = random.Random(most)
    rows = [(rng.randint(0, most) if rng.random() < 0.6 else most, rng.randint(0, 40)) for _ in range(60)]
    got = importance.radix_sorted(spark.createDataFrame(rows, "a long, b long").repartition(3), ["a", "b"]).orderBy("pos").collect()
    assert [r["pos"] for r in got] == list(range(60))
    assert [(r["a"], r["b"]) for r in got] == sorted(rows)


def test_registered_queries_have_sql():
    new = ["op11_line_dedup", "op12_lexical_search", "op13_importance"]
    assert all(name in queries.QUERIES and name in queries.ORACLES for name in new)
