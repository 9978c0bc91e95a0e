"""Text workloads against plain Python on small inputs."""

import random
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeloom.functions.text import clean_word, clean_words, delimited_tokens, words
from lakeloom.operators import aggregates, columns
from lakeloom.operators import words as w

LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"


def py_clean(token):
    while token and token[0] not in LETTERS:
        token = token[1:]
    while token and token[-1] not in LETTERS:
        token = token[:-1]
    return "".join(c.lower() if c in LETTERS else c for c in token)


def py_pairs(texts):
    counts = Counter()
    for line in texts:
        tokens = [py_clean(t) for t in line.split()]
        for f in tokens:
            for s in tokens:
                if f and s and f != s:
                    counts[f, s] += 1
    return counts


def random_lines(n, longest, seed):
    rnd = random.Random(seed)
    vocabulary = ["The", "the,", "(cat)", "dog", "a1b", "42", "--", "é", "naïve", "ÉCOLE", "x", "X!", "don't", "a#b"]
    return [" ".join(rnd.choice(vocabulary) + str(rnd.choice(["", "", "q"])) for _ in range(rnd.randrange(longest)))
            for _ in range(n)]


@pytest.mark.parametrize("block", [1, 2, 5, 256])
def test_pairs_match_brute_force(lines, block):
    texts = random_lines(60, 25, block) + ["same line here"] * 50
    got = {(r.first, r.second): r.n for r in w.cooccur_pairs(lines(*texts), block=block).collect()}
    assert got == py_pairs(texts)


def test_long_line_is_cut_into_blocks(lines):
    text = " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)) + " aa aa ba"
    got = {(r.first, r.second): r.n for r in w.cooccur_pairs(lines(text), block=64).collect()}
    assert got == py_pairs([text])


@pytest.mark.parametrize("parts", [1, 3, 64])
def test_stripes_hold_the_pairs(lines, parts):
    texts = random_lines(40, 20, 99)
    pairs = {(r.first, r.second): r.n for r in w.cooccur_pairs(lines(*texts)).collect()}
    stripes = w.cooccur_stripes(lines(*texts), parts).collect()
    assert {(r.word, other): n for r in stripes for other, n in r.stripe.items()} == pairs
    assert sum(len(r.stripe) for r in stripes) == len(pairs)
    assert len({(r.word, r.part) for r in stripes}) == len(stripes)
    assert max(r.part for r in stripes) < parts


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aB é,.\t1", max_size=25), min_size=1, max_size=5))
def test_word_count_and_cleaning(lines, texts):
    df = lines(*texts)
    assert {r.word: r.n for r in w.word_count(df).collect()} == Counter(t for x in texts for t in x.split())
    tokens = df.select(F.explode(words("value")).alias("t"))
    cleaned = Counter(r.t for r in tokens.select(clean_word("t").alias("t")).collect())
    assert cleaned == Counter(py_clean(t) for x in texts for t in x.split())
    whole = [r.t for r in df.select(clean_words("value").alias("t")).collect()]
    assert sorted(whole) == sorted([c for c in map(py_clean, x.split()) if c] for x in texts)


def test_whitespace_is_ascii_only(lines):
    df = lines("a\u00a0b c\x0bd\x0ce")
    assert df.select(words("value")).first()[0] == ["a\u00a0b", "c", "d", "e"]


def test_last_token_above(lines, rows):
    data = lines("2001   31 32  34", "2002 23\t25", "[2003]*40", "2004", "2005 3 x", "", "2001 31 45", "2006 [30]")
    assert rows(columns.last_token_above(data)) == [("2001", 34), ("2001", 45), ("2003", 40)]
    assert data.select(delimited_tokens("value")).first()[0] == ["2001", "31", "32", "34"]


def test_count_by_field_keeps_the_header_and_drops_short_lines(lines, rows):
    data = lines("a,b,c,d,e,f,g,Country", "1,2,3,4,5,6,7,Spain,x", '1,2,3,4,5,6,"7,Spain', "1,2,3", "1,2,3,4,5,6,7,,,")
    assert rows(aggregates.count_by_field(data)) == [("Country", 1), ("Spain", 2)]
    assert aggregates.short_lines(data).first().n_short == 2


def test_sum_by_field_skips_bad_amounts_and_empty_keys(lines, rows):
    data = lines("1,x,10,Visa", "2,x,5,Visa", "3,x,1.5,Visa", "4,x,abc,Cash", "5,x,7,", "6,x,2,Cash", "7,x")
    assert rows(aggregates.sum_by_field(data)) == [("Cash", 2), ("Visa", 15)]


def test_mean_and_variance_skip_what_is_no_number(lines):
    data = aggregates.measure(lines("a,8.0,b", "a,9.0,b", "a,x,b", "a", "a,8.5,b"))
    assert tuple(aggregates.mean_parts(data, "x").first()) == (25.5, 3, 8.5)
    dev, n, var = aggregates.variance_parts(data, "x").first()
    assert (round(dev, 9), n, round(var, 9)) == (0.5, 3, round(0.5 / 3, 9))
    about = aggregates.deviation_about(data, "x", 8.5).first()
    assert (about.sum_sq_dev, about.n) == (0.5, 3)


def test_pairs_are_made_after_the_shuffle(lines, monkeypatch):
    """What is shuffled has a row for a word of a line, not for a pair; the words of most lines have the first numbers."""
    monkeypatch.setattr(w, "TASK_PAIRS", 1000)
    texts = [" ".join(f"{chr(97 + i)}{chr(97 + j)}" for j in random.Random(i).sample(range(26), 20)) + " the the of" for i in range(20)]
    counts, numbers = w.pair_counts(lines(*texts))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate posexplode(ys") < plan.index("Exchange hashpartitioning(x")
    assert "Exchange" not in plan[:plan.index("Generate posexplode(ys")]
    names = {r.number: r.word for r in numbers.collect()}
    assert sorted(names) == list(range(len(names))) and {names[0], names[1]} == {"the", "of"}
    got = {(names[r.pair >> 32], names[r.pair & (1 << 32) - 1]): r.n for r in counts.collect()}
    assert {(b, a): n for (a, b), n in got.items()} | got == py_pairs(texts) and len(py_pairs(texts)) == 2 * len(got)
