"""Quality rules whose cutoffs are certified on labelled documents.

Every rule is a number per document, higher being worse, and a fixed list of cutoffs. The labelled documents of a stratum are dealt into two
halves by a hash of their id. The first half picks a cutoff per rule, the one that finds most bad documents more than it loses
good ones, and puts the rules in order of that gain. The second half, which had no part in the choice, certifies them: the best
rule alone, the best two together and so on are tested in this fixed sequence, as long as the exact binomial bound shows that
together they reject at most ``alpha`` of the good documents. Testing ends at the first failure, so that a sequence needs no
correction for its length; over the strata the bounds hold together with probability ``1 - delta`` (Bonferroni).
Only DataFrame expressions are used.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.helpers import packed, store, text_or_empty, unpacked, words_of

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals"]

# Rules as SQL over the counts (all integers, so that any engine gives the same quotient), with cutoffs.
RULES: dict[str, str] = {
    "symbols": "1000 * n_symbols / nullif(word_chars, 0)",
    "capitals": "1000 * n_capitals / nullif(word_chars, 0)",
    "dup_lines": "1000 * n_dup_lines / nullif(n_words, 0)",
    "repeats": "1000 * n_repeat_words / nullif(n_words, 0)",
    "long_words": "100 * word_chars / nullif(n_words, 0)",
}
CUTOFFS: dict[str, Sequence[int]] = {
    "symbols": (10, 20, 50, 100, 150, 200, 300, 400),
    "capitals": (50, 100, 150, 200, 300, 400, 600, 800),
    "dup_lines": (2, 5, 10, 20, 30, 50, 100, 200),
    "repeats": (50, 100, 150, 200, 250, 300, 400, 450),
    "long_words": (700, 800, 900, 1000, 1200, 1500, 2000, 3000),
}
ALPHA = 0.05        # good documents of a stratum that all its cutoffs together may reject
DELTA = 0.05
PICK_SHARE = 0.025  # good documents of the first half that a cutoff may lose to be picked


def measured(docs: DataFrame, keep: Mapping[str, Column], text: Column | None = None) -> DataFrame:
    """The columns of ``keep`` with the counts of each whole text; an empty or missing text counts zero.

    ``n_repeat_words`` are the words that lie in a 3-word window found twice or more. Windows are compared by a 64-bit
    hash of their words. The work per text is linear apart from one sort, which only repeating texts pay.
    """
    names = list(keep)
    body = text_or_empty() if text is None else text

    def step(df: DataFrame, *kept: str, **new: Column) -> DataFrame:
        return df.select(*names, *kept, *[c.alias(n) for n, c in new.items()])

    def pair(a: Column, b: Column) -> Column:
        return F.xxhash64(a, b)

    def same(a: Column, b: Column) -> Column:
        return F.coalesce(a["h"] == b["h"], F.lit(False))

    df = docs.select(*[c.alias(n) for n, c in keep.items()], body.alias("_t"))
    df = step(df, "_t", _w=words_of(F.col("_t")),
              _l=F.filter(F.split("_t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    w = F.col("_w")
    df = step(
        df,
        n_words=F.size("_w").cast("long"),
        word_chars=F.length(F.array_join("_w", "")).cast("long"),
        n_symbols=F.length(F.regexp_replace("_t", f"[^{SYMBOLS}]+", "")).cast("long"),
        n_capitals=F.length(F.regexp_replace("_t", "[^A-Z]+", "")).cast("long"),
        n_dup_lines=(F.size("_l") - F.size(F.array_distinct("_l"))).cast("long"),
        _n=F.size(w),
        _g=F.zip_with(F.zip_with(w, F.slice(w, 2, F.size(w)), pair), F.slice(w, 3, F.size(w)), pair))
    base = COUNTS[:4] + COUNTS[5:]
    # The last two entries lack words: no windows start there.
    df = step(df, *base, _g=F.slice("_g", 1, F.greatest(F.col("_n") - 2, F.lit(0))))
    df = step(df, *base, _s=F.when(
        F.size(F.array_distinct("_g")) < F.size("_g"),
        F.sort_array(F.transform("_g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    s = F.col("_s")
    df = step(df, *base, _p=F.sort_array(F.transform(
        F.filter(s, lambda x, i: same(x, F.get(s, i - 1)) | same(x, F.get(s, i + 1))), lambda x: x["i"])))
    covered = F.aggregate(
        "_p", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, p: F.struct((a["n"] + p + 3 - F.greatest(a["end"], p)).alias("n"), (p + 3).alias("end")),
        lambda a: a["n"])
    df = step(df, *base, n_repeat_words=F.coalesce(covered, F.lit(0)).cast("long"))
    return df.select(*names, *COUNTS)


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def log_binomial_tail(k: Column, n: Column, p: Column) -> Column:
    """Natural logarithm of P(X <= k) for X ~ Binomial(n, p), summed exactly, term by term, in logarithms."""
    odds = F.log(p / (1 - p))
    first = n * F.log(1 - p)

    def add(a: Column, i: Column) -> Column:
        term = a["term"] + F.log((n - i + 1) / i) + odds
        top = F.greatest(a["total"], term)
        return F.struct(term.alias("term"), (
            top + F.log(F.exp(a["total"] - top) + F.exp(term - top))).alias("total"))

    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.aggregate(steps, F.struct(first.alias("term"), first.alias("total")), add, lambda a: a["total"])


def picked_cutoffs(holdout: DataFrame, rules: Mapping[str, str] = RULES, cutoffs: Mapping[str, Sequence[int]] = CUTOFFS,
                   share: float = PICK_SHARE) -> DataFrame:
    """(stratum, and per rule a nullable ``cut_`` and ``place_`` in the order of gains) from ``holdout`` (stratum, good, and the counts).

    Each labelled document is counted once per rule, at the largest cutoff it reaches, and running sums over the cutoffs give the
    rest, so the work does not grow with the number of cutoffs.
    """
    levels = [F.struct(
        F.lit(name).alias("rule"),
        F.filter(F.array(*[F.lit(c) for c in cutoffs[name]]), lambda c: c <= F.expr(sql)).alias("hit"))
        for name, sql in rules.items()]
    long = holdout.select("stratum", "good", F.explode(F.array(*levels)).alias("x"))
    totals = long.filter(F.col("x.rule") == next(iter(rules))).groupBy("stratum").agg(
        F.sum(F.col("good").cast("long")).alias("n_good"))
    reached = long.filter(F.size("x.hit") > 0).groupBy(
        "stratum", F.col("x.rule").alias("rule"), F.array_max("x.hit").alias("top")).agg(
            F.sum(F.col("good").cast("long")).alias("good"), F.sum((~F.col("good")).cast("long")).alias("bad"))
    grid = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(c).alias("cutoff"))
                               for r in rules for c in cutoffs[r]]))
    strata = totals.select("stratum", "n_good", grid.alias("x")).select("stratum", "n_good", "x.*")
    r = reached.select(F.col("stratum").alias("s"), F.col("rule").alias("r"), "top", "good", "bad")
    counts = strata.join(r, F.col("stratum").eqNullSafe(F.col("s")) & (F.col("rule") == F.col("r"))
                         & (F.col("top") >= F.col("cutoff")), "left").groupBy(
        "stratum", "n_good", "rule", "cutoff").agg(
            F.coalesce(F.sum("good"), F.lit(0)).alias("lost"), F.coalesce(F.sum("bad"), F.lit(0)).alias("found"))
    sound = counts.filter((F.col("found") > F.col("lost")) & (F.col("lost") <= share * F.col("n_good")))
    best = sound.groupBy("stratum", "rule").agg(
        F.max(F.struct((F.col("found") - F.col("lost")).alias("gain"), F.col("cutoff"))).alias("x"))
    order = Window.partitionBy("stratum").orderBy(F.col("x.gain").desc(), "rule")  # a row per rule
    placed = best.withColumn("place", F.row_number().over(order))
    return placed.groupBy("stratum").agg(*[
        F.max(F.when(F.col("rule") == name, F.col(x))).alias(f"{to}_{name}")
        for name in rules for x, to in (("x.cutoff", "cut"), ("place", "place"))])


def certified_cutoffs(holdout: DataFrame, rules: Mapping[str, str] = RULES,
                      cutoffs: Mapping[str, Sequence[int]] = CUTOFFS,
                      alpha: float = ALPHA, delta: float = DELTA, share: float = PICK_SHARE) -> DataFrame:
    """(stratum, one nullable cutoff per rule) from ``holdout`` (stratum, good, picks, and the counts).

    Rows with ``picks`` choose, the others certify. A null stratum is a stratum. Rows without a verdict (``good`` null) are left
    out. Without any loss a stratum needs ``log(delta / strata) / log(1 - alpha)`` good documents that certify.
    """
    labelled = holdout.filter(F.col("good").isNotNull())
    picked = picked_cutoffs(labelled.filter("picks"), rules, cutoffs, share).withColumnRenamed("stratum", "_stratum")
    n_strata = labelled.agg(F.count_distinct("stratum") + F.max(F.col("stratum").isNull().cast("int")))
    first = F.least(*[F.when(F.expr(f"{sql} >= cut_{name}"), F.col(f"place_{name}")) for name, sql in rules.items()], F.lit(None))
    tried = labelled.filter("good AND NOT picks").join(picked, F.col("stratum").eqNullSafe(F.col("_stratum"))).withColumn("_first", first)
    depths = range(1, len(rules) + 1)
    losses = tried.groupBy("stratum").agg(
        F.count("*").alias("n_good"), *[F.count_if(F.col("_first") <= j).alias(f"lost_{j}") for j in depths])
    allowed = losses.join(F.broadcast(n_strata.toDF("n_strata"))).withColumn(  # one row
        "allowed", F.log(F.lit(delta) / F.col("n_strata")))
    # A longer sequence loses no less, so the tests that pass are its first ones.
    passed = [F.when((F.col(f"lost_{j}") <= alpha * F.col("n_good"))
                     & (log_binomial_tail(F.col(f"lost_{j}"), F.col("n_good"), F.lit(alpha)) <= F.col("allowed")), j) for j in depths]
    depth = allowed.select("stratum", F.greatest(*passed, F.lit(0)).alias("depth"))
    both = depth.join(picked, F.col("stratum").eqNullSafe(F.col("_stratum")))
    return both.select("stratum", *[
        F.when(F.col(f"place_{name}") <= F.col("depth"), F.col(f"cut_{name}")).alias(f"cut_{name}") for name in rules])


def verdict(rules: Mapping[str, str] = RULES) -> Column:
    """Whether a row with counts, and the cutoffs of its stratum, is kept.

    One number over counts and cutoffs, not a conjunction: Spark would push the part on counts below the join and down
    to the scan as a filter, and there write out every count anew wherever it is named.
    """
    hits = [base_failed()] + [F.coalesce(F.expr(f"{sql} >= cut_{name}"), F.lit(False)) for name, sql in rules.items()]
    return F.greatest(*[h.cast("int") for h in hits]) == 0


def one_verdict(labels: DataFrame) -> DataFrame:
    """One row per labelled document: good only if every label of it says so. Null ids and null labels fall out."""
    return labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy(
        F.col("doc_id").alias("labelled_id")).agg((F.min("quality") == 1).alias("good"))


def picks(name: str) -> Column:
    """Whether a labelled document is of the half that picks cutoffs."""
    return F.substring(F.md5(F.col(name).cast("string").cast("binary")), 1, 1) < "8"


def decide(counts: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """``counts`` (with ``stratum``) and ``base_failed``, ``kept``. ``cutoffs`` is a stored table with one row per stratum;
    Spark knows its size and broadcasts it when it is small."""
    c = cutoffs.withColumnRenamed("stratum", "_stratum")
    joined = counts.join(c, F.col("stratum").eqNullSafe(F.col("_stratum")), "left")
    return joined.withColumns({"base_failed": base_failed(), "kept": verdict()}).drop(*c.columns)


def fit(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """Stored cutoffs from counts (doc_id, stratum, ...) and ``labels`` (doc_id, quality).

    Documents that the base rules reject are no evidence on the cutoffs and are left out. A document id
    that occurs in several rows counts with each.
    """
    holdout = counts.filter(~base_failed()).join(
        one_verdict(labels), F.col("doc_id") == F.col("labelled_id")).withColumn("picks", picks("doc_id")).drop("labelled_id")
    return store(certified_cutoffs(holdout).coalesce(1), "cutoffs")


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, stratum (lang), the counts, base_failed, kept. Texts are read once."""
    counts = store(measured(docs, {"doc_id": F.col("doc_id"), "stratum": F.col("lang")}), "counts")
    return decide(counts, fit(counts, labels))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The kept rows of ``docs``, all columns. The second pass counts again where the text lies and moves none of it."""
    counts = measured(docs, {"doc_id": F.col("doc_id"), "stratum": F.col("lang")})
    cutoffs = fit(store(counts, "counts"), labels)
    again = measured(docs, {"row": packed(docs), "stratum": F.col("lang")})
    return unpacked(decide(again, cutoffs).filter("kept"), "row", docs.columns)


