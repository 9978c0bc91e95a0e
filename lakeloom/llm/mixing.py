"""Mixes sources to target weights by fitting subset sums of document lengths.

Each source gets whole repeats of all its documents, as many as its target holds, and for the rest of its budget a number of documents
of each exact length: first the same share of every length, rounded up or down so that the sums along the lengths hold, then a bounded
knapsack over the lengths for what is left. Which documents of a length are taken follows from a seeded hash, so reruns agree.

Only (source, length) counts reach Python. The chosen documents of a length are those up to a hash threshold, so
rows meet their plan by (source, length) and no text moves.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.helpers import packed, store, text_or_empty, unpacked, words_of

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5           # of all sizes
MOST = 2.0            # times its size that a source may give
SEED = 17
KNAPSACK = 1 << 16    # words left to the knapsack; its memory is a few bytes for each
BUCKET_BITS = 12      # documents of one length are ranked in 4096 parts
BROADCAST_ROWS = 1_000_000  # plan rows (some 50 bytes each) that are sent to every executor


def size_of() -> Column:
    return F.size(words_of(text_or_empty())).cast("long")


def draw(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("doc_id"), text_or_empty())


def targets(counts: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from (source, size, n).

    Sources in code-point order, null last, get the weights in turn. A target is ``weight * level`` or, where that is above it,
    ``most`` times the source's size. The level comes from running sums over the sources by the level at which each one stops;
    that equals resharing the excess by weight until none is above. One row per source meets in one task, no documents.
    """
    s = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    at = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1
    s = s.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), at)).withColumn(
        "stop", most * F.col("source_size") / F.col("w"))
    order = Window.orderBy("stop", F.col("source").asc_nulls_last())
    s = s.select(
        "*", F.sum(most * F.col("source_size")).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("full"),
        F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)).alias("open"),
        F.sum("source_size").over(Window.partitionBy()).alias("total"))
    level = (share * F.col("total") - F.coalesce("full", F.lit(0.0))) / F.col("open")
    # The first source in this order that does not stop below the level sets it for the rest; later ones give less.
    s = s.withColumn("level", F.max(F.when(level <= F.col("stop"), level)).over(Window.partitionBy()))
    cap = most * F.col("source_size")
    return s.select("source", "source_size", F.least(cap, F.coalesce(F.col("w") * F.col("level"), cap)).alias("target"))


def subset_sum(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each size to take, at most ``counts``, so that the sum is the largest reachable up to ``budget``."""
    take = np.zeros(len(sizes), dtype=np.int64)
    best = np.full(budget + 1, -1, dtype=np.int32)  # the item that first reached each sum
    reached = np.zeros(budget + 1, dtype=bool)
    reached[0] = True
    items: list[tuple[int, int]] = []
    for i in np.argsort(-sizes, kind="stable"):
        size, left, part = int(sizes[i]), int(counts[i]), 1
        left = min(left, budget // size) if size else 0
        while left > 0 and not reached[budget]:  # 1, 2, 4, ... copies make any number up to the count
            part = min(part, left)
            step = size * part
            if step <= budget:
                new = reached[:-step] & ~reached[step:]
                best[step:][new] = len(items)
                reached[step:] |= new
                items.append((int(i), part))
            left, part = left - part, part * 2
    at = int(np.flatnonzero(reached)[-1])
    while at:
        i, part = items[best[at]]
        take[i] += part
        at -= int(sizes[i]) * part
    return take


def shares(sizes: np.ndarray, counts: np.ndarray, part: int, total: int, seed: int = SEED) -> np.ndarray:
    """``counts * part / total``, each rounded down or up: systematic rounding along the lengths from a seeded start.

    The words taken differ from ``part`` by at most the largest size; what is above is handed back.
    """
    start = xxhash.xxh64_intdigest(np.stack([sizes, counts]).astype("<i8").tobytes(), seed) % total
    order = np.argsort(sizes, kind="stable")
    more, done = np.zeros(len(sizes), dtype=np.int64), start
    for i in order:
        more[i] = (done % total + int(counts[i]) * part) // total
        done = done % total + int(counts[i]) * part
    over = int((more * sizes).sum()) - part
    while over > 0:
        held = order[more[order] > 0]
        enough = held[sizes[held] >= over]
        i = enough[0] if len(enough) else held[-1]
        more[i] -= 1
        over -= int(sizes[i])
    return more


def fit(sizes: np.ndarray, counts: np.ndarray, target: float) -> tuple[int, np.ndarray]:
    """(whole repeats, documents of each size to take once more) for one source."""
    total = int((sizes * counts).sum())
    more = np.zeros(len(sizes), dtype=np.int64)
    if not total:
        return 0, more
    whole = int((target + 1e-6) // total)
    budget = max(0, round(target - whole * total))
    more = shares(sizes, counts, budget - min(budget // 8, KNAPSACK // 2), total)
    rest = budget - int((more * sizes).sum())
    for i in np.argsort(-sizes, kind="stable"):
        if rest <= KNAPSACK or not sizes[i]:
            break
        n = min(int(counts[i] - more[i]), (rest - KNAPSACK // 2) // int(sizes[i]))
        more[i] += n
        rest -= n * int(sizes[i])
    if rest > 0:
        more += subset_sum(sizes, counts - more, rest)
    return whole, more


def counted(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, h, copies): rows of the same id and text are counted together."""
    return store(docs.select("doc_id", "source", size_of().alias("size"), draw(seed).alias("h")).groupBy(
        "doc_id", "source", "size", "h").agg(F.count("*").alias("copies")), "sizes")


def planned(rows: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Stored plan (source, size, source_size, target, whole, more, last, part).

    Of each length the ``more`` rows with the smallest hash are taken once more than ``whole`` times: those below hash ``last``, and ``part`` of
    the rows that have it (one, unless rows repeat).
    """
    counts = store(rows.groupBy("source", "size").agg(F.sum("copies").alias("n")), "lengths")
    goal = targets(counts, weights, share, most)
    schema = T.StructType([
        T.StructField("source", rows.schema["source"].dataType), T.StructField("size", T.LongType()),
        T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType()),
        T.StructField("whole", T.LongType()), T.StructField("more", T.LongType())])

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size")
        whole, more = fit(pdf["size"].to_numpy(), pdf["n"].to_numpy(), float(pdf["target"].iloc[0]))
        return pdf.assign(whole=whole, more=more)[schema.names]

    s = goal.withColumnRenamed("source", "_source")
    plan = store(counts.join(s, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").groupBy(
        "source").applyInPandas(one, schema), "plan")
    chosen = plan.filter("more > 0").select(F.col("source").alias("_s"), F.col("size").alias("_n"), "more")
    bucket = F.shiftright("h", 64 - BUCKET_BITS)  # ascends with h
    spread = rows.withColumn("bucket", bucket)
    parts = spread.groupBy("source", "size", "bucket").agg(F.sum("copies").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source", "size").orderBy("bucket")) - F.col("n")
    on = F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_n"))
    edge = parts.withColumn("before", before).join(chosen, on).filter(
        "before < more AND before + n >= more").select("_s", "_n", F.col("bucket").alias("_b"), "before", "more")
    near = spread.join(edge, on & (F.col("bucket") == F.col("_b")))
    done = F.col("before") + F.sum("copies").over(
        Window.partitionBy("source", "size", "bucket").orderBy("h", "doc_id")) - F.col("copies")
    last = near.withColumn("done", done).filter("done < more AND done + copies >= more").select(
        F.col("source").alias("_s"), F.col("size").alias("_n"), F.col("h").alias("last"),
        (F.col("more") - F.col("done")).alias("part"))
    return store(plan.join(last, on, "left").drop("_s", "_n"), "plan")


def with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (source, size, ...) with their plan. The plan has a row per source and length; up to a million go to all executors."""
    p = plan.withColumnsRenamed({"source": "_s", "size": "_n"})
    if plan.count() <= BROADCAST_ROWS:
        p = F.broadcast(p)
    return rows.join(p, F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_n"))).drop("_s", "_n")


def extra(copies: Column) -> Column:
    """How many of ``copies`` equal rows are taken once more."""
    return F.when(F.col("h") < F.col("last"), copies).when(
        F.col("h") == F.col("last"), F.least(copies, F.col("part"))).otherwise(0).cast("long")


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST,
        seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken (words; a multiple of size).

    A missing text has size 0 and is never taken; a missing source is a source of its own, the last.
    """
    rows = counted(docs, seed)
    got = with_plan(rows, planned(rows, weights, share, most)).withColumn("extra", extra(F.col("copies")))
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    times = F.col("whole") + (F.col("copy") <= F.col("extra")).cast("long")
    return got.select("*", copy).select(
        "doc_id", "source", "size", "source_size", "target", (times * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST,
          seed: int = SEED) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, all columns."""
    plan = planned(counted(docs, seed), weights, share, most)
    rows = with_plan(docs.select(
        packed(docs).alias("row"), "doc_id", "source", size_of().alias("size"), draw(seed).alias("h")), plan).filter("size > 0")
    times = F.col("whole") + extra(F.lit(1))
    shared = F.col("part") > 1  # several equal rows at the threshold: count them together
    if not plan.filter(shared).isEmpty():
        edge = F.coalesce((F.col("h") == F.col("last")) & shared, F.lit(False))
        some = rows.filter(edge).groupBy("doc_id", "h").agg(
            F.any_value("row").alias("row"), (F.count("*") * F.max("whole") + F.max("part")).alias("times"))
        taken = rows.filter(~edge).select("row", times.alias("times")).unionByName(some.select("row", "times"))
    else:
        taken = rows.select("row", times.alias("times"))
    out = taken.filter("times > 0").select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return unpacked(out, "row", docs.columns)
