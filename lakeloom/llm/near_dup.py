"""Near-duplicate classes by ProbMinHash, banding and verification.

Texts with equal words are one node. Nodes that agree in all components of a band share a bucket. Each bucket first links its
members to one of them, so a group of copies gives as many pairs as it has members; candidates are checked by the exact
similarity of the two texts. Only buckets whose members then still belong to different components are compared
further, across components only: sketches choose the pairs, the most alike first, and the same exact check links them. That
happens inside the task that holds the bucket; only links that join two components leave it. No bucket is capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm import shingles
from lakeloom.llm.components import components
from lakeloom.llm.helpers import packed, store, text_or_empty, unpacked

WORDS = 5
SIMILAR = 0.8
BANDS, ROWS = 24, 4       # two texts of similarity 0.8 miss each other in all bands 3 times in a million
LIKELY = 57 / 96          # sketches of a pair at 0.8 agree in less than this less often than such a pair misses in all bands
BLOCK = 1024              # members of a block; two blocks are compared at a time
BLOCK_BYTES = 4 << 20     # of their texts together, a longer text alone
KEPT_WORDS = 1 << 20      # words whose shingles are kept while pairs are checked
MOST_BLOCKS = 16          # in larger buckets pairs that share a second band meet in that
BATCH_WORDS = 200_000     # words that are sketched together
ALONE = -2                # instead of a second band: pairs that share none


def sketched(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, h, key, sig) per row: h hashes the text, key its words; sig is null if there are none."""
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("h", T.LongType()),
        T.StructField("key", T.BinaryType()), T.StructField("sig", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = shingles.WordHashes()

        def emit(b: pa.RecordBatch, keys: list[bytes], bags: list) -> pa.RecordBatch:
            full = [x for x in bags if len(x[0])]
            made = iter(shingles.sketches(full, BANDS * ROWS)) if full else iter(())
            sig = [next(made).tobytes() if len(x[0]) else None for x in bags]
            return pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(keys, pa.binary()), pa.array(sig, pa.binary())], schema.names)

        for b in batches:
            start, held, keys, bags = 0, 0, [], []
            for i, x in enumerate(b.column(2)):
                w = x.as_py().lower().split()
                keys.append(xxhash.xxh3_128_digest(b" ".join(w)))
                bags.append(shingles.weighted(w, memo, words))
                held += len(w)
                if held >= BATCH_WORDS or i == b.num_rows - 1:
                    yield emit(b.slice(start, i + 1 - start), keys, bags)
                    start, held, keys, bags = i + 1, 0, [], []

    text = text_or_empty()
    return docs.select("doc_id", F.xxhash64(text).alias("h"), text.cast("binary").alias("b")).mapInArrow(run, schema)


def banded(nodes: DataFrame) -> DataFrame:
    """(key, band, bucket): one row per band."""
    buckets = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(
        i, F.substring(F.col("sig"), i * (4 * ROWS) + 1, F.lit(4 * ROWS))))
    return nodes.filter("sig IS NOT NULL").select("key", F.posexplode(buckets).alias("band", "bucket"))


def verified(pairs: DataFrame, texts: DataFrame, words: int = WORDS, similar: float = SIMILAR) -> DataFrame:
    """The pairs (a, b) whose texts are similar."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, bags, held = shingles.WordHashes(), {}, 0

        def bag(key: bytes, text: pa.Scalar):
            nonlocal held
            if key not in bags:
                if len(bags) > 64 or held > KEPT_WORDS:
                    bags.clear()
                    held = 0
                bags[key] = shingles.weighted(text.as_py().lower().split(), memo, words)
                held += len(bags[key][0])
            return bags[key]

        for b in batches:
            ka, kb = b.column(0).to_pylist(), b.column(1).to_pylist()
            ok = [shingles.similarity(bag(x, s), bag(y, t)) >= similar
                  for x, y, s, t in zip(ka, kb, b.column(2), b.column(3))]
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    one = texts.select(F.col("key").alias("a"), F.col("b").alias("ta"))
    two = texts.select(F.col("key").alias("b"), F.col("b").alias("tb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a binary, b binary")


def linked(pdf: pd.DataFrame, words: int, similar: float, likely: float = LIKELY) -> pd.DataFrame:
    """Links (a, b) that join components of one block.

    A pair is looked at in one block only: that of the first band it shares, or of the first two where that bucket was cut finer
    (``finer`` is the second band there, ``ALONE`` for pairs that share no other band, else -1). Pairs of components that a link has joined meanwhile are left out: they
    would join nothing.
    """
    pdf = pdf[pdf["key"] != pdf["center"]].drop_duplicates("key").reset_index(drop=True)
    if len(pdf) < 2:
        return pd.DataFrame({"a": [], "b": []}, dtype=object)
    sig = np.frombuffer(b"".join(pdf["sig"]), "<u4").reshape(len(pdf), -1)
    comp, keys = pd.factorize(pdf["comp"])[0], pdf["key"].to_numpy()
    pairs = [np.zeros((3, 0), dtype=np.int16)]  # components that agree, and the two members
    bands = np.array([int(b) for b in (pdf["band"].iloc[0], pdf["finer"].iloc[0]) if b >= 0])
    upto = BANDS if pdf["finer"].iloc[0] == ALONE else bands[-1] + 1
    for i in range(len(pdf) - 1):
        rest = np.flatnonzero(comp[i + 1:] != comp[i]) + i + 1
        same = sig[rest] == sig[i]
        alike = same.sum(axis=1)
        on = alike >= likely * same.shape[1]
        rest, same, alike = rest[on], same[on], alike[on]
        shared = same.reshape(len(rest), BANDS, ROWS).all(axis=2)
        # The block's bands are shared, and no other one before the last of them, or no other one at all.
        on = shared[:, bands].all(axis=1) & (shared[:, :upto].sum(axis=1) == len(bands))
        pairs.append(np.array([alike[on], np.full(on.sum(), i), rest[on]], dtype=np.int16))
    root = list(range(int(comp.max()) + 1))
    memo, bags, out = shingles.WordHashes(), {}, []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    def bag(i: int):
        if i not in bags:
            bags[i] = shingles.weighted(pdf["b"].iat[i].lower().split(), memo, words)
        return bags[i]

    alike, left, right = np.concatenate(pairs, axis=1)
    for at in np.lexsort((right, left, -alike)):
        i, j = int(left[at]), int(right[at])
        a, b = find(comp[i]), find(comp[j])
        if a != b and shingles.similarity(bag(i), bag(j)) >= similar:
            root[a] = b
            out.append((keys[i], keys[j]))
    return pd.DataFrame(out, columns=["a", "b"])


def open_buckets(members: DataFrame, least: int = 3) -> DataFrame:
    """(bucket, n) of buckets with several components and ``least`` members: whole ones need a pair besides the center."""
    return members.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter(
            f"n >= {least} AND lo != hi").select("bucket", "n")


def rest_links(members: DataFrame, nodes: DataFrame, texts: DataFrame, words: int = WORDS, similar: float = SIMILAR,
               block: int = BLOCK, most: int = MOST_BLOCKS) -> DataFrame:
    """Links across components within a bucket. ``members``: (bucket, band, key, center, comp), stored.

    A bucket above ``block`` members, or above ``BLOCK_BYTES`` of texts, is compared block against block, each member once per block. Above ``most`` blocks, pairs that
    share further bands meet within the second one, among fewer members; the blocks against blocks are left with the pairs that
    share this band alone. All pairs of a bucket are looked at, whatever its size.
    """
    kept = store(members.join(open_buckets(members), "bucket"), "open")
    large = kept.filter(F.col("n") > block * most).drop("n")
    other = kept.select("key", F.col("bucket").alias("second"), F.col("band").alias("finer"))
    finer = store(large.join(other, "key").filter("band < finer").select(
        F.xxhash64("bucket", "second").alias("bucket"), "band", "finer", "key", "center", "comp"), "finer")
    whole = F.when(F.col("n") <= block * most, -1).otherwise(ALONE)
    parts = kept.withColumn("finer", whole).unionByName(finer.join(open_buckets(finer, 2), "bucket"))
    sized = parts.join(texts.select("key", F.octet_length("b").alias("size")), "key")
    parts = sized.join(sized.groupBy("bucket", "finer").agg(F.sum("size").alias("bytes")), ["bucket", "finer"])
    n_blocks = F.greatest(F.ceil(F.col("n") / block), F.ceil(F.col("bytes") / BLOCK_BYTES)).cast("int")
    mine = F.pmod(F.xxhash64("key", F.lit(7)), n_blocks).cast("int")
    spread = parts.withColumn("_n", n_blocks).withColumn("_i", mine).withColumn(
        "_j", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    spread = spread.select("bucket", "band", "finer", F.least("_i", "_j").alias("_i"), F.greatest("_i", "_j").alias("_j"),
                           "key", "center", "comp")
    full = spread.join(nodes.select("key", "sig"), "key").join(texts, "key")
    return full.groupBy("bucket", "_i", "_j").applyInPandas(
        lambda pdf: linked(pdf, words, similar), "a binary, b binary")


def classes(docs: DataFrame, words: int = WORDS, similar: float = SIMILAR) -> DataFrame:
    """(doc_id, h, copies, class_key) per distinct (doc_id, text). Bands and sketches are laid out for ``SIMILAR`` and above."""
    if similar < SIMILAR:
        raise ValueError(f"pairs below a similarity of {SIMILAR} would be missed")
    rows = store(sketched(docs, words), "sketches")
    nodes = store(rows.groupBy("key").agg(
        F.min(F.struct("doc_id", "h")).alias("of"), F.first("sig").alias("sig")), "nodes")
    buckets = banded(nodes).groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("key").alias("center")).filter("n > 1").select("bucket", "center")
    members = store(banded(nodes).join(buckets, "bucket"), "members")
    wanted = nodes.join(members.select("key").distinct(), "key", "left_semi").select(
        "key", F.col("of.doc_id").alias("_d"), F.col("of.h").alias("_h"))
    text = text_or_empty()
    body = docs.select(F.col("doc_id").alias("_id"), F.xxhash64(text).alias("_x"), text.cast("binary").alias("b"))
    texts = store(body.join(wanted, F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_x") == F.col("_h"))).select(
        "key", "b").dropDuplicates(["key"]), "texts")
    star = members.filter("key != center").select(F.col("center").alias("a"), F.col("key").alias("b")).distinct()
    links = store(verified(star, texts, words, similar), "links")
    first = components(links)
    comp = members.join(first, F.col("key") == F.col("node"), "left").select(
        "bucket", "band", "key", "center", F.coalesce("label", "key").alias("comp"))
    more = store(rest_links(store(comp, "members"), nodes, texts, words, similar), "links")
    label = first if more.isEmpty() else components(links.unionByName(more))
    return rows.groupBy("doc_id", "h", "key").agg(F.count("*").alias("copies")).join(
        label, F.col("key") == F.col("node"), "left").select(
            "doc_id", "h", "copies", F.coalesce("label", "key").alias("class_key"))


def decided(docs: DataFrame, words: int = WORDS, similar: float = SIMILAR) -> DataFrame:
    """(doc_id, h, copies, class_id, stays, class_size). The smallest doc_id of a class stays, a null id only if there is no other."""
    rows = store(classes(docs, words, similar), "classes")
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "h")
    # Stored, so that Spark sees two plain sides and can split the rows of a class that holds a third of the table.
    heads = store(rows.groupBy("class_key").agg(F.min(order).alias("head"), F.sum("copies").alias("class_size")), "heads")
    return rows.join(heads, "class_key").select(
        "doc_id", "h", "copies", F.col("head.doc_id").alias("class_id"), "class_size",
        (F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("h") == F.col("head.h"))).alias("stays"))


def near_dup(docs: DataFrame, words: int = WORDS, similar: float = SIMILAR) -> DataFrame:
    """One row per document: doc_id, class_id (doc_id of the one that stays), class_size, kept.

    Texts with the same words, also texts without any, are of one class. Rows repeated with id and text count each; one of them stays.
    """
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    return decided(docs, words, similar).select("*", copy).select(
        "doc_id", "class_id", "class_size", (F.col("stays") & (F.col("copy") == 1)).alias("kept"))


def keep_one(docs: DataFrame, words: int = WORDS, similar: float = SIMILAR) -> DataFrame:
    """The rows of ``docs`` that stay, all columns."""
    rows = store(decided(docs, words, similar), "decided")
    row = docs.select(packed(docs).alias("row"), F.col("doc_id").alias("_id"), F.xxhash64(text_or_empty()).alias("_x"))
    on = F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_x") == F.col("_h"))
    name = [F.col("doc_id").alias("_d"), F.col("h").alias("_h")]
    kept = row.join(rows.filter("NOT stays").select(*name), on, "left_anti")
    twice = rows.filter("stays AND copies > 1").select(*name)
    if not twice.isEmpty():  # rows given more than once: one of each is enough
        once = kept.join(twice, on, "left_semi").groupBy("_id", "_x").agg(F.any_value("row").alias("row"))
        kept = kept.join(twice, on, "left_anti").select("row").unionByName(once.select("row"))
    return unpacked(kept, "row", docs.columns)
