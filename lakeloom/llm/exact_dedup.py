"""Exact deduplication: counting quotient filters find texts that may repeat, bytes decide.

Texts are equal when they agree after lower-casing A-Z; a missing text counts as empty. A 48-bit fingerprint of every row
goes into a counting quotient filter of its partition; the filters of all partitions merge, block of quotients by
block, into the filter of the whole table without loss. Only rows whose fingerprint counts more than one carry their text
any further: they are grouped by the bytes themselves, so a false positive costs time and never a row.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeloom.llm.helpers import packed, store, text_or_empty, unpacked

FINGERPRINT_BITS = 48
QUOTIENT_BITS_OF_BLOCK = 16   # quotients of one block; its filter holds about as many fingerprints
FLUSH_ROWS = 1 << 20          # a longer partition gives several filters


class QuotientFilter:
    """Counting quotient filter of one block of quotients, with remainders of at most 32 bits.

    ``occupied`` marks quotients that have a run, ``run_end`` the last remainder of each run; runs lie in quotient order and
    remainders ascend within a run. ``many`` marks remainders with a counter.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        """``keys``: distinct (quotient << 32 | remainder), ascending."""
        self.keys, self.counts = keys, counts

    @classmethod
    def merge(cls, filters: list[QuotientFilter]) -> QuotientFilter:
        """Sorted remainders of all filters, counts of equal ones added up."""
        keys = np.concatenate([f.keys for f in filters])
        counts = np.concatenate([f.counts for f in filters])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.array([], dtype=int)
        return cls(keys[starts], np.add.reduceat(counts, starts) if len(keys) else counts)

    def pack(self) -> bytes:
        quotients = (self.keys >> np.uint64(32)).astype(np.int64)
        occupied = np.zeros(1 << QUOTIENT_BITS_OF_BLOCK, dtype=bool)
        occupied[quotients] = True
        run_end = np.r_[quotients[1:] != quotients[:-1], True] if len(quotients) else np.array([], dtype=bool)
        many = self.counts > 1
        sparse = len(quotients) * 4 < len(occupied) // 8  # a nearly empty block lists its quotients
        place = np.flatnonzero(occupied).astype("<u4").tobytes() if sparse else np.packbits(occupied).tobytes()
        head = np.array([len(self.keys), occupied.sum() if sparse else 0], dtype="<u4").tobytes()
        return b"".join([
            head, place, np.packbits(run_end).tobytes(), np.packbits(many).tobytes(),
            (self.keys & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes(), self.counts[many].astype("<i8").tobytes()])

    @classmethod
    def unpack(cls, data: bytes) -> QuotientFilter:
        n, listed = (int(x) for x in np.frombuffer(data, "<u4", 2))
        at, bits = 8, (n + 7) // 8
        if listed:
            occupied = np.frombuffer(data, "<u4", listed, at).astype(np.int64)
            at += 4 * listed
        else:
            size = 1 << QUOTIENT_BITS_OF_BLOCK
            occupied = np.flatnonzero(np.unpackbits(np.frombuffer(data, "u1", size // 8, at), count=size))
            at += size // 8
        run_end = np.unpackbits(np.frombuffer(data, "u1", bits, at), count=n).astype(bool)
        many = np.unpackbits(np.frombuffer(data, "u1", bits, at + bits), count=n).astype(bool)
        at += 2 * bits
        remainders = np.frombuffer(data, "<u4", n, at).astype(np.uint64)
        run = np.cumsum(run_end) - run_end
        keys = (occupied[run].astype(np.uint64) << np.uint64(32)) | remainders
        counts = np.ones(n, dtype=np.int64)
        counts[many] = np.frombuffer(data, "<i8", int(many.sum()), at + 4 * n)
        return cls(keys, counts)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, h, sha, fp) per row: h a hash of the text as it is, sha and fp of its lower-cased bytes."""
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("h", T.LongType()),
        T.StructField("sha", T.BinaryType()), T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sha = [hashlib.sha256(x.as_py().lower()).digest() for x in b.column(2)]
            top = np.frombuffer(b"".join(sha), ">u8").reshape(-1, 4)[:, 0]
            fp = (top >> np.uint64(64 - FINGERPRINT_BITS)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(sha, pa.binary()), pa.array(fp)], ["doc_id", "h", "sha", "fp"])

    text = text_or_empty()
    return docs.select("doc_id", F.xxhash64(text).alias("h"), text.cast("binary").alias("b")).mapInArrow(run, schema)


def repeated_fingerprints(rows: DataFrame, n_rows: int) -> DataFrame:
    """(fp) of all fingerprints that ``rows`` (fp, copies) hold more than once.

    Blocks follow from ``n_rows``, so that a block holds about 65,000 fingerprints whatever the table's size. A fingerprint that
    a third of all rows share is one counter in every filter.
    """
    bits = max(QUOTIENT_BITS_OF_BLOCK, min(FINGERPRINT_BITS, math.ceil(math.log2(max(n_rows, 2)))))
    # Below 2**32 quotient and remainder: a remainder has at most 32 bits, the rest of the fingerprint is quotient.
    remainder = min(FINGERPRINT_BITS - bits, 32)
    in_block = QUOTIENT_BITS_OF_BLOCK

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def flush() -> pd.DataFrame:
            fp = np.concatenate([x["fp"].to_numpy() for x in held]).astype(np.uint64)
            copies = np.concatenate([x["copies"].to_numpy() for x in held])
            quotient = fp >> np.uint64(remainder)
            key = (quotient & np.uint64((1 << in_block) - 1)) << np.uint64(32) | fp & np.uint64((1 << remainder) - 1)
            block = (quotient >> np.uint64(in_block)).astype(np.int64)
            order = np.lexsort((key, block))
            block, key, copies = block[order], key[order], copies[order]
            starts = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
            out = [(block[a], QuotientFilter.merge([QuotientFilter(key[a:z], copies[a:z])]).pack())
                   for a, z in zip(starts, np.r_[starts[1:], len(block)])]
            return pd.DataFrame(out, columns=["block", "part"])

        n = 0
        for b in batches:
            held.append(b)
            n += len(b)
            if n >= FLUSH_ROWS:
                yield flush()
                held, n = [], 0
        if n:
            yield flush()

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        whole = QuotientFilter.merge([QuotientFilter.unpack(x) for x in pdf["part"]])
        key = whole.keys[whole.counts > 1]
        quotient = np.uint64(int(pdf["block"].iloc[0]) << in_block) + (key >> np.uint64(32))
        return pd.DataFrame({"fp": (quotient << np.uint64(remainder) | key & np.uint64(0xFFFFFFFF)).astype(np.int64)})

    parts = rows.select("fp", "copies").mapInPandas(build, "block long, part binary")
    return parts.groupBy("block").applyInPandas(merge, "fp long")


def groups(docs: DataFrame) -> DataFrame:
    """(doc_id, h, sha, copies, keep_id, keep_h, group_size): one row for equal (doc_id, text), ``copies`` counts them."""
    rows = store(digests(docs).groupBy("doc_id", "h", "sha", "fp").agg(F.count("*").alias("copies")), "digests")
    repeated = store(repeated_fingerprints(rows, rows.count()), "repeated")
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("h", T.LongType()),
        T.StructField("b", T.BinaryType()), T.StructField("fp", T.LongType())])

    def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lower = [x.as_py().lower() for x in b.column(2)]
            fp = [int.from_bytes(hashlib.sha256(x).digest()[:8], "big") >> (64 - FINGERPRINT_BITS) for x in lower]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(lower, pa.binary()), pa.array(fp, pa.int64())], schema.names)

    text = text_or_empty()
    routed = docs.select("doc_id", F.xxhash64(text).alias("h"), text.cast("binary").alias("b")).mapInArrow(
        normal, schema).join(repeated, "fp", "left_semi")
    # The grouping key is the text itself. Every task first reduces its copies to one row.
    equal = routed.groupBy("b").agg(
        F.max(F.struct("doc_id", "h")).alias("keep"), F.count("*").alias("group_size")).filter("group_size > 1").select(
            F.unhex(F.sha2("b", 256)).alias("sha"), F.col("keep.doc_id").alias("keep_id"),
            F.col("keep.h").alias("keep_h"), "group_size")
    joined = rows.drop("fp").join(equal, "sha", "left")
    single = F.col("group_size").isNull()
    return joined.select(
        "doc_id", "h", "sha", "copies",
        F.when(single, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(single, F.col("h")).otherwise(F.col("keep_h")).alias("keep_h"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"))


def stays():
    return F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("h") == F.col("keep_h"))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    The largest doc_id of equal texts stays; a null id stays only where no other row has the text. Of rows repeated
    with the same id and text one stays.
    """
    copy = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    return groups(docs).select("*", copy).select(
        "doc_id", "keep_id", "group_size", (stays() & (F.col("copy") == 1)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns. Rows to drop are looked up by id and text hash."""
    decided = store(groups(docs), "groups")
    lost = decided.filter(~stays()).select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"))
    row = docs.select(packed(docs).alias("row"), F.col("doc_id").alias("_id"), F.xxhash64(text_or_empty()).alias("_x"))
    kept = row.join(lost, F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_x") == F.col("_h")), "left_anti")
    twice = decided.filter(stays() & (F.col("copies") > 1)).select(F.col("doc_id").alias("_d"), F.col("h").alias("_h"))
    if not twice.isEmpty():  # rows given more than once: one of each is enough
        on = F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_x") == F.col("_h"))
        once = kept.join(twice, on, "left_semi").groupBy("_id", "_x").agg(F.any_value("row").alias("row"))
        kept = kept.join(twice, on, "left_anti").select("row").unionByName(once.select("row"))
    return unpacked(kept, "row", docs.columns)
