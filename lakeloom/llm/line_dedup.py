"""Line deduplication with levelled sorted runs of line hashes.

Documents come in batches. What earlier batches held is a small set of runs, tables that are bucketed and sorted by a 128-bit hash
of the line, at most one to a level. A new batch is merged against the runs without moving them: lines that the runs
have settled already drop out, the rest becomes a run of its own on the lowest level. Whenever a level would hold two runs they are
merged into one on the next level, so that n batches leave at most log2(n) runs and rewrite a hash as often.

Everything is a DataFrame plan; no Python runs in tasks.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeloom.llm.helpers import LOWER, UPPER, packed, store, text_or_empty, unpacked
from lakeloom.session import workspace

LEAST = 3      # documents that hold a line before it counts as repeated
LENGTH = 20    # code points of a line worth looking at
BATCHES = 4
BLANKS = " \t\n\x0b\x0c\r"
HASH = ["h", "g"]


def key_of(bare: Column) -> Column:
    """A-Z lower-cased. Lines of ASCII alone take the faster function."""
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def lines_of(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, text_hash, pos, h, g): the lines of at least ``length`` code points without the white space at both ends."""
    text = text_or_empty()
    lines = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    bare = lines.withColumn("bare", F.btrim("line", F.lit(BLANKS))).filter(F.length("bare") >= length)
    return bare.withColumn("key", key_of(F.col("bare"))).select(
        "doc_id", "text_hash", "pos", F.xxhash64("key").alias("h"), F.xxhash64(F.lit(1), "key").alias("g"))


def held_by(lines: DataFrame) -> DataFrame:
    """(h, g, n, keep) per line: how many documents hold it and the largest of their ids.

    Rows with one doc_id are one document, and so are rows without any, whose id is below all others.
    """
    no_id = F.max(F.when(F.col("doc_id").isNull(), 1).otherwise(0))
    return lines.groupBy(*HASH).agg((F.count_distinct("doc_id") + no_id).alias("n"), F.max("doc_id").alias("keep"))


class LineRuns:
    """The lines seen so far, as levels of runs (h, g, n, keep).

    The runs lie below the shared folder, each in as many buckets as the session has shuffle partitions, so that a batch that was
    grouped by hash meets them bucket by bucket. ``n`` and ``keep`` of a line add up over the runs. A document is part of one batch.
    """

    def __init__(self, spark: SparkSession, least: int = LEAST):
        self.spark, self.least = spark, least
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[DataFrame | None] = []

    @property
    def runs(self) -> list[DataFrame]:
        return [run for run in self.levels if run is not None]

    def _write(self, rows: DataFrame) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        rows.write.bucketBy(self.buckets, *HASH).sortBy(*HASH).option("path", workspace(self.spark, "run")).saveAsTable(name)
        return self.spark.table(name)

    def unsettled(self, held: DataFrame) -> DataFrame:
        """Rows of ``held`` that the runs still need.

        A line that they hold in ``least`` documents, one of them with no smaller id, is settled: more documents change nothing.
        """
        seen, n, keep = held, F.lit(0), []
        for i, run in enumerate(self.runs):
            seen = seen.join(run.select(*HASH, F.col("n").alias(f"n{i}"), F.col("keep").alias(f"keep{i}")), HASH, "left")
            n, keep = n + F.coalesce(f"n{i}", F.lit(0)), [*keep, F.col(f"keep{i}")]
        if not keep:
            return held
        largest = F.greatest(*keep) if len(keep) > 1 else keep[0]
        settled = (n >= self.least) & F.coalesce(F.col("keep") <= largest, F.col("keep").isNull())
        return seen.filter(~settled).select(*held.columns)

    def add(self, lines: DataFrame) -> None:
        """Take in the lines of a batch (doc_id, h, g)."""
        run, level = self._write(self.unsettled(held_by(lines))), 0
        while level < len(self.levels) and self.levels[level] is not None:
            run, self.levels[level] = self._write(self._merged(self.levels[level], run)), None
            level += 1
        self.levels[level:level + 1] = [run]

    @staticmethod
    def _merged(one: DataFrame, two: DataFrame) -> DataFrame:
        """Both runs merged along their order: the buckets of one meet those of the other, nothing is shuffled."""
        two = two.select(*HASH, F.col("n").alias("n2"), F.col("keep").alias("keep2"))
        return one.join(two, HASH, "full").select(
            *HASH, (F.coalesce("n", F.lit(0)) + F.coalesce("n2", F.lit(0))).alias("n"), F.greatest("keep", "keep2").alias("keep"))

    def repeated(self) -> DataFrame:
        """(h, g, keep) of the lines found in at least ``least`` documents.

        The runs are merged by joins: a union of tables in equal buckets is taken for one that has them too, which it has not.
        """
        return reduce(self._merged, self.runs).filter(F.col("n") >= self.least).select(*HASH, "keep")


def lost_lines(docs: DataFrame, length: int = LENGTH, least: int = LEAST, batches: int = BATCHES) -> DataFrame:
    """(doc_id, text_hash, lost): places of the lines that a text loses; texts that lose none have no row.

    A line that a third of all documents hold is one row per task in its batch's run. The join that finds its places has the
    stored list of repeated lines on one side and plain lines on the other, so that Spark can split its rows.
    """
    batch = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).alias("batch")
    lines = store(lines_of(docs, length).select("*", batch), "lines", "batch")
    runs = LineRuns(docs.sparkSession, least)
    for i in range(batches):
        runs.add(lines.filter(F.col("batch") == i))
    repeated = store(runs.repeated(), "repeated")
    return lines.join(repeated, HASH).filter(~F.col("doc_id").eqNullSafe(F.col("keep"))).groupBy("doc_id", "text_hash").agg(
        F.collect_set("pos").alias("lost"))


def deduplicated(docs: DataFrame, length: int = LENGTH, least: int = LEAST, batches: int = BATCHES) -> DataFrame:
    """(row, text, n_lines, n_dropped) per row of ``docs``: row is the row itself, text what is left of its text."""
    lost = lost_lines(docs, length, least, batches).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("lost").alias("_lost"))
    rows = docs.select(packed(docs).alias("row"), F.col("doc_id").alias("_doc"), F.xxhash64(text_or_empty()).alias("_of"))
    both = rows.join(lost, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_of") == F.col("_hash")), "left")
    lines = F.split("_text", "\n")
    places = F.array_except(F.sequence(F.lit(0), F.col("n_lines").cast("int") - 1), "_lost")
    kept = F.array_join(F.transform(places, lambda i: F.get("_lines", i)), "\n")
    return both.withColumn("_text", text_or_empty("row.text")).withColumn("_lines", lines).withColumn("n_lines", F.size("_lines").cast("long")).select(
        "row", F.when(F.col("_lost").isNull(), F.col("_text")).otherwise(kept).alias("text"), "n_lines",
        F.coalesce(F.size("_lost"), F.lit(0)).cast("long").alias("n_dropped"))


def line_dedup(docs: DataFrame, length: int = LENGTH, least: int = LEAST, batches: int = BATCHES) -> DataFrame:
    """One row per document: doc_id, text (what is left of it), n_lines (before), n_dropped.

    Lines of at least ``length`` code points that ``least`` documents hold stay only in the document with the largest id,
    there as often as they occur. A missing text counts as empty, which is one empty line. Rows that repeat an id are one
    document: they count once and keep or lose a line together; rows without id are one document whose id is the smallest.
    """
    done = deduplicated(docs.select("doc_id", "text"), length, least, batches)
    return done.select(F.col("row.doc_id").alias("doc_id"), "text", "n_lines", "n_dropped")


def keep_lines(docs: DataFrame, length: int = LENGTH, least: int = LEAST, batches: int = BATCHES) -> DataFrame:
    """``docs``, all columns, with what is left of each text; a missing text stays missing."""
    done = deduplicated(docs, length, least, batches)
    text = F.when(F.col("row.text").isNotNull(), F.col("text"))
    return unpacked(done.select(F.col("row").withField("text", text).alias("row")), "row", docs.columns)
