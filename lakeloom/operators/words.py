"""Word counts and word co-occurrence within lines."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeloom.functions.text import clean_words, words
from lakeloom.operators import pairs
from lakeloom.session import workspace

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
STORED_BYTES = 16 << 20  # of a row group: rows are large

TASK_PAIRS = 8_000_000  # pairs of words that a task adds up
ROUND_PAIRS = 2         # pairs for each word of a line that a round deals out: what one round writes is a small multiple of the lines
ROUND_TASKS = 12        # tasks of a round, at least
CHUNK_ROUNDS = 4        # parts of the lines that are numbered one after the other


def lines_of(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per line of a text column."""
    return df.select(F.explode(F.split(text, "\n")).alias("value"))


def word_count(lines: DataFrame) -> DataFrame:
    """Case-sensitive white-space tokens, punctuation kept."""
    return lines.select(F.explode(words("value")).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def line_bags(lines: DataFrame) -> DataFrame:
    """Distinct sorted bags of cleaned words with the number of lines that have each: ``joined, copies``, a blank between two words.

    Copies of a line, however many, count once from here on.
    """
    # No filter on the size: pushed below the grouping it would clean every line once more.
    return lines.groupBy(F.array_join(F.sort_array(clean_words("value")), " ").alias("joined")).agg(F.count("*").alias("copies"))


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What is written within leaves no shuffle files behind."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def stored_in_turn(label: str, *frames: DataFrame) -> DataFrame:
    """All rows of the frames, written one frame after the other and read back; between them shuffle files go."""
    spark = frames[0].sparkSession
    path = workspace(spark, label)
    with _shuffles_removed(spark):
        for df in frames:
            df.write.mode("append").option("parquet.block.size", STORED_BYTES).parquet(path)
    return spark.read.schema(frames[0].schema).parquet(path)


def dictionary(words: DataFrame) -> DataFrame:
    """``word, number``: whole numbers from 0 without gaps, one for each distinct word of ``words`` (``word, n``), those of largest n first.

    The words are sorted by range and stored once with their task and their place in it; a task's numbers start after those of the
    tasks before it.
    """
    place = F.monotonically_increasing_id()  # the task in the upper bits, the row in the lower 33
    placed = stored_in_turn(
        "dictionary", words.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").select("word", place.alias("place"))).select(
        "word", F.shiftright("place", 33).alias("task"), F.col("place").bitwiseAND(F.lit((1 << 33) - 1)).alias("row"))
    sizes = placed.groupBy("task").agg(F.count("*").alias("n"))
    first = sizes.select("task", (F.sum("n").over(Window.orderBy("task")) - F.col("n")).alias("first"))  # a row per task
    return placed.join(first, "task").select("word", (F.col("first") + F.col("row")).alias("number"))


def _numbered_chunks(lines: DataFrame, block: int, task_blocks: int) -> tuple[DataFrame, DataFrame]:
    """The lines as ``pairs.numbered`` has them, spread over tasks, and the dictionary.

    Only the distinct words of a chunk meet the dictionary, not the words of each line.
    """
    chunks = stored_in_turn("chunks", line_bags(lines).mapInArrow(pairs.chunked, pairs.CHUNKS))
    said = chunks.select("chunk", F.posexplode(F.arrays_zip("words", "lines")).alias("at", "told")).select(
        "chunk", "at", F.col("told.words").alias("word"), F.col("told.lines").alias("n"))
    numbers = stored_in_turn("numbers", dictionary(said.select("word", "n")))
    if numbers.count() >= 1 << 31:
        raise ValueError("more words than two of them fit one long")
    places = said.join(numbers, "word").groupBy("chunk").agg(
        F.sort_array(F.collect_list(F.struct("at", F.col("number").cast("int").alias("number")))).getField("number").alias("numbers"))
    parts = max(1, min(CHUNK_ROUNDS, chunks.count() // 16))
    told = [chunks.drop("lines").where(of == i).join(places.where(of == i), "chunk").mapInArrow(
        pairs.numbered(block, block * block * task_blocks), pairs.NUMBERED)
        for of in [F.pmod(F.xxhash64("chunk"), F.lit(parts))] for i in range(parts)]
    return stored_in_turn("numbered", *told), numbers


def _common(numbers: DataFrame) -> pa.Array:
    """The first words of the dictionary, for each task; there are ``COMMON`` of them at most."""
    first = numbers.where(F.col("number") < pairs.COMMON).select("number", "word").toArrow()
    return first.sort_by("number").column("word").combine_chunks().cast(pa.string())


def _tile_keys(spark: SparkSession, n: int) -> list[int]:
    """``n`` numbers that hash partitioning into ``n`` partitions deals to one partition each."""
    places = spark.range(32 * n, numPartitions=1).select(F.col("id").cast("int").alias("key")).select(
        "key", F.pmod(F.hash("key"), F.lit(n)).alias("place"))
    keys = {r.place: r.key for r in places.groupBy("place").agg(F.min("key").alias("key")).collect()}
    return [keys.get(i, i) for i in range(n)]


def _rounds(numbered: DataFrame, apart: bool, spread: int = 0) -> list[DataFrame]:
    """The words of lines dealt to their tiles, as many as a task adds up to each, in rounds if these are taken ``apart``.

    The rounds follow the length of lines, not their number: each deals out a certain multiple of the stored words.
    """
    n_words, n_pairs = numbered.agg(F.sum("n_words"), F.sum("n_whole" if spread else "n_pairs")).first()
    tiles = (n_pairs or 0) // TASK_PAIRS + 1
    rounds = max(1, min(n_pairs // (ROUND_PAIRS * n_words), tiles // ROUND_TASKS)) if apart and n_words else 1
    tasks = -(-tiles // rounds)
    keys = _tile_keys(numbered.sparkSession, tasks)
    return [numbered.mapInArrow(pairs.dealt(tasks * rounds, i * tasks, keys, spread), pairs.DEALT).repartition(tasks, "x_tile")
            for i in range(rounds)]


def pair_counts(lines: DataFrame, block: int = 256, task_blocks: int = 256, apart: bool = False) -> tuple[DataFrame | list[DataFrame], DataFrame]:
    """``pair, n`` and the dictionary: how often two words share a line, as the numbers of both in one long, the smaller one above.

    A pair counts (times of first) x (times of second) in each line. The lines are stored in chunks, as numbers; a line of more
    than ``block`` words is there once for each block, and a row of at most ``task_blocks`` square blocks. What is shuffled is no pair, but
    each word of a line with the more frequent words of the line: a word seen everywhere has few of them. Pairs are made and added up
    where their rarer word lies, in tasks of about ``TASK_PAIRS``.

    ``apart``: a list of frames in place of the first, one for each round, in which the pairs are not yet added up: for ``partners_per_word``,
    which does so and lets the shuffle files of a round go before the next.
    """
    numbered, numbers = _numbered_chunks(lines, block, task_blocks)
    rounds = _rounds(numbered, apart)
    if apart:
        return rounds, numbers
    rows = rounds[0].mapInArrow(pairs.told(pairs.as_pairs, _common(numbers)), pairs.PAIRS)
    found = rows.select("x", "ns", F.posexplode("ys").alias("at", "y")).select("x", "y", F.get("ns", "at").alias("n"))
    pair = F.shiftleft(F.col("y").cast("long"), 32).bitwiseOR(F.col("x").cast("long"))
    return found.select(pair.alias("pair"), "n"), numbers


def cooccur_pairs(lines: DataFrame, block: int = 256, task_blocks: int = 256) -> DataFrame:
    """How often each ordered pair of different words shares a line: ``first, second, n``.

    Both orders of a pair have the same count, so only one is added up, over the words' numbers; the words join it at the end.
    """
    counts, numbers = pair_counts(lines, block, task_blocks)
    split = counts.select(
        F.shiftright("pair", 32).alias("_lo"), F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).alias("_hi"), "n")
    lo, hi = (numbers.select(F.col("number").alias(at), F.col("word").alias(name)) for at, name in (("_lo", "lo"), ("_hi", "hi")))
    orders = F.array(
        F.struct(F.col("lo").alias("first"), F.col("hi").alias("second"), "n"),
        F.struct(F.col("hi").alias("first"), F.col("lo").alias("second"), "n"))
    return split.join(lo, "_lo").join(hi, "_hi").select(F.inline(orders))


def cooccur_stripes(lines: DataFrame, parts: int = 64, apart: bool = False) -> DataFrame | list[DataFrame]:
    """The same counts as maps: ``word, part, stripe``, where ``stripe`` maps neighbours to counts.

    Every word's neighbours are dealt to ``parts`` parts by their numbers, whatever their number, and a part without
    neighbours has no row. So no row holds all neighbours of a word seen everywhere, and no task where ``parts`` is a multiple of
    ``pairs.SPREAD``. A word is shuffled with all words of its line, and the maps are made where they are added up.

    ``apart``: a list of frames, one for each round, that have the rows between them.
    """
    numbered, numbers = _numbered_chunks(lines, 256, 256)
    give, spread = pairs.told(pairs.as_stripes(parts), _common(numbers), whole=True), pairs.SPREAD if parts % pairs.SPREAD == 0 else 1
    rounds = [dealt.mapInArrow(give, pairs.STRIPES) for dealt in _rounds(numbered, apart, spread)]
    return rounds if apart else rounds[0]


def partners_per_word(rounds: list[DataFrame], numbers: DataFrame) -> DataFrame:
    """Per word: distinct partners, all pair counts, the largest one, and a sum that ties counts to partners, from ``pair_counts`` apart.

    ``bound`` adds up every count times a number read off its partner (length, first and last letter). A task adds up its pairs and what
    they give to both words; the sums of a round are stored, and added up over all rounds at the end.
    """
    def sums(given: DataFrame) -> DataFrame:
        return given.groupBy("first").agg(
            F.sum("n_partners").alias("n_partners"), F.sum("n_pairs").alias("n_pairs"), F.max("top_count").alias("top_count"),
            F.sum("bound").alias("bound"))

    give = pairs.told(pairs.as_sums, _common(numbers))
    stored = stored_in_turn("partners", *[sums(dealt.mapInArrow(give, pairs.SUMS)) for dealt in rounds])
    return sums(stored).join(numbers, F.col("first") == F.col("number")).select("word", "n_partners", "n_pairs", "top_count", "bound")
