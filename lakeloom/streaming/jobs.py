"""Sources, sinks and progress of streaming jobs."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType


def kafka_source_options(servers: str, topic: str, min_partitions: int | None = None,
                         max_offsets: int | None = None) -> dict[str, str]:
    """Read a topic from its first offset; the checkpoint, not a consumer group, keeps the position.

    ``min_partitions`` splits topic partitions over more tasks, ``max_offsets`` bounds a micro-batch.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_kafka(spark: SparkSession, servers: str, topic: str, **limits: int | None) -> DataFrame:
    """Needs the Kafka connector on the class path."""
    options = kafka_source_options(servers, topic, **limits)
    return spark.readStream.format("kafka").options(**options).load()


def _is_file(spark: SparkSession, path: str) -> bool:
    """One status call to the file system; nothing is listed."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isFile()


def read_files(spark: SparkSession, path: str, fmt: str = "parquet", schema: StructType | None = None,
               max_files: int | None = None, **options: str) -> DataFrame:
    """Files as a stream: a folder, or a single file within one. ``max_files`` bounds a micro-batch."""
    schema = schema or spark.read.format(fmt).load(path).schema
    stream = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files:
        stream = stream.option("maxFilesPerTrigger", max_files)
    if _is_file(spark, path):
        folder, _, name = path.rstrip("/").rpartition("/")
        return stream.option("pathGlobFilter", name).load(folder)
    return stream.load(path)


def write_topics(routed: DataFrame, path: str, checkpoint: str, stop_on_empty: bool = False) -> StreamingQuery:
    """Append ``topic, key, value`` to one folder per topic, each event exactly once."""
    writer = routed.writeStream.format("parquet").partitionBy("topic").option("path", path)
    return _start(writer, checkpoint, stop_on_empty)


def write_kafka(routed: DataFrame, servers: str, checkpoint: str, stop_on_empty: bool = False) -> StreamingQuery:
    """Send each row to the topic it names, at least once. Needs the Kafka connector."""
    writer = routed.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return _start(writer, checkpoint, stop_on_empty)


def write_batches(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                  stop_on_empty: bool = False) -> StreamingQuery:
    """Hand every micro-batch and its number to ``write``.

    After a failure the last batch comes again under its old number, so ``write`` should replace
    what it wrote for that number (``lakeloom.sources.writers.write_mart_batch`` does).
    """
    return _start(df.writeStream.foreachBatch(write), checkpoint, stop_on_empty)


def write_files(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", stop_on_empty: bool = False,
                by: Sequence[str] = ()) -> StreamingQuery:
    """Append to one folder, or to one per value of ``by``, each row exactly once."""
    writer = df.writeStream.format(fmt).option("path", path)
    return _start(writer.partitionBy(*by) if by else writer, checkpoint, stop_on_empty)


def _start(writer, checkpoint: str, stop_on_empty: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if stop_on_empty else writer).start()
