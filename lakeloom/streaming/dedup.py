"""One event per key on a stream, with late events on an output of their own.

Built-in deduplication forgets a key when the watermark passes it and then leaves out, unseen, whatever still comes for that time. Here a
stateful processor keeps each key until a timer of its own fires and says of every event what it is, so that nothing is lost: an event
that comes too late to be compared leaves on the second output.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUTCOME = "outcome"
FIRST, LATE = "first", "late"
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


BUCKETS = 4096  # of keys; a checkpoint keeps its number
STEPS = 16      # timers in a delay


def _packed(kept: list[tuple]) -> bytes:
    """Keys and event times in one value."""
    batch = pa.RecordBatch.from_arrays([pa.array(list(column)) for column in zip(*kept)], ["key", "at"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as stream:
        stream.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> Iterator[tuple]:
    table = pa.ipc.open_stream(bytes(data)).read_all()
    return zip(table.column("key").to_pylist(), table.column("at").to_pylist())


class FirstOfKey(StatefulProcessor):
    """The first event of a key, for as long as the key is kept; late events of keys that are not kept.

    State is held for a bucket of keys, as a list with a value for each batch that brought new keys: these keys and their event times,
    packed. So a batch reads and writes a few values for each of its buckets, however many keys there are, since a value per key would cost
    more than all else. Timers are set at steps of the keeping time; when one fires, the bucket's keys that are over are dropped.
    """

    def __init__(self, keep_ms: int):
        self.keep_ms, self.step = keep_ms, max(1, keep_ms // STEPS)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getListState("seen", T.StructType().add("packed", T.BinaryType()))

    def _kept(self) -> Iterator[tuple]:
        return (kept for (packed,) in self.seen.get() for kept in _unpacked(packed))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        watermark, known, new = timerValues.getCurrentWatermarkInMs(), {one for one, _ in self._kept()}, []
        for row in rows:
            if row.key in known:
                continue
            if row.at < watermark:
                yield Row(event=row.event, outcome=LATE)
                continue
            known.add(row.key)
            new.append((row.key, row.at))
            yield Row(event=row.event, outcome=FIRST)
        if new:
            self.seen.appendValue((_packed(new),))
            for timer in {-(-(at + self.keep_ms) // self.step) * self.step for _, at in new}:
                self.handle.registerTimer(timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        last = expiredTimerInfo.getExpiryTimeInMs() - self.keep_ms
        kept = [(one, at) for one, at in self._kept() if at > last]
        if kept:
            self.seen.put([(_packed(kept),)])
        else:
            self.seen.clear()
        return iter(())

    def close(self) -> None:
        pass


def first_and_late(events: DataFrame, key: str, event_time: str, delay: str, buckets: int = BUCKETS) -> DataFrame:
    """The columns of ``events`` and ``outcome``: ``first`` for the first event of each key, ``late`` for events that cannot be compared.

    A key is kept until the watermark, ``delay`` behind the latest event, has passed its first event by another ``delay`` (and up to a
    sixteenth of it more); further events of it are left out until then. An event behind the watermark whose key is not kept is late: it
    may be new or not. Events without key or time have nothing to be compared by and are all first. A task holds the keys of one bucket at
    a time: choose ``buckets`` by the number of keys within two delays. It must not change while a checkpoint is in use.
    """
    if not events.isStreaming:
        raise ValueError("for tables there is events.dedup: nothing is late there")
    keep_ms = events.sparkSession.range(1).select(
        F.unix_millis(F.timestamp_millis(F.lit(0)) + F.expr(f"INTERVAL {delay}")).alias("ms")).first().ms
    whole = F.struct(*[F.col(f"`{c}`") for c in events.columns]).alias("event")
    bare = F.col(key).isNull() | F.col(event_time).isNull()
    # The struct hides the event time from the planner, which would otherwise drop late events before the processor sees them.
    compared = F.col(key)
    if isinstance(events.select(key).schema[0].dataType, (T.StructType, T.ArrayType)):  # packed as text
        compared = F.to_json(F.struct(key), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    told = events.where(~bare).withWatermark(event_time, delay).select(
        F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket"), compared.alias("key"), F.unix_millis(event_time).alias("at"), whole)
    out = T.StructType().add("event", told.schema["event"].dataType).add(OUTCOME, T.StringType())
    processor = FirstOfKey(keep_ms)
    done = told.groupBy("bucket").transformWithState(processor, out, "append", "eventTime")
    rest = events.where(bare).select(whole, F.lit(FIRST).alias(OUTCOME))
    return done.unionByName(rest).select("event.*", OUTCOME)


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """The state store that keeps keys on disk, for streams started within."""
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
