"""User mapper and reducer functions on partitions and key groups.

The operators in this package use built-in expressions; these are for user code that has none. ``reduce_groups`` takes reducers
that may be applied in parts, ``reduce_sorted`` any that read a key's rows in order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import groupby, islice
from operator import itemgetter
from typing import Any

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


SLICES = 1024  # of the tasks; a key has at most so many partial results at the end


def map_lines(lines: DataFrame, mapper: Callable[..., Iterable[tuple]], schema: str, **params: Any) -> DataFrame:
    """Apply ``mapper(line, **params)``, which gives zero or more output rows, to each text line."""
    names = StructType.fromDDL(schema).names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [row for line in batch["value"] for row in mapper(line, **params)]
            yield pd.DataFrame(rows, columns=names)

    return lines.select("value").mapInPandas(run, schema)


def reduce_groups(pairs: DataFrame, key: str, reducer: Callable[[pd.DataFrame], pd.DataFrame],
                  schema: str) -> DataFrame:
    """Apply an associative ``reducer`` to the rows of each key.

    Its output has the columns of its input. Every batch is reduced where it lies, before anything is shuffled,
    and the results once more per key and slice of tasks, so that a hot key never meets in one task as a whole.
    """
    def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, group in batch.groupby(key, dropna=False, sort=False):
                yield reducer(group)

    combined = pairs.mapInPandas(combine, schema).withColumn("_slice", F.pmod(F.spark_partition_id(), F.lit(SLICES)))
    names = pairs.columns
    partial = combined.groupBy(key, "_slice").applyInPandas(lambda g: reducer(g[names]), schema)
    return partial.groupBy(key).applyInPandas(reducer, schema)


Part = pa.RecordBatch
Reducer = Callable[[tuple, Iterator[Part]], Iterable[tuple]]
OUT_ROWS = 4096  # that a task holds before it hands them on


def rows_of(parts: Iterable[Part]) -> Iterator[tuple]:
    """The rows of the parts, one after the other, as tuples."""
    for part in parts:
        yield from zip(*(c.to_pylist() for c in part.columns))


def _segments(batches: Iterable[Part], n_keys: int) -> Iterator[tuple[tuple, Part]]:
    """(key, rows) for every stretch of one key within a batch; a missing value is a key like any other."""
    for batch in batches:
        if not batch.num_rows:
            continue
        changes = [0]
        if batch.num_rows > 1:
            differ = None
            for column in batch.columns[:n_keys]:
                here, before = column.slice(1), column.slice(0, batch.num_rows - 1)
                both = pc.fill_null(pc.not_equal(here, before), False)
                one = pc.or_(both, pc.not_equal(pc.is_null(here), pc.is_null(before)))
                differ = one if differ is None else pc.or_(differ, one)
            changes += [i.as_py() + 1 for i in pc.indices_nonzero(differ)]
        for start, stop in zip(changes, [*changes[1:], batch.num_rows]):
            yield tuple(c[start].as_py() for c in batch.columns[:n_keys]), batch.slice(start, stop - start)


def reduce_sorted(rows: DataFrame, keys: Sequence[str], reducer: Reducer, schema: str,
                  order: Sequence[str | Column] = ()) -> DataFrame:
    """Apply ``reducer(key, parts)``, which gives zero or more output rows, to the rows of each key in the given order.

    Any reducer will do: it sees all rows of a key once, one after the other, and may depend on their order. ``parts`` is an iterator
    of record batches with the columns of ``rows``, keys first; ``rows_of`` reads them as tuples. A reducer may stop early.

    Spark sorts each task's rows, on disk where they do not fit, and the task reads them as a stream: neither it nor the reducer holds
    more than one batch, however many rows a key has. A key's rows are one task's work, since each may depend on all before it;
    where a reducer can be applied in parts, ``reduce_groups`` splits hot keys.
    """
    target = StructType.fromDDL(schema)
    names, n_keys = target.names, len(keys)
    types = [f.type for f in rows.sparkSession.createDataFrame([], target).toArrow().schema]

    def run(batches: Iterator[Part]) -> Iterator[Part]:
        def out() -> Iterator[tuple]:
            for key, stretch in groupby(_segments(batches, n_keys), key=itemgetter(0)):
                yield from reducer(key, (part for _, part in stretch))

        found = out()
        while held := list(islice(found, OUT_ROWS)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names)

    others = [c for c in rows.columns if c not in keys]
    ordered = rows.select(*keys, *others).repartition(*keys).sortWithinPartitions(*keys, *order)
    return ordered.mapInArrow(run, target)
