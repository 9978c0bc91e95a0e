"""Ranking, previous-value and running aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.functions.numbers import percent_change, zero_if_null
from lakeloom.session import workspace


def top_k_per(df: DataFrame, part: Sequence[str], order: Sequence[Column], k: int,
              rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group.

    The limit sits directly above the window, so Spark cuts each group to ``k`` rows per task
    before the shuffle: a group of any size costs one task no more than ``k`` rows from each other task.
    """
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def first_rows(df: DataFrame, order: Sequence[Column], n: int, groups: int = 1024) -> DataFrame:
    """The first ``n`` rows of all, chosen in two steps: first in ``groups`` groups of tasks, then among those.

    Each task sends at most ``n`` rows to its group, and the last step sees at most ``groups`` x ``n``, however many tasks there are.
    """
    grouped = df.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(groups)))
    return top_k_per(grouped, ["_group"], order, n, "_place").drop("_group", "_place").orderBy(*order).limit(n)


def with_previous(df: DataFrame, keys: Sequence[str], period: str, value: str, pct: str,
                  previous: str = "prev_revenue") -> DataFrame:
    """Add the value of the previous period present in each group, and the change in percent.

    Expects one row per group and period, that is, an aggregate.
    """
    w = Window.partitionBy(*keys).orderBy(period)
    raw = df.withColumn("_previous", F.lag(value, 1).over(w))
    return raw.select(
        *df.columns,
        zero_if_null(F.col("_previous")).alias(previous),
        percent_change(F.col(value), F.col("_previous")).alias(pct))


def running_sum(df: DataFrame, order: str, value: str, out: str) -> DataFrame:
    """Sum from the first row up to the current one.

    The window is not partitioned: use it on a table of periods, not on rows.
    """
    w = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.sum(value).over(w))


def moving_average(df: DataFrame, order: str, value: str, out: str, n: int = 3) -> DataFrame:
    """Mean of the current row and the ``n - 1`` before it; for tables of periods as well."""
    w = Window.orderBy(order).rowsBetween(1 - n, Window.currentRow)
    return df.withColumn(out, F.avg(value).over(w))


GROUP_ROWS = 1 << 20  # a group that one task ranks


def ranked(df: DataFrame, part: Sequence[str], order: str, ties: Sequence[str] = (), *,
           row_number: str | None = None, rank: str | None = None, dense_rank: str | None = None,
           lag: tuple[str, int, str] | None = None, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Rank functions over groups of any size, ordered by ``order`` and then ``ties``, ascending.

    Each keyword names the output column of one function; ``lag`` is ``(column, n, output)``.
    The groups are counted first. Where none has more than ``group_rows`` rows, which a task sorts at a time, the window functions do
    it. Otherwise the rows are sorted by range on group, order and ties, and stored once with the number of their range. A group is then one or
    more pieces, each within one range; its size, its order values or how often they repeat do not matter, as equal rows
    may lie in different ranges too. Ranks inside a piece need only an offset, which comes from one summary row per piece.
    """
    largest = df.groupBy(*part).count().agg(F.max("count")).first()[0] or 0
    if largest <= group_rows:
        w, by_value = Window.partitionBy(*part).orderBy(order, *ties), Window.partitionBy(*part).orderBy(order)
        made = {row_number: F.row_number().over(w), rank: F.rank().over(by_value), dense_rank: F.dense_rank().over(by_value)}
        if lag:
            made[lag[2]] = F.lag(lag[0], lag[1]).over(w)
        return df.select(*df.columns, *[c.cast("long").alias(name) if name in (row_number, rank, dense_rank) else c.alias(name)
                                        for name, c in made.items() if name])
    part, keys = list(part), ["_range", *part]
    rows = _by_range(df, part, order, ties)
    w = Window.partitionBy(*keys).orderBy(order, *ties, "_row_id")
    by_value = Window.partitionBy(*keys).orderBy(order)
    pieces = _pieces(rows, keys, part, order, values=bool(dense_rank))

    local = rows.withColumn("_row", F.row_number().over(w))
    if rank:
        local = local.withColumn("_rank", F.rank().over(by_value))
    if dense_rank:
        local = local.withColumn("_dense", F.dense_rank().over(by_value))
    if lag:
        local = local.withColumn(lag[2], F.lag(lag[0], lag[1]).over(w))
    out = _left_join_on(local, pieces, keys).withColumn("_position", F.col("_before") + F.col("_row"))
    goes_on = F.col("_goes_on") & F.col(order).eqNullSafe(F.col("_first"))
    if rank:
        out = out.withColumn(rank, F.when(goes_on, F.col("_run_start")).otherwise(
            F.col("_before") + F.col("_rank") - 1) + 1)
    if dense_rank:
        out = out.withColumn(dense_rank, F.col("_values_before") + F.col("_dense"))
    if lag:
        out = _lag_across_pieces(out, part, *lag)
    if row_number:
        out = out.withColumn(row_number, F.col("_position"))
    return out.select(*df.columns, *[c for c in (row_number, rank, dense_rank, lag and lag[2]) if c])


def _left_join_on(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join that also matches NULL keys, since NULL is a group of its own in a window."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, on, "left").drop(*[f"_r_{k}" for k in keys])


def _by_range(df: DataFrame, part: list[str], order: str, ties: Sequence[str]) -> DataFrame:
    """``df`` stored in order, with ``_range`` and ``_row_id``, which makes every row different."""
    by = [*part, order, *ties, "_row_id"]
    tagged = df.withColumn("_row_id", F.monotonically_increasing_id())
    path = workspace(df.sparkSession, "ranges")
    tagged.repartitionByRange(*by).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _pieces(rows: DataFrame, keys: list[str], part: list[str], order: str, values: bool) -> DataFrame:
    """One row per piece: rows and values before it in its group, its first value, whether that goes on from the piece before
    (``_goes_on``), and the position at which the run of that value starts (``_run_start``).

    A group has at most as many pieces as there are ranges.
    """
    # NULL is one more distinct value of ``order`` for dense_rank.
    n_values = F.count_distinct(order) + F.max(F.col(order).isNull().cast("int")) if values else F.lit(0)
    low = F.struct(F.col(order).isNotNull().alias("set"), order)
    runs = rows.groupBy(*keys, order).agg(F.count("*").alias("_n"))
    ends = runs.groupBy(*keys).agg(
        F.sum("_n").alias("_rows"), n_values.cast("long").alias("_values"), F.min(low)[order].alias("_first"),
        F.max(low)[order].alias("_last"), F.max_by("_n", low).alias("_n_last"))
    w = Window.partitionBy(*part).orderBy("_range")
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    goes_on = F.coalesce((F.row_number().over(w) > 1) & F.col("_first").eqNullSafe(F.lag("_last").over(w)), F.lit(False))
    p = ends.withColumn("_goes_on", goes_on).withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    new = F.when(~(F.col("_goes_on") & F.col("_first").eqNullSafe(F.col("_last"))),
                 F.col("_before") + F.col("_rows") - F.col("_n_last"))
    repeats = F.sum(F.col("_goes_on").cast("long")).over(w)
    return p.withColumn("_new", new).select(
        *keys, "_before", "_goes_on", "_first", "_rows",
        (F.coalesce(F.sum("_values").over(earlier), F.lit(0)) - repeats).alias("_values_before"),
        F.last("_new", ignorenulls=True).over(earlier).alias("_run_start"))


def _lag_across_pieces(out: DataFrame, part: list[str], column: str, n: int, name: str) -> DataFrame:
    """Fill the first ``n`` rows of a piece from the last ``n`` rows of the pieces before it."""
    tails = out.where(F.col("_row") > F.col("_rows") - n).select(
        *part, (F.col("_position") + n).alias("_wanted"), F.col(column).alias("_carried"))
    head = (F.col("_before") > 0) & (F.col("_row") <= n)
    heads = out.withColumn("_wanted", F.when(head, F.col("_position")))
    filled = heads.join(
        tails.withColumnsRenamed({k: f"_r_{k}" for k in part} | {"_wanted": "_r_wanted"}),
        [*[F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in part], F.col("_wanted") == F.col("_r_wanted")],
        "left").drop(*[f"_r_{k}" for k in part], "_r_wanted")
    return filled.withColumn(name, F.when(head, F.col("_carried")).otherwise(F.col(name)))
