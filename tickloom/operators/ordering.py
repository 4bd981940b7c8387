"""Numbering the rows of groups in order, whatever the size of a group.

A single series may hold a large share of all points. Rows are range-partitioned
by group and order, which cuts large groups like any other stretch of rows, and
each partition numbers its rows as they stream by. What a partition must know of
its neighbours comes from a table with one row per partition, made of the same
partitions: a query reads its one exchange several times, so rows are shuffled once and
no copy of them is written. There is no limit above which the method or the
result changes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Columns of ``ordered_rows`` beside those of the rows: a hash of the keys, the weight, and of the
#: row's partition its first and last group, how many rows and how much weight earlier partitions have of the
#: first, how many rows the last has up to here, and whether the next partition goes on with it.
ORDERED_NAMES = ["_group", "_weight", "_first", "_last", "_in_rows", "_in_sum", "_out_rows", "_goes_on"]
_EDGES = ["_part", "_first", "_last", "_rows", "_sum"]


def ordered_rows(
    rows: DataFrame, keys: list[str], order: list[Column], weight: Column | None = None
) -> DataFrame:
    """``rows`` in partitions that follow each other by ``keys`` and ``order``, sorted, with ``ORDERED_NAMES``."""
    ordered = sorted_partitions(rows, keys, order, weight)
    edges = ordered.mapInArrow(_edges, "_part int, _first long, _last long, _rows long, _sum long")
    return with_neighbours(ordered, _carried(edges)).select(*rows.columns, *ORDERED_NAMES)


def with_neighbours(ordered: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of ``sorted_partitions`` with what ``known`` says of their ``_part``, in a row per partition."""
    placed = ordered.withColumn("_of", F.spark_partition_id())
    return placed.join(F.broadcast(known), F.col("_of") == F.col("_part"))


def sorted_partitions(
    rows: DataFrame, keys: list[str], order: list[Column], weight: Column | None = None
) -> DataFrame:
    """``rows`` with ``_group`` and ``_weight``, sorted, in partitions that follow each other.

    All readers of the exchange must see the same partitions. Spark's reuse of
    exchanges gives that: a session that has switched it off is refused, and readers check
    that their partitions begin and end as the table of neighbours says.
    """
    spark = rows.sparkSession
    if spark.conf.get("spark.sql.exchange.reuse", "true") != "true":
        raise RuntimeError("ordering rows needs spark.sql.exchange.reuse")
    # The hash skips nulls, so which keys are null is hashed as well.
    group = F.xxhash64(*[part for k in keys for part in (F.col(k).isNull(), F.col(k))])
    by = [*[F.col(k).asc() for k in keys], *order]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    weighed = rows.withColumns(
        {"_group": group, "_weight": F.lit(0).cast("bigint") if weight is None else weight.cast("bigint")}
    )
    # Behind a generator no column is known to be constant, so none is left out by some readers
    # and carried by others, which would make their exchanges differ.
    opaque = weighed.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in weighed.columns]))))
    return opaque.repartitionByRange(n, *by).sortWithinPartitions(*by)


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for a partition that has any: its first and last group, and rows and weight of the last."""
    first, last, rows, total = None, None, 0, 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        group, weight = batch.column("_group").to_numpy(), batch.column("_weight").to_numpy()
        if first is None:
            first = int(group[0])
        changes = np.flatnonzero(group[1:] != group[:-1]) + 1
        if len(changes) or group[0] != last:
            rows = total = 0
        start = int(changes[-1]) if len(changes) else 0
        last, rows, total = int(group[-1]), rows + len(group) - start, total + int(weight[start:].sum())
    if first is not None:
        values = [first, last, rows, total]
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int32()), *[pa.array([v], pa.int64()) for v in values]],
            names=_EDGES,
        )


def _carried(edges: DataFrame) -> DataFrame:
    """What each partition must know of its neighbours; one row per partition goes in and comes out."""
    # Rows of a group lie together. So the partitions that end with a group follow each other, and
    # what lies before a partition of its first group is what those before it end with. Sums of
    # a group are running sums less what they were where its first such partition begins.
    row = Window.orderBy("_part")
    new = F.coalesce(F.lag("_last").over(row) != F.col("_last"), F.lit(True))
    total = {name: F.sum(name).over(row) for name in ("_rows", "_sum")}
    begun = edges.withColumns({f"{name}_all": t for name, t in total.items()} | {"_new": new})
    before = {f"{n}_before": F.max(F.when(F.col("_new"), F.col(f"{n}_all") - F.col(n))).over(row) for n in total}
    ends = begun.withColumns(before).select(
        "_part", "_first", "_last", *[(F.col(f"{n}_all") - F.col(f"{n}_before")).alias(n) for n in total]
    )
    goes_on = F.lag("_last").over(row) == F.col("_first")
    zero = F.lit(0).cast("bigint")
    return ends.select(
        "_part",
        "_first",
        "_last",
        F.when(goes_on, F.lag("_rows").over(row)).otherwise(zero).alias("_in_rows"),
        F.when(goes_on, F.lag("_sum").over(row)).otherwise(zero).alias("_in_sum"),
        F.col("_rows").alias("_out_rows"),
        F.coalesce(F.lead("_first").over(row) == F.col("_last"), F.lit(False)).alias("_goes_on"),
    )


NOT_REUSED = "readers of one exchange saw different partitions; spark.sql.exchange.reuse must be on"


class Numbers:
    """Place of each row in its group and the weight before it, as the batches of a partition stream by."""

    def __init__(self) -> None:
        self.last: int | None = None
        self.rows = self.total = 0
        self.expected: tuple[int, int] | None = None

    def of(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which rows begin a group here, all rows' places, and the weights before them."""
        n = batch.num_rows
        group, weight = batch.column("_group").to_numpy(), batch.column("_weight").to_numpy()
        if self.last is None:
            # The first group goes on where the partitions before it end.
            self.last = batch.column("_first")[0].as_py()
            if self.last != group[0]:
                raise RuntimeError(NOT_REUSED)
            self.expected = (batch.column("_last")[0].as_py(), batch.column("_out_rows")[0].as_py())
            self.rows, self.total = batch.column("_in_rows")[0].as_py(), batch.column("_in_sum")[0].as_py()
        new = np.concatenate([[group[0] != self.last], group[1:] != group[:-1]])
        start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        same = np.cumsum(new) == 0  # rows of the group that the batch before ended with
        before = np.cumsum(weight) - weight
        numbers = np.arange(n) - start + 1 + np.where(same, self.rows, 0)
        sums = before - before[start] + np.where(same, self.total, 0)
        self.last, self.rows, self.total = int(group[-1]), int(numbers[-1]), int(sums[-1] + weight[-1])
        return new, numbers, sums

    def end(self) -> None:
        """To be called after the last batch."""
        if self.expected not in (None, (self.last, self.rows)):
            raise RuntimeError(NOT_REUSED)


def numbered_rows(ordered: DataFrame) -> DataFrame:
    """``ordered_rows`` with ``_number``, the place in the group from 1, and ``_before``, the weight before."""
    zero = F.lit(0).cast("bigint")
    return ordered.mapInArrow(_number, ordered.withColumns({"_number": zero, "_before": zero}).schema)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    numbers = Numbers()
    for batch in batches:
        if batch.num_rows:
            _, places, sums = numbers.of(batch)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(places), pa.array(sums)],
                names=[*batch.schema.names, "_number", "_before"],
            )
    numbers.end()


def with_rank(
    rows: DataFrame,
    keys: list[str],
    order: list[Column],
    name: str = "rank",
    weight: Column | None = None,
    weight_before: str = "weight_before",
) -> DataFrame:
    """Number the rows of every group from 1 in the given order.

    ``order`` should be total for the result to repeat. With ``weight``, a whole
    number, ``weight_before`` is the sum of the weights of the group's earlier
    rows. Null keys are keys like any other. Rows stay in order in their partitions.
    """
    numbered = numbered_rows(ordered_rows(rows, keys, order, weight))
    added = [F.col("_number").alias(name)]
    if weight is not None:
        added.append(F.col("_before").alias(weight_before))
    return numbered.select(*rows.columns, *added)


def crosses(length: int) -> Column:
    """Whether the stretch of ``length`` rows in which a row of ``numbered_rows`` lies crosses the bound of
    its partition. Stretches begin at the places 1, ``length`` + 1 and so on of a group."""
    stretch = F.floor((F.col("_number") - 1) / length)
    cut = lambda rows: (rows % length != 0) & (stretch == F.floor((rows - 1) / length))
    begun = (F.col("_group") == F.col("_first")) & cut(F.col("_in_rows"))
    unfinished = (F.col("_group") == F.col("_last")) & F.col("_goes_on") & cut(F.col("_out_rows"))
    return begun | unfinished
