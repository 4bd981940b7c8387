"""User functions over the ordered points of a series that take many tasks for a large series.

A function is given as the start, the step and the merge of a state. Points lie in ordered partitions, where
a series is one segment or several. A first pass steps through the last segment of each partition
from the start, which gives the state that segment makes; one row per partition merges them to the
state in which each partition finds its first series, a prefix sum of states; a second pass steps from
there and yields rows. So a series is worked on by as many tasks as its points fill partitions.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tickloom.model import SERIES_KEY, with_series_key
from tickloom.operators.ordering import NOT_REUSED, sorted_partitions, with_neighbours

_Batches = Iterator[pa.RecordBatch]
_STATES = "_part int, _first long, _last long, _is_one boolean, _state binary"
_NAMES = [field.split()[0] for field in _STATES.split(", ")]


@dataclass(frozen=True)
class SegmentFunction:
    """``step`` takes the state before some points, which are in order, and gives the state behind them and rows.

    ``merge(a, b)`` is the state behind two stretches that follow each other, from the states that
    each makes from ``start()``; it must be associative, and agree with stepping through both. States are
    pickled and sent to every task, one per partition, so they should be small.
    """

    start: Callable[[], Any]
    step: Callable[[Any, pd.DataFrame], tuple[Any, pd.DataFrame]]
    merge: Callable[[Any, Any], Any]


def apply_to_segments(
    points: DataFrame, function: SegmentFunction, schema: StructType | str, order: list[Column] | None = None
) -> DataFrame:
    """Rows of ``schema`` that ``function`` makes from the points of each series, in ``order`` (by tick).

    Points that agree in the order come in no set sequence. No points give no rows.
    """
    keyed = with_series_key(points)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    ordered = sorted_partitions(keyed, SERIES_KEY, order or [F.col("ts")])
    states = ordered.mapInArrow(_summary(function), _STATES)
    # One row per partition, in one task.
    before = states.repartition(1).sortWithinPartitions("_part").mapInArrow(_prefix(function), _STATES)
    placed = with_neighbours(ordered, before)
    return placed.mapInArrow(_run(function, keyed.columns, to_arrow_schema(schema)), schema)


def _segments(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Group and rows of each stretch of one group."""
    group = batch.column("_group").to_numpy()
    bounds = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1), len(group)]
    for first, last in zip(bounds, bounds[1:]):
        yield int(group[first]), batch.slice(first, last - first)


def _points(segment: pa.RecordBatch, columns: list[str]) -> pd.DataFrame:
    return segment.select(columns).to_pandas()


def _row(part: int, first: int, last: int, is_one: bool, state: bytes | None) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
    values = [part, first, last, is_one, state]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=_NAMES)


def _summary(function: SegmentFunction) -> Callable[[_Batches], _Batches]:
    """A row for a partition: its first and last group, whether it is one, and the state the last makes."""

    def run(batches: _Batches) -> _Batches:
        first, last, state, is_one = None, None, None, True
        for batch in batches:
            columns = [c for c in batch.schema.names if c not in ("_group", "_weight")]
            # Only the last group of the partition can go on, so others are not stepped through.
            parts = list(_segments(batch)) if batch.num_rows else []
            for at, (group, segment) in enumerate(parts):
                if first is None:
                    first = group
                is_one = is_one and group == first
                if at < len(parts) - 1:
                    last = None
                    continue
                if group != last:
                    state = function.start()
                last = group
                state, _ = function.step(state, _points(segment, columns))
        if first is not None:
            yield _row(TaskContext.get().partitionId(), first, last, is_one, pickle.dumps(state))

    return run


def _prefix(function: SegmentFunction) -> Callable[[_Batches], _Batches]:
    """The same rows with the state in which each partition finds its first group; null where it begins there."""

    def run(batches: _Batches) -> _Batches:
        group, state = None, None
        for batch in batches:
            for row in batch.to_pylist():
                goes_on = group == row["_first"]
                before, own = state if goes_on else None, pickle.loads(row["_state"])
                yield _row(*(row[n] for n in _NAMES[:-1]), None if before is None else pickle.dumps(before))
                state = function.merge(before, own) if goes_on and row["_is_one"] else own
                group = row["_last"]

    return run


def _run(function: SegmentFunction, columns: list[str], schema: pa.Schema) -> Callable[[_Batches], _Batches]:
    def run(batches: _Batches) -> _Batches:
        last, state, expected = None, None, None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            for group, segment in _segments(batch):
                if last is None:
                    if group != segment.column("_first")[0].as_py():
                        raise RuntimeError(NOT_REUSED)
                    expected, found = segment.column("_last")[0].as_py(), segment.column("_state")[0].as_py()
                    state = function.start() if found is None else pickle.loads(found)
                elif group != last:
                    state = function.start()
                last = group
                state, rows = function.step(state, _points(segment, columns))
                yield pa.RecordBatch.from_pandas(rows, schema=schema, preserve_index=False)
        if last != expected:
            raise RuntimeError(NOT_REUSED)

    return run
