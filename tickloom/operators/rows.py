"""User functions over rows, series and generated rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tickloom.functions.expressions import read_expressions
from tickloom.model import SERIES_KEY, with_series_key


def apply_exprs(df: DataFrame, script: str | list[str], name: str = "stack") -> DataFrame:
    """Run SQL expressions on every row and add their results as one struct.

    The first expression is ``e0``, the top of the stack. ``script`` is a list of
    expressions, one text of lines, or ``@file`` / ``%file`` naming a text file.
    """
    expressions = read_expressions(script)
    fields = [F.expr(text).alias(f"e{place}") for place, text in enumerate(expressions)]
    return df.withColumn(name, F.struct(*fields))


def map_rows(
    df: DataFrame,
    function: Callable[..., pd.DataFrame],
    schema: StructType | str,
    **options: Any,
) -> DataFrame:
    """Run a Python function on batches of rows.

    ``function`` gets a pandas frame and the keyword options and returns a frame
    of ``schema``. Batches hold ``spark.sql.execution.arrow.maxRecordsPerBatch``
    rows at most.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield function(batch, **options)

    return df.mapInPandas(run, schema)


def apply_per_series(
    points: DataFrame,
    function: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
    schema: StructType | str,
) -> DataFrame:
    """Run a Python function on the points of each series.

    ``function`` gets the points of a series as an iterator of frames, in no set
    order, and yields frames of ``schema``. It streams, so a series of any size
    takes the memory of one batch; what is kept between batches is up to the
    function.
    """
    keyed = with_series_key(points)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    kinds = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in function(batch.to_pandas() for batch in batches):
            yield pa.RecordBatch.from_pandas(frame, schema=kinds, preserve_index=False)

    # Adaptive execution would join partitions that are small in bytes, and so put
    # many Python calls into one task.
    n = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartition(n, *SERIES_KEY).groupBy(*SERIES_KEY).applyInArrow(run, schema)


def generate_rows(df: DataFrame, generator: Callable[..., Any], *arguments: Column) -> DataFrame:
    """Rows a Python table function makes from each row, beside that row.

    ``generator`` is made with ``pyspark.sql.functions.udtf`` or ``arrow_udtf``. A
    row for which it makes nothing is dropped. Where a built-in generator such as
    ``explode`` fits, use that instead.
    """
    return df.lateralJoin(generator(*[argument.outer() for argument in arguments]))


def generate_from_series(points: DataFrame, generator: Callable[..., Any]) -> DataFrame:
    """Rows an Arrow table function makes from the points of each series, in the order of ticks.

    ``generator`` is made with ``pyspark.sql.functions.arrow_udtf``, whose ``returnType`` gives the
    columns (Spark 4.1 knows no ``analyze`` there). For each series a new instance gets the points
    batch by batch in ``eval``, and ``terminate`` ends it; what is kept between batches is up to the
    instance. A series is one task; see ``apply_to_segments`` for large ones.
    """
    keyed = with_series_key(points)
    return generator(keyed.asTable().partitionBy(*SERIES_KEY).orderBy("ts"))
