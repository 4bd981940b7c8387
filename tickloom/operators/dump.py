"""Writing points as text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.text import continuation_line, full_line
from tickloom.model import POINT_FIELDS, SERIES_KEY, selector_text, with_series_key
from tickloom.operators.ordering import crosses, numbered_rows, ordered_rows

# Order of points with one tick, so that results repeat.
POINT_ORDER = [name for name in POINT_FIELDS if name != "ts"]

# Lines that may follow each other with one name.
RUN_LINES = 1_000_000


def dump_text(points: DataFrame, optimize: bool = False, run_lines: int = RUN_LINES) -> DataFrame:
    """One text line per point, with the key of its series.

    With ``optimize``, lines are in order and only the first line of a series
    names it; the others start with ``=`` and hold position and value. The name
    comes again after every ``run_lines`` lines, for every series alike. Runs of
    lines under one name stay in one partition, and so in one file. Points are
    shuffled once, into ordered partitions where lines are written as they stand;
    only the lines of a run that goes on over the bound of a partition move again.
    """
    points = with_series_key(points)
    if not optimize:
        return points.select(*SERIES_KEY, "ts", full_line(selector_text()).alias("line"))
    if run_lines < 1:
        raise ValueError("run_lines must be at least 1")
    rows = points.select(*SERIES_KEY, *POINT_FIELDS)
    order = [F.col("ts"), *map(F.col, POINT_ORDER)]
    place = F.col("_number") - 1
    runs = numbered_rows(ordered_rows(rows, SERIES_KEY, order)).withColumns(
        {"_run": F.floor(place / run_lines), "_in_run": place % run_lines, "_crosses": crosses(run_lines)}
    )
    n = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    crossing = (
        runs.where("_crosses")
        .repartition(n, *SERIES_KEY, "_run")
        .sortWithinPartitions(*SERIES_KEY, "_number")
    )
    line = F.when(F.col("_in_run") == 0, full_line(selector_text())).otherwise(continuation_line())
    lines = [part.select(*SERIES_KEY, "ts", line.alias("line")) for part in (runs.where("NOT _crosses"), crossing)]
    return lines[0].union(lines[1])


def update_stream(
    points: DataFrame, ready: DataFrame | None = None, run_lines: int = RUN_LINES
) -> DataFrame:
    """Lines in the order an ingest endpoint reads them, with the key of their series.

    ``ready`` has lines of its own in ``line``, which are passed through as they
    are, without a key; each must name its series.
    """
    stream = dump_text(points, optimize=True, run_lines=run_lines)
    if ready is None:
        return stream
    nothing = {name: F.lit(None).cast(stream.schema[name].dataType) for name in (*SERIES_KEY, "ts")}
    continued = F.raise_error(F.concat(F.lit("line names no series: "), F.col("line")))
    named = F.when(F.ltrim("line").startswith("="), continued).otherwise(F.col("line"))
    return stream.union(
        ready.select(*[c.alias(name) for name, c in nothing.items()], named.alias("line"))
    )
