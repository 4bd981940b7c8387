"""Whole workflows made of the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.aggregates import emitted_count, series_bounds
from tickloom.operators.dump import dump_text
from tickloom.operators.joins import bounds_cogroup
from tickloom.operators.parse import parse_lines, strict_points
from tickloom.sources.keyvalue import sequence_file_sink
from tickloom.sources.series import series_scan
from tickloom.sources.text import write_update_stream


def merge_text(lines: DataFrame) -> DataFrame:
    """Lines of any series in any order, as ordered lines that name each series once.

    In tall form the merge of equal selectors is the grouping by series key that
    the dump makes, so points are never gathered into blocks.
    """
    return dump_text(strict_points(parse_lines(lines)), optimize=True)


def time_window(points: DataFrame) -> DataFrame:
    """First and last tick over all series, and the series that have them."""
    return bounds_cogroup(series_bounds(points))


def scan_to_sequence_files(
    points: DataFrame, path: str, *selectors: str, now: int, timespan: int
) -> None:
    """Selected points of a window as lines in sequence files."""
    chosen = series_scan(points, *selectors, now=now, timespan=timespan)
    lines = dump_text(chosen).select(F.col("line").cast("binary").alias("value"))
    sequence_file_sink(lines, path)


def push_points(points: DataFrame, path: str, ready: DataFrame | None = None) -> DataFrame:
    """Write points and ready lines as an update stream; returns the lines written per series."""
    write_update_stream(points, path, ready)
    return emitted_count(points, ready)
