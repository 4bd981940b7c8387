"""Reading points from text lines."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.text import (
    LINE_PARTS,
    label_entries,
    labels_of_entries,
    parsed_value,
    percent_decode,
    with_line_parts,
)
from tickloom.model import POINT_FIELDS, POINTS_SCHEMA, VALUE_FIELDS, empty_string_map

# Columns that ``sources.text.read_lines`` adds to give lines their file order.
LINE_PLACE = ["file", "block_start", "place"]


def _typed(lines: DataFrame, column: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """Lines, their place and the columns ``carry``, plus the parts of each line, typed.

    ``_bad`` says what is wrong with a line taken by itself. The parts pass through
    a one-element ``inline``, so that conditions put on them later, also those that
    joins add, work on the parts and do not repeat the parsing.
    """

    def raw(name: str) -> Column:
        return F.col("_parts")[LINE_PARTS.index(name)]

    def part(name: str) -> Column:
        return F.nullif(raw(name), F.lit(""))

    kept = [column, *[name for name in lines.columns if name in LINE_PLACE], *carry]
    named = raw("brace") == "{"
    staged = with_line_parts(lines.select(*kept), column, "_parts").withColumns(
        {
            "ts": part("ts").try_cast("bigint"),
            "lat": part("lat").try_cast("double"),
            "lon": part("lon").try_cast("double"),
            "elev": part("elev").try_cast("bigint"),
            "_value": raw("value"),
            "_entries": F.when(named, label_entries(raw("labels"))),
        }
    )
    typed = staged.withColumns(
        {
            **parsed_value(F.col("_value")),
            "_mark": raw("mark") == "=",
            "_named": named,
            "_class": F.when(named, percent_decode(raw("class"))),
            "_labels": labels_of_entries(F.col("_entries")),
        }
    )
    lost_position = reduce(
        or_, [part(name).isNotNull() & F.col(name).isNull() for name in ("lat", "lon", "elev")]
    )
    no_value = reduce(and_, [F.col(name).isNull() for name in VALUE_FIELDS])
    bad = (
        F.when(F.col("_parts").isNull(), "malformed line")
        .when(F.col("ts").isNull(), "tick out of range")
        .when(lost_position, "malformed position")
        .when(no_value, "malformed value")
        .when(F.col("_named") & F.col("_mark"), "continuation line names a series")
        .when(
            F.col("_named") & (F.col("_class").isNull() | F.col("_labels").isNull()),
            "malformed series name",
        )
    )
    parts = F.struct("_mark", "_class", "_labels", *POINT_FIELDS, bad.alias("_bad"))
    return typed.select(*kept, F.inline(F.array(parts)))


def _finish(typed: DataFrame, column: str, keep: list[str]) -> DataFrame:
    nameless = F.when(
        F.col("class").isNull() | F.col("labels").isNull(), "no series named before this line"
    )
    return typed.withColumn("attributes", empty_string_map()).select(
        *POINTS_SCHEMA.fieldNames(),
        *keep,
        F.col(column).alias("line"),
        F.coalesce("_bad", nameless).alias("problem"),
    )


def parse_lines(lines: DataFrame, column: str = "line", carry: tuple[str, ...] = ()) -> DataFrame:
    """Points of self-contained lines, with ``line``, ``problem`` and the columns ``carry`` of the lines.

    ``problem`` is null for a good line. Continuation lines are problems here;
    ``parse_stream`` reads them.
    """
    typed = _typed(lines, column, carry).withColumns(
        {
            "class": F.when(~F.col("_mark"), F.col("_class")),
            "labels": F.when(~F.col("_mark"), F.col("_labels")),
        }
    )
    return _finish(typed, column, list(carry))


def parse_stream(lines: DataFrame, column: str = "line") -> DataFrame:
    """As ``parse_lines``, for lines that may continue the series before them.

    ``lines`` has the columns of ``LINE_PLACE``. The series in force at the start
    of a file block comes from the last full line of the blocks before it, so that
    no task reads more than a block in order. Lines that continue a malformed line
    are problems too, and no series carries over from one file to the next.
    """

    def head(value: Column) -> Column:
        return F.when(~F.ltrim(F.col(column)).startswith("="), value)

    block = ["file", "block_start"]
    series = F.struct("_class", "_labels")

    block_ends = lines.groupBy(*block).agg(
        F.max_by(column, head(F.col("place"))).alias("_end")
    )
    before = (
        Window.partitionBy("file").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = block_ends.select(*block, F.last("_end", ignorenulls=True).over(before).alias(column))
    carried = _typed(carried, column).select(*block, series.alias("_carried"))

    so_far = (
        Window.partitionBy(*block).orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    )
    current = F.coalesce(F.last("_series", ignorenulls=True).over(so_far), F.col("_carried"))
    placed = (
        _typed(lines, column)
        .withColumn("_series", head(series))
        .join(carried, block, "left")
        .withColumn("_current", current)
        .withColumns({"class": F.col("_current._class"), "labels": F.col("_current._labels")})
    )
    return _finish(placed, column, LINE_PLACE)


def good_points(parsed: DataFrame) -> DataFrame:
    """Points of the lines without a problem."""
    return parsed.where(F.col("problem").isNull()).drop("line", "problem", *LINE_PLACE)


def rejected_lines(parsed: DataFrame) -> DataFrame:
    """Lines with a problem, and what it is."""
    return parsed.where(F.col("problem").isNotNull()).select("line", "problem")


def strict_points(parsed: DataFrame) -> DataFrame:
    """Points of all lines; the query fails on the first line with a problem."""
    return parsed.where(is_fine()).drop("line", "problem", *LINE_PLACE)


def is_fine() -> Column:
    """True for a line without a problem; one with a problem fails the query.

    As a condition the check stays whatever columns are used later.
    """
    failure = F.raise_error(F.concat(F.col("problem"), F.lit(": "), F.col("line")))
    return F.when(F.col("problem").isNull(), True).otherwise(failure.cast("boolean"))
