"""Series stored as Parquet tables of points or blocks."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.geo import cell, cover
from tickloom.functions.selectors import selector_condition
from tickloom.functions.timeunits import floor_div
from tickloom.model import BLOCKS_SCHEMA, POINTS_SCHEMA, SERIES_KEY, with_selector, with_series_key
from tickloom.operators.blocks import pack_points, with_statistics
from tickloom.operators.parse import good_points, is_fine, parse_lines, strict_points


def write_points(points: DataFrame, path: str, bucket_width: int | None = None) -> None:
    """Write points, sorted so that readers skip row groups by class and tick.

    With ``bucket_width`` the table is partitioned by time bucket of that many
    ticks, and a window scan reads only the buckets it needs.
    """
    columns = [name for name in points.columns if name in (*POINTS_SCHEMA.fieldNames(), "label_key")]
    rows = points.select(*columns)
    if bucket_width is None:
        rows.repartitionByRange("class", "ts").sortWithinPartitions("class", "ts").write.parquet(path)
        return
    bucketed = rows.withColumn("bucket", floor_div(F.col("ts"), bucket_width))
    (
        bucketed.repartitionByRange("bucket", "class", "ts")
        .sortWithinPartitions("bucket", "class", "ts")
        .write.partitionBy("bucket")
        .parquet(path)
    )


def read_points(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_points_by_place(points: DataFrame, path: str) -> None:
    """Write points in the order of their ``cell``, so that ``points_in_box`` reads what lies near a box."""
    placed = with_series_key(points).withColumn("cell", cell(F.col("lat"), F.col("lon")))
    columns = [n for n in placed.columns if n in (*POINTS_SCHEMA.fieldNames(), "label_key", "cell")]
    placed.select(*columns).repartitionByRange("cell", "ts").sortWithinPartitions("cell", "ts").write.parquet(path)


def points_in_box(
    spark: SparkSession, path: str, lat_min: float, lat_max: float, lon_min: float, lon_max: float
) -> DataFrame:
    """Points of ``write_points_by_place`` in a box, its edges included.

    A box from a larger to a smaller longitude goes over the 180th meridian. Ranges of cells that cover
    the box reach the scan; the coordinates then decide.
    """
    ranges = cover(lat_min, lat_max, lon_min, lon_max)
    points = spark.read.parquet(path)
    if not ranges:
        return points.where("false")
    near = reduce(or_, [F.col("cell").between(low, high) for low, high in ranges])
    if lon_min <= lon_max:
        in_lon = F.col("lon").between(lon_min, lon_max)
    else:
        in_lon = (F.col("lon") >= lon_min) | (F.col("lon") <= lon_max)
    return points.where(near & F.col("lat").between(lat_min, lat_max) & in_lon)


def save_points_by_series(points: DataFrame, table: str, path: str, buckets: int) -> None:
    """Save points as a table whose files hold whole series, dealt into ``buckets`` by series key.

    Joins and groupings by series (``partition_join``, ``series_count``) then use the points where they lie,
    and only what is joined to them moves. The table ``table`` is in the session's catalogue, its files are
    under ``path``. A series is one bucket, so points of a table with very large series are better written
    by ``write_points``, and joined there by a shuffle that adaptive execution splits.
    """
    keyed = with_series_key(points)
    columns = [name for name in keyed.columns if name in (*POINTS_SCHEMA.fieldNames(), "label_key")]
    (
        keyed.select(*columns)
        .repartition(buckets, *SERIES_KEY)
        .write.bucketBy(buckets, *SERIES_KEY)
        .sortBy(*SERIES_KEY)
        .option("path", path)
        .saveAsTable(table)
    )


def write_blocks(blocks: DataFrame, path: str) -> None:
    """Write blocks with statistics of their points, in an order that lets readers skip row groups."""
    with_statistics(blocks).sortWithinPartitions("class", "first_tick").write.parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of a table that has at least the columns of ``BLOCKS_SCHEMA``."""
    blocks = spark.read.parquet(path)
    missing = [name for name in BLOCKS_SCHEMA.fieldNames() if name not in blocks.columns]
    if missing:
        raise ValueError(f"not a table of blocks, missing {', '.join(missing)}")
    return blocks


def series_scan(
    points: DataFrame,
    *selectors: str,
    now: int,
    timespan: int,
    bucket_width: int | None = None,
) -> DataFrame:
    """Points of selected series in the window ``(now - timespan, now]``.

    The window and the known classes of the selectors are plain comparisons, so
    they reach the scan. ``bucket_width`` adds the matching condition on the
    partition column of ``write_points``. Adds the ``id`` of the series.
    """
    in_window = (F.col("ts") > now - timespan) & (F.col("ts") <= now)
    if bucket_width is not None:
        first, last = (now - timespan) // bucket_width, now // bucket_width
        in_window = F.col("bucket").between(first, last) & in_window
    chosen = points.where(in_window & selector_condition(*selectors))
    return with_selector(chosen).withColumnRenamed("selector", "id")


#: Fields of an item of mixed kind; each may be null or absent.
MIXED_KINDS = ("line", "lines", "block", "blocks")


def normalize_mixed(items: DataFrame, column: str = "item", strict: bool = True) -> DataFrame:
    """Points of one column whose items are text lines, blocks, or arrays of either.

    A column of one kind holds strings, arrays of strings, block structs or arrays
    of them. A column of mixed kind is a struct with some of the ``MIXED_KINDS``
    fields, of which an item fills what it has. Empty arrays and nulls are skipped.
    A text that is no line fails the query when ``strict``.
    """
    if items.columns != [column]:
        raise ValueError(f"expected the single column {column!r}, got {items.columns}")
    kinds = _kinds(F.col(column), items.schema[column].dataType)
    texts = [_as_array(kinds[k], k == "line") for k in ("line", "lines") if k in kinds]
    stored = [_as_array(kinds[k], k == "block") for k in ("block", "blocks") if k in kinds]
    if not stored:
        parsed = parse_lines(_each(items, line=texts))
        points = strict_points(parsed) if strict else good_points(parsed)
        return points.select(*POINTS_SCHEMA.fieldNames())
    head = ["class", "labels", "attributes"]
    if not texts:
        blocks = _each(items, block=stored).select("block.*")
        return blocks.select(*head, F.inline("points")).select(*POINTS_SCHEMA.fieldNames())
    # Lines and blocks stay rows of one table, so the items are read once: a parsed line is
    # an array of one point beside the arrays of the blocks.
    parsed = parse_lines(_each(items, line=texts, block=stored), carry=("block",))
    is_line = F.col("line").isNotNull()
    good = is_fine() if strict else F.col("problem").isNull()
    kind = parsed.schema["block"].dataType["points"].dataType
    line_points = F.array(F.struct(*[F.col(f.name) for f in kind.elementType.fields])).cast(kind)
    both = [F.when(is_line, F.col(name)).otherwise(F.col(f"block.{name}")).alias(name) for name in head]
    every = F.when(is_line, line_points).otherwise(F.col("block.points"))
    return parsed.where(~is_line | good).select(*both, F.inline(every)).select(*POINTS_SCHEMA.fieldNames())


def normalized_sink(
    items: DataFrame, path: str, column: str = "item", strict: bool = True, **bounds: int
) -> None:
    """Write items of mixed kind as a table of blocks; ``bounds`` are those of ``pack_points``."""
    write_blocks(pack_points(normalize_mixed(items, column, strict), **bounds), path)


def _kinds(item: Column, kind: T.DataType) -> dict[str, Column]:
    if isinstance(kind, T.StringType):
        return {"line": item}
    if isinstance(kind, T.ArrayType):
        return {"lines" if isinstance(kind.elementType, T.StringType) else "blocks": item}
    if isinstance(kind, T.StructType) and "points" in kind.fieldNames():
        return {"block": item}
    if isinstance(kind, T.StructType) and kind.fields and set(kind.fieldNames()) <= set(MIXED_KINDS):
        return {name: item[name] for name in kind.fieldNames()}
    raise ValueError(f"neither lines nor blocks: {kind.simpleString()}")


def _as_array(value: Column, is_single: bool) -> Column:
    return F.array(value) if is_single else value


def _each(items: DataFrame, **arrays: list[Column]) -> DataFrame:
    """A row per element that is not null of any of the arrays of an item, under the name of its kind.

    Rows of other kinds are null there.
    """

    def under(kind: str) -> Callable[[Column], Column]:
        return lambda value: F.struct(*[(value if n == kind else F.lit(None)).alias(n) for n in arrays])

    rows = [F.transform(array, under(kind)) for kind, of in arrays.items() for array in of]
    if len(rows) > 1:
        rows = [F.concat(*[F.coalesce(a, F.array()) for a in rows])]
    return items.select(F.inline(rows[0])).where(reduce(or_, [F.col(n).isNotNull() for n in arrays]))
