"""Series stored with a directory that answers selectors before any point is read.

Three tables lie side by side. ``series`` has a row per series with an id, its metadata, its number of
points and its bounds. ``postings`` lists the ids of the series that have a class, or a label of a
name and value, in the order of name, value and id; a frequent value has many rows, never a long array. ``points``
holds the points with their series id, in its order. Ids follow class and labels, so series that a
selector takes together lie together.

A selector is looked up in the postings, where its names and values are pushed to the scan. The ids found
are covered by ranges, which are pushed to the scan of the points and skip files and row groups;
a semi-join then keeps exactly the ids.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.selectors import Match, parse_selector
from tickloom.model import POINT_FIELDS, SERIES_KEY, with_series_key
from tickloom.operators.ordering import with_rank
from tickloom.session import materialise

#: Ranges of ids that are pushed to the scan of the points at most.
COVER_RANGES = 64

_CLASS, _LABEL = 0, 1


def write_series(points: DataFrame, path: str) -> None:
    """Write points and their directory under ``path``.

    A series has the attributes of its first point. Points without class are series of the empty class.
    """
    keyed = with_series_key(points)
    place = F.struct("ts", *[c for c in POINT_FIELDS if c != "ts"])
    grouped = keyed.groupBy(*SERIES_KEY).agg(
        F.any_value("labels").alias("labels"),
        F.min_by("attributes", place).alias("attributes"),
        F.count(F.lit(1)).alias("n_points"),
        F.min("ts").alias("first_tick"),
        F.max("ts").alias("last_tick"),
    )
    order = [F.col(c) for c in SERIES_KEY]
    numbered = with_rank(grouped.withColumn("_all", F.lit(0)), ["_all"], order, "series_id").drop("_all")
    # In the order of the ids, as numbered.
    numbered.write.parquet(f"{path}/series")
    series = points.sparkSession.read.parquet(f"{path}/series")
    none = F.create_map().cast("map<string,string>")
    # A name is an attribute's only where no label has it.
    labels, attributes = F.coalesce("labels", none), F.coalesce("attributes", none)
    named = F.map_concat(labels, F.map_filter(attributes, lambda k, _: ~F.map_contains_key(labels, k)))
    postings = series.select(F.lit(_CLASS).alias("kind"), F.lit("").alias("name"), F.col("class").alias("value"), "series_id")
    postings = postings.union(series.select(F.lit(_LABEL), F.explode(named), "series_id"))
    by = ["kind", "name", "value", "series_id"]
    postings.repartitionByRange(*by).sortWithinPartitions(*by).write.parquet(f"{path}/postings")
    ids = series.select(*SERIES_KEY, "series_id")
    stored = keyed.select(*SERIES_KEY, "labels", "attributes", *POINT_FIELDS).join(ids, SERIES_KEY)
    stored.repartitionByRange("series_id", "ts").sortWithinPartitions("series_id", "ts").write.parquet(
        f"{path}/points"
    )


def series_directory(spark: SparkSession, path: str) -> DataFrame:
    """The row of every series."""
    return spark.read.parquet(f"{path}/series")


def find_series(spark: SparkSession, path: str, *selectors: str) -> DataFrame:
    """``series_id`` of every series that matches any of the selectors."""
    if not selectors:
        raise ValueError("at least one selector is needed")
    return reduce(DataFrame.union, [_found(spark, path, text) for text in selectors]).distinct()


def _found(spark: SparkSession, path: str, selector: str) -> DataFrame:
    parsed = parse_selector(selector)
    postings = spark.read.parquet(f"{path}/postings")

    def having(kind: int, name: str, match: Match) -> DataFrame:
        of_name = postings.where((F.col("kind") == kind) & (F.col("name") == name))
        narrow = match.pushable(F.col("value"))
        listed = of_name if narrow is None else of_name.where(narrow)
        return listed.where(match.on(F.col("value"))).select("series_id")

    conditions = [having(_LABEL, name, match) for name, match in parsed.label_matches]
    if parsed.class_match != Match(".*", True) or not conditions:
        conditions.append(having(_CLASS, "", parsed.class_match))
    # A series has a class and each label once, so it meets all conditions if it is listed so often.
    listed = reduce(DataFrame.union, [c.select("series_id", F.lit(i).alias("i")) for i, c in enumerate(conditions)])
    return (
        listed.groupBy("series_id")
        .agg(F.count_distinct("i").alias("n"))
        .where(F.col("n") == len(conditions))
        .select("series_id")
    )


def fetch_series(
    spark: SparkSession, path: str, *selectors: str, first: int | None = None, last: int | None = None
) -> DataFrame:
    """Points of the selected series, with ``series_id``, from tick ``first`` to ``last`` where given."""
    ids = materialise(find_series(spark, path, *selectors))
    ranges = _cover(ids)
    points = spark.read.parquet(f"{path}/points")
    if not ranges:
        return points.where("false")
    within = reduce(or_, [F.col("series_id").between(low, high) for low, high in ranges])
    if first is not None:
        within = within & (F.col("ts") >= first)
    if last is not None:
        within = within & (F.col("ts") <= last)
    return points.where(within).join(ids, "series_id", "left_semi")


def _cover(ids: DataFrame) -> list[tuple[int, int]]:
    """Ranges that hold all ids, ``COVER_RANGES`` at most: the extremes within equal stretches of their span."""
    ends = ids.agg(F.min("series_id").alias("low"), F.max("series_id").alias("high")).first()
    if ends["low"] is None:
        return []
    width = -(-(ends["high"] - ends["low"] + 1) // COVER_RANGES)
    cell = F.floor((F.col("series_id") - ends["low"]) / width)
    rows = ids.groupBy(cell.alias("cell")).agg(F.min("series_id").alias("low"), F.max("series_id").alias("high"))
    ranges: list[tuple[int, int]] = []
    for row in rows.orderBy("cell").collect():
        if ranges and row["low"] == ranges[-1][1] + 1:
            ranges[-1] = (ranges[-1][0], row["high"])
        else:
            ranges.append((row["low"], row["high"]))
    return ranges
