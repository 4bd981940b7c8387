"""Cutting series into time chunks and joining them again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.timeunits import floor_div
from tickloom.model import empty_string_map, with_series_key

# Label that names the chunk of a series; fixed by the data model.
CHUNK_LABEL = "chunkId"


def without_chunk_label(labels: Column) -> Column:
    return F.map_filter(F.coalesce(labels, empty_string_map()), lambda k, v: k != CHUNK_LABEL)


def chunk_labels(labels: Column, chunk_id: Column) -> Column:
    """Labels with the chunk label set, replacing one already there."""
    return F.map_concat(
        without_chunk_label(labels), F.create_map(F.lit(CHUNK_LABEL), chunk_id.cast("string"))
    )


def time_chunk(points: DataFrame, clip_from: int, clip_to: int, width: int) -> DataFrame:
    """Points within ``[clip_from, clip_to]``, labelled with their chunk.

    Chunks are ``width`` ticks wide and aligned at tick 0. Each chunk is a series
    of its own; ``base_key`` keeps the label text of the series it came from.
    Only a filter and a projection: nothing is shuffled.
    """
    if width < 1:
        raise ValueError("width must be at least 1")
    clipped = with_series_key(points.where(F.col("ts").between(clip_from, clip_to)))
    return (
        clipped.withColumn("chunk_id", floor_div(F.col("ts"), width))
        .withColumnRenamed("label_key", "base_key")
        .withColumn("labels", chunk_labels(F.col("labels"), F.col("chunk_id")))
    )


def chunk_fuse(chunks: DataFrame) -> DataFrame:
    """Points of the original series: chunk labels removed."""
    plain = chunks.withColumn("labels", without_chunk_label(F.col("labels"))).drop("chunk_id")
    if "base_key" in plain.columns:
        return plain.withColumnRenamed("base_key", "label_key")
    return with_series_key(plain.drop("label_key"))
