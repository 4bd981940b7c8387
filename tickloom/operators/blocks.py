"""Packing points into blocks and back."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tickloom.functions.ids import text_id, with_series_ids
from tickloom.functions.text import parsed_labels
from tickloom.functions.timeunits import floor_div
from tickloom.model import (
    HEADER_FIELDS,
    METADATA_FIELDS,
    POINT_FIELDS,
    POINT_TYPE,
    SERIES_KEY,
    VALUE_FIELDS,
    arity,
    empty_string_map,
    label_text,
    point_struct,
    with_series_key,
)
from tickloom.operators.chunks import chunk_labels, without_chunk_label
from tickloom.operators.dump import POINT_ORDER
from tickloom.operators.ordering import Numbers, ordered_rows
from tickloom.session import materialise

# Bounds of a block unless the caller asks for others. A block is one row.
DEFAULT_BLOCK_POINTS = 100_000
DEFAULT_BLOCK_BYTES = 64_000_000
# What ``with_statistics`` adds to a header.
STATISTICS = ["n_points", "first_tick", "last_tick", "kinds"]
# A point without the text of its value.
_POINT_BYTES = 80


def point_of(*columns: str) -> dict[str, Column]:
    """Point columns from 2 to 5 input columns.

    The forms are (tick, value), (tick, elevation, value), (tick, latitude,
    longitude, value) and (tick, latitude, longitude, elevation, value). The
    result has keys ``ts``, ``lat``, ``lon``, ``elev`` and ``value`` and holds
    the arguments that ``model.to_points`` takes.
    """
    forms = {
        2: ("ts", "value"),
        3: ("ts", "elev", "value"),
        4: ("ts", "lat", "lon", "value"),
        5: ("ts", "lat", "lon", "elev", "value"),
    }
    if len(columns) not in forms:
        raise ValueError("a point has 2, 3, 4 or 5 columns")
    return dict(zip(forms[len(columns)], map(F.col, columns)))


def pack_points(
    points: DataFrame,
    max_points: int = DEFAULT_BLOCK_POINTS,
    max_bytes: int = DEFAULT_BLOCK_BYTES,
    by: list[str] | None = None,
) -> DataFrame:
    """Blocks of bounded size, in tick order within a series.

    A block has at most ``max_points`` points and ends with the point that takes
    the series over the next multiple of ``max_bytes``. Blocks of a series are
    numbered upwards from 0 in ``block_no``; a number is left out where both
    bounds are met at once. All blocks carry the metadata of the series. ``by``
    adds grouping columns that are kept in the result.

    Points are shuffled once, into ordered partitions, and packed as they stream by there;
    only the pieces of a block that goes on over the bound of a partition are exchanged.
    """
    packed = _packed(points, max_points, max_bytes, by or [])
    zero = F.lit(0).cast("bigint")
    return packed.select(
        "class",
        parsed_labels(F.col("label_key")).alias("labels"),
        "attributes",
        *[zero.alias(name) for name in HEADER_FIELDS],
        "count",
        "points",
        "label_key",
        *(by or []),
        "block_no",
    )


def _packed(points: DataFrame, max_points: int, max_bytes: int, by: list[str]) -> DataFrame:
    """Keys, ``block_no``, ``attributes``, ``count`` and ``points`` of blocks, and in ``first_place`` the
    place of the first point in its series, from 1."""
    if max_points < 1 or max_bytes < 1:
        raise ValueError("max_points and max_bytes must be at least 1")
    keys = [*SERIES_KEY, *by]
    # The label map is left out of the shuffle: the label text says the same.
    rows = with_series_key(points).select(*keys, "attributes", *POINT_FIELDS)
    size = F.lit(_POINT_BYTES) + F.coalesce(F.octet_length("v_str"), F.lit(0))
    ordered = ordered_rows(rows, keys, [F.col("ts"), *map(F.col, POINT_ORDER)], size)
    schema = rows.select(*keys, "attributes").schema
    for field in T.StructType.fromDDL("block_no long, first_place long, count long, is_piece boolean"):
        schema.add(field)
    schema.add("points", T.ArrayType(POINT_TYPE))
    pieces = ordered.mapInArrow(_packer(to_arrow_schema(schema), max_points, max_bytes), schema)
    piece = F.struct("first_place", "points")
    joined = (
        pieces.where("is_piece")
        .groupBy(*keys, "block_no")
        .agg(
            F.min_by("attributes", "first_place").alias("attributes"),
            F.min("first_place").alias("first_place"),
            F.sum("count").alias("count"),
            F.flatten(F.transform(F.sort_array(F.collect_list(piece)), lambda p: p["points"])).alias("points"),
        )
    )
    return pieces.where("NOT is_piece").drop("is_piece").unionByName(joined)


def _packer(
    schema: pa.Schema, max_points: int, max_bytes: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Packs the rows of an ordered partition; what may go on beyond it is marked as a piece."""
    kept = [name for name in schema.names if name not in ("block_no", "first_place", "count", "is_piece", "points")]

    def blocks(
        rows: pa.RecordBatch, starts: np.ndarray, numbers: np.ndarray, places: np.ndarray, is_piece: np.ndarray
    ) -> pa.RecordBatch:
        bounds = np.append(starts, rows.num_rows)
        points = pa.StructArray.from_arrays(
            [rows.column(name) for name in POINT_FIELDS],
            fields=[pa.field(f.name, f.type, f.nullable) for f in schema.field("points").type.value_type],
        )
        made = {
            "block_no": pa.array(numbers[starts]),
            "first_place": pa.array(places[starts]),
            "count": pa.array(np.diff(bounds).astype(np.int64)),
            "is_piece": pa.array(is_piece),
            "points": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), points),
        }
        first = pa.array(starts)
        return pa.RecordBatch.from_arrays(
            [made[n] if n in made else rows.column(n).take(first) for n in schema.names], schema=schema
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = Numbers()
        # Rows of the block that is still open, the number and first place of it, and whether it was begun before.
        held: list[pa.RecordBatch] = []
        number, place, begun, goes_on, group = 0, 0, False, False, None

        def closed(is_piece: bool) -> pa.RecordBatch:
            rows = pa.concat_batches(held) if len(held) > 1 else held[0]
            return blocks(rows, np.zeros(1, np.int64), np.array([number]), np.array([place]), np.array([is_piece]))

        for batch in batches:
            if batch.num_rows == 0:
                continue
            is_first = group is None
            new, places, before = numbers.of(batch)
            # Neither quotient ever falls, so their sum changes exactly where one of them does.
            of_row = (places - 1) // max_points + before // max_bytes
            goes_on = batch.column("_goes_on")[0].as_py()
            rows = batch.select([*kept, *POINT_FIELDS])
            starts_here = new | (np.diff(of_row, prepend=of_row[0]) != 0)
            starts_here[0] = is_first or bool(new[0]) or of_row[0] != number
            starts = np.flatnonzero(starts_here)
            if len(starts) == 0:
                held.append(rows)
            else:
                if held:
                    held.append(rows.slice(0, starts[0]))
                    yield closed(begun)
                    begun = False
                if is_first:
                    begun = (places[0] - 1) % max_points != 0
                if len(starts) > 1:
                    whole = rows.slice(0, starts[-1]).slice(starts[0])
                    marks = np.zeros(len(starts) - 1, bool)
                    marks[0], begun = begun, False
                    at = starts[0]
                    yield blocks(whole, starts[:-1] - at, of_row[at:], places[at:], marks)
                last = starts[-1]
                held, number, place = [rows.slice(last)], int(of_row[last]), int(places[last])
            group = numbers.last
        if held:
            yield closed(begun or goes_on)
        numbers.end()

    return run


def unpack_points(blocks: DataFrame) -> DataFrame:
    """Points of blocks, with their ``arity`` in shortest form.

    All five fields are columns and absent ones are null.
    """
    carried = [c for c in blocks.columns if c not in (*HEADER_FIELDS, "count", "points", *STATISTICS)]
    return blocks.select(*carried, F.inline("points")).withColumn("arity", arity())


def block_metadata(blocks: DataFrame) -> DataFrame:
    """Header and metadata of blocks; absent parts are empty, never null."""
    return with_series_key(blocks).select(
        F.coalesce("class", F.lit("")).alias("class"),
        F.coalesce("labels", empty_string_map()).alias("labels"),
        F.coalesce("attributes", empty_string_map()).alias("attributes"),
        *HEADER_FIELDS,
        "count",
        *[c for c in ("label_key", "block_no") if c in blocks.columns],
    )


def metadata_of_map(metadata: Column) -> dict[str, Column]:
    """Metadata columns of a struct that may lack any of them."""
    return {
        "class": F.coalesce(metadata["class"], F.lit("")),
        "labels": F.coalesce(metadata["labels"], empty_string_map()),
        "attributes": F.coalesce(metadata["attributes"], empty_string_map()),
    }


def with_bounds(blocks: DataFrame) -> DataFrame:
    """Blocks with ``first_tick`` and ``last_tick``, read from the header where the table stores them.

    They are null for a block without points.
    """
    missing = {"first_tick": F.array_min("points.ts"), "last_tick": F.array_max("points.ts")}
    return blocks.withColumns({name: c for name, c in missing.items() if name not in blocks.columns})


def with_statistics(blocks: DataFrame) -> DataFrame:
    """Blocks with what their header should say of their points, so that the points need not be read.

    ``n_points``, ``first_tick`` and ``last_tick``, and ``kinds``: the names of the value fields in use.
    """

    def if_used(name: str) -> Column:
        return F.when(F.exists("points", lambda p: p[name].isNotNull()), F.lit(name))

    kinds = F.array_compact(F.array(*map(if_used, VALUE_FIELDS)))
    return with_bounds(blocks).withColumns({"n_points": block_points(), "kinds": kinds})


def block_bounds(blocks: DataFrame) -> DataFrame:
    """Points, first and last tick of every series, from the headers of its blocks.

    Of blocks that ``write_blocks`` has stored, no points are read. Blocks without points count as 0.
    """
    known = with_bounds(with_series_key(blocks))
    n = F.col("n_points") if "n_points" in known.columns else block_points()
    return known.groupBy(*SERIES_KEY).agg(
        F.sum(n).alias("n_points"), F.min("first_tick").alias("first_tick"), F.max("last_tick").alias("last_tick")
    )


def clip_blocks(blocks: DataFrame, clip_from: int, clip_to: int) -> DataFrame:
    """The points from ``clip_from`` to ``clip_to``, in the blocks that have any.

    Blocks outside are left out by their header, which a scan of stored blocks can use to skip
    them; the points of blocks inside are not looked at.
    """
    near = with_bounds(blocks).where((F.col("last_tick") >= clip_from) & (F.col("first_tick") <= clip_to))
    inside = (F.col("first_tick") >= clip_from) & (F.col("last_tick") <= clip_to)
    kept = F.filter("points", lambda p: p["ts"].between(clip_from, clip_to))
    clipped = near.withColumn("points", F.when(inside, F.col("points")).otherwise(kept))
    return clipped.where(F.size("points") > 0).drop(*STATISTICS)


def merge_series(
    blocks: DataFrame,
    max_points: int = DEFAULT_BLOCK_POINTS,
    max_bytes: int = DEFAULT_BLOCK_BYTES,
) -> DataFrame:
    """Blocks with one selector merged in tick order, equal points kept.

    The headers decide: a block that overlaps no other and holds from half of
    ``max_points`` up to all of them passes as it is. What lies between two such blocks of a series
    (blocks that overlap, and small ones) is unpacked, merged and packed again within the bounds, so a
    series never sits in one row whole unless it fits a block. Points are read from their arrays
    only there; blocks meet their verdict in a join, which is broadcast where the headers are few.

    The merged series has the attributes of its first block. ``block_no`` is the number of
    points of the series before the block.
    """
    blocks = with_bounds(with_series_key(blocks))
    headers = blocks.select(
        *SERIES_KEY,
        "first_tick",
        "last_tick",
        label_text(F.col("attributes")).alias("_attributes"),
        block_points().alias("_points"),
    )
    # Blocks without points come last, whatever their attributes.
    place = F.struct(F.col("first_tick").isNull(), "first_tick", "_attributes")
    owners = headers.groupBy(*SERIES_KEY).agg(
        F.min_by("_attributes", place).alias("_attributes"),
        F.min("first_tick").alias("_start"),
        F.max("last_tick").alias("_end"),
    )
    full = (F.col("_points") * 2 >= max_points) & (F.col("_points") <= max_points)
    verdicts = materialise(_stretches(headers.drop("_attributes").join(owners, SERIES_KEY), full))
    span = ["first_tick", "last_tick"]
    judged = blocks.drop("attributes", "block_no").join(
        verdicts.where(F.col("first_tick").isNotNull()).distinct(), [*SERIES_KEY, *span]
    )
    attributes = parsed_labels(F.col("_attributes"))
    columns = [*METADATA_FIELDS, *HEADER_FIELDS, "count", "points", "label_key", "block_no"]
    zero = F.lit(0).cast("bigint")
    own_header = {"attributes": attributes, "labels": parsed_labels(F.col("label_key")), "count": F.col("_points")}
    passed = judged.where("_passes").withColumns({**own_header, "block_no": F.col("_base")})

    points = (
        judged.where("NOT _passes")
        .select(*SERIES_KEY, "_base", "_attributes", F.inline("points"))
        .withColumn("attributes", empty_string_map())
    )
    merged = _packed(points, max_points, max_bytes, ["_base", "_attributes"])
    fresh = {**own_header, **{name: zero for name in HEADER_FIELDS}}
    del fresh["count"]
    merged = merged.withColumns({**fresh, "block_no": F.col("_base") + F.col("first_place") - 1})
    empty = verdicts.where(F.col("first_tick").isNull()).dropDuplicates(SERIES_KEY).withColumns(
        {**fresh, "count": zero, "points": F.array().cast(T.ArrayType(POINT_TYPE)), "block_no": zero}
    )
    return reduce(DataFrame.union, [part.select(*columns) for part in (passed, merged, empty)])


def block_points() -> Column:
    """Points that a block stores."""
    return F.when(F.col("points").isNull(), 0).otherwise(F.size("points.ts")).cast("bigint")


#: A series is swept in so many parts of its time at most.
_SWEEP_PARTS = 4096


def _stretches(headers: DataFrame, full: Column) -> DataFrame:
    """Sweep over the intervals of each series: which blocks pass, and where what lies between them begins.

    ``_passes`` says that a block is ``full`` and overlaps no other (equal ticks overlap). ``_base`` is the
    number of points of the series before a block that passes, and else before the stretch of blocks it is in.
    The time from ``_start`` to ``_end`` of a series is swept in parts, each with what it must know of the
    others, so that a series with very many blocks is no single task. Of blocks without points, those of a
    series that has no others stay, with null ticks.
    """
    span = F.col("_end").cast("decimal(20,0)") - F.col("_start") + 1
    offset = F.col("first_tick").cast("decimal(20,0)") - F.col("_start")
    part = F.floor(offset.cast("double") / span.cast("double") * _SWEEP_PARTS)
    swept = headers.where(F.col("first_tick").isNotNull() | F.col("_start").isNull()).withColumn(
        "_part", F.coalesce(part, F.lit(0).cast("bigint"))
    )
    key = [*SERIES_KEY, "_part"]
    inside = Window.partitionBy(*key).orderBy("first_tick", "last_tick")
    earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
    parts = Window.partitionBy(*SERIES_KEY).orderBy("_part")
    earlier_parts = parts.rowsBetween(Window.unboundedPreceding, -1)

    totals = swept.groupBy(*key).agg(
        F.max("last_tick").alias("_last"), F.min("first_tick").alias("_begin"), F.sum("_points").alias("_sum")
    )
    around = totals.select(
        *key,
        F.max("_last").over(earlier_parts).alias("_last_before"),
        F.lead("_begin").over(parts).alias("_begin_after"),
        F.coalesce(F.sum("_sum").over(earlier_parts), F.lit(0)).alias("_points_before"),
    )
    before = F.greatest(F.max("last_tick").over(earlier), F.col("_last_before"))
    after = F.coalesce(F.lead("first_tick").over(inside), F.col("_begin_after"))
    points = F.col("_points_before") + F.coalesce(F.sum("_points").over(earlier), F.lit(0))
    judged = swept.join(around, key).select(
        *swept.columns, before.alias("_b"), after.alias("_a"), points.alias("_before")
    )
    alone = (F.col("_b").isNull() | (F.col("_b") < F.col("first_tick"))) & (
        F.col("_a").isNull() | (F.col("_a") > F.col("last_tick"))
    )
    judged = judged.withColumn("_passes", alone & full & F.col("first_tick").isNotNull()).withColumn(
        "_after", F.when(F.col("_passes"), F.col("_before") + F.col("_points"))
    )
    # The stretch of a block begins behind the last block before it that passes.
    begun = (
        judged.groupBy(*key)
        .agg(F.max("_after").alias("_after"))
        .select(*key, F.max("_after").over(earlier_parts).alias("_from"))
    )
    stretch = F.greatest(F.max("_after").over(earlier), F.col("_from"), F.lit(0).cast("bigint"))
    return judged.join(begun, key).select(
        *SERIES_KEY,
        "first_tick",
        "last_tick",
        "_attributes",
        "_passes",
        F.when(F.col("_passes"), F.col("_before")).otherwise(stretch).alias("_base"),
        F.when(F.col("_passes"), F.col("_points")).alias("_points"),
    )


def split_key_value(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Blocks as a table of metadata and a table of point payloads.

    Both carry the ids, series key and block number that join them again.
    """
    keyed = with_series_ids(blocks)
    on = ["class_id", "labels_id", *SERIES_KEY, "block_no"]
    keys = keyed.select(
        *on, *[c for c in METADATA_FIELDS if c != "class"], *HEADER_FIELDS, "count"
    )
    return keys, keyed.select(*on, "points")


def join_key_value(keys: DataFrame, payloads: DataFrame) -> DataFrame:
    """Undo ``split_key_value``."""
    return keys.join(payloads, ["class_id", "labels_id", *SERIES_KEY, "block_no"])


def load_blocks(
    blocks: DataFrame,
    mode: str = "normal",
    gen_ids: bool = False,
    clip_from: int | None = None,
    clip_to: int | None = None,
    chunk_width: int | None = None,
) -> DataFrame:
    """Stored blocks as ``(className, labels[, ids][, chunkId], encoded)``.

    ``normal`` keeps the whole block, ``light`` only its metadata, and ``chunk``
    cuts it into time chunks, which need both clip bounds and a width. ``encoded``
    is the block as a struct. With ``gen_ids`` both join ids are columns and labels.
    """
    mode = mode.lower()
    if mode not in ("normal", "light", "chunk"):
        raise ValueError(f"unknown mode: {mode!r}")
    stored = with_series_key(blocks)
    extra: list[str] = []
    if mode == "chunk":
        if clip_from is None or clip_to is None or chunk_width is None:
            raise ValueError("chunk mode needs clip_from, clip_to and chunk_width")
        stored = chunk_blocks(stored, clip_from, clip_to, chunk_width)
        extra = ["chunkId"]
        stored = stored.withColumn("chunkId", F.col("chunk_id").cast("string"))
    if gen_ids:
        original = label_text(without_chunk_label(F.col("labels")))
        stored = stored.withColumns(
            {"classIdForJoin": text_id("class"), "labelsIdForJoin": text_id(original)}
        )
        stored = stored.withColumn("labels", with_id_labels(F.col("labels")))
        extra = ["classIdForJoin", "labelsIdForJoin", *extra]
    payload = [*METADATA_FIELDS, *HEADER_FIELDS, "count"]
    if mode != "light":
        payload.append("points")
    return stored.select(
        F.col("class").alias("className"), "labels", *extra, F.struct(*payload).alias("encoded")
    )


def with_id_labels(labels: Column) -> Column:
    """Labels with both ids of the row among them, replacing ones already there."""
    names = ("classIdForJoin", "labelsIdForJoin")
    plain = F.map_filter(F.coalesce(labels, empty_string_map()), lambda k, v: ~k.isin(*names))
    return F.map_concat(
        plain, F.create_map(*[c for n in names for c in (F.lit(n), F.col(n).cast("string"))])
    )


def chunk_blocks(blocks: DataFrame, clip_from: int, clip_to: int, width: int) -> DataFrame:
    """Every block cut into one block per time chunk, without a shuffle.

    The ticks of a block are sorted, so a chunk is a slice of the array: each
    point is looked at a fixed number of times, however many chunks there are.
    """
    if width < 1:
        raise ValueError("width must be at least 1")

    def starts(points: Column) -> Column:
        """Places (from 1) of the first point of each chunk, and one past the end."""
        chunk = lambda i: floor_div(F.get(points, i)["ts"], width)
        places = F.sequence(F.lit(0), F.size(points) - 1)
        firsts = F.filter(places, lambda i: (i == 0) | (chunk(i) != chunk(i - 1)))
        return F.concat(firsts, F.array(F.size(points)))

    clipped = (
        clip_blocks(with_series_key(blocks), clip_from, clip_to)
        .withColumn("points", F.sort_array("points"))
        .withColumn("_starts", starts(F.col("points")))
    )
    cut = clipped.select("*", F.posexplode("_starts").alias("_n", "_first")).where(
        F.col("_n") < F.size("_starts") - 1
    )
    length = F.get("_starts", F.col("_n") + 1) - F.col("_first")
    return (
        cut.withColumn("points", F.slice("points", F.col("_first") + 1, length))
        .withColumn("chunk_id", floor_div(F.get("points", F.lit(0))["ts"], width))
        .withColumn("count", F.size("points").cast("bigint"))
        .withColumn("labels", chunk_labels(F.col("labels"), F.col("chunk_id")))
        .drop("_starts", "_n", "_first")
    )
