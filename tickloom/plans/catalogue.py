"""One query per operator, over the given tables, with the same query in SQL."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.ids import with_series_ids
from tickloom.functions.portable import (
    add,
    columns_from_portable,
    columns_to_portable,
    new_bag,
)
from tickloom.functions.stack import (
    flatten_bag,
    flatten_struct,
    levelled_stack,
    stack_get,
    stack_order,
    stack_to_struct,
)
from tickloom.functions.timeunits import (
    convert_ticks,
    floor_div,
    ticks_of_local_timestamp,
    ticks_of_timestamp,
    timestamp_of_ticks,
)
from tickloom.model import (
    SERIES_KEY,
    arity,
    label_text,
    selector_text,
    to_points,
    with_selector,
    with_series_key,
)
from tickloom.operators.aggregates import (
    bag_by_key,
    block_count,
    emitted_count,
    is_block_empty,
    series_bounds,
    series_count,
    top_one,
    window_of_all,
)
from tickloom.operators.blocks import (
    block_bounds,
    block_metadata,
    clip_blocks,
    join_key_value,
    load_blocks,
    merge_series,
    metadata_of_map,
    pack_points,
    point_of,
    split_key_value,
    unpack_points,
)
from tickloom.operators.chunks import chunk_fuse, time_chunk
from tickloom.operators.dump import POINT_ORDER, dump_text
from tickloom.operators.joins import (
    cogroup_bags,
    group_assignment,
    partition_join,
    reduce_by_group,
)
from tickloom.operators.parse import parse_lines, parse_stream, strict_points
from tickloom.operators.ordering import with_rank
from tickloom.operators.rows import apply_exprs, apply_per_series, generate_from_series, map_rows
from tickloom.operators.segments import SegmentFunction, apply_to_segments
from tickloom.operators.select import filter_by_metadata, select_series
from tickloom.plans.events import event_points, read_table
from tickloom.plans.workflows import (
    merge_text,
    push_points,
    scan_to_sequence_files,
    time_window,
)
from tickloom.session import new_shared_path
from tickloom.sources.directory import fetch_series, find_series, series_directory, write_series
from tickloom.sources.files import read_archive_entries, whole_file_ingest
from tickloom.sources.keyvalue import (
    BYTES_WRITABLE,
    SEQUENCE_INPUT,
    SEQUENCE_OUTPUT,
    TEXT_WRITABLE,
    bytes_sink,
    hadoop_sink,
    hadoop_source,
    kv_sink,
    kv_source,
    sequence_file_sink,
    sequence_file_source,
)
from tickloom.sources.ranges import range_scan
from tickloom.sources.series import (
    MIXED_KINDS,
    normalized_sink,
    points_in_box,
    read_blocks,
    read_points,
    save_points_by_series,
    series_scan,
    write_blocks,
    write_points,
    write_points_by_place,
)
from tickloom.sources.text import read_lines, write_lines, write_update_stream

Query = Callable[[SparkSession, str], DataFrame]



@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


CATALOGUE: dict[str, Entry] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under the name of its function."""

    def register(run: Query) -> Query:
        CATALOGUE[run.__name__] = Entry(run, sql)
        return run

    return register


# The points of the events table in SQL; ``lk`` is the label text.
P = """
with p as (
  select event_type as class, 'shard=' || (user_id % 4) || ',user=' || user_id as lk,
         event_type || '{shard=' || (user_id % 4) || ',user=' || user_id || '}' as selector,
         user_id, user_id % 4 as shard,
         case when user_id % 3 = 0 then 'gold' else 'std' end as tier,
         epoch_us(ts) as ts,
         case when event_id % 4 in (0, 1) then (event_id % 181 - 90)::double end as lat,
         case when event_id % 4 in (0, 1) then (event_id % 361 - 180)::double end as lon,
         case when event_id % 4 in (0, 2) then event_id % 1000 end as elev,
         value as v_double, event_id
  from events
),
lines as (
  select *,
         ts || '/' || coalesce(lat || ':' || lon, '') || '/' || coalesce(elev::varchar, '') as place,
         row_number() over (
           partition by class, lk
           order by ts, lat nulls first, lon nulls first, elev nulls first, v_double, event_id) as rn
  from p
)
"""

_ID = "('0x' || substr(md5({}), 1, 15))::bigint"
CLASS_ID = _ID.format("class")
LABELS_ID = _ID.format("lk")

DAY = 86_400_000_000
# Ticks used as window and clip bounds, within the first month of 2024.
CLIP_FROM, CLIP_TO = 1_704_326_400_000_000, 1_705_881_600_000_000
NOW, TIMESPAN = 1_705_881_600_000_000, 7 * DAY
SELECTORS = ["~p.+|si.*{shard~[01]+}", "click{tier=gold}"]


def exact_sum(value: Column | str) -> Column:
    """Sum that does not depend on the order of the rows."""
    return F.sum(F.col(value).cast("decimal(20,4)") if isinstance(value, str) else value).cast("double")


def tick_text(points: str = "points") -> Column:
    return F.array_join(F.transform(points, lambda p: p["ts"].cast("string")), ",")


# ---------------------------------------------------------------- sources


@query(
    """
    with n as (select max(event_id) + 1 as c, (max(event_id) + 7) // 7 as step from events)
    select event_id - (event_id // step) * step as seqno, 100 + event_id as value, event_type
    from events, n
    """
)
def range_scan_query(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events").select("event_id", "event_type")
    last = events.agg(F.max("event_id")).first()[0]
    numbers = range_scan(spark, 100, last + 1, splits=7)
    return numbers.join(events, F.col("value") == F.col("event_id") + 100).select(
        "seqno", "value", "event_type"
    )


@query(
    P
    + f"""
    select selector as id, ts, v_double from p
    where ts > {NOW - TIMESPAN} and ts <= {NOW}
      and ((regexp_full_match(class, 'p.*|si.*') and regexp_full_match(shard::varchar, '[01]'))
           or (class = 'click' and tier = 'gold'))
    """
)
def series_scan_query(spark: SparkSession, folder: str) -> DataFrame:
    points = event_points(spark, folder, window=(NOW - TIMESPAN, NOW), selectors=SELECTORS)
    return series_scan(points, *SELECTORS, now=NOW, timespan=TIMESPAN).select("id", "ts", "v_double")


@query(
    P
    + f"""
    select selector as id, ts, v_double from p
    where ts > {NOW - TIMESPAN} and ts <= {NOW} and class in ('click', 'view') and shard = 2
    """
)
def stored_series_scan(spark: SparkSession, folder: str) -> DataFrame:
    path = new_shared_path(spark, "points")
    write_points(event_points(spark, folder), path, bucket_width=DAY)
    points = read_points(spark, path)
    scanned = series_scan(
        points, "~click|view{shard=2}", now=NOW, timespan=TIMESPAN, bucket_width=DAY
    )
    return scanned.select("id", "ts", "v_double")


LABEL_SELECTORS = ["~.*{shard=2,user~1.*}", "click{tier=gold,shard=3}"]


@query(
    P
    + """
    select selector, ts, v_double from p
    where (shard = 2 and starts_with(user_id::varchar, '1')) or (class = 'click' and tier = 'gold' and shard = 3)
    """
)
def series_fetch(spark: SparkSession, folder: str) -> DataFrame:
    path = new_shared_path(spark, "directory")
    write_series(event_points(spark, folder), path)
    points = fetch_series(spark, path, *LABEL_SELECTORS)
    return points.select(selector_text().alias("selector"), "ts", "v_double")


@query(
    P
    + """
    select selector, count(*) as n_points, min(ts) as first_tick, max(ts) as last_tick from p
    where (shard = 2 and starts_with(user_id::varchar, '1')) or (class = 'click' and tier = 'gold' and shard = 3)
    group by selector
    """
)
def series_lookup(spark: SparkSession, folder: str) -> DataFrame:
    path = new_shared_path(spark, "directory")
    write_series(event_points(spark, folder), path)
    found = find_series(spark, path, *LABEL_SELECTORS)
    series = series_directory(spark, path).join(found, "series_id", "left_semi")
    return series.select(selector_text().alias("selector"), "n_points", "first_tick", "last_tick")


@query(
    P
    + """
    select selector, count(*) as n_points, min(ts) as first_tick, max(ts) as last_tick from p group by selector
    """
)
def stored_block_bounds(spark: SparkSession, folder: str) -> DataFrame:
    path = new_shared_path(spark, "blocks")
    write_blocks(pack_points(event_points(spark, folder), max_points=20), path)
    bounds = with_selector(block_bounds(read_blocks(spark, path)))
    return bounds.select("selector", "n_points", "first_tick", "last_tick")


@query(P + "select selector, ts, lat, lon, v_double from p where lat between 10.5 and 40 and (lon >= 100 or lon <= -150.5)")
def points_in_box_query(spark: SparkSession, folder: str) -> DataFrame:
    path = new_shared_path(spark, "places")
    write_points_by_place(event_points(spark, folder), path)
    points = points_in_box(spark, path, 10.5, 40.0, 100.0, -150.5)
    return with_selector(points).select("selector", "ts", "lat", "lon", "v_double")


@query(
    P
    + f"""
    select selector, ts, v_double from p where ts between {CLIP_FROM} and {CLIP_TO}
    """
)
def stored_block_clip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_shared_path(spark, "blocks")
    write_blocks(pack_points(event_points(spark, folder), max_points=20), path)
    points = unpack_points(clip_blocks(read_blocks(spark, path), CLIP_FROM, CLIP_TO))
    return with_selector(points).select("selector", "ts", "v_double")


@query(
    P
    + f"""
    select class as "className",
           'classIdForJoin=' || {CLASS_ID} || ',labelsIdForJoin=' || {LABELS_ID} || ',' || lk as label_text,
           {CLASS_ID} as "classIdForJoin", {LABELS_ID} as "labelsIdForJoin", count(*) as n_header, count(*) as n_stored
    from p group by class, lk
    """
)
def block_load(spark: SparkSession, folder: str) -> DataFrame:
    loaded = load_blocks(pack_points(event_points(spark, folder)), "normal", gen_ids=True)
    return loaded.select(
        "className",
        label_text(F.col("labels")).alias("label_text"),
        "classIdForJoin",
        "labelsIdForJoin",
        F.col("encoded.count").alias("n_header"),
        F.size("encoded.points").cast("bigint").alias("n_stored"),
    )


@query(
    P
    + """
    select class as "className", lk as label_text, count(*) as n_header,
           min(tier) as tier from p group by class, lk
    """
)
def block_load_light(spark: SparkSession, folder: str) -> DataFrame:
    loaded = load_blocks(pack_points(event_points(spark, folder)), "light")
    return loaded.select(
        "className",
        label_text(F.col("labels")).alias("label_text"),
        F.col("encoded.count").alias("n_header"),
        F.col("encoded.attributes")["tier"].alias("tier"),
    )


@query(
    P
    + f"""
    select class as "className", {LABELS_ID} as "labelsIdForJoin",
           floor(ts / {DAY}.0)::bigint::varchar as "chunkId",
           'chunkId=' || floor(ts / {DAY}.0)::bigint || ',classIdForJoin=' || {CLASS_ID}
             || ',labelsIdForJoin=' || {LABELS_ID} || ',' || lk as label_text,
           count(*) as n_header, string_agg(ts::varchar, ',' order by ts) as ticks
    from p where ts between {CLIP_FROM} and {CLIP_TO} group by class, lk, 3, 4
    """
)
def block_load_chunk(spark: SparkSession, folder: str) -> DataFrame:
    loaded = load_blocks(
        pack_points(event_points(spark, folder, clip=(CLIP_FROM, CLIP_TO))),
        "chunk",
        gen_ids=True,
        clip_from=CLIP_FROM,
        clip_to=CLIP_TO,
        chunk_width=DAY,
    )
    return loaded.select(
        "className",
        "labelsIdForJoin",
        "chunkId",
        label_text(F.col("labels")).alias("label_text"),
        F.col("encoded.count").alias("n_header"),
        tick_text("encoded.points").alias("ticks"),
    )


FULL_LINE = "place || ' ' || selector || ' ' || v_double"


@query(P + f"select {FULL_LINE} as line from lines")
def text_source(spark: SparkSession, folder: str) -> DataFrame:
    path = new_shared_path(spark, "lines")
    dump_text(event_points(spark, folder)).select("line").write.text(path)
    return read_lines(spark, path).select("line")


@query(P + "select selector, ts, lat, lon, elev, v_double from p")
def block_binary_source(spark: SparkSession, folder: str) -> DataFrame:
    path = new_shared_path(spark, "blocks")
    write_blocks(pack_points(event_points(spark, folder)), path)
    points = with_selector(unpack_points(read_blocks(spark, path)))
    return points.select("selector", "ts", "lat", "lon", "elev", "v_double")


@query("select event_id as key, value from events")
def kv_source_query(spark: SparkSession, folder: str) -> DataFrame:
    settings = {"format": "csv", "format.stored": "parquet", "mergeSchema.stored": "false"}
    return kv_source(
        spark, f"{folder}/events.parquet", settings, "stored", key="event_id", value="value"
    )


# Texts of fifty documents each, one after the other.
FILES = """
with files as (
  select doc_id // 50 as n, string_agg(text, chr(10) order by doc_id) as content from documents group by 1
)
"""


def write_files(files: DataFrame, path: str) -> None:
    """Write ``content`` under the file name ``name``; a retried task writes the same again."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, folder = fs.FileSystem.from_uri(path)
        system.create_dir(folder, recursive=True)
        for batch in batches:
            for name, content in zip(batch["name"], batch["content"]):
                with system.open_output_stream(f"{folder}/{name}", compression=None) as stream:
                    stream.write(content)
            yield batch[["name"]]

    files.select("name", "content").mapInPandas(write, "name string").write.format("noop").mode(
        "overwrite"
    ).save()


@query(
    FILES
    + """
    select case when f.n % 2 = 0 or g.n is null then 'file' || f.n else md5(g.content) end as key,
           md5(f.content) as digest, strlen(f.content) as n_bytes
    from files f left join files g on g.n = f.n - 1
    """
)
def whole_file_ingest_query(spark: SparkSession, folder: str) -> DataFrame:
    path = new_shared_path(spark, "files")
    number = floor_div(F.col("doc_id"), 50)
    texts = F.array_sort(F.collect_list(F.struct("doc_id", "text")))
    files = (
        read_table(spark, folder, "documents")
        .groupBy(number.alias("n"))
        .agg(F.encode(F.array_join(F.transform(texts, lambda t: t["text"]), "\n"), "UTF-8").alias("content"))
    )
    write_files(files.withColumn("name", F.concat(F.lit("file"), F.col("n").cast("string"))), path)
    numbers = files.select("n")
    before = numbers.select((F.col("n") + 1).alias("n"), F.lit(True).alias("has_before"))
    place = lambda n: F.concat(F.lit(f"{path}/file"), n.cast("string"))
    pair = (F.col("n") % 2 == 1) & F.col("has_before")
    lines = numbers.join(before, "n", "left").select(
        F.when(pair, F.concat(place(F.col("n") - 1), F.lit(" "), place(F.col("n"))))
        .otherwise(place(F.col("n")))
        .alias("line")
    )
    records = in_sequence_file(spark, whole_file_ingest(spark, lines, path))
    name = F.decode("key", "UTF-8")
    return records.select(
        F.when(F.octet_length("key") < 20, name).otherwise(F.md5("key")).alias("key"),
        F.md5("value").alias("digest"),
        F.octet_length("value").cast("bigint").alias("n_bytes"),
    )


def in_sequence_file(spark: SparkSession, records: DataFrame) -> DataFrame:
    """Records written as ``(key bytes, value bytes)`` sequence files and read back."""
    path = new_shared_path(spark, "sequence")
    pairs = records.select(F.col("key").cast("binary"), "value")
    hadoop_sink(pairs, path, SEQUENCE_OUTPUT, BYTES_WRITABLE, BYTES_WRITABLE)
    return hadoop_source(
        spark, path, SEQUENCE_INPUT, BYTES_WRITABLE, BYTES_WRITABLE, "key binary, value binary"
    )


@query(
    """
    select 'docs%20' || doc_id // 50 || '.zip ' || doc_id || '.txt' as key, strlen(text) as n_bytes,
           md5(text) as digest
    from documents
    union all
    select 'docs%20' || doc_id // 50 || '.zip about/' || doc_id, strlen(lang), md5(lang) from documents
    """
)
def archive_entry_ingest(spark: SparkSession, folder: str) -> DataFrame:
    def zipped(batch: pd.DataFrame) -> pd.DataFrame:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("about/", "")
            for doc, text, lang in zip(batch["doc_id"], batch["text"], batch["lang"]):
                archive.writestr(f"{doc}.txt", text)
                archive.writestr(f"about/{doc}", lang)
        return pd.DataFrame({"name": [f"docs {batch['n'].iat[0]}.zip"], "content": [buffer.getvalue()]})

    documents = read_table(spark, folder, "documents").select("doc_id", "text", "lang")
    archives = (
        documents.withColumn("n", floor_div(F.col("doc_id"), 50))
        .groupBy("n")
        .applyInPandas(zipped, "name string, content binary")
    )
    path = new_shared_path(spark, "archives")
    write_files(archives, path)
    records = in_sequence_file(spark, read_archive_entries(spark, path, split_bytes=1 << 16))
    return records.select(
        F.decode("key", "UTF-8").alias("key"),
        F.octet_length("value").cast("bigint").alias("n_bytes"),
        F.md5("value").alias("digest"),
    )


# ------------------------------------------- text, blocks and functions


@query(P + "select class, lk as label_key, ts, lat, lon, elev, v_double from p")
def parse_text(spark: SparkSession, folder: str) -> DataFrame:
    parsed = strict_points(parse_lines(dump_text(event_points(spark, folder))))
    return with_series_key(parsed).select("class", "label_key", "ts", "lat", "lon", "elev", "v_double")


@query(P + f"select {FULL_LINE} as line from lines")
def dump_text_query(spark: SparkSession, folder: str) -> DataFrame:
    return dump_text(event_points(spark, folder)).select("line")


HEADED_LINE = f"case when rn = 1 then {FULL_LINE} else '=' || place || ' ' || v_double end"


@query(P + f"select class, lk as label_key, rn as place, {HEADED_LINE} as line from lines")
def dump_text_optimized(spark: SparkSession, folder: str) -> DataFrame:
    lines = dump_text(event_points(spark, folder), optimize=True)
    return lines_in_place(lines, *SERIES_KEY)


def lines_in_place(lines: DataFrame, *columns: str) -> DataFrame:
    """Lines with their place in their series, as they follow each other in the partitions."""
    at = lines.withColumn("_at", F.monotonically_increasing_id())
    place = F.row_number().over(Window.partitionBy(*SERIES_KEY).orderBy("_at"))
    return at.select(*columns, place.cast("bigint").alias("place"), "line")


@query(P + f"select class, lk as label_key, rn as place, {HEADED_LINE} as line from lines")
def convert_text(spark: SparkSession, folder: str) -> DataFrame:
    merged = merge_text(dump_text(event_points(spark, folder)).select("line"))
    return lines_in_place(merged, *SERIES_KEY)


@query(P + "select class, lk as label_key, rn as place, ts, lat, lon, elev, v_double from lines")
def dump_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = new_shared_path(spark, "lines")
    write_lines(dump_text(event_points(spark, folder), optimize=True), path)
    points = with_series_key(strict_points(parse_stream(read_lines(spark, path))))
    ranked = with_rank(points, SERIES_KEY, [F.col("ts"), *map(F.col, POINT_ORDER)], name="place")
    return ranked.select(*SERIES_KEY, "place", "ts", "lat", "lon", "elev", "v_double")


@query(
    P
    + """
    select selector, count(*) as n_points, string_agg(ts::varchar, ',' order by ts) as ticks
    from p group by selector
    """
)
def pack_points_query(spark: SparkSession, folder: str) -> DataFrame:
    packed = with_selector(pack_points(event_points(spark, folder)))
    return packed.select("selector", F.col("count").alias("n_points"), tick_text().alias("ticks"))


@query(
    P
    + """
    select selector, (rn - 1) // 5 as block_no, count(*) as n_points,
           string_agg(ts::varchar, ',' order by ts) as ticks
    from lines group by 1, 2
    """
)
def pack_points_bounded(spark: SparkSession, folder: str) -> DataFrame:
    packed = with_selector(pack_points(event_points(spark, folder), max_points=5))
    return packed.select(
        "selector", "block_no", F.col("count").alias("n_points"), tick_text().alias("ticks")
    )


FORM = """case when lat is null and elev is null then 2 when lat is null then 3
                when elev is null then 4 else 5 end"""


@query(
    P
    + f"""
    select selector, {FORM} as form, count(*) as n_points, count(lat) as n_located,
           count(elev) as n_raised, string_agg(ts::varchar, ',' order by ts) as ticks
    from p group by 1, 2
    """
)
def pack_points_elevation(spark: SparkSession, folder: str) -> DataFrame:
    forms = {
        2: ("ts", "v_double"),
        3: ("ts", "elev", "v_double"),
        4: ("ts", "lat", "lon", "v_double"),
        5: ("ts", "lat", "lon", "elev", "v_double"),
    }
    rows = event_points(spark, folder).withColumn("form", arity())
    read = [
        to_points(
            rows.where(F.col("form") == size),
            class_=F.col("class"),
            labels={name: F.col("labels")[name] for name in ("user", "shard")},
            **point_of(*columns),
            keep=["form"],
        )
        for size, columns in forms.items()
    ]
    packed = with_selector(pack_points(reduce(DataFrame.unionByName, read), by=["form"]))
    some = lambda field: F.size(F.filter("points", lambda p: p[field].isNotNull())).cast("bigint")
    return packed.select(
        "selector",
        "form",
        F.col("count").alias("n_points"),
        some("lat").alias("n_located"),
        some("elev").alias("n_raised"),
        tick_text().alias("ticks"),
    )


@query(
    P
    + """
    select selector, ts, lat, lon, elev, v_double,
           case when lat is null and elev is null then 2 when lat is null then 3
                when elev is null then 4 else 5 end as arity
    from p
    """
)
def unpack_points_query(spark: SparkSession, folder: str) -> DataFrame:
    points = with_selector(unpack_points(pack_points(event_points(spark, folder), max_points=50)))
    return points.select("selector", "ts", "lat", "lon", "elev", "v_double", "arity")


@query(
    P
    + """
    select class, lk as label_text, 'tier=' || min(tier) as attribute_text, 0 as base,
           0 as bucketcount, 0 as bucketspan, 0 as lastbucket, count(*) as n_points
    from p group by class, lk
    """
)
def block_metadata_query(spark: SparkSession, folder: str) -> DataFrame:
    metadata = block_metadata(pack_points(event_points(spark, folder)))
    return metadata.select(
        "class",
        label_text(F.col("labels")).alias("label_text"),
        label_text(F.col("attributes")).alias("attribute_text"),
        "base",
        "bucketcount",
        "bucketspan",
        "lastbucket",
        F.col("count").alias("n_points"),
    )


@query(
    """
    select event_id, case when event_id % 5 = 0 then '' else event_type end as class,
           case when event_id % 3 = 0 then '' else 'user=' || user_id end as label_text,
           '' as attribute_text
    from events
    """
)
def metadata_of_map_query(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    rows = events.select(
        "event_id",
        F.struct(
            F.when(F.col("event_id") % 5 != 0, F.col("event_type")).alias("class"),
            F.when(
                F.col("event_id") % 3 != 0,
                F.create_map(F.lit("user"), F.col("user_id").cast("string")),
            ).alias("labels"),
            F.lit(None).cast("map<string,string>").alias("attributes"),
        ).alias("metadata"),
    )
    metadata = rows.select("event_id", *[c.alias(n) for n, c in metadata_of_map(F.col("metadata")).items()])
    return metadata.select(
        "event_id",
        "class",
        label_text(F.col("labels")).alias("label_text"),
        label_text(F.col("attributes")).alias("attribute_text"),
    )


@query(P + f"select distinct selector, {CLASS_ID} as class_id, {LABELS_ID} as labels_id from p")
def series_ids(spark: SparkSession, folder: str) -> DataFrame:
    series = event_points(spark, folder).select(*SERIES_KEY).distinct()
    return with_selector(with_series_ids(series)).select("selector", "class_id", "labels_id")


def _sip_sum(a: str, b: str) -> str:
    return f"(({a}::hugeint + {b}::hugeint) % {1 << 64})::ubigint"


def _sip_turn(a: str, bits: int) -> str:
    return f"(({a}::hugeint * {1 << bits}) % {1 << 64})::ubigint | ({a} >> {64 - bits})"


def _keyed_ids_sql(key: bytes) -> str:
    """Ids of class and labels under a key: a step of the recursion is a round over all texts at once."""
    low, high = (int.from_bytes(key[i : i + 8], "little") for i in (0, 8))
    start = [int.from_bytes(text, "big") for text in (b"somepseu", b"dorandom", b"lygenera", b"tedbytes")]
    v = [f"{word ^ (high if i % 2 else low)}::ubigint as v{i}" for i, word in enumerate(start)]
    digits = "h || repeat('00', (7 - n % 8)::int) || lpad(to_hex(n % 256), 2, '0')"
    pairs = " || ".join(f"substr(d, (w * 16 + {2 * i + 1})::int, 2)" for i in reversed(range(8)))
    return f"""
    , texts as (select class as text from p union select lk from p),
    bytes as (select text, hex(encode(text)) as h, octet_length(encode(text)) as n from texts),
    padded as (select text, n // 8 + 1 as n_words, {digits} as d from bytes),
    split as (select text, d, n_words, unnest(range(n_words)) as w from padded),
    words as (select text, w, ('0x' || {pairs})::ubigint as m from split),
    state as (
      select text, n_words, 0::bigint as step, {", ".join(v)} from padded
      union all
      select text, n_words, step + 1, xor(a, after) as v0, v1, {_sip_turn("c", 32)} as v2, v3 from (
        select text, n_words, step, after, a, c, xor({_sip_turn("v3", 21)}, a) as v3,
               xor({_sip_turn("v1", 17)}, c) as v1 from (
          select text, n_words, step, after, v1, v3, {_sip_sum("v0", "v3")} as a, {_sip_sum("v2", "v1")} as c from (
            select text, n_words, step, after, {_sip_turn("a", 32)} as v0, c as v2,
                   xor({_sip_turn("v1", 13)}, a) as v1, xor({_sip_turn("v3", 16)}, c) as v3 from (
              select *, {_sip_sum("v0", "v1")} as a, {_sip_sum("v2", "v3")} as c from (
                select s.text, n_words, step, v0, v1,
                       case when step = 2 * n_words then xor(v2, 255::ubigint) else v2 end as v2,
                       case when step % 2 = 0 then xor(v3, coalesce(m, 0::ubigint)) else v3 end as v3,
                       case when step % 2 = 1 then coalesce(m, 0::ubigint) else 0::ubigint end as after
                from state s left join words w on w.text = s.text and w.w = step // 2
                where step < 2 * n_words + 4)))))
    ),
    ids as (
      select text, xor(xor(v0, v1), xor(v2, v3))::hugeint as id from state where step = 2 * n_words + 4
    ),
    signed as (select text, (case when id >= {1 << 63} then id - {1 << 64} else id end)::bigint as id from ids)
    select distinct selector, c.id as class_id, l.id as labels_id
    from p join signed c on c.text = p.class join signed l on l.text = p.lk
    """


#: For the queries only; a real key is kept secret.
SAMPLE_KEY = bytes(range(16))


@query(P.replace("with", "with recursive", 1) + _keyed_ids_sql(SAMPLE_KEY))
def keyed_series_ids(spark: SparkSession, folder: str) -> DataFrame:
    series = event_points(spark, folder).select(*SERIES_KEY).distinct()
    return with_selector(with_series_ids(series, SAMPLE_KEY)).select("selector", "class_id", "labels_id")


@query(P + "select event_id, selector from p")
def series_selector(spark: SparkSession, folder: str) -> DataFrame:
    return event_points(spark, folder).select("event_id", selector_text().alias("selector"))


@query(
    """
    select event_id, event_type || ':' || value as by_text,
           '[' || user_id || ',' || event_id || ']' as bag_text,
           event_id::varchar || '|' || event_type as tuple_text, user_id || ' days' as other
    from events
    """
)
def to_portable_query(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events").select(
        "event_id",
        F.create_map(F.col("event_id"), F.create_map("event_type", "value")).alias("nested"),
        F.array("user_id", "event_id").alias("numbers"),
        F.struct("event_id", "event_type").alias("pair"),
        F.make_dt_interval(F.col("user_id").cast("int")).alias("span"),
    )
    portable = columns_to_portable(events, "nested", "numbers", "pair", "span")
    inner = F.col("nested")[F.col("event_id").cast("string")]
    first = F.map_entries(inner)[0]
    return portable.select(
        "event_id",
        F.concat(first["key"], F.lit(":"), first["value"].cast("string")).alias("by_text"),
        F.concat(
            F.lit("["), F.array_join(F.transform("numbers", lambda e: e["x"].cast("string")), ","), F.lit("]")
        ).alias("bag_text"),
        F.concat(F.col("pair.event_id").cast("string"), F.lit("|"), F.col("pair.event_type")).alias("tuple_text"),
        F.regexp_replace(
            F.regexp_extract("span", r"(\d+) 00:00:00", 1), r"$", " days"
        ).alias("other"),
    )


@query(
    """
    select event_id, event_id || ',' || user_id as bag_text, event_id + user_id as list_sum,
           2 + event_id % 2 as n_inner
    from events
    """
)
def from_portable_query(spark: SparkSession, folder: str) -> DataFrame:
    one = lambda name: F.struct(F.col(name).alias("x"))
    events = read_table(spark, folder, "events").select(
        "event_id",
        F.array(one("event_id"), one("user_id")).alias("bag"),
        F.struct("event_id", "user_id").alias("pair"),
        F.create_map(
            F.lit("k"),
            F.when(F.col("event_id") % 2 == 0, F.array(one("event_id"), one("user_id"))).otherwise(
                F.array(one("event_id"), one("user_id"), one("event_id"))
            ),
        ).alias("by_name"),
    )
    script = columns_from_portable(events, "bag", "pair", "by_name")
    return script.select(
        "event_id",
        F.array_join(F.transform("bag", lambda e: e.cast("string")), ",").alias("bag_text"),
        F.aggregate("pair", F.lit(0).cast("bigint"), lambda a, e: a + e).alias("list_sum"),
        F.size(F.filter(F.col("by_name")["k"], lambda e: e.isNotNull())).alias("n_inner"),
    )


@query(
    """
    select event_id, event_type || ',' || user_id as bag_text, event_id + user_id as total,
           event_type || user_id as joined
    from events
    """
)
def bag_build(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events").withColumn("bag", new_bag(T.StringType()))
    events = events.withColumn("bag", add(events, "bag", "event_type"))
    row = F.struct(F.col("user_id").cast("string").alias("x"))
    events = events.withColumn("bag", add(events, "bag", row))
    return events.select(
        "event_id",
        F.array_join(F.transform("bag", lambda e: e["x"]), ",").alias("bag_text"),
        add(events, "event_id", "user_id").alias("total"),
        add(events, "event_type", "user_id").alias("joined"),
    )


@query("select event_id, event_type as e0, user_id as e1, value as e2 from events")
def stack_to_struct_query(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events")
    stack = stack_to_struct(F.col("event_type"), F.col("user_id"), F.col("value"))
    return flatten_struct(events.select("event_id", stack.alias("stack")), "stack")


@query(
    """
    select event_id, case when event_id % 4 < 3 then (event_id % 4)::int end as level,
           case event_id % 4 when 0 then event_type when 1 then user_id::varchar when 2 then props end as obj
    from events
    """
)
def stack_get_query(spark: SparkSession, folder: str) -> DataFrame:
    stack = levelled_stack(F.col("event_type"), F.col("user_id"), F.col("props"))
    events = read_table(spark, folder, "events").withColumn("stack", stack)
    found = stack_get(F.col("stack"), (F.col("event_id") % 4).cast("int"))
    return events.select("event_id", found["level"].alias("level"), found["obj"].alias("obj"))


@query(
    f"""
    with e as (
      select event_id, unnest([0, 0, 1]) as level,
             unnest([event_type, user_id::varchar, event_type]) as obj
      from events
    )
    select event_id, string_agg(level || ':' || obj, ',' order by level, {_ID.format('obj')}) as ordered
    from e group by event_id
    """
)
def stack_order_query(spark: SparkSession, folder: str) -> DataFrame:
    def item(level: int, obj: Column) -> Column:
        return F.struct(F.lit(level).alias("level"), obj.cast("string").alias("obj"))

    stack = F.array(item(1, F.col("event_type")), item(0, F.col("user_id")), item(0, F.col("event_type")))
    ordered = F.transform(
        stack_order(stack), lambda e: F.concat(e["level"].cast("string"), F.lit(":"), e["obj"])
    )
    events = read_table(spark, folder, "events")
    return events.select("event_id", F.array_join(ordered, ",").alias("ordered"))


@query(
    """
    select event_id, floor(epoch_us(ts) / 1000.0)::bigint as in_ms, epoch_us(ts) * 1000 as in_ns,
           floor((epoch_us(ts) - 1705000000000000) / 1000.0)::bigint as signed_ms,
           floor(epoch_us(ts) / 1000.0)::bigint as again_ms
    from events
    """
)
def time_unit_convert(spark: SparkSession, folder: str) -> DataFrame:
    ticks = ticks_of_local_timestamp(F.col("ts"))
    signed = ticks - F.lit(1_705_000_000_000_000)
    return read_table(spark, folder, "events").select(
        "event_id",
        convert_ticks(ticks, "us", "ms").alias("in_ms"),
        convert_ticks(ticks, "us", "ns").alias("in_ns"),
        convert_ticks(signed, "us", "ms").alias("signed_ms"),
        ticks_of_timestamp(timestamp_of_ticks(ticks), "ms").alias("again_ms"),
    )


@query(
    """
    with n as (select (max(event_id) + 2) // 2 as step from events)
    select '[TOP OUT] ' || event_type as e0, event_id || ' [2 IN]' as e1,
           (event_id - (event_id // step) * step) || ' [TOP IN]' as e2
    from events, n
    """
)
def row_string_expr(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events").select("event_id", "event_type")
    last = events.agg(F.max("event_id")).first()[0]
    numbers = range_scan(spark, 0, last + 1, splits=2).join(events, F.col("value") == F.col("event_id"))
    script = [
        "concat('[TOP OUT] ', event_type)",
        "concat(cast(value as string), ' [2 IN]')",
        "concat(cast(seqno as string), ' [TOP IN]')",
    ]
    return apply_exprs(numbers, script).select("stack.*")


# ---------------------------------------------------- selection, projection


@query(
    P
    + """
    select event_id, selector from p
    where (regexp_full_match(class, 'p.*|si.*') and regexp_full_match(shard::varchar, '[01]'))
       or (class = 'click' and tier = 'gold')
    """
)
def select_series_query(spark: SparkSession, folder: str) -> DataFrame:
    chosen = select_series(event_points(spark, folder, selectors=SELECTORS), *SELECTORS)
    return with_selector(chosen).select("event_id", "selector")


@query(P + "select event_id, selector, v_double from p where class = 'click'")
def filter_by_name(spark: SparkSession, folder: str) -> DataFrame:
    chosen = filter_by_metadata(event_points(spark, folder, name="click"), "name", "click")
    return with_selector(chosen).select("event_id", "selector", "v_double")


@query(
    P
    + f"""
    select selector, count(*) filter (ts <= {CLIP_FROM}) = 0 as is_empty,
           count(*) filter (ts <= {CLIP_FROM}) as n_points
    from p group by selector
    """
)
def is_series_empty(spark: SparkSession, folder: str) -> DataFrame:
    blocks = pack_points(event_points(spark, folder)).withColumns(
        {
            "count": F.lit(0).cast("bigint"),
            "points": F.filter("points", lambda p: p["ts"] <= CLIP_FROM),
        }
    )
    per_block = with_selector(blocks).select(
        "selector", is_block_empty().alias("is_empty"), block_count().alias("n_points")
    )
    return per_block.groupBy("selector").agg(
        F.bool_and("is_empty").alias("is_empty"), F.sum("n_points").alias("n_points")
    )


@query(P + "select class as name, ts as tick, v_double * 2 as doubled from p")
def project(spark: SparkSession, folder: str) -> DataFrame:
    return event_points(spark, folder).select(
        F.col("class").alias("name"), F.col("ts").alias("tick"), (F.col("v_double") * 2).alias("doubled")
    )


@query(
    """
    select event_id, unnest([event_type, user_id::varchar]) as obj, unnest([0, 1]) as level,
           value as e0
    from events
    """
)
def flatten(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events").select(
        "event_id",
        levelled_stack(F.col("event_type"), F.col("user_id")).alias("bag"),
        stack_to_struct(F.col("value")).alias("tuple"),
    )
    return flatten_bag(flatten_struct(events, "tuple"), "bag")


# ---------------------------------------------------------- aggregates


@query(P + "select selector, count(*) as n_points from p group by selector")
def series_count_query(spark: SparkSession, folder: str) -> DataFrame:
    return with_selector(series_count(event_points(spark, folder))).select("selector", "n_points")


@query(
    P
    + f"""
    select selector, {CLASS_ID} as class_id, {LABELS_ID} as labels_id,
           min(ts) as first_tick, max(ts) as last_tick
    from p group by selector, class, lk
    """
)
def series_bounds_query(spark: SparkSession, folder: str) -> DataFrame:
    bounds = with_selector(series_bounds(event_points(spark, folder)))
    return bounds.select("selector", "class_id", "labels_id", "first_tick", "last_tick")


@query(
    P
    + """
    select selector, count(*) as n_points, arg_min('half=' || (event_id % 2), ts) as attribute_text,
           string_agg(ts::varchar, ',' order by ts) as ticks
    from p group by selector
    """
)
def merge_series_query(spark: SparkSession, folder: str) -> DataFrame:
    points = event_points(spark, folder)
    halves = []
    for half in (0, 1):
        rows = points.where(F.col("event_id") % 2 == half).withColumn(
            "attributes", F.create_map(F.lit("half"), F.lit(str(half)))
        )
        halves.append(pack_points(rows, max_points=3))
    path = new_shared_path(spark, "blocks")
    write_blocks(halves[0].unionByName(halves[1]), path)
    merged = with_selector(merge_series(read_blocks(spark, path)))
    return merged.select(
        "selector",
        F.col("count").alias("n_points"),
        label_text(F.col("attributes")).alias("attribute_text"),
        tick_text().alias("ticks"),
    )


@query(
    P
    + """
    , b as (select class, selector, min(ts) as f, max(ts) as l from p group by class, selector)
    select (select selector from b order by f, class, selector limit 1) as first_series,
           (select f from b order by f, class, selector limit 1) as first_tick,
           (select selector from b order by l desc, class, selector limit 1) as last_series,
           (select l from b order by l desc, class, selector limit 1) as last_tick
    """
)
def group_all_window(spark: SparkSession, folder: str) -> DataFrame:
    window = window_of_all(series_bounds(event_points(spark, folder)))
    return window.select(
        F.col("first_series.selector").alias("first_series"),
        "first_tick",
        F.col("last_series.selector").alias("last_series"),
        "last_tick",
    )


@query(
    """
    with sizes as (select user_id, count(*) as n, sum(event_id)::bigint as total from events group by 1)
    select user_id, part, least(20, n - part * 20) as n_rows, total as id_sum
    from sizes, unnest(range((n + 19) // 20)) as parts(part)
    """
)
def group_by_key(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events").select("user_id", "event_id", "value")
    bags = bag_by_key(events, ["user_id"], rows_per_bag=20)
    total = F.sum("id_sum").over(Window.partitionBy("user_id"))
    return bags.select("user_id", "part", *bag_sums("bag", "n_rows", "id_sum")).withColumn("id_sum", total)


def bag_sums(bag: str, size: str, total: str) -> list[Column]:
    zero = F.lit(0).cast("bigint")
    return [
        F.size(bag).cast("bigint").alias(size),
        F.aggregate(bag, zero, lambda a, e: a + e["event_id"]).alias(total),
    ]


@query(P + "select class, lk as label_key, count(*) as emitted from p group by class, lk")
def emitted_count_query(spark: SparkSession, folder: str) -> DataFrame:
    return emitted_count(event_points(spark, folder))


# --------------------------------------------------------------- joins


@query(
    P
    + f"""
    , b as (
      select class, selector, {CLASS_ID} as class_id, {LABELS_ID} as labels_id,
             min(ts) as f, max(ts) as l
      from p group by class, lk, selector),
    mn as (select class_id, labels_id, selector, f from b order by f, class, selector limit 1),
    mx as (select class_id, labels_id, selector, l from b order by l desc, class, selector limit 1)
    select class_id, labels_id, selector, f as first_tick, l as last_tick
    from mn full join mx using (class_id, labels_id, selector)
    """
)
def bounds_cogroup_query(spark: SparkSession, folder: str) -> DataFrame:
    return time_window(event_points(spark, folder))


@query(
    """
    with a as (select user_id as k, count(*) as n, sum(event_id)::bigint as s from events group by 1),
    b as (select o_custkey as k, count(*) as n, sum(o_orderkey)::bigint as s from orders group by 1),
    j as (select k, coalesce(a.n, 0) as na, coalesce(a.s, 0) as sa, coalesce(b.n, 0) as nb,
                 coalesce(b.s, 0) as sb
          from a full join b using (k))
    select k as key, part, greatest(0, least(10, na - part * 10)) as n_left, sa as left_sum,
           greatest(0, least(10, nb - part * 10)) as n_right, sb as right_sum
    from j, unnest(range((greatest(na, nb) + 9) // 10)) as parts(part)
    """
)
def cogroup_bags_query(spark: SparkSession, folder: str) -> DataFrame:
    events = read_table(spark, folder, "events").select(F.col("user_id").alias("key"), "event_id")
    orders = read_table(spark, folder, "orders").select(
        F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("event_id")
    )
    bags = cogroup_bags(events, orders, ["key"], rows_per_bag=10)
    of_key = Window.partitionBy("key")
    return bags.select(
        "key",
        "part",
        *bag_sums("left_bag", "n_left", "left_sum"),
        *bag_sums("right_bag", "n_right", "right_sum"),
    ).withColumns({name: F.sum(name).over(of_key) for name in ("left_sum", "right_sum")})


SHARD_ID = _ID.format("'shard=' || shard")


@query(
    P
    + f"""
    select {SHARD_ID} as group_id, count(*) as n_points, min(ts) as first_tick, max(ts) as last_tick,
           sum(v_double::decimal(20,4))::double as total
    from p group by 1
    """
)
def partition_join_query(spark: SparkSession, folder: str) -> DataFrame:
    points = event_points(spark, folder)
    return reduce_by_group(
        points,
        group_assignment(points, ["shard"]),
        partial={
            "n": F.count(F.lit(1)),
            "first": F.min("ts"),
            "last": F.max("ts"),
            "v": F.sum(F.col("v_double").cast("decimal(20,4)")),
        },
        final={
            "n_points": F.sum("n"),
            "first_tick": F.min("first"),
            "last_tick": F.max("last"),
            "total": F.sum("v").cast("double"),
        },
    )


@query(P + f"select event_id, selector, {SHARD_ID} as group_id from p")
def partition_join_points(spark: SparkSession, folder: str) -> DataFrame:
    points = event_points(spark, folder)
    joined = partition_join(points, group_assignment(points, ["shard"]))
    return with_selector(joined).select("event_id", "selector", "group_id")


@query(P + f"select selector, ts, v_double, {SHARD_ID} as group_id from p")
def partition_join_stored(spark: SparkSession, folder: str) -> DataFrame:
    path = new_shared_path(spark, "points")
    table = f"points_{path[-32:]}"
    save_points_by_series(event_points(spark, folder), table, path, buckets=16)
    points = spark.table(table)
    light = load_blocks(pack_points(event_points(spark, folder)), "light")
    series = light.select(F.col("className").alias("class"), "labels")
    joined = partition_join(points, group_assignment(series, ["shard"]))
    return joined.select(selector_text().alias("selector"), "ts", "v_double", "group_id")


# ------------------------------------------------ order, chunks and sinks


@query(
    P
    + """
    select selector, ts, v_double,
           row_number() over (partition by selector order by ts desc, event_id) as place
    from p
    """
)
def sort_points(spark: SparkSession, folder: str) -> DataFrame:
    ranked = with_rank(
        event_points(spark, folder),
        SERIES_KEY,
        [F.col("ts").desc(), *map(F.col, POINT_ORDER)],
        name="place",
    )
    return with_selector(ranked).select("selector", "ts", "v_double", "place")


@query(
    P
    + """
    , b as (select class, selector, max(ts) as last_tick from p group by class, selector)
    select class, selector, last_tick from b
    qualify row_number() over (partition by class order by last_tick desc, selector desc) = 1
    """
)
def top_one_query(spark: SparkSession, folder: str) -> DataFrame:
    bounds = with_selector(series_bounds(event_points(spark, folder)))
    latest = top_one(
        bounds.select("class", "selector", "last_tick"),
        ["class"],
        ["last_tick", "selector"],
        descending=True,
    )
    return latest.select("class", "selector", "last_tick")


@query(
    P
    + f"""
    select selector, floor(ts / {DAY}.0)::bigint::varchar as chunk, count(*) as n_points,
           min(ts) as first_tick, max(ts) as last_tick
    from p where ts between {CLIP_FROM} and {CLIP_TO} group by 1, 2
    """
)
def time_chunk_query(spark: SparkSession, folder: str) -> DataFrame:
    chunks = time_chunk(event_points(spark, folder, clip=(CLIP_FROM, CLIP_TO)), CLIP_FROM, CLIP_TO, DAY)
    counted = chunks.groupBy("class", "base_key", "chunk_id").agg(
        F.count(F.lit(1)).alias("n_points"),
        F.min("ts").alias("first_tick"),
        F.max("ts").alias("last_tick"),
    )
    return counted.select(
        selector_text("class", "base_key").alias("selector"),
        F.col("chunk_id").cast("string").alias("chunk"),
        "n_points",
        "first_tick",
        "last_tick",
    )


@query(
    P
    + f"""
    select selector, count(*) as n_points, min(ts) as first_tick, max(ts) as last_tick
    from p where ts between {CLIP_FROM} and {CLIP_TO} group by 1
    """
)
def chunk_fuse_query(spark: SparkSession, folder: str) -> DataFrame:
    chunks = time_chunk(event_points(spark, folder, clip=(CLIP_FROM, CLIP_TO)), CLIP_FROM, CLIP_TO, DAY)
    fused = with_series_key(chunk_fuse(chunks))
    counted = fused.groupBy(*SERIES_KEY).agg(
        F.count(F.lit(1)).alias("n_points"),
        F.min("ts").alias("first_tick"),
        F.max("ts").alias("last_tick"),
    )
    return with_selector(counted).select("selector", "n_points", "first_tick", "last_tick")


def line_bytes(spark: SparkSession, folder: str) -> DataFrame:
    lines = dump_text(event_points(spark, folder))
    return lines.select(F.encode("line", "UTF-8").alias("value"))


@query(P + f"select {FULL_LINE} as line from lines")
def bytes_sink_query(spark: SparkSession, folder: str) -> DataFrame:
    path = new_shared_path(spark, "bytes")
    bytes_sink(line_bytes(spark, folder), path)
    return spark.read.parquet(path).select(F.decode("value", "UTF-8").alias("line"))


@query(P + f"select {FULL_LINE} as line from lines")
def sequence_file_sink_query(spark: SparkSession, folder: str) -> DataFrame:
    path = new_shared_path(spark, "sequence")
    sequence_file_sink(line_bytes(spark, folder), path)
    return sequence_file_source(spark, path).select(F.decode("value", "UTF-8").alias("line"))


@query(
    P
    + f"""
    select {FULL_LINE} as line from lines
    where ts > {NOW - TIMESPAN} and ts <= {NOW} and class = 'view'
    """
)
def scan_to_sequence_files_query(spark: SparkSession, folder: str) -> DataFrame:
    path = new_shared_path(spark, "sequence")
    points = event_points(spark, folder, window=(NOW - TIMESPAN, NOW))
    scan_to_sequence_files(points, path, "view{}", now=NOW, timespan=TIMESPAN)
    return sequence_file_source(spark, path).select(F.decode("value", "UTF-8").alias("line"))


@query(
    P
    + """
    select selector, count(*) as n_points, min(ts) as first_tick,
           sum(v_double::decimal(20,4))::double as total
    from p group by selector
    """
)
def normalize_mixed_query(spark: SparkSession, folder: str) -> DataFrame:
    points = event_points(spark, folder)
    kind = F.col("event_id") % 4
    lines = dump_text(points.where(kind < 2)).select(
        F.when(F.length("line") % 2 == 0, F.col("line")).alias("line"),
        F.when(F.length("line") % 2 == 1, F.array("line", F.lit(None))).alias("lines"),
    )
    block = F.struct("class", "labels", "attributes", "count", "points")
    single = pack_points(points.where(kind == 2)).select(block.alias("block"))
    listed = pack_points(points.where(kind == 3)).select(F.array(block).alias("blocks"))
    mixed = lines.unionByName(single, allowMissingColumns=True).unionByName(
        listed, allowMissingColumns=True
    )
    path = new_shared_path(spark, "blocks")
    normalized_sink(mixed.select(F.struct(*MIXED_KINDS).alias("item")), path)
    stored = with_selector(read_blocks(spark, path))
    return stored.groupBy("selector").agg(
        F.sum("count").alias("n_points"),
        F.min(F.array_min("points.ts")).alias("first_tick"),
        exact_sum(
            F.aggregate(
                "points.v_double",
                F.lit(0).cast("decimal(38,4)"),
                lambda a, v: (a + v.cast("decimal(20,4)")).cast("decimal(38,4)"),
            )
        ).alias("total"),
    )


@query("select event_id as key, props as value from events")
def kv_sink_query(spark: SparkSession, folder: str) -> DataFrame:
    path = new_shared_path(spark, "pairs")
    pairs = read_table(spark, folder, "events").select("event_id", "props")
    settings = {"format": "parquet", "format.text": "json", "compression.text": "gzip"}
    kv_sink(pairs, path, settings, "text")
    return kv_source(spark, path, settings, "text", schema="key bigint, value string")


@query("select event_id::varchar as key, props as value from events")
def hadoop_kv(spark: SparkSession, folder: str) -> DataFrame:
    path = new_shared_path(spark, "pairs")
    pairs = read_table(spark, folder, "events").select(F.col("event_id").cast("string"), "props")
    hadoop_sink(pairs, path, SEQUENCE_OUTPUT, TEXT_WRITABLE, TEXT_WRITABLE)
    return hadoop_source(
        spark, path, SEQUENCE_INPUT, TEXT_WRITABLE, TEXT_WRITABLE, "key string, value string"
    )


@query(
    P
    + """
    select selector, count(*) as n_points, min(ts) as first_tick, max(ts) as last_tick,
           sum(v_double::decimal(20,4))::double as total
    from p group by selector
    """
)
def update_stream_query(spark: SparkSession, folder: str) -> DataFrame:
    path = new_shared_path(spark, "stream")
    points = event_points(spark, folder)
    ready = dump_text(points.where(F.col("event_id") % 3 == 0)).select("line")
    write_update_stream(points.where(F.col("event_id") % 3 != 0), path, ready, run_lines=7)
    points = with_series_key(strict_points(parse_stream(read_lines(spark, path))))
    counted = points.groupBy(*SERIES_KEY).agg(
        F.count(F.lit(1)).alias("n_points"),
        F.min("ts").alias("first_tick"),
        F.max("ts").alias("last_tick"),
        exact_sum("v_double").alias("total"),
    )
    return with_selector(counted).select("selector", "n_points", "first_tick", "last_tick", "total")


@query(
    P
    + """
    select class, lk as label_key, count(*) as emitted from p where event_id % 3 <> 0 group by class, lk
    union all select null, null, count(*) from p where event_id % 3 = 0
    """
)
def push_points_query(spark: SparkSession, folder: str) -> DataFrame:
    points = event_points(spark, folder)
    ready = dump_text(points.where(F.col("event_id") % 3 == 0)).select("line")
    return push_points(
        points.where(F.col("event_id") % 3 != 0), new_shared_path(spark, "stream"), ready
    )


@query(
    P
    + """
    select selector, (rn - 1) // 10 as block_no, count(*) as n_header,
           string_agg(ts::varchar, ',' order by ts) as ticks
    from lines group by 1, 2
    """
)
def key_value_split(spark: SparkSession, folder: str) -> DataFrame:
    keys, payloads = split_key_value(pack_points(event_points(spark, folder), max_points=10))
    whole = with_selector(join_key_value(keys, payloads))
    return whole.select("selector", "block_no", F.col("count").alias("n_header"), tick_text().alias("ticks"))


# -------------------------------------------------------- user functions


@query(
    """
    select event_id, upper(event_type) || '-' || user_id as e0, value * 2 + 1 as e1,
           event_id % 7 = 0 as e2
    from events
    """
)
def apply_exprs_query(spark: SparkSession, folder: str) -> DataFrame:
    script = """
        concat(upper(event_type), '-', user_id)
        value * 2 + 1
        event_id % 7 = 0
    """
    run = apply_exprs(read_table(spark, folder, "events"), script)
    return run.select("event_id", "stack.*")


@query(
    """
    select event_id, 'u' || user_id || '.' || event_type as path,
           (ascii(event_type) + user_id) % 256 as check_byte
    from events
    """
)
def map_rows_query(spark: SparkSession, folder: str) -> DataFrame:
    def packed(batch: pd.DataFrame, separator: str, size: int) -> pd.DataFrame:
        """What a foreign library would do to a batch."""
        return pd.DataFrame(
            {
                "event_id": batch["event_id"],
                "path": "u" + batch["user_id"].astype(str) + separator + batch["event_type"],
                "check_byte": (batch["event_type"].str.encode("utf-8").str[0] + batch["user_id"]) % size,
            }
        )

    events = read_table(spark, folder, "events").select("event_id", "user_id", "event_type")
    return map_rows(
        events, packed, "event_id bigint, path string, check_byte bigint", separator=".", size=256
    )


@query(
    P
    + """
    , ordered as (select class, lk, ts, lag(ts) over (partition by class, lk order by ts) as before from p)
    select class, lk as label_key, count(*) as n_points,
           count(*) filter (before is null or ts - before > 3600000000) as n_sessions
    from ordered group by 1, 2
    """
)
def apply_per_series_query(spark: SparkSession, folder: str) -> DataFrame:
    def sessions(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Runs of ticks with gaps of an hour at most, merged frame by frame."""
        key, n, runs = None, 0, []
        for frame in frames:
            key = [frame[name].iat[0] for name in SERIES_KEY]
            n += len(frame)
            spans = sorted([*runs, *((t, t) for t in frame["ts"])])
            runs = spans[:1]
            for low, high in spans[1:]:
                if low - runs[-1][1] > 3_600_000_000:
                    runs.append((low, high))
                else:
                    runs[-1] = (runs[-1][0], max(high, runs[-1][1]))
        yield pd.DataFrame([[*key, n, len(runs)]], columns=[*SERIES_KEY, "n_points", "n_sessions"])

    points = event_points(spark, folder).select(*SERIES_KEY, "ts")
    schema = "class string, label_key string, n_points bigint, n_sessions bigint"
    return apply_per_series(points, sessions, schema)


def _session_step(state: tuple, frame: pd.DataFrame) -> tuple[tuple, pd.DataFrame]:
    """State: first and last tick, and sessions so far; a session goes on over gaps of an hour at most."""
    first, last, n = state
    ts = frame["ts"].to_numpy()
    before = ts[:1] if last is None else [last]
    new = np.diff(ts, prepend=before) > 3_600_000_000
    if last is None:
        new[0] = True
    number = n + np.cumsum(new)
    rows = frame[[*SERIES_KEY, "ts"]].assign(session=number)
    return (ts[0] if first is None else first, ts[-1], int(number[-1])), rows


def _sessions_merged(a: tuple, b: tuple) -> tuple:
    if a[0] is None or b[0] is None:
        return a if b[0] is None else b
    return a[0], b[1], a[2] + b[2] - (b[0] - a[1] <= 3_600_000_000)


@query(
    P
    + """
    , g as (select class, lk, ts, coalesce(ts - lag(ts) over w > 3600000000, true)::int as is_new
            from p window w as (partition by class, lk order by ts)),
    s as (select *, sum(is_new) over (partition by class, lk order by ts) as session from g)
    select class, lk as label_key, session::bigint as session, count(*) as n_points,
           min(ts) as first_tick, max(ts) as last_tick
    from s group by class, lk, session
    """
)
def sessions_by_segments(spark: SparkSession, folder: str) -> DataFrame:
    points = event_points(spark, folder).select(*SERIES_KEY, "ts")
    function = SegmentFunction(lambda: (None, None, 0), _session_step, _sessions_merged)
    numbered = apply_to_segments(points, function, "class string, label_key string, ts bigint, session bigint")
    return numbered.groupBy(*SERIES_KEY, "session").agg(
        F.count(F.lit(1)).alias("n_points"), F.min("ts").alias("first_tick"), F.max("ts").alias("last_tick")
    )


@query(
    P
    + f"""
    , b as (select selector, min(ts) // {DAY} as a, max(ts) // {DAY} as z from p group by selector),
    d as (select selector, unnest(range(a, z + 1)) as day from b)
    select selector, day from d where day % 7 in (1, 4)
    """
)
def generate_rows_query(spark: SparkSession, folder: str) -> DataFrame:
    @F.arrow_udtf(returnType="class string, label_key string, day bigint")
    class ServiceDays:
        """Days from the first to the last tick of a series, by a calendar that only Python code knows."""

        def __init__(self):
            self.next_day = None

        def eval(self, points: pa.RecordBatch) -> Iterator[pa.Table]:
            ticks = points.column("ts").to_numpy()
            first, last = ticks[0] // DAY, ticks[-1] // DAY
            days = np.arange(first if self.next_day is None else self.next_day, last + 1)
            self.next_day = last + 1
            days = days[np.isin(days % 7, (1, 4))]
            key = {name: pa.array([points.column(name)[0].as_py()] * len(days), pa.string()) for name in SERIES_KEY}
            yield pa.table(key | {"day": pa.array(days, pa.int64())})

    points = event_points(spark, folder).select(*SERIES_KEY, "ts")
    days = generate_from_series(points, ServiceDays)
    return with_selector(days).select("selector", "day")


def _public_name(name: str) -> str:
    return name.removesuffix("_query")


def queries() -> dict[str, Query]:
    return {_public_name(name): entry.run for name, entry in CATALOGUE.items()}


def oracle_sql() -> dict[str, str]:
    return {_public_name(name): entry.sql for name, entry in CATALOGUE.items() if entry.sql}
