"""Sources, sinks and streams."""

import os
import zipfile
from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from tickloom.model import with_series_key
from tickloom.operators.blocks import pack_points, unpack_points
from tickloom.operators.dump import dump_text
from tickloom.operators.parse import good_points, parse_lines
from tickloom.operators.select import select_series
from tickloom.session import materialise, new_shared_path, removing_tables, shared_dir
from tickloom.sources.files import (
    archive_entries,
    archive_index,
    ingest_totals,
    read_archive_entries,
    read_whole_files,
    whole_file_ingest,
)
from tickloom.sources.keyvalue import (
    TEXT_WRITABLE,
    bytes_sink,
    hadoop_sink,
    kv_sink,
    kv_source,
    resolve_profile,
    sequence_file_sink,
    sequence_file_source,
)
from tickloom.sources.ranges import range_location, range_scan
from tickloom.sources.series import (
    normalize_mixed,
    normalized_sink,
    read_blocks,
    read_points,
    series_scan,
    write_blocks,
    write_points,
)

from fixtures import frame, point, same_points


def seqnos(df):
    return [r["seqno"] for r in df.orderBy("value").collect()]


def test_range_splits(spark):
    assert seqnos(range_scan(spark, 0, 10, 4)) == [0, 1, 2, 0, 1, 2, 0, 1, 2, 0]
    assert seqnos(range_scan(spark, 5, 3, 10)) == [0, 0, 0]
    assert seqnos(range_location(spark, "range://0:100", 2)) == [*range(50), *range(50)]
    assert [r["value"] for r in range_scan(spark, -2, 4).orderBy("value").collect()] == [-2, -1, 0, 1]
    assert range_scan(spark, 0, 0, 3).count() == 0
    for wrong in ((0, 5, 0), (0, -1, 1)):
        with pytest.raises(ValueError):
            range_scan(spark, *wrong)
    with pytest.raises(ValueError):
        range_location(spark, "range://a:b")


@pytest.fixture(scope="module")
def points(spark):
    return frame(
        spark,
        *[point(c, {"k": str(t % 2)}, ts=t * 10, v_long=t) for c in ("a", "b", "c") for t in range(-20, 20)],
    )


@pytest.mark.parametrize("width", [None, 50])
def test_window_scan(spark, points, tmp_path, width):
    path = str(tmp_path / "points")
    write_points(points, path, bucket_width=width)
    stored = read_points(spark, path)
    got = series_scan(stored, "~a|b{k=1}", now=100, timespan=130, bucket_width=width)
    assert sorted((r["class"], r["ts"]) for r in got.collect()) == sorted(
        (c, t * 10) for c in "ab" for t in range(-20, 20) if t % 2 == 1 and -30 < t * 10 <= 100
    )
    assert got.first()["id"] in ("a{k=1}", "b{k=1}")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "In(class" in plan and "GreaterThan(ts,-30)" in plan and "LessThanOrEqual(ts,100)" in plan
    if width:
        assert "bucket" in plan[plan.index("PartitionFilters") :].split("PushedFilters")[0]


def test_block_tables(spark, points, tmp_path):
    path = str(tmp_path / "blocks")
    write_blocks(pack_points(points, 6), path)
    assert read_blocks(spark, path).count() == 3 * 2 * 4
    other = str(tmp_path / "other")
    spark.range(3).write.parquet(other)
    with pytest.raises(ValueError, match="missing"):
        read_blocks(spark, other)


def test_normalize_mixed(spark, points, tmp_path):
    lines = dump_text(points.where("v_long < 0")).select("line")
    block = F.struct("class", "labels", "attributes", "count", "points")
    blocks = pack_points(points.where("v_long >= 0"), 5).select(block.alias("block"))
    for kind in (F.col("line"), F.array("line", F.lit(None))):
        same_points(normalize_mixed(lines.select(kind.alias("item"))), points.where("v_long < 0"))
    for kind in (F.col("block"), F.array("block", F.lit(None))):
        same_points(normalize_mixed(blocks.select(kind.alias("item"))), points.where("v_long >= 0"))

    some = F.col("line").contains("a{")
    mixed = (
        lines.select(F.when(some, F.col("line")).alias("line"), F.when(~some, F.array("line", F.lit(None))).alias("lines"))
        .unionByName(blocks, allowMissingColumns=True)
        .union(spark.sql("select cast(null as string), cast(array() as array<string>)").withColumn("b", F.lit(None).cast(blocks.schema["block"].dataType)))
    )
    items = mixed.select(F.struct("line", "lines", "block").alias("item"))
    same_points(normalize_mixed(items), points)
    normalized_sink(items, str(tmp_path / "blocks"), max_points=4)
    stored = read_blocks(spark, str(tmp_path / "blocks"))
    assert stored.where("count > 4").isEmpty()
    same_points(unpack_points(stored), points)

    bad = items.union(spark.createDataFrame([(("no line", None, None),)], items.schema))
    with pytest.raises(Exception, match="malformed line: no line"):
        normalize_mixed(bad).count()
    same_points(normalize_mixed(bad, strict=False), points)
    # The items are read once, whatever kinds they hold.
    stored_items = str(tmp_path / "items")
    items.write.parquet(stored_items)
    plan = normalize_mixed(spark.read.parquet(stored_items))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1

    no_line = spark.createDataFrame([("bm90IGEgbGluZQ",)], "item string")
    with pytest.raises(Exception, match="malformed line"):
        normalize_mixed(no_line).count()
    assert normalize_mixed(no_line, strict=False).count() == 0
    for wrong in (no_line.withColumn("more", F.lit(1)), spark.range(1).toDF("item")):
        with pytest.raises(ValueError):
            normalize_mixed(wrong)


def test_profiles():
    settings = {"format": "csv", "format.raw": "json", "sep": ";", "sep.raw": ",", "x.other": "1"}
    assert resolve_profile(settings)["format"] == "csv"
    raw = resolve_profile(settings, "raw")
    assert (raw["format"], raw["sep"], raw["x.other"]) == ("json", ",", "1")


def test_key_value_formats(spark, tmp_path):
    pairs = spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string")
    settings = {"format": "csv", "sep": ";", "format.col": "parquet"}
    for suffix in ("", "col"):
        path = str(tmp_path / f"pairs{suffix}")
        kv_sink(pairs, path, settings, suffix)
        back = kv_source(spark, path, settings, suffix, schema="key bigint, value string")
        assert sorted(map(tuple, back.collect())) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError):
        kv_sink(pairs.select("k"), path, settings)
    with pytest.raises(ValueError):
        kv_source(spark, path, {})
    with pytest.raises(ValueError):
        hadoop_sink(pairs, path, "any", TEXT_WRITABLE, TEXT_WRITABLE)


def test_binary_sinks(spark, tmp_path):
    df = spark.createDataFrame([(bytearray(b"\x00\xff"),), (bytearray(b""),)], "b binary")
    bytes_sink(df, str(tmp_path / "bytes"))
    sequence_file_sink(df, str(tmp_path / "sequence"))
    back = sequence_file_source(spark, str(tmp_path / "sequence"))
    assert sorted(bytes(r[0]) for r in back.collect()) == [b"", b"\x00\xff"]
    for wrong in (df.withColumn("more", F.lit(1)), spark.range(1)):
        for sink in (bytes_sink, sequence_file_sink):
            with pytest.raises(ValueError):
                sink(wrong, str(tmp_path / "never"))


def test_whole_files(spark, tmp_path):
    for name, content in {"a.bin": b"AA", "b.bin": b"BBB", "key": b"K"}.items():
        (tmp_path / name).write_bytes(content)
    paths = spark.createDataFrame(
        [(f"{tmp_path}/a.bin",), (f"  {tmp_path}/key   {tmp_path}/b.bin ",), ("",), (f"file:{tmp_path}/b.bin",)],
        "line string",
    )
    records = whole_file_ingest(spark, paths, str(tmp_path))
    got = sorted((bytes(r["key"]), bytes(r["value"])) for r in records.collect())
    assert got == [(b"K", b"BBB"), (b"a.bin", b"AA"), (b"b.bin", b"BBB")]
    assert tuple(ingest_totals(records).first()) == (3, 1 + 3 + 5 + 2 + 5 + 3)
    for line, problem in {"a b c": "not one or two paths", "/no/such": "files not found"}.items():
        wrong = spark.createDataFrame([(line,)], "line string")
        with pytest.raises(Exception, match=problem):
            whole_file_ingest(spark, wrong, str(tmp_path)).select("key").collect()


def test_archives(spark, tmp_path):
    for name in ("a b+c~.zip", "plain.zip"):
        with zipfile.ZipFile(tmp_path / name, "w") as archive:
            archive.writestr("dir/", "")
            archive.writestr("dir/x y.txt", "hello")
            archive.writestr("empty", "")
    rows = archive_entries(read_whole_files(spark, str(tmp_path))).collect()
    assert sorted((r["key"], bytes(r["value"])) for r in rows) == [
        ("a%20b%2Bc%7E.zip dir/x y.txt", b"hello"),
        ("a%20b%2Bc%7E.zip empty", b""),
        ("plain.zip dir/x y.txt", b"hello"),
        ("plain.zip empty", b""),
    ]


@pytest.mark.parametrize("split_bytes", [1, 300, 1 << 30])
def test_archives_are_read_by_ranges(spark, tmp_path, split_bytes):
    expected = {}
    for name in ("a b+c~.zip", "plain.zip"):
        with zipfile.ZipFile(tmp_path / name, "w") as archive:
            archive.writestr("dir/", "")
            for i in range(40):
                info = zipfile.ZipInfo(f"dir/é{i}")
                info.extra = b"\x99\x99\x02\x00xy" if i % 3 else b""
                info.compress_type = zipfile.ZIP_DEFLATED if i % 2 else zipfile.ZIP_STORED
                content = (name * i * i).encode()
                archive.writestr(info, content)
                expected[quote(name, safe="*-._").replace("~", "%7E") + f" dir/é{i}"] = content
    with zipfile.ZipFile(tmp_path / "none.zip", "w"):
        pass
    assert archive_index(spark, str(tmp_path)).count() == 80
    rows = read_archive_entries(spark, str(tmp_path), split_bytes)
    assert {r["key"]: bytes(r["value"]) for r in rows.collect()} == expected
    tasks = rows.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks == 1 if split_bytes > 300 else tasks > 1


def test_damaged_and_odd_archives_fail(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("x", "hello hello")
    data = bytearray((tmp_path / "a.zip").read_bytes())
    data[data.index(b"hello")] ^= 1
    (tmp_path / "a.zip").write_bytes(data)
    with pytest.raises(Exception, match="damaged"):
        read_archive_entries(spark, str(tmp_path)).collect()
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_BZIP2) as archive:
        archive.writestr("x", "hello")
    with pytest.raises(Exception, match="method 12"):
        read_archive_entries(spark, str(tmp_path)).collect()


def test_materialised_tables_are_in_the_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_shared_path(spark, "x").startswith(shared_dir(spark))
    table = materialise(spark.range(5))
    assert table.count() == 5 and table.inputFiles()[0].startswith(f"file://{shared_dir(spark)}")


def test_tables_can_be_removed_when_their_results_are_used(spark):
    kept = materialise(spark.range(3))
    with removing_tables(spark):
        gone = materialise(spark.range(5))
        folder = gone.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        assert gone.count() == 5 and os.path.isdir(folder)
        new_shared_path(spark, "never-written")
    assert not os.path.exists(folder) and kept.count() == 3


def test_row_operators_run_on_streams(spark, points, tmp_path):
    """Reading, selecting and writing lines needs no state, so it streams as it is."""
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    dump_text(points).select("line").write.text(source)
    lines = spark.readStream.text(source).withColumnRenamed("value", "line")
    chosen = select_series(good_points(parse_lines(lines)), "b{k=1}")
    out = dump_text(chosen).select("line")
    run = (
        out.writeStream.format("text")
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start(target)
    )
    run.awaitTermination(120)
    written = parse_lines(spark.read.text(target).withColumnRenamed("value", "line"))
    same_points(good_points(written), with_series_key(points).where("class = 'b' and label_key = 'k=1'"))
