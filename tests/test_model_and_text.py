"""Points, keys, ids and the text format."""

import pytest
from pyspark.sql import functions as F

from tickloom.functions.ids import with_series_ids
from tickloom.functions.timeunits import convert_ticks, floor_div, ticks_of_local_timestamp
from tickloom.model import label_text, to_points, with_selector
from tickloom.operators.aggregates import series_count
from tickloom.operators.dump import dump_text, update_stream
from tickloom.operators.parse import (
    good_points,
    parse_lines,
    parse_stream,
    rejected_lines,
    strict_points,
)
from tickloom.plans.workflows import push_points
from tickloom.sources.text import read_lines, write_lines

from fixtures import frame, point, same_points


MIXED = [
    point(ts=-5, v_long=7),
    point("empty labels", ts=1, v_double=1.5),
    point("a b/c", {"k=1": "x,y", "é{}": "50% +"}, ts=2, lat=1.25, lon=-3.5, v_bool=True),
    point("a b/c", {"k=1": "x,y", "é{}": "50% +"}, ts=3, elev=-9, v_bool=False),
    point("", {"only": ""}, ts=4, lat=0.0, lon=0.0, elev=12, v_str="it's a/b {c} = 'd' é"),
    point("big", {"n": "1"}, ts=2**62, v_double=1e20),
    point("big", {"n": "1"}, ts=2**62 + 1, v_double=float("inf")),
    point("big", {"n": "1"}, ts=2**62 + 2, v_double=-1e-7),
    point("big", {"n": "1"}, ts=2**62 + 3, v_str=""),
    point("big", {"n": "1"}, ts=2**62 + 4, v_long=-(2**63)),
]


def test_parse_undoes_dump(spark):
    points = frame(spark, *MIXED)
    same_points(strict_points(parse_lines(dump_text(points))), points)


def test_value_types_survive_the_text(spark):
    lines = {r["ts"]: r["line"] for r in dump_text(frame(spark, *MIXED)).collect()}
    assert lines[-5] == "-5// c{} 7"
    assert lines[2] == "2/1.25:-3.5/ a%20b%2Fc{%C3%A9%7B%7D=50%25%20%2B,k%3D1=x%2Cy} T" or lines[2] == (
        "2/1.25:-3.5/ a%20b%2Fc{k%3D1=x%2Cy,%C3%A9%7B%7D=50%25%20%2B} T"
    )
    assert lines[3].endswith(" F")


def test_optimized_dump_names_each_series_once(spark):
    points = frame(spark, *MIXED)
    lines = dump_text(points, optimize=True).collect()
    assert len(lines) == len(MIXED)
    heads = [r for r in lines if not r["line"].startswith("=")]
    assert sorted(r["class"] for r in heads) == ["", "a b/c", "big", "c", "empty labels"]
    assert {r["class"]: r["ts"] for r in heads}["big"] == 2**62


def test_equal_first_points_give_one_head(spark):
    copies = frame(spark, *[point(ts=1, v_long=5)] * 4, point(ts=1, v_long=9), point(ts=8, v_long=1))
    lines = sorted(r["line"] for r in dump_text(copies, optimize=True).collect())
    assert lines == sorted(["1// c{} 5"] + ["=1// 5"] * 3 + ["=1// 9", "=8// 1"])


def test_negative_zero_keeps_its_sign(spark):
    points = frame(spark, point(ts=1, v_double=-0.0), point(ts=1, v_double=0.0), point("d", ts=1, v_double=-0.0))
    lines = sorted(r["line"] for r in dump_text(points, optimize=True).collect())
    assert len(lines) == 3 and "1// d{} -0.0" in lines
    assert sorted(line.rsplit(" ", 1)[1] for line in lines) == ["-0.0", "-0.0", "0.0"]


@pytest.fixture(params=["1", "8"])
def partitions(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def hot_and_cold(spark):
    return frame(
        spark,
        *[point("hot", {"k": "1"}, ts=t * t, v_long=t) for t in range(40)],
        *[point(f"cold{c}", ts=t, v_long=t) for c in range(5) for t in range(2)],
    )


@pytest.mark.parametrize("run_lines", [3, 1000])
def test_optimized_dump_reads_back_whole(spark, tmp_path, partitions, run_lines):
    points = hot_and_cold(spark).union(frame(spark, *MIXED))
    path = str(tmp_path / "dump")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "7")
    try:
        write_lines(dump_text(points, optimize=True, run_lines=run_lines), path)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    same_points(strict_points(parse_stream(read_lines(spark, path))), points)


def test_dump_written_as_plain_text_reads_back_whole(spark, tmp_path):
    points = hot_and_cold(spark)
    dump_text(points, optimize=True).select("line").write.text(str(tmp_path / "dump"))
    same_points(strict_points(parse_stream(read_lines(spark, str(tmp_path / "dump")))), points)


def test_names_in_the_text_depend_on_the_series_only(spark, partitions):
    points = hot_and_cold(spark)
    for run_lines, heads in ((1000, 6), (3, 14 + 5), (1, 50)):
        lines = dump_text(points, optimize=True, run_lines=run_lines)
        assert lines.where(~F.col("line").startswith("=")).count() == heads
    with pytest.raises(ValueError):
        dump_text(points, optimize=True, run_lines=0)


def test_update_stream_passes_ready_lines(spark, tmp_path, partitions):
    points = hot_and_cold(spark)
    ready = dump_text(frame(spark, *MIXED)).select("line")
    path = str(tmp_path / "stream")
    counted = push_points(points, path, ready)
    for file in (tmp_path / "stream").glob("*.txt"):
        assert not file.read_text().startswith("=")
    same_points(strict_points(parse_stream(read_lines(spark, path))), points.union(frame(spark, *MIXED)))
    assert {r["class"]: r["emitted"] for r in counted.collect()} == {
        "hot": 40, **{f"cold{c}": 2 for c in range(5)}, None: len(MIXED)
    }
    continued = spark.createDataFrame([("=1// 2",)], "line string")
    with pytest.raises(Exception, match="names no series"):
        update_stream(points, continued).collect()


def test_points_without_a_value_are_never_lost_silently(spark):
    df = spark.sql("select 1L ts, 5 v union all select 2L, null")
    read = lambda **options: to_points(df, F.lit("c"), F.col("ts"), F.col("v"), **options)
    for use in (lambda p: dump_text(p).collect(), lambda p: series_count(p).collect(), lambda p: p.count()):
        with pytest.raises(Exception, match="a point without a value"):
            use(read())
    kept = read(drop_null_values=True)
    assert series_count(kept).first()["n_points"] == dump_text(kept).count() == 1
    with pytest.raises(Exception, match="a point without a value"):
        dump_text(frame(spark, point(ts=1))).collect()


def test_a_plus_in_a_line_is_a_plus(spark):
    lines = spark.createDataFrame([("1// a+b{k=c+d} 'e+f%2B'",)], "line string")
    row = strict_points(parse_lines(lines)).first()
    assert (row["class"], row["labels"], row["v_str"]) == ("a+b", {"k": "c+d"}, "e+f+")


def test_stream_carries_series_over_file_blocks(spark, tmp_path):
    path = tmp_path / "one.txt"
    lines = ["0// first{k=v} 0", *[f"={t}// {t}" for t in range(1, 400)], "400/1.0:2.0/ second{} 'x'"]
    lines += [f"={t}//3 {t}.5" for t in range(401, 700)]
    path.write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        read = read_lines(spark, str(path))
        assert read.select("block_start").distinct().count() > 3
        points = strict_points(parse_stream(read)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(points) == len(lines)
    assert {p["ts"] for p in points if p["class"] == "first"} == set(range(400))
    assert {p["ts"] for p in points if p["class"] == "second"} == set(range(400, 700))


def test_continuation_does_not_cross_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1// c{} 1\n=2// 2\n")
    (tmp_path / "b.txt").write_text("=3// 3\n")
    parsed = parse_stream(read_lines(spark, str(tmp_path)))
    assert {p["ts"] for p in good_points(parsed).collect()} == {1, 2}
    rejected = rejected_lines(parsed).collect()
    assert [(r["line"], r["problem"]) for r in rejected] == [("=3// 3", "no series named before this line")]


def test_lines_after_a_malformed_head_are_no_part_of_the_series_before(spark, tmp_path):
    (tmp_path / "a.txt").write_text("1// c{} 1\n=2// 2\nd{} oops\n=3// 3\n4// e{} 4\n=5// f{} 5\n=6// 6\n")
    parsed = parse_stream(read_lines(spark, str(tmp_path)))
    assert {(p["class"], p["ts"]) for p in good_points(parsed).collect()} == {("c", 1), ("c", 2), ("e", 4), ("e", 6)}
    assert {r["line"]: r["problem"] for r in rejected_lines(parsed).collect()} == {
        "d{} oops": "malformed line",
        "=3// 3": "no series named before this line",
        "=5// f{} 5": "continuation line names a series",
    }


def test_bad_lines_are_rejected(spark):
    bad = {
        "junk": "malformed line",
        "1// c{} nonsense": "malformed value",
        "1// c{} '%zz'": "malformed value",
        "99999999999999999999// c{} 1": "tick out of range",
        "1/1.2.3:4/ c{} 1": "malformed position",
        "1// c{} 99999999999999999999": "malformed value",
        "1// c{a=1,a=2} 1": "malformed series name",
        "1// c{%zz=1} 1": "malformed series name",
        "1// %zz{} 1": "malformed series name",
        "=1// 5": "no series named before this line",
        "1// 5": "no series named before this line",
    }
    lines = spark.createDataFrame([(line,) for line in [*bad, "1// c{a=b} 1"]], "line string")
    parsed = parse_lines(lines)
    assert {r["line"]: r["problem"] for r in rejected_lines(parsed).collect()} == bad
    assert good_points(parsed).count() == 1
    with pytest.raises(Exception, match="USER_RAISED_EXCEPTION"):
        strict_points(parsed).collect()
    # Also when no column of the bad lines is used.
    with pytest.raises(Exception, match="malformed line"):
        strict_points(parse_lines(lines.where("line = 'junk'"))).count()


def test_label_text_is_canonical_and_injective(spark):
    df = spark.sql(
        """select map('b', '1', 'a', '2') m union all select map('a', '2', 'b', '1')
           union all select map('a', '1,b=2') union all select map('a', '1', 'b', '2')
           union all select cast(null as map<string,string>) union all select map('k', null)"""
    )
    got = [r[0] for r in df.select(label_text(F.col("m"))).collect()]
    assert got == ["a=2,b=1", "a=2,b=1", "a=1%2Cb%3D2", "a=1,b=2", "", "k="]


def test_ids_of_labels_do_not_depend_on_class(spark):
    points = frame(spark, point("a", {"k": "v"}), point("b", {"k": "v"}), point("b", {"k": "w"}))
    rows = with_series_ids(points).select("class", "label_key", "class_id", "labels_id").collect()
    assert len({r["labels_id"] for r in rows}) == 2
    assert len({r["class_id"] for r in rows}) == 2
    assert all(0 <= r["class_id"] < 2**60 for r in rows)


def test_null_class_and_labels_are_empty(spark):
    rows = spark.sql("select cast(null as string) class, cast(null as map<string,string>) labels")
    assert with_selector(rows).first()["selector"] == "{}"


def test_to_points_types_values_and_keys(spark):
    df = spark.sql("select 1L ts, 'x' s, true b, 2 i, 3.5D d, cast(null as string) n")
    for name, column in {"s": "v_str", "b": "v_bool", "i": "v_long", "d": "v_double"}.items():
        points = to_points(df, F.lit("c"), F.col("ts"), F.col(name), labels={"z": F.col("n"), "a": F.col("i")})
        row = points.first()
        assert row[column] is not None
        assert row["label_key"] == "a=2,z="
        assert points.select(label_text(F.col("labels"))).first()[0] == "a=2,z="
    with pytest.raises(ValueError):
        to_points(df, F.lit("c"), F.col("ts"), F.array("i"))
    with pytest.raises(ValueError):
        to_points(df, F.lit("c"), F.col("ts"), F.col("i"), lat=F.lit(1.0))


def test_ticks(spark):
    df = spark.sql("select -1L x union all select -1000L union all select 1999L union all select -1001L")
    got = [r[0] for r in df.select(convert_ticks(F.col("x"), "us", "ms")).collect()]
    assert got == [-1, -1, 1, -2]
    assert [r[0] for r in df.select(floor_div(F.col("x"), 10)).collect()] == [-1, -100, 199, -101]
    with pytest.raises(ValueError):
        convert_ticks(F.col("x"), "us", "h")


def test_local_ticks_ignore_the_session_zone(spark):
    df = spark.sql(
        "select explode(array(timestamp_ntz'2024-03-10 02:30:00.000001', timestamp_ntz'1969-12-31 23:59:59.5')) t"
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = [r[0] for r in df.select(ticks_of_local_timestamp(F.col("t"))).collect()]
            assert got == [1710037800000001, -500000]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
