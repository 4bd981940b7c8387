"""Conditions of catalogue queries that must reach the scan."""

import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators.blocks import block_bounds, clip_blocks, pack_points, unpack_points
from tickloom.functions.geo import cell, cover
from tickloom.operators.aggregates import series_count
from tickloom.operators.joins import group_assignment, partition_join
from tickloom.operators.select import select_series
from tickloom.plans import catalogue
from tickloom.plans.events import event_points
from tickloom.sources.directory import fetch_series, find_series, write_series
from tickloom.sources.series import (
    points_in_box,
    read_blocks,
    save_points_by_series,
    write_blocks,
    write_points_by_place,
)

from fixtures import frame, point, same_points

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "query, pushed",
    [
        ("filter_by_name", ["EqualTo(event_type,click)"]),
        ("select_series", ["StringStartsWith(event_type,p)"]),
        ("series_scan", ["GreaterThan(ts,", "LessThanOrEqual(ts,", "event_type"]),
        ("time_chunk", ["GreaterThanOrEqual(ts,", "LessThanOrEqual(ts,"]),
        ("chunk_fuse", ["GreaterThanOrEqual(ts,", "LessThanOrEqual(ts,"]),
    ],
)
def test_conditions_reach_the_scan(spark, query, pushed):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = catalogue.queries()[query](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PushedFilters") :].split("\n")[0]
    assert all(p in filters for p in pushed), filters


def scans(query):
    """What each file scan of a finished query read: its line in the plan, and its rows."""
    plan = query._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    found = [leaves.apply(i) for i in range(leaves.size())]
    return [(n.toString(), n.metrics().apply("numOutputRows").value()) for n in found if n.nodeName().startswith("Scan parquet")]


@pytest.fixture
def plain_plans(spark):
    """Plans as they are before any run, so that their scans can be looked at."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_label_selectors_skip_points_of_other_series(spark, plain_plans, tmp_path):
    path = str(tmp_path / "series")
    points = event_points(spark, FOLDER)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    write_series(points, path)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    selector = "~.*{user=7}"
    found = fetch_series(spark, path, selector)
    found._jdf.queryExecution().toRdd().count()
    text, read = next((t, n) for t, n in scans(found) if "v_double" in t)
    assert "series_id" in text[text.index("PushedFilters") :]
    assert 0 < read < 0.6 * points.count()
    same_points(found, select_series(points, selector))


@pytest.mark.parametrize("selector", ["click{shard=1}", "~p.*|view{user~1.*,tier=gold}", "~.*{nothing=1}", "click", "~.*"])
def test_fetch_equals_a_scan(spark, tmp_path, selector):
    path = str(tmp_path / "series")
    points = event_points(spark, FOLDER).where(F.col("labels")["user"] < "3")
    write_series(points, path)
    same_points(fetch_series(spark, path, selector), select_series(points, selector))


def test_attributes_are_found_behind_labels(spark, tmp_path):
    path = str(tmp_path / "series")
    rows = [point("a", {"k": "l"}, ts=1, v_long=1, attributes={"k": "a"}), point("b", {}, ts=1, v_long=2, attributes={"k": "a"})]
    write_series(frame(spark, *rows), path)
    assert [r["class"] for r in fetch_series(spark, path, "~.*{k=a}").collect()] == ["b"]
    assert fetch_series(spark, path, "~.*{k=z}").collect() == []
    assert [r.ts for r in fetch_series(spark, path, "a", first=1, last=1).collect()] == [1]
    assert fetch_series(spark, path, "a", first=2).collect() == []
    with pytest.raises(ValueError):
        find_series(spark, path)


def test_bounds_and_clips_use_the_headers(spark, plain_plans, tmp_path):
    path = str(tmp_path / "blocks")
    points = frame(spark, *[point("c", {"k": str(t % 3)}, ts=t, v_long=t) for t in range(3000)])
    write_blocks(pack_points(points, 10), path)
    bounds = block_bounds(read_blocks(spark, path))
    plan = bounds._jdf.queryExecution().executedPlan().toString()
    assert "points" not in plan[plan.index("ReadSchema") :].replace("n_points", "").split("\n")[0]
    assert {(r.n_points, r.first_tick, r.last_tick) for r in bounds.collect()} == {(1000, k, 2997 + k) for k in range(3)}
    clipped = clip_blocks(read_blocks(spark, path), 100, 140)
    plan = clipped._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :].split("\n")[0]
    assert "GreaterThanOrEqual(last_tick,100)" in pushed and "LessThanOrEqual(first_tick,140)" in pushed
    assert sorted(r.ts for r in unpack_points(clipped).collect()) == list(range(100, 141))


def test_statistics_tell_the_kinds_of_values(spark, tmp_path):
    path = str(tmp_path / "blocks")
    write_blocks(pack_points(frame(spark, point(ts=1, v_long=1), point(ts=2, v_str="x"))), path)
    row = read_blocks(spark, path).first()
    assert (row["n_points"], row["first_tick"], row["last_tick"], row["kinds"]) == (2, 1, 2, ["v_long", "v_str"])


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_stored_points_are_joined_where_they_lie(spark, plain_plans, no_broadcast, tmp_path):
    points = event_points(spark, FOLDER)
    save_points_by_series(points, "points_by_series", str(tmp_path / "points"), 8)
    try:
        stored = spark.table("points_by_series")
        joined = partition_join(stored, group_assignment(points, ["shard"]))
        tree = joined._jdf.queryExecution().executedPlan().toString()
        # The side of the points: from the join down to the scan of the bucketed table.
        left = tree[tree.index("SortMergeJoin") : tree.index("Bucketed: true")]
        assert "Exchange" not in left
        assert joined.count() == points.count()
        counts = series_count(stored)
        assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
        same_points(stored, points)
    finally:
        spark.sql("drop table points_by_series")


BOXES = [(-90, 90, -180, 180), (0, 0, 0, 0), (10.5, 11, -3, 40), (-90, -89, 179, 180), (80, 90, 170, -170), (5, 1, 0, 1), (-33, 47.25, -1, 0)]


@pytest.mark.parametrize("box", BOXES)
@pytest.mark.parametrize("ranges", [2, 32])
def test_boxes_are_covered(spark, box, ranges):
    rng = random.Random(1)
    places = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(500)]
    places += [(float(a), float(b)) for a in box[:2] for b in box[2:]] + [(-90.0, -180.0), (90.0, 180.0), (0.0, 0.0)]
    rows = spark.createDataFrame(places, "lat double, lon double").withColumn("c", cell(F.col("lat"), F.col("lon"))).collect()
    found = cover(*box, ranges)
    assert len(found) <= ranges and all(a <= b for a, b in found) and found == sorted(found)
    inside = lambda r: box[0] <= r.lat <= box[1] and (
        box[2] <= r.lon <= box[3] if box[2] <= box[3] else r.lon >= box[2] or r.lon <= box[3]
    )
    for r in rows:
        by_hand = 0
        y, x = (min(int((v - a) / s * 2**31), 2**31 - 1) for v, a, s in ((r.lat, -90, 180), (r.lon, -180, 360)))
        for i in range(31):
            by_hand |= (x >> i & 1) << 2 * i | (y >> i & 1) << 2 * i + 1
        assert r.c == by_hand
        assert not inside(r) or any(a <= r.c <= b for a, b in found)


def test_boxes_skip_points_elsewhere(spark, plain_plans, tmp_path):
    path = str(tmp_path / "places")
    points = event_points(spark, FOLDER)
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    write_points_by_place(points, path)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    found = points_in_box(spark, path, 10, 40, 20, 80)
    found._jdf.queryExecution().toRdd().count()
    text, read = scans(found)[0]
    assert "cell" in text[text.index("PushedFilters") :] and 0 < read < 0.5 * points.count()
    same_points(found, points.where("lat between 10 and 40 and lon between 20 and 80"))
    assert points_in_box(spark, path, 5, 1, 0, 1).count() == 0
