"""Packing, ranking of large groups, chunks, joins and bags."""

import random
from functools import reduce

import pytest
from pyspark.sql import functions as F

from tickloom.model import BLOCKS_SCHEMA, SERIES_KEY, with_selector, with_series_key
from tickloom.operators.aggregates import (
    bag_by_key,
    block_count,
    is_block_empty,
    series_bounds,
    series_count,
    top_one,
    window_of_all,
)
from tickloom.operators.blocks import (
    block_metadata,
    chunk_blocks,
    join_key_value,
    load_blocks,
    merge_series,
    pack_points,
    point_of,
    split_key_value,
    unpack_points,
)
from tickloom.operators.chunks import chunk_fuse, time_chunk
from tickloom.operators.dump import POINT_ORDER, dump_text
from tickloom.operators.joins import (
    bounds_cogroup,
    cogroup_bags,
    group_assignment,
    partition_join,
)
from tickloom.operators.ordering import with_rank
from tickloom.operators.segments import SegmentFunction, apply_to_segments
from tickloom.operators import blocks as block_module
from tickloom.sources.series import read_blocks, write_blocks

from fixtures import frame, point, same_points


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the points in one series, most of them close together."""
    rng = random.Random(7)
    ticks = [0, *(10**12 + rng.randrange(5000) for _ in range(300))]
    points = [point("hot", {"k": "v"}, ts=t, v_long=i) for i, t in enumerate(ticks)]
    points += [point(f"c{i % 60}", {"k": str(i % 3)}, ts=rng.randrange(100), v_long=i) for i in range(600)]
    return frame(spark, *points).repartition(4).cache()


def order(descending=False):
    ts = F.col("ts").desc() if descending else F.col("ts")
    return [ts, *(F.col(name) for name in POINT_ORDER)]


@pytest.fixture(params=["1", "4", "40"])
def partitions(spark, request):
    """Ranges from the whole table to stretches that cut every large group."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    yield int(request.param)
    spark.conf.set("spark.sql.shuffle.partitions", before)


def place_of_every_point(points, descending=False):
    by_series = {}
    for p in points.collect():
        key = (p["class"], tuple(sorted(p["labels"].items())))
        by_series.setdefault(key, []).append((p["ts"], p["v_long"]))
    places = {}
    for key, values in by_series.items():
        ordered = sorted(values, key=lambda v: (-v[0] if descending else v[0], v[1]))
        places.update({(key[0], v): place for place, v in enumerate(ordered, 1)})
    return places


@pytest.mark.parametrize("descending", [False, True])
def test_rank_does_not_depend_on_partitions(skewed, partitions, descending):
    keyed = with_series_key(skewed)
    ranked = with_rank(keyed, SERIES_KEY, order(descending))
    got = {(r["class"], (r["ts"], r["v_long"])): r["rank"] for r in ranked.collect()}
    assert got == place_of_every_point(skewed, descending)


def test_rank_of_one_group_null_keys_and_weights(spark, partitions):
    rows = [(None, 1, v) for v in range(50)] + [(1, None, v) for v in range(50)] + [(None, None, 7)]
    df = spark.createDataFrame(rows, "a int, b int, v int").repartition(3)
    ranked = with_rank(df, ["a", "b"], [F.col("v")], weight=F.col("v")).collect()
    assert sorted(map(tuple, ranked), key=repr) == sorted(
        [(None, None, 7, 1, 0), *((*k, v, v + 1, v * (v - 1) // 2) for k in ((None, 1), (1, None)) for v in range(50))],
        key=repr,
    )


def test_rank_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "k int, v int")
    assert with_rank(empty, ["k"], [F.col("v")]).collect() == []


def test_unpack_undoes_pack(skewed, partitions):
    blocks = pack_points(skewed, max_points=7)
    same_points(unpack_points(blocks), skewed)
    rows = blocks.orderBy(*SERIES_KEY, "block_no").collect()
    by_series = {}
    for row in rows:
        assert row["count"] == len(row["points"]) <= 7
        assert [p["ts"] for p in row["points"]] == sorted(p["ts"] for p in row["points"])
        by_series.setdefault((row["class"], row["label_key"]), []).append(row)
    for series in by_series.values():
        assert [r["block_no"] for r in series] == list(range(len(series)))
        assert all(r["count"] == 7 for r in series[:-1])
        for earlier, later in zip(series, series[1:]):
            assert earlier["points"][-1]["ts"] <= later["points"][0]["ts"]


def test_blocks_are_bounded_in_bytes(spark):
    points = frame(spark, *[point(ts=t, v_str="x" * 420) for t in range(40)])
    blocks = pack_points(points, max_points=9, max_bytes=2000).orderBy("block_no").collect()
    assert [t for b in blocks for t in (p["ts"] for p in b["points"])] == list(range(40))
    assert max(b["count"] for b in blocks) <= 4
    with pytest.raises(ValueError):
        pack_points(points, max_bytes=0)


def test_blocks_have_the_declared_columns(spark):
    blocks = pack_points(frame(spark, point(v_long=1)))
    declared = {f.name: f.dataType.simpleString() for f in BLOCKS_SCHEMA}
    assert {f.name: f.dataType.simpleString() for f in blocks.schema if f.name in declared} == declared
    with pytest.raises(ValueError):
        pack_points(blocks, max_points=0)


def test_point_forms():
    assert list(point_of("t", "v")) == ["ts", "value"]
    assert list(point_of("t", "e", "v")) == ["ts", "elev", "value"]
    assert list(point_of("t", "a", "o", "v")) == ["ts", "lat", "lon", "value"]
    assert list(point_of("t", "a", "o", "e", "v")) == ["ts", "lat", "lon", "elev", "value"]
    for wrong in (("t",), tuple("abcdef")):
        with pytest.raises(ValueError):
            point_of(*wrong)


def test_arity(spark):
    points = frame(
        spark,
        point(ts=2, v_long=1),
        point(ts=3, elev=1, v_long=1),
        point(ts=4, lat=1.0, lon=1.0, v_long=1),
        point(ts=5, lat=1.0, lon=1.0, elev=1, v_long=1),
    )
    rows = unpack_points(pack_points(points)).collect()
    assert all(r["arity"] == r["ts"] for r in rows) and len(rows) == 4


def stored_blocks(spark):
    """Blocks whose header count and points disagree in every way."""
    one = "named_struct('ts',%dL,'lat',cast(null as double),'lon',cast(null as double),'elev',cast(null as bigint),'v_long',1L,'v_double',cast(null as double),'v_bool',cast(null as boolean),'v_str',cast(null as string))"
    pts = lambda *ticks: f"array({','.join(one % t for t in ticks)})"
    none = f"filter({pts(1)}, p -> false)"
    head = "cast(0 as bigint) base, cast(0 as bigint) bucketcount, cast(0 as bigint) bucketspan, cast(0 as bigint) lastbucket"
    rows = [
        ("'unset header'", "map('k','v')", "map('a','1')", 0, pts(1, 2, 3)),
        ("'empty'", "map('k','v')", "map('a','1')", 0, none),
        ("'header only'", "map('k','v')", "map('a','1')", 4, none),
        ("cast(null as string)", "cast(null as map<string,string>)", "cast(null as map<string,string>)", 1, pts(9)),
    ]
    parts = [
        f"select {c} class, {l} labels, {a} attributes, {head}, cast({n} as bigint) count, {p} points"
        for c, l, a, n, p in rows
    ]
    return spark.sql(" union all ".join(parts))


def test_count_and_emptiness_agree(spark):
    rows = stored_blocks(spark).select("class", block_count().alias("n"), is_block_empty().alias("empty"))
    assert {r["class"]: (r["n"], r["empty"]) for r in rows.collect()} == {
        "unset header": (3, False),
        "empty": (0, True),
        "header only": (4, False),
        None: (1, False),
    }


def test_metadata_is_never_null(spark):
    row = block_metadata(stored_blocks(spark)).where("class = ''").first()
    assert (row["labels"], row["attributes"], row["count"]) == ({}, {}, 1)


def test_merge_keeps_equal_points_and_empty_series(spark):
    a = frame(spark, *[point("m", {"k": "v"}, ts=t, v_long=1, attributes={"from": "a"}) for t in (5, 6, 6)])
    b = frame(spark, *[point("m", {"k": "v"}, ts=t, v_long=1, attributes={"from": "b"}) for t in (1, 6)])
    empty = stored_blocks(spark).where("class = 'empty'")
    blocks = pack_points(a, 2).unionByName(pack_points(b, 2)).drop("label_key", "block_no")
    merged = {r["class"]: r for r in merge_series(blocks.unionByName(empty)).collect()}
    assert [p["ts"] for p in merged["m"]["points"]] == [1, 5, 6, 6, 6]
    assert merged["m"]["attributes"] == {"from": "b"} and merged["m"]["count"] == 5
    assert merged["empty"]["points"] == [] and merged["empty"]["attributes"] == {"a": "1"}


def test_merge_of_large_series(skewed, partitions):
    blocks = pack_points(skewed.where("v_long % 2 = 0"), 10).unionByName(
        pack_points(skewed.where("v_long % 2 = 1"), 10)
    )
    merged = merge_series(blocks, 50)
    same_points(unpack_points(merged), skewed)
    assert merged.where("class = 'hot'").count() == 7


def test_split_and_join_of_blocks(skewed):
    blocks = pack_points(skewed, max_points=20)
    keys, payloads = split_key_value(blocks)
    assert "points" not in keys.columns
    same_points(unpack_points(join_key_value(keys, payloads)), skewed)


def test_load_modes(spark):
    points = frame(spark, *[point("c", {"k": "v"}, ts=t, v_long=t) for t in (-11, -10, -1, 0, 9, 10, 25)])
    blocks = pack_points(points)
    normal = load_blocks(blocks, "NORMAL").first()
    assert len(normal["encoded"]["points"]) == 7
    light = load_blocks(blocks, "light", gen_ids=True)
    assert light.columns == ["className", "labels", "classIdForJoin", "labelsIdForJoin", "encoded"]
    assert "points" not in light.first()["encoded"]
    chunks = load_blocks(blocks, "Chunk", gen_ids=True, clip_from=-10, clip_to=10, chunk_width=10)
    got = {r["chunkId"]: [p["ts"] for p in r["encoded"]["points"]] for r in chunks.collect()}
    assert got == {"-1": [-10, -1], "0": [0, 9], "1": [10]}
    assert chunks.select("labelsIdForJoin").distinct().count() == 1
    assert chunks.first()["labelsIdForJoin"] == light.first()["labelsIdForJoin"]
    first = light.first()
    assert first["labels"] == {
        "k": "v", **{n: str(first[n]) for n in ("classIdForJoin", "labelsIdForJoin")}
    }
    for wrong in ({"mode": "other"}, {"mode": "chunk"}, {"mode": "chunk", "clip_from": 0, "clip_to": 1}):
        with pytest.raises(ValueError):
            load_blocks(blocks, **wrong)


def test_block_chunks_equal_point_chunks(skewed):
    width, low, high = 17, 3, 10**12 + 900
    by_block = unpack_points(chunk_blocks(pack_points(skewed, 13), low, high, width).drop("label_key"))
    by_point = time_chunk(skewed, low, high, width)
    same_points(by_block.drop("arity"), by_point.drop("base_key"))


def test_chunk_width_must_be_positive(skewed):
    with pytest.raises(ValueError):
        chunk_blocks(pack_points(skewed), 0, 9, -5)


def test_fuse_undoes_chunk(skewed):
    chunks = time_chunk(skewed, 10, 10**12 + 2000, 50)
    clip = skewed.where(F.col("ts").between(10, 10**12 + 2000))
    same_points(chunk_fuse(chunks), clip)
    same_points(chunk_fuse(chunks.drop("base_key")), clip)
    with pytest.raises(ValueError):
        time_chunk(skewed, 0, 1, 0)


def test_chunk_edges_and_negative_ticks(spark):
    points = frame(spark, *[point(labels={"chunkId": "old", "k": "v"}, ts=t, v_long=t) for t in (-20, -11, -10, -1, 0, 10, 20)])
    rows = time_chunk(points, -11, 20, 10).collect()
    assert {r["ts"]: r["labels"]["chunkId"] for r in rows} == {
        -11: "-2", -10: "-1", -1: "-1", 0: "0", 10: "1", 20: "2",
    }
    assert all(r["labels"]["k"] == "v" for r in rows)


def test_bounds_and_extremes(spark):
    points = frame(
        spark,
        *[point("b", ts=t, v_long=1) for t in (1, 50)],
        *[point("a", ts=t, v_long=1) for t in (1, 50)],
        point("z", ts=20, v_long=1),
    )
    assert {r["class"]: r["n_points"] for r in series_count(points).collect()} == {"a": 2, "b": 2, "z": 1}
    both = window_of_all(series_bounds(points)).first()
    assert both["first_series"]["class"] == both["last_series"]["class"] == "a"
    assert (both["first_tick"], both["last_tick"]) == (1, 50)
    one = bounds_cogroup(series_bounds(points)).collect()
    assert [(r["first_tick"], r["last_tick"]) for r in one] == [(1, 50)]
    later = points.union(frame(spark, point("z", ts=60, v_long=1)))
    two = bounds_cogroup(series_bounds(later)).collect()
    assert sorted(((r["first_tick"], r["last_tick"]) for r in two), key=repr) == [(1, None), (None, 60)]
    assert bounds_cogroup(series_bounds(points.where("false"))).collect() == []
    best = top_one(with_selector(series_bounds(later)), [], ["last_tick", "selector"], descending=True)
    assert best.first()["class"] == "z"


def test_group_join(skewed):
    assignment = group_assignment(skewed, ["k"])
    assert assignment.count() == series_count(skewed).count()
    joined = partition_join(skewed, assignment)
    assert joined.count() == skewed.count()
    by_label = joined.select("group_id", F.col("labels")["k"].alias("k")).distinct()
    assert by_label.count() == by_label.select("k").distinct().count() == 4


def key_values(df, bag):
    return sorted((r["k"], e["v"]) for r in df.collect() for e in r[bag])


@pytest.mark.parametrize("rows_per_bag", [10, 1000])
def test_bags_are_filled_one_after_the_other(spark, partitions, rows_per_bag):
    rows = [(1, 5)] * 200 + [(k, v) for k in (2, None) for v in range(14)]
    made = [
        bag_by_key(spark.createDataFrame(rows, "k int, v int").repartition(n), ["k"], rows_per_bag=rows_per_bag)
        for n in (1, 8)
    ]
    sizes = [sorted(((r["k"], r["part"], len(r["bag"])) for r in m.collect()), key=repr) for m in made]
    expected = []
    for k, n in ((1, 200), (2, 14), (None, 14)):
        expected += [(k, p, min(rows_per_bag, n - p * rows_per_bag)) for p in range(-(-n // rows_per_bag))]
    assert sizes[0] == sizes[1] == sorted(expected, key=repr)
    contents = [sorted(((r["k"], r["part"], sorted(e["v"] for e in r["bag"])) for r in m.collect()), key=repr) for m in made]
    assert contents[0] == contents[1]


def test_bags_of_rows_that_differ_only_in_a_map(spark):
    rows = [(1, {"a": i, "b": -i} if i % 2 else {"b": -i, "a": i}) for i in range(40)]
    made = []
    for listed, n in ((rows, 1), (rows[::-1], 8)):
        turned = [(k, dict(reversed(m.items()))) if n == 8 else (k, m) for k, m in listed]
        bags = bag_by_key(spark.createDataFrame(turned, "k int, m map<string,int>").repartition(n), ["k"], rows_per_bag=7)
        made.append({r["part"]: sorted(e["m"]["a"] for e in r["bag"]) for r in bags.collect()})
    assert made[0] == made[1] and [len(made[0][p]) for p in range(6)] == [7, 7, 7, 7, 7, 5]


@pytest.mark.parametrize("rows_per_bag", [10, 1000])
def test_cogroup_keeps_every_row_once(spark, rows_per_bag):
    left = [(1, v) for v in range(50)] + [(2, 0)]
    right = [(1, v) for v in range(30)] + [(3, 7)]
    frames = [spark.createDataFrame(rows, "k int, v int").repartition(4) for rows in (left, right)]
    joined = cogroup_bags(*frames, ["k"], rows_per_bag=rows_per_bag)
    assert key_values(joined, "left_bag") == sorted(left)
    assert key_values(joined, "right_bag") == sorted(right)
    sizes = {r["k"]: (len(r["left_bag"]), len(r["right_bag"])) for r in joined.collect() if r["k"] != 1}
    assert sizes == {2: (1, 0), 3: (0, 1)}


def test_attributes_are_no_part_of_the_key(spark):
    points = frame(spark, point("c", {"k": "v"}, ts=1, v_long=1, attributes={"a": "1"}), point("c", {"k": "v"}, ts=2, v_long=1))
    blocks = pack_points(points)
    assert blocks.count() == 1
    assert blocks.first()["attributes"] == {"a": "1"}


def consecutive(spark, series, blocks, each, at=0):
    """Blocks of one series that follow each other."""
    points = [point("long", {"s": str(s)}, ts=10 * (at + i), v_long=i) for s in range(series) for i in range(blocks * each)]
    return pack_points(frame(spark, *points), each)


def marked(blocks):
    """The points of every block, and whether it went through as it was: only unpacking changes the mark."""
    return {(r["label_key"], tuple((p["ts"], p["v_long"]) for p in r["points"])): r["base"] for r in blocks.collect()}


def test_merge_touches_only_what_overlaps(spark, tmp_path):
    full = consecutive(spark, 2, 100, 8)
    late = frame(spark, *[point("long", {"s": "1"}, ts=t, v_long=-1) for t in (2405, 2407, 2409, 2411)])
    path = str(tmp_path / "blocks")
    stored = full.unionByName(pack_points(late, 8)).withColumn("base", F.lit(77).cast("bigint"))
    write_blocks(stored, path)
    merged = merge_series(read_blocks(spark, path), 8)
    got = marked(merged)
    # 77 in a header field shows the blocks that were not packed again: all but the overlapped block.
    assert sum(base == 77 for base in got.values()) == 199
    again = [(k, points) for (k, points), base in got.items() if base == 0]
    assert {k for k, _ in again} == {"s=1"}
    assert sorted(p for _, points in again for p in points) == sorted(
        [(2400 + 10 * i, 240 + i) for i in range(8)] + [(t, -1) for t in (2405, 2407, 2409, 2411)]
    )
    same_points(unpack_points(merged), unpack_points(stored))
    for key in ("s=0", "s=1"):
        rows = merged.where(F.col("label_key") == key).orderBy("block_no").collect()
        ticks = [p["ts"] for r in rows for p in r["points"]]
        assert ticks == sorted(ticks)
        assert [r["block_no"] for r in rows] == [sum(r["count"] for r in rows[:i]) for i in range(len(rows))]


def test_merge_sweeps_series_of_any_number_of_blocks(spark, monkeypatch):
    """The same merge whether a series is swept in few parts of its time or in many."""
    rng = random.Random(3)
    halves = [
        pack_points(frame(spark, *[point("s", ts=rng.randrange(400), v_long=i) for i in range(60)]), 4),
        pack_points(frame(spark, *[point("s", ts=1000 + 3 * i, v_long=i) for i in range(60)]), 4),
        pack_points(frame(spark, point("s", ts=1000 + 3 * 30, v_long=-1), point("s", ts=5000, v_long=-1)), 4),
    ]
    blocks = reduce(type(halves[0]).unionByName, halves).withColumn("base", F.lit(5).cast("bigint"))
    whole = marked(merge_series(blocks, 4))
    monkeypatch.setattr(block_module, "_SWEEP_PARTS", 7)
    assert marked(merge_series(blocks, 4)) == whole
    # The far part passes but for the block that the single point falls into.
    assert sum(base == 5 for base in whole.values()) >= 13


def test_points_are_shuffled_once(spark):
    points = frame(spark, *[point("s", ts=t, v_long=t) for t in range(100)])
    for packed in (pack_points(points, max_points=7), dump_text(points, optimize=True, run_lines=9)):
        query = packed._jdf.queryExecution()
        query.toRdd().count()
        final = query.executedPlan().toString().split("== Initial Plan ==")[0]
        nodes = [line.strip(" :+-") for line in final.split("\n")]
        assert sum(n.startswith("Exchange rangepartitioning") for n in nodes) == 1
        assert sum(n.startswith("ReusedExchange") for n in nodes) >= 3


def test_ordering_refuses_a_session_that_reuses_no_exchange(spark, skewed):
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        with pytest.raises(RuntimeError, match="exchange.reuse"):
            pack_points(skewed)
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def sessions_by_hand(points, gap):
    found = {}
    for p in sorted(points.collect(), key=lambda p: p["ts"]):
        runs = found.setdefault((p["class"], p["label_key"]), [])
        if runs and p["ts"] - runs[-1][-1] <= gap:
            runs[-1].append(p["ts"])
        else:
            runs.append([p["ts"]])
    return {(*key, n): ticks for key, runs in found.items() for n, ticks in enumerate(runs, 1)}


@pytest.mark.parametrize("batch_rows", ["10000", "3"])
def test_segments_give_the_same_for_any_partitions(spark, skewed, partitions, batch_rows):
    def step(state, frame):
        rows, state = [], list(state)
        for tick in frame["ts"]:
            if state[1] is None or tick - state[1] > 20:
                state[2] += 1
            state[0], state[1] = tick if state[0] is None else state[0], tick
            rows.append(state[2])
        return tuple(state), frame[["class", "label_key", "ts"]].assign(session=rows)

    def merge(a, b):
        return a[0], b[1], a[2] + b[2] - (b[0] - a[1] <= 20)

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)
    try:
        points = with_series_key(skewed)
        function = SegmentFunction(lambda: (None, None, 0), step, merge)
        rows = apply_to_segments(points, function, "class string, label_key string, ts long, session long").collect()
        got = {}
        for r in rows:
            got.setdefault((r["class"], r["label_key"], r["session"]), []).append(r["ts"])
        assert {k: sorted(v) for k, v in got.items()} == sessions_by_hand(points, 20)
        assert apply_to_segments(points.where("false"), function, "class string, session long").collect() == []
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
