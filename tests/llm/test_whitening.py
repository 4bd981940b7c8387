"""Whitening against numpy on whole small tables."""

import random

import numpy as np
import pytest

from tickloom.llm import catalogue
from tickloom.llm.whitening import whiten

SCHEMA = "vec_id long, embedding array<double>, label int, id string, number string, z string, n string"


def table(spark, vectors, partitions=3):
    rows = [(i, v, 1, "c", "c", "c", "c") for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def expected(vectors, components=8):
    """Whitened rows by plain numpy, and what goes with them."""
    x = [[int(np.floor(1024 * c)) + 100_000 for c in v] for _, v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    off = [[n * c - s for c, s in zip(row, sums)] for row in x]
    centred = np.array(off) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    return [sum(c * c for c in row) for row in off], centred @ axes[:, :components], values


def check(rows, vectors, components):
    deviation, projected, values = expected(vectors, components)
    by_id = {}
    for r in rows:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    assert len(rows) == len(vectors) * components and {r.n for r in rows} == {len(vectors)}
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9
    got = np.array([[by_id[i][c + 1].whitened for c in range(components)] for i, _ in vectors])
    wanted = projected / np.sqrt(values[:components])
    flip = np.sign((got * wanted).sum(axis=0))
    assert np.abs(got * flip - wanted).max() < 1e-7
    assert [by_id[i][1].deviation for i, _ in vectors] == deviation
    for c in range(components):
        assert by_id[vectors[0][0]][c + 1].explained == pytest.approx(values[c] / values.sum(), rel=1e-9)


@pytest.mark.parametrize("block_bytes", [4 << 20, 800])
def test_whole_table_by_blocks_of_any_size(spark, block_bytes):
    rng = np.random.default_rng(5)
    mixed = rng.normal(size=(700, 10)) @ rng.normal(size=(10, 10)) + 3
    vectors = [(i, row.tolist()) for i, row in enumerate(mixed)]
    vectors += [(1000 + i, vectors[0][1]) for i in range(300)]
    check(whiten(table(spark, vectors, 7), block_bytes=block_bytes).collect(), vectors, 8)


def test_unusable_vectors_are_left_out(spark):
    rng = random.Random(2)
    good = [(i, [rng.gauss(0, 1) for _ in range(3)]) for i in range(50)]
    inf, nan = float("inf"), float("nan")
    bad = [(90, None), (91, []), (92, [1.0, None, 2.0]), (93, [1.0, inf, 2.0]), (94, [nan, 0.0, 0.0])]
    bad += [(95, [-inf, 0.0, 0.0]), (96, [1.0]), (97, [1.0, 2.0, 3.0, 4.0])]
    check(whiten(table(spark, good + bad)).collect(), good, 3)


def test_ids_may_repeat_and_be_null(spark):
    rows = whiten(table(spark, [(None, [1.0, 2.0]), (1, [2.0, 1.0]), (1, [2.0, 1.0]), (2, [5.0, 9.0])])).collect()
    assert sorted(str(r.vec_id) for r in rows) == sorted(["None"] * 2 + ["1"] * 4 + ["2"] * 2)


def test_axes_without_variance_have_no_place(spark):
    rows = whiten(table(spark, [(i, [float(i), 7.0, 2.0 * i]) for i in range(20)])).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in rows)
    assert rows[0].identity_error < 1e-9
    same = whiten(table(spark, [(i, [0.5, 7.0]) for i in range(5)])).collect()
    assert len(same) == 10
    assert all((r.whitened, r.explained, r.identity_error, r.deviation) == (None, None, None, 0) for r in same)


def test_no_usable_vector_gives_no_rows(spark):
    assert whiten(table(spark, [(1, None), (2, [])])).collect() == []
    assert whiten(table(spark, [(1, [1.0])]).where("false")).collect() == []


def test_too_large_entries_fail(spark):
    with pytest.raises(Exception, match="too large to be counted"):
        whiten(table(spark, [(1, [1e300]), (2, [1.0])])).collect()


def test_query_is_whole(spark):
    folder = "/root/testdata/sf0.001"
    vectors = [(r.vec_id, list(r.embedding)) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    check(catalogue.queries()["op13_embedding_whitening"](spark, folder).collect(), vectors, 8)
