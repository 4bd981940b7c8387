"""Whitening of embeddings with MLlib block matrices.

Method. Vectors become whole numbers ``x = floor(1024 c) + 100000``, whose sums
are exact. Rows are gathered into blocks where they are read and the blocks are
numbered, which indexes the rows; a block is centred exactly (``(n x - S) / n`` with
whole numbers above the line) whenever it is used. The scatter matrix is the transposed
``BlockMatrix`` times itself, its eigenvectors are found by one local ``eigh``,
and a second product of block matrices projects all rows.

``BlockMatrix.multiply`` cuts the rows of a product over the square root of the
partitions only, as it expects matrices that are as wide as high. So the middle
dimension of the scatter product is cut in splits of ``BLOCKS_PER_SPLIT`` blocks,
and for the projection block k is laid at row k div g and column k mod g, against a
block diagonal matrix that holds the whitening matrix g times; that is the same product
in a square layout, with a task for every few blocks. The last block of a partition is filled up with
zero rows, which add nothing.

Through the driver go one row per partition, the numbers of the blocks (MLlib
plans products there) and matrices of dimension x dimension.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tickloom.session import materialise

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
BLOCK_BYTES = 4 << 20
BLOCKS_PER_SPLIT = 16
#: Buffered vectors of unusual lengths are written out beyond so many bytes.
_BUFFER_BYTES = 64 << 20
_LARGEST = 2.0**48

_Batches = Iterator[pa.RecordBatch]
_INDEXED = T.StructType(
    [
        T.StructField(
            "index",
            T.StructType([T.StructField("i", T.LongType(), False), T.StructField("j", T.LongType(), False)]),
        ),
        T.StructField("matrix", MatrixUDT()),
    ]
)
_RESULT = (
    "component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whiten(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    components: int = COMPONENTS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """A row per usable vector and component: the vector's place on that component, in unit variance.

    Columns: the id, ``component`` from 1 by falling eigenvalue, ``n``, ``deviation`` (the sum over
    dimensions of (n x - S)^2), ``whitened``, ``explained`` (the component's share of the trace) and
    ``identity_error`` (largest entry of the covariance of ``whitened`` minus the identity, measured on
    all rows).

    Vectors that are null or empty, or hold a null or a non-finite entry, are left out. So are vectors
    of another length than the commonest (of equally common ones the longest): they lack
    entries, or have none to set them against. Ids may be null and may repeat; each row counts. A
    component without variance (fewer distinct vectors than dimensions) has null ``whitened`` and does not
    enter ``identity_error``; where no vector varies, ``explained`` and ``identity_error`` are null. No
    usable vector: no rows. Other columns are not read. Entries of 2^48 / 1024 or more,
    and a ``deviation`` beyond 2^63, fail the query.
    """
    spark = vectors.sparkSession
    id_type = vectors.schema[id_column].dataType
    schema = T.StructType([T.StructField(id_column, id_type), *T.StructType.fromDDL(_RESULT)])
    blocks = materialise(_blocks(vectors, id_column, vector_column, id_type, block_bytes))
    lengths = blocks.groupBy("dim").agg(F.sum("n").alias("n"))
    chosen = lengths.orderBy(F.desc("n"), F.desc("dim")).first()
    if chosen is None:
        return spark.createDataFrame([], schema)
    dim, n = chosen["dim"], chosen["n"]
    rows_per_block = _rows_per_block(dim, block_bytes)
    blocks, count = _numbered(blocks.where(F.col("dim") == dim))
    sums = _sums(blocks, dim)

    values, axes = np.linalg.eigh(_covariance(blocks, count, dim, n, sums, rows_per_block))
    values, axes = values[::-1], axes[:, ::-1]
    trace, k = float(values.sum()), min(components, dim)
    varies = [bool(e > max(values[0], 0) * dim * np.finfo(float).eps) for e in values[:k]]
    signs = np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(dim)])
    matrix = (axes * signs)[:, :k] / np.sqrt(np.where(varies, values[:k], 1.0)) * varies

    projected = _project(blocks, count, dim, n, sums, rows_per_block, matrix)
    rows = materialise(_rows(blocks, projected, n, sums, dim))
    error = _identity_error(rows, varies)
    explained = [max(float(e), 0.0) / trace if trace > 0 else None for e in values[:k]]
    exploded = rows.select("id", "deviation", F.posexplode("z").alias("c", "z"))

    def of(per_component: list, kind: str) -> F.Column:
        return F.get(F.array(*[F.lit(v).cast(kind) for v in per_component]), F.col("c"))

    return exploded.select(
        F.col("id").alias(id_column),
        (F.col("c") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        F.when(of(varies, "boolean"), F.col("z")).alias("whitened"),
        of(explained, "double").alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def _rows_per_block(dim: int, block_bytes: int) -> int:
    return max(1, block_bytes // (8 * dim))


def _blocks(
    vectors: DataFrame, id_column: str, vector_column: str, id_type: T.DataType, block_bytes: int
) -> DataFrame:
    """A row per block: ``part`` and ``seq``, ``dim``, ``n``, ``ids``, column sums, and ``x`` as bytes."""
    v = F.col("v")
    unusable = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    usable = vectors.select(
        F.col(id_column).alias("id"), F.col(vector_column).cast("array<double>").alias("v")
    ).where(v.isNotNull() & (F.size(v) > 0) & ~unusable)
    schema = T.StructType.fromDDL("part int, seq long, dim int, n long, sums array<long>, x binary")
    schema.add("ids", T.ArrayType(id_type))
    return usable.mapInArrow(_gather(to_arrow_schema(schema), block_bytes), schema)


def _gather(schema: pa.Schema, block_bytes: int) -> Callable[[_Batches], _Batches]:
    def run(batches: _Batches) -> _Batches:
        part, seq = TaskContext.get().partitionId(), {}
        waiting: dict[int, tuple[list[pa.Array], list[np.ndarray]]] = {}

        def full(dim: int, least: int) -> _Batches:
            """Blocks of the vectors of one length that wait, but for a rest smaller than ``least``."""
            rows = _rows_per_block(dim, block_bytes)
            ids, x = pa.concat_arrays(waiting[dim][0]), np.concatenate(waiting[dim][1])
            at = 0
            while len(x) - at >= min(least, rows) and at < len(x):
                block = x[at : at + rows]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int32()),
                        pa.array([seq.setdefault(dim, 0)], pa.int64()),
                        pa.array([dim], pa.int32()),
                        pa.array([len(block)], pa.int64()),
                        pa.array([block.sum(axis=0)], pa.list_(pa.int64())),
                        pa.array([block.tobytes()], pa.binary()),
                        pa.ListArray.from_arrays(pa.array([0, len(block)], pa.int32()), ids.slice(at, len(block))),
                    ],
                    schema=schema,
                )
                seq[dim] += 1
                at += rows
            waiting[dim] = ([ids.slice(at)], [x[at:]])

        for batch in batches:
            offsets = batch.column("v").offsets.to_numpy()
            flat = batch.column("v").values.to_numpy()
            lengths = np.diff(offsets)
            for dim in np.unique(lengths).tolist():
                which = np.flatnonzero(lengths == dim)
                scaled = np.floor(flat[offsets[which][:, None] + np.arange(dim)] * SCALE)
                if scaled.size and np.abs(scaled).max() >= _LARGEST:
                    raise OverflowError("an entry of a vector is too large to be counted exactly")
                ids, x = waiting.setdefault(dim, ([], []))
                ids.append(batch.column("id").take(pa.array(which)))
                x.append(scaled.astype(np.int64) + SHIFT)
                if sum(map(len, x)) >= _rows_per_block(dim, block_bytes):
                    yield from full(dim, _rows_per_block(dim, block_bytes))
            if sum(a.nbytes for _, x in waiting.values() for a in x) > _BUFFER_BYTES:
                for dim in list(waiting):
                    yield from full(dim, 1)
        for dim in list(waiting):
            yield from full(dim, 1)

    return run


def _numbered(blocks: DataFrame) -> tuple[DataFrame, int]:
    """Blocks with a ``number`` without gaps, and how many there are; the driver sees a row per partition."""
    starts, total = [], 0
    for row in blocks.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect():
        starts.append((row["part"], total))
        total += row["n"]
    first = F.broadcast(blocks.sparkSession.createDataFrame(starts, "part int, first long"))
    return blocks.join(first, "part").withColumn("number", F.col("first") + F.col("seq")), total


def _sums(blocks: DataFrame, dim: int) -> list[int]:
    each = blocks.select(F.posexplode("sums").alias("at", "s"))
    rows = each.groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    by_place = {r["at"]: int(r["s"]) for r in rows}
    return [by_place[i] for i in range(dim)]


def _off_mean(x: bytes, dim: int, n: int, sums: list[int]) -> np.ndarray:
    """``n x - S`` of every row, exact."""
    mean = np.array([s // n for s in sums], np.int64)
    rest = np.array([s - n * (s // n) for s in sums], np.int64)
    from_mean = np.frombuffer(x, np.int64).reshape(-1, dim) - mean
    if float(np.abs(from_mean).max(initial=0)) * n >= 2.0**62:
        raise OverflowError("deviations do not fit a long")
    return from_mean * n - rest


def _centred(
    blocks: DataFrame, dim: int, n: int, sums: list[int], rows_per_block: int, index: tuple[str, str]
) -> DataFrame:
    """Blocks of centred rows under the given block index, as ``createBlockMatrix`` takes them."""
    schema = to_arrow_schema(_INDEXED)

    def run(batches: _Batches) -> _Batches:
        for batch in batches:
            for i, j, x in zip(*(batch.column(c).to_pylist() for c in ("i", "j", "x")), strict=True):
                matrix = np.zeros((rows_per_block, dim))
                centred = _off_mean(x, dim, n, sums) / n
                matrix[: len(centred)] = centred
                yield _matrix_batch(i, j, matrix, schema)

    i, j = index
    return blocks.selectExpr(f"{i} AS i", f"{j} AS j", "x").mapInArrow(run, _INDEXED)


def _matrix_batch(i: int, j: int, matrix: np.ndarray, schema: pa.Schema) -> pa.RecordBatch:
    rows, columns = matrix.shape
    index_type, matrix_type = schema.field("index").type, schema.field("matrix").type
    # Column by column, as MLlib keeps its matrices.
    values = pa.ListArray.from_arrays(pa.array([0, matrix.size], pa.int32()), matrix.ravel(order="F"))
    none = pa.array([None], pa.list_(pa.int32()))
    parts = [pa.array([1]), pa.array([rows]), pa.array([columns]), none, none, values, pa.array([False])]
    dense = [part.cast(field.type) for part, field in zip(parts, matrix_type, strict=True)]
    place = pa.StructArray.from_arrays([pa.array([i]), pa.array([j])], fields=list(index_type))
    return pa.RecordBatch.from_arrays(
        [place, pa.StructArray.from_arrays(dense, fields=list(matrix_type))], schema=schema
    )


def _covariance(
    blocks: DataFrame, count: int, dim: int, n: int, sums: list[int], rows_per_block: int
) -> np.ndarray:
    tall = callMLlibFunc(
        "createBlockMatrix",
        _centred(blocks, dim, n, sums, rows_per_block, ("number", "0L")),
        rows_per_block,
        dim,
        count * rows_per_block,
        dim,
    )
    splits = -(-count // BLOCKS_PER_SPLIT)
    scatter = BlockMatrix(tall.transpose().multiply(tall, splits), dim, dim).toLocalMatrix().toArray()
    return (scatter + scatter.T) / 2 / n


def _project(
    blocks: DataFrame,
    count: int,
    dim: int,
    n: int,
    sums: list[int],
    rows_per_block: int,
    matrix: np.ndarray,
) -> DataFrame:
    """``number`` of every block and its rows in the new axes, as an array of arrays."""
    spark, k = blocks.sparkSession, matrix.shape[1]
    side = math.isqrt(count - 1) + 1
    high = -(-count // side)
    square = callMLlibFunc(
        "createBlockMatrix",
        _centred(blocks, dim, n, sums, rows_per_block, (f"number DIV {side}", f"number % {side}")),
        rows_per_block,
        dim,
        high * rows_per_block,
        side * dim,
    )
    diagonal = callMLlibFunc(
        "createBlockMatrix", _diagonal(spark, side, matrix), dim, k, side * dim, side * k
    )
    product = callMLlibFunc("getMatrixBlocks", square.multiply(diagonal))

    def run(batches: _Batches) -> _Batches:
        for batch in batches:
            values = batch.column("values")
            for at, transposed in enumerate(batch.column("transposed").to_pylist()):
                flat = values[at].values.to_numpy()
                rows = flat.reshape(-1, k) if transposed else flat.reshape(k, -1).T
                nested = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, rows.size + 1, k), pa.int32()),
                    pa.array(np.ascontiguousarray(rows).ravel()),
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("number").slice(at, 1),
                        pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), nested),
                    ],
                    names=["number", "z"],
                )

    plain = T.StructType.fromDDL("number long, values array<double>, transposed boolean")
    return product.mapInArrow(_plain_blocks(side, to_arrow_schema(plain)), plain).mapInArrow(
        run, "number long, z array<array<double>>"
    )


def _plain_blocks(side: int, schema: pa.Schema) -> Callable[[_Batches], _Batches]:
    """Blocks of a product by the number they had, with the fields of the matrix type as columns."""

    def run(batches: _Batches) -> _Batches:
        for batch in batches:
            index, matrix = batch.column(0), batch.column(1)
            i, j = (np.asarray(index.field(c), np.int64) for c in (0, 1))
            columns = [pa.array(i * side + j), matrix.field("values"), matrix.field("isTransposed")]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return run


def _diagonal(spark: SparkSession, side: int, matrix: np.ndarray) -> DataFrame:
    schema = to_arrow_schema(_INDEXED)

    def run(batches: _Batches) -> _Batches:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                yield _matrix_batch(i, i, matrix, schema)

    return spark.range(side).mapInArrow(run, _INDEXED)


def _rows(blocks: DataFrame, projected: DataFrame, n: int, sums: list[int], dim: int) -> DataFrame:
    """Id, deviation and new coordinates of every row."""
    ids = blocks.select("number", "ids", "x")
    schema = T.StructType.fromDDL("number long, deviation array<long>")
    schema.add("ids", blocks.schema["ids"].dataType)
    arrow = to_arrow_schema(schema)

    def run(batches: _Batches) -> _Batches:
        for batch in batches:
            for at, x in enumerate(batch.column("x").to_pylist()):
                off = _off_mean(x, dim, n, sums)
                if float((off.astype(float) ** 2).sum(axis=1).max(initial=0)) >= 2.0**63:
                    raise OverflowError("deviations do not fit a long")
                deviation = pa.array([(off * off).sum(axis=1)], pa.list_(pa.int64()))
                columns = [batch.column("number").slice(at, 1), deviation, batch.column("ids").slice(at, 1)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    known = ids.mapInArrow(run, schema)
    # The product may have more rows than the block, which was filled up.
    placed = known.join(projected, "number").withColumn("z", F.slice("z", 1, F.size("ids")))
    return placed.select(F.inline(F.arrays_zip("ids", "deviation", "z"))).withColumnRenamed("ids", "id")


def _identity_error(rows: DataFrame, varies: list[bool]) -> float | None:
    at = [i for i, v in enumerate(varies) if v]
    if not at:
        return None
    z = lambda i: F.get("z", F.lit(i))
    pairs = [(i, j) for i in at for j in at if i <= j]
    entries = rows.agg(*[F.covar_pop(z(i), z(j)).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(entries[f"c{i}_{j}"] - (i == j)) for i, j in pairs)
