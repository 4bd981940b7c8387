"""Uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

Method. Each input partition holds a known number of rows. How many of them go
to each target block is drawn exactly, as the rows of a random matrix with the
partition sizes as row sums and the block sizes as column sums (a multivariate
hypergeometric draw without replacement). A partition permutes its rows locally
and deals them out by its matrix row; the rows are exchanged once; each block
permutes again. The result is a uniformly random permutation, every shard has
its exact size and every slot is known without a global sort.

A shard consists of blocks of ``ROWS_PER_BLOCK`` rows or less, so that a task of the second
permutation holds a bounded number of rows however large a shard is. The matrix is never
built: a task draws the row it needs by halving the list of partitions, drawing how many
rows of each block fall to either half, until one partition is left. Every task draws
the same for the same half, as its seed is the place of the half.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import materialise

#: Rows of a block of a shard at most.
ROWS_PER_BLOCK = 4096
#: Blocks that are drawn together, as the generator's exact draw takes fewer than 10**9 rows of a kind.
_BUNDLE = 512
_GENERATOR_LIMIT = 10**9

_PART, _PLACE, _BLOCK, _KEY = "_part", "_place", "_block", "_key"


def split_evenly(total: int, parts: int) -> np.ndarray:
    """Sizes of ``parts`` parts that differ by one at most, larger ones first."""
    return np.array([total // parts + (i < total % parts) for i in range(parts)], dtype=np.int64)


def draw(rng: np.random.Generator, good: int, bad: int, rows: int) -> int:
    """How many of ``rows`` rows drawn without replacement are among the ``good`` ones, at any size.

    Where the generator's own draw does not reach, the exact law is inverted: probabilities follow from
    the most likely number by their ratios, over twelve standard deviations to either side, beyond
    which lies less than a uniform number can tell from nothing.
    """
    if good < _GENERATOR_LIMIT and bad < _GENERATOR_LIMIT:
        return int(rng.hypergeometric(good, bad, rows))
    total = good + bad
    least, most = max(0, rows - bad), min(good, rows)
    mode = min(most, max(least, (rows + 1) * (good + 1) // (total + 2)))
    spread = math.sqrt(rows / total * good * (bad / total) * ((total - rows) / max(total - 1, 1)))
    reach = int(12 * spread) + 60
    low, high = max(least, mode - reach), min(most, mode + reach)
    k = np.arange(low, high, dtype=np.float64)
    # Of neighbours k and k + 1, how much likelier the second is.
    steps = (
        np.log(good - k) + np.log(rows - k) - np.log(k + 1) - np.log(float(bad - rows) + k + 1)
    )
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    shares = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(shares, rng.random() * shares[-1], side="right"))


def draw_row(rng: np.random.Generator, left: np.ndarray, rows: int) -> np.ndarray:
    """Of ``rows`` rows drawn without replacement from ``left``, how many fall to each block."""
    drawn = np.zeros(len(left), dtype=np.int64)
    rest = int(left.sum())
    for first in range(0, len(left), _BUNDLE):
        if rows == 0:
            break
        bundle = left[first : first + _BUNDLE]
        size = int(bundle.sum())
        rest -= size
        taken = draw(rng, size, rest, rows)
        rows -= taken
        if size < _GENERATOR_LIMIT:
            drawn[first : first + _BUNDLE] = rng.multivariate_hypergeometric(bundle, taken, method="marginals")
            continue
        for i, good in enumerate(bundle.tolist(), first):
            size -= good
            drawn[i] = draw(rng, good, size, taken)
            taken -= int(drawn[i])
    return drawn


class CommunicationMatrix:
    """The matrix for ``sizes`` rows per input partition and ``blocks`` rows per block.

    It keeps one number per partition; a row takes time in proportion to the blocks times the
    logarithm of the partitions, and the memory of the blocks.
    """

    def __init__(self, sizes: dict[int, int], shard_rows: np.ndarray, per_shard: int, seed: int):
        self.parts = sorted(sizes)
        self.before = np.concatenate([[0], np.cumsum([sizes[p] for p in self.parts], dtype=np.int64)])
        self.shard_rows, self.per_shard, self.seed = shard_rows, per_shard, seed

    def blocks(self) -> np.ndarray:
        return np.concatenate([split_evenly(int(n), self.per_shard) for n in self.shard_rows])

    def row(self, part: int) -> np.ndarray:
        """How many rows of an input partition go to each block."""
        at, first, last = int(np.searchsorted(self.parts, part)), 0, len(self.parts)
        left = self.blocks()
        while last - first > 1:
            middle = (first + last) // 2
            rng = np.random.default_rng([self.seed, first, last])
            lower = draw_row(rng, left, int(self.before[middle] - self.before[first]))
            left, first, last = (lower, first, middle) if at < middle else (left - lower, middle, last)
        return left


def shuffle_into_shards(
    docs: DataFrame, shards: int = 16, seed: int = 20_240_607, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """All rows of ``docs`` with ``shard`` (from 0) and ``slot`` (gapless from 0 in the shard).

    Row counts of shards differ by one at most. Columns of ``docs`` named
    ``shard`` or ``slot`` are replaced; null values, equal rows and empty texts
    are rows like any other; an empty table gives no rows.

    The locally permuted input is written once to the shared folder: a lost
    executor cannot change which rows a partition held when it was counted.
    The driver and the tasks hold one number per input partition, tasks also one per block.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("shard", "slot")])
    written = materialise(
        docs.select(whole.alias("row"))
        .withColumn(_PART, F.spark_partition_id())
        .withColumn(_KEY, F.rand(seed))
        .sortWithinPartitions(_KEY)
        .select(
            "row", _PART, F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias(_PLACE)
        )
    )
    sizes = {r[_PART]: r["n"] for r in written.groupBy(_PART).agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    per_shard = max(1, -(-total // (shards * rows_per_block)))
    matrix = docs.sparkSession.sparkContext.broadcast(
        CommunicationMatrix(sizes, split_evenly(total, shards), per_shard, seed)
    )

    @F.pandas_udf("int")
    def block_of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        last, until = None, None
        for part, place in batches:
            out = np.empty(len(part), dtype=np.int32)
            for p in part.unique():
                if p != last:
                    last, until = p, np.cumsum(matrix.value.row(int(p)))
                mine = (part == p).to_numpy()
                out[mine] = np.searchsorted(until, place.to_numpy()[mine], side="right")
            yield pd.Series(out)

    again = F.xxhash64(F.lit(seed + 1), _PART, _PLACE)
    rank = F.row_number().over(Window.partitionBy(_BLOCK).orderBy(again, _PART, _PLACE))
    # Arithmetic of split_evenly: rows of the blocks before this one in its shard.
    shard, nth = F.floor(F.col(_BLOCK) / per_shard).cast("int"), F.col(_BLOCK) % per_shard
    in_shard = F.lit(total // shards) + (shard < total % shards).cast("long")
    before = nth * F.floor(in_shard / per_shard) + F.least(nth, in_shard % per_shard)
    return (
        written.withColumn(_BLOCK, block_of(_PART, _PLACE))
        .withColumn(_KEY, rank)
        .select(
            "row.*", shard.alias("shard"), (before + F.col(_KEY) - 1).cast("long").alias("slot")
        )
    )
