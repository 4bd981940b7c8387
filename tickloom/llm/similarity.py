"""Join of documents by the Jaccard similarity of their word n-grams, with Bayesian pruning.

Method. MinHash bands give candidate pairs. Candidates are compared a few
MinHash values at a time; after n values with m agreements the posterior
probability that the similarity reaches the threshold, with a uniform prior, is
a tail of the Beta(m + 1, n - m + 1) distribution, and a pair is dropped as soon
as it falls below ``TOLERANCE``. What is left is verified on the n-gram sets.

How this stays linear in rows:

* Equal texts form one class; everything else works on one text per class.
* A bucket of a band is compared inside one task, large buckets by pairs of
  blocks. Only the edges of a spanning forest leave the task, not its pairs.
* The components of those edges are groups; texts are brought together once per
  group (large ones again by pairs of blocks), pruned with all MinHash values
  and verified. Again only spanning edges leave, with the number of links of
  each text, which counts every linked document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import row_of
from tickloom.llm.components import connected_components
from tickloom.session import materialise

WORDS = 5
#: Similarity of at least 4 / 5, as whole numbers so that the test is exact.
THRESHOLD = (4, 5)
#: Bands of four values: a pair at the threshold shares none with probability 3e-6.
BANDS, BAND_VALUES = 24, 4
VALUES = BANDS * BAND_VALUES
#: Values whose low bytes ride along in the buckets.
FIRST_VALUES = 32
STEP = 16
TOLERANCE = 1e-6

#: Texts of a bucket, and of a group, that are compared in one piece.
BUCKET_BLOCK = 512
GROUP_BLOCK = 256

_rng = np.random.default_rng(5_081_320)
_FACTORS = _rng.integers(0, 1 << 31, VALUES, dtype=np.uint32) * 2 + 1
_TERMS = _rng.integers(0, 1 << 32, VALUES, dtype=np.uint32)
_PLACES = _rng.integers(0, 1 << 63, WORDS, dtype=np.uint64) * 2 + 1
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SMALL = np.frombuffer(
    bytes(b + 32 if 65 <= b <= 90 else 0 if b == 32 or 9 <= b <= 13 else b for b in range(256)), np.uint8
)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(text: str) -> np.ndarray:
    """64-bit hashes of the words of a text: runs between ASCII white space, A-Z as a-z."""
    data = _SMALL[np.frombuffer(text.encode(), np.uint8)]
    inside = data != 0
    if not inside.any():
        return np.empty(0, np.uint64)
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    lengths = edges[1::2] - edges[::2]
    letters = data[inside].astype(np.uint64) + np.uint64(1)
    begins = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - np.repeat(begins, lengths)
    powers = np.multiply.accumulate(np.full(int(lengths.max()), _BASE, np.uint64))
    return _mixed(np.add.reduceat(letters * powers[place], begins) + lengths.astype(np.uint64) * _PLACES[0])


def shingles(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the different runs of five words; a shorter text is one run."""
    words = _word_hashes(text or "")
    n = min(WORDS, len(words))
    if n == 0:
        return words
    total = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        total += words[i : len(words) - n + 1 + i] * _PLACES[i]
    return np.unique(_mixed(total + np.uint64(n)))


def min_hashes(grams: np.ndarray) -> np.ndarray:
    """``VALUES`` MinHash values of a set, 16 bits each."""
    short = (grams >> np.uint64(32)).astype(np.uint32)
    least = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 4096):
        part = short[at : at + 4096, None] * _FACTORS + _TERMS
        np.minimum(least, part.min(axis=0), out=least)
    return (least & 0xFFFF).astype("<u2")


@cache
def least_agreements(n: int, tolerance: float = TOLERANCE) -> int:
    """The fewest agreements in ``n`` values with which a pair may still reach the threshold."""
    t = THRESHOLD[0] / THRESHOLD[1]
    posterior = 0.0
    for m in range(n + 1):
        posterior += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        if posterior >= tolerance:
            return m
    return n


def surviving_pairs(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of two signature matrices that no step drops; i < j where ``same``."""
    left, right = [], []
    rows = max(1, (1 << 22) // max(1, len(b) * STEP))
    for at in range(0, len(a), rows):
        part = a[at : at + rows]
        agreed = (part[:, None, :STEP] == b[None, :, :STEP]).sum(axis=2, dtype=np.int16)
        i, j = np.nonzero(agreed >= least_agreements(STEP))
        if same:
            ahead = i + at < j
            i, j = i[ahead], j[ahead]
        found = agreed[i, j]
        for n in range(STEP, a.shape[1], STEP):
            found = found + (part[i, n : n + STEP] == b[j, n : n + STEP]).sum(axis=1, dtype=np.int16)
            keep = found >= least_agreements(n + STEP)
            i, j, found = i[keep], j[keep], found[keep]
        left.append(i + at)
        right.append(j)
    return np.concatenate(left), np.concatenate(right)


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest member of each member's component, for pairs of members."""
    root = np.arange(n)
    while True:
        before = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            return root


def sketch(docs: DataFrame, carry: list[str] | None) -> DataFrame:
    """``row``, ``id``, ``class`` (digest of the text) and MinHash values; written once.

    Values are null for a text without words.
    """
    given = docs.select(
        row_of(docs, carry),
        F.monotonically_increasing_id().alias("id"),
        text_class().alias("class"),
        F.col("text"),
        F.lit(None).cast("binary").alias("first"),
        F.lit(None).cast("binary").alias("values"),
    )
    kept = given.drop("text").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            firsts, values = [], []
            for text in batch.column(batch.schema.names.index("text")).to_pylist():
                grams = shingles(text)
                signature = min_hashes(grams) if len(grams) else None
                values.append(None if signature is None else signature.tobytes())
                firsts.append(
                    None if signature is None else (signature[:FIRST_VALUES] & 0xFF).astype(np.uint8).tobytes()
                )
            new = {"first": pa.array(firsts, pa.binary()), "values": pa.array(values, pa.binary())}
            yield pa.RecordBatch.from_arrays(
                [new[n] if n in new else batch.column(batch.schema.names.index(n)) for n in kept.names],
                names=kept.names,
            )

    return materialise(given.mapInArrow(run, kept))


def text_class() -> Column:
    return F.unhex(F.md5(F.encode(F.coalesce("text", F.lit("")), "UTF-8")))


def _in_blocks(rows: DataFrame, size: int, member: str) -> DataFrame:
    """``rows`` once per pair of blocks (``i`` <= ``j``) that its own ``block`` belongs to.

    ``rows`` has ``n``, the size of its group. Small groups are one block.
    """
    blocks = F.ceil(F.col("n") / size)
    own = F.pmod(F.xxhash64(F.lit(17), member), blocks).cast("int")
    return (
        rows.withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), blocks.cast("int") - 1)))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .drop("n", "other")
    )


def _by_task(rows: DataFrame, key: list[str]) -> DataFrame:
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, *key).sortWithinPartitions(*key)


def _runs(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Rows of sorted batches by key, as lists by column."""
    at, held = None, {}
    for batch in batches:
        names = batch.schema.names
        columns = [batch.column(i).to_pylist() for i in range(len(names))]
        keys = list(zip(*(columns[names.index(k)] for k in key), strict=True))
        start = 0
        for end in range(1, len(keys) + 1):
            if end < len(keys) and keys[end] == keys[start]:
                continue
            if keys[start] != at:
                if at is not None:
                    yield at, held
                at, held = keys[start], {n: [] for n in names}
            for n, column in zip(names, columns, strict=True):
                held[n].extend(column[start:end])
            start = end
    if at is not None:
        yield at, held


def _split(rows: dict[str, list]) -> tuple[np.ndarray, np.ndarray, bool]:
    """Places of the rows of block i and of block j, and whether the blocks are the same."""
    block = np.array(rows["block"])
    if rows["i"][0] == rows["j"][0]:
        every = np.arange(len(block))
        return every, every, True
    return np.flatnonzero(block == rows["i"][0]), np.flatnonzero(block == rows["j"][0]), False


def _pairs(matrix: np.ndarray, rows: dict[str, list]) -> tuple[np.ndarray, np.ndarray]:
    left, right, same = _split(rows)
    if not len(left) or not len(right):
        none = np.empty(0, np.int64)
        return none, none
    i, j = surviving_pairs(matrix[left], matrix[right], same)
    return left[i], right[j]


def _bucket_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: tuple[list, list] = ([], [])
    for _, rows in _runs(batches, ["band", "key", "i", "j"]):
        if len(rows["node"]) < 2:
            continue
        i, j = _pairs(np.frombuffer(b"".join(rows["first"]), np.uint8).reshape(-1, FIRST_VALUES), rows)
        node = np.array(rows["node"])
        order = np.argsort(node)
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        root = _roots(len(node), place[i], place[j])
        linked = root != np.arange(len(node))
        out[0].extend(node[order][linked].tolist())
        out[1].extend(node[order][root[linked]].tolist())
        if len(out[0]) > 50_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["a", "b"])
            out = ([], [])
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["a", "b"])


def _common(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of pairs of sets."""
    if len(i) < 8 * len(sets):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j, strict=True)])
    # Many pairs of few sets: a product of incidence matrices, over grams that two sets have.
    grams, gram_of, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    shared = np.flatnonzero(count > 1)
    column = np.full(len(grams), -1)
    column[shared] = np.arange(len(shared))
    places = column[gram_of]
    total = np.zeros((len(sets), len(sets)), np.float32)
    width = 8192
    for first in range(0, len(shared), width):
        mine = (places >= first) & (places < first + width)
        part = np.zeros((len(sets), min(width, len(shared) - first)), np.float32)
        part[owner[mine], places[mine] - first] = 1
        total += part @ part.T
    return total[i, j].astype(np.int64)


def _group_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["node", "root", "links"]
    out: tuple[list, list, list] = ([], [], [])
    for _, rows in _runs(batches, ["component", "i", "j"]):
        if len(rows["node"]) < 2:
            continue
        i, j = _pairs(np.frombuffer(b"".join(rows["values"]), "<u2").reshape(-1, VALUES), rows)
        if len(i):
            sets = [shingles(t) for t in rows["text"]]
            size = np.array([len(s) for s in sets])
            common = _common(sets, i, j)
            real = common * THRESHOLD[1] >= THRESHOLD[0] * (size[i] + size[j] - common)
            i, j = i[real], j[real]
        if not len(i):
            continue
        node, docs = np.array(rows["node"]), np.array(rows["n_docs"])
        links = np.zeros(len(node), np.int64)
        np.add.at(links, i, docs[j])
        np.add.at(links, j, docs[i])
        order = np.argsort(node)
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        root = _roots(len(node), place[i], place[j])
        seen = np.flatnonzero(links[order] > 0)
        out[0].extend(node[order][seen].tolist())
        out[1].extend(node[order][root[seen]].tolist())
        out[2].extend(links[order][seen].tolist())
        if len(out[0]) > 50_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)
            out = ([], [], [])
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=names)


def join_similar(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``carry`` of ``docs``, or all), ``id``, ``class_id``, ``n_links``, ``first``.

    Two documents are linked when the sets of their runs of five words have a
    Jaccard similarity of at least 4/5. ``n_links`` counts the linked documents,
    equal texts included; ``class_id`` is the smallest ``doc_id`` of the
    component of links; ``first`` marks the one row of the component with the
    smallest ``doc_id`` (nulls last, then ``id``).

    Words are runs between ASCII white space, with A-Z taken as a-z; a text of
    fewer than five words is one run. Texts without words (null, empty or white
    space) have no links and a class each of their own, and a class whose
    ``doc_id`` are all null has a null ``class_id``. Rows with equal texts, also
    repeated rows, are linked. Other columns may have any names. An empty table
    gives no rows.
    """
    sketched = sketch(docs, carry)
    order = F.struct(F.col("row.doc_id").isNull().alias("none"), F.col("row.doc_id").alias("doc_id"), F.col("id").alias("id"))
    classes = materialise(
        sketched.where(F.col("values").isNotNull())
        .groupBy("class")
        .agg(
            F.any_value("values").alias("values"),
            F.any_value("first").alias("first"),
            F.count("*").alias("n_docs"),
            F.min(order).alias("least"),
        )
        .withColumn("node", F.monotonically_increasing_id())
    )
    groups = connected_components(candidate_edges(classes))
    linked = verified_links(classes, groups, docs)
    components = connected_components(linked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = linked.groupBy("node").agg(F.sum("links").alias("links")).withColumnRenamed("node", "l_node")
    of_class = materialise(
        classes.select("class", "node", "n_docs", "least")
        .join(components.withColumnRenamed("node", "c_node"), F.col("node") == F.col("c_node"), "left")
        .join(links, F.col("node") == F.col("l_node"), "left")
        .select(
            "class",
            "least",
            F.coalesce("component", "node").alias("component"),
            (F.coalesce("links", F.lit(0)) + F.col("n_docs") - 1).alias("n_links"),
        )
    )
    least = of_class.groupBy("component").agg(F.min("least").alias("head")).withColumnRenamed("component", "of")
    decided = of_class.join(least, F.col("component") == F.col("of")).select(
        F.col("class").alias("of_class"), "head", "n_links"
    )
    joined = sketched.drop("first", "values").join(decided, F.col("class") == F.col("of_class"), "left")
    alone = F.col("head").isNull()
    return joined.select(
        "row",
        "id",
        F.when(alone, F.col("row.doc_id")).otherwise(F.col("head.doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        (alone | (F.col("head.id") == F.col("id"))).alias("first"),
    )


def candidate_edges(classes: DataFrame) -> DataFrame:
    """``a`` and ``b``: a spanning forest of the pairs that share a band and survive the pruning."""
    width = 2 * BAND_VALUES
    banded = classes.select(
        "node",
        F.col("first"),
        "values",
        F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band"),
    ).select("node", "first", "band", F.expr(f"substring(values, band * {width} + 1, {width})").alias("key"))
    many = banded.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    many = many.select(F.col("band").alias("m_band"), F.col("key").alias("m_key"), "n")
    rows = banded.join(many, (F.col("band") == F.col("m_band")) & (F.col("key") == F.col("m_key"))).drop(
        "m_band", "m_key"
    )
    key = ["band", "key", "i", "j"]
    tasks = _in_blocks(rows, BUCKET_BLOCK, "node")
    return _by_task(tasks, key).mapInArrow(_bucket_edges, "a long, b long").distinct()


def verified_links(classes: DataFrame, groups: DataFrame, docs: DataFrame) -> DataFrame:
    """``node``, ``root`` and ``links`` of texts with a link; written once.

    A row comes from each pair of blocks; roots are spanning edges of the links.
    """
    sizes = groups.groupBy("component").agg(F.count("*").alias("n")).withColumnRenamed("component", "of")
    members = (
        groups.join(sizes, F.col("component") == F.col("of"))
        .select(F.col("node").alias("m_node"), "component", "n")
        .join(classes, F.col("m_node") == F.col("node"))
        .select("node", "component", "n", "n_docs", "values", F.col("class").alias("of_class"))
    )
    texts = docs.groupBy(text_class().alias("class")).agg(F.any_value("text").alias("text"))
    rows = members.join(texts, F.col("of_class") == F.col("class")).drop("of_class", "class")
    key = ["component", "i", "j"]
    tasks = _in_blocks(rows, GROUP_BLOCK, "node")
    return materialise(_by_task(tasks, key).mapInArrow(_group_links, "node long, root long, links long"))


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each component of linked documents, with the columns of ``docs``."""
    return join_similar(docs).where("first").select("row.*")
