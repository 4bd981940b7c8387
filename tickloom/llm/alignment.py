"""Alignment of the tokens that two tokenizers make of the same text.

Method. Documents are shuffled by their full text, so that copies meet, and each distinct text is
tokenised and aligned once. Tokens of a text are ranges of its bytes. Every end of a token of either
tokenizer cuts the text; between two cuts lies the overlap of exactly one token of the first and one of
the second, so the cuts list all links, and cuts that both make bound the groups.

A task puts texts into blocks and keeps the id pairs of a block in a list of its own, so a pair is
counted, and its total comes back, once per block and not once per text. Totals weigh a text by its
copies. A frequent pair has as many rows as there are blocks. Measures are joined to the
documents by the digest of the text; adaptive execution splits that join where a text has very many copies.

Python in tasks is the tokenizers, numpy on one text or block at a time, and zstandard for the coded
links. What is broadcast is the two tokenizers and one row per id of the first one.
"""

from __future__ import annotations

import hashlib
import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import materialise

#: A block is closed when its texts have so many different id pairs, counted by text.
BLOCK_PAIRS = 1 << 21
#: How the first tokenizer cuts a text before it merges bytes: fixed by its vocabulary.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_Batches = Iterator[pa.RecordBatch]
_MEASURES = "digest binary, n_a long, n_b long, n_groups long, n_links long"
_BLOCKS = (
    "block long, texts array<struct<digest: binary, n_a: long, n_b: long, n_groups: long, n_links: long, "
    "groups_sha256: string, n_pairs: int>>, links binary, pairs array<long>, weights array<long>"
)
_COUNTED = f"{_MEASURES}, n_best long, count_sum long, groups_sha256 string"
_LONG = np.int64


def _byte_of_character() -> dict[str, int]:
    """How a byte-level vocabulary writes bytes: printable ones as they are, others from U+0100 up."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Aligner:
    """The two tokenizers, and the links between their tokens of a text."""

    def __init__(self, byte_bpe: str, piece_model: bytes):
        model = json.loads(byte_bpe)["model"]
        byte_of = _byte_of_character()
        special = {t["content"] for t in json.loads(byte_bpe)["added_tokens"]}
        ranks = {
            bytes(byte_of[c] for c in entry): i for entry, i in model["vocab"].items() if entry not in special
        }
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        if [model["vocab"][m] for m in merged] != list(range(256, 256 + len(merged))):
            raise ValueError("ids of the byte-level vocabulary are not in the order of its merges")
        self.bytes_a = {i: entry for entry, i in ranks.items()}
        self.first = tiktoken.Encoding(
            "byte-level", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.second = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        self.bytes_b = dict(enumerate(map(self._piece_bytes, range(self.second.get_piece_size()))))
        size_a = max(self.bytes_a) + 1
        self.lengths_a = np.array([len(self.bytes_a.get(i, b"")) for i in range(size_a)], _LONG)
        self.lengths_b = np.array([len(b) for b in self.bytes_b.values()], _LONG)
        # The text of an id with each sign that may follow it.
        self.written_a = np.array([f"{i}{s}" for s in ",|" for i in range(size_a)], object)
        self.written_b = np.array([f"{i}{s}" for s in ",;" for i in range(len(self.bytes_b))], object)

    def _piece_bytes(self, i: int) -> bytes:
        piece = self.second.id_to_piece(i)
        if self.second.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace("▁", " ").encode()

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both tokenizers, or None where either does not give the text back byte by byte."""
        spaced = f" {text}"
        a, b = self.first.encode_ordinary(spaced), self.second.encode(text, num_threads=1)
        whole = spaced.encode()
        for ids, known in ((a, self.bytes_a), (b, self.bytes_b)):
            if b"".join(map(known.__getitem__, ids)) != whole:
                return None
        return np.array(a, _LONG), np.array(b, _LONG)

    def align(self, a: np.ndarray, b: np.ndarray) -> tuple[int, np.ndarray, str]:
        """Number of groups, the id pair of each link as one number, and the digest of the groups."""
        ends_a, ends_b = np.cumsum(self.lengths_a[a]), np.cumsum(self.lengths_b[b])
        cuts = np.union1d(ends_a, ends_b)
        pairs = (a[np.searchsorted(ends_a, cuts)] << 32) | b[np.searchsorted(ends_b, cuts)]
        shared = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(shared, ends_a), np.searchsorted(shared, ends_b)
        last_a, last_b = np.isin(ends_a, shared), np.isin(ends_b, shared)
        # An id of the first comes after the ids of the second of earlier groups, one of the second
        # after all ids of the first up to its own group.
        written = np.empty(len(a) + len(b), object)
        until_a, until_b = np.cumsum(np.bincount(group_a)), np.cumsum(np.bincount(group_b))
        before = np.concatenate([[0], until_b])[group_a]
        written[np.arange(len(a)) + before] = self.written_a[a + last_a * (len(self.written_a) // 2)]
        written[np.arange(len(b)) + until_a[group_b]] = self.written_b[b + last_b * (len(self.written_b) // 2)]
        listed = "".join(written.tolist())[:-1]
        return len(shared), pairs, hashlib.sha256(listed.encode()).hexdigest()


_aligners: dict[int, Aligner] = {}


def _aligner(byte_bpe: str, piece_model: bytes) -> Aligner:
    key = zlib.crc32(byte_bpe.encode(), zlib.crc32(piece_model))
    if key not in _aligners:
        _aligners[key] = Aligner(byte_bpe, piece_model)
    return _aligners[key]


def align_tokens(
    docs: DataFrame, byte_bpe_file: str, piece_file: str, block_pairs: int = BLOCK_PAIRS
) -> DataFrame:
    """A row per document with the measures of its alignment; ``docs`` needs ``doc_id`` and ``text``.

    ``n_a`` and ``n_b`` tokens of the byte-level BPE and of the piece model, ``n_groups`` between
    the ends that both have, ``n_links`` of overlapping tokens, ``n_best`` of them whose pair is in as many
    documents as any pair of the same first token, ``count_sum`` of the documents of the pairs over all links,
    and ``groups_sha256``.

    Null and empty texts, and texts that a tokenizer does not give back byte by byte, have no tokens: zeros and
    an empty digest, and they count nowhere. Copies count each; equal and null ids are rows of
    their own. A text of any length is aligned whole, as a block by itself if need be. Other columns are not
    read. An empty table gives no rows. Both files are read by the driver only; the ids of the first
    must be in the order of its merges.
    """
    spark = docs.sparkSession
    with open(byte_bpe_file, encoding="utf-8") as file, open(piece_file, "rb") as model:
        tokenizers = spark.sparkContext.broadcast((file.read(), model.read()))
    told = F.when(F.length("text") > 0, F.unhex(F.sha2("text", 256)))
    texts = docs.where(F.length("text") > 0).groupBy("text").agg(F.count("*").alias("copies"))
    digested = texts.select(F.unhex(F.sha2("text", 256)).alias("digest"), "text", "copies")
    blocks = materialise(digested.mapInArrow(_align_blocks(tokenizers, block_pairs), _BLOCKS))

    listed = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "weights")).alias("place", "p"))
    of_pair = Window.partitionBy("pair")
    counted = listed.select("block", "place", F.col("p.pairs").alias("pair"), "p.weights").withColumn(
        "count", F.sum("weights").over(of_pair)
    )
    first_id = F.shiftright("pair", 32)
    # One row per id of the first tokenizer at most.
    best = counted.groupBy(first_id.alias("a")).agg(F.max("count").alias("most"))
    scored = counted.join(F.broadcast(best), first_id == F.col("a")).select(
        "block", "place", "count", (F.col("count") == F.col("most")).alias("best")
    )
    measures = (
        blocks.select(F.col("block").alias("of"), "texts", "links")
        .groupBy("of")
        .cogroup(scored.groupBy("block"))
        .applyInArrow(_measure, _COUNTED)
    )
    known = docs.select("doc_id", told.alias("digest")).join(measures, "digest", "left")
    numbers = [name.split()[0] for name in _COUNTED.split(", ")][1:-1]
    return known.select(
        F.col("doc_id").cast("long"),
        *[F.coalesce(name, F.lit(0).cast("long")).alias(name) for name in numbers],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )


class _Block:
    """Texts that wait to be written as one row."""

    def __init__(self) -> None:
        self.texts: list[dict] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.copies: list[int] = []
        self.size = 0

    def add(self, digest: bytes, copies: int, n_a: int, n_b: int, found: tuple[int, np.ndarray, str]) -> None:
        groups, links, sha = found
        pairs, times = np.unique(links, return_counts=True)
        self.texts.append(
            {
                "digest": digest,
                "n_a": n_a,
                "n_b": n_b,
                "n_groups": groups,
                "n_links": len(links),
                "groups_sha256": sha,
                "n_pairs": len(pairs),
            }
        )
        self.pairs.append(pairs)
        self.times.append(times)
        self.copies.append(copies)
        self.size += len(pairs)

    def written(self, number: int) -> pa.RecordBatch:
        pairs, places = np.unique(np.concatenate(self.pairs), return_inverse=True)
        lengths = [len(p) for p in self.pairs]
        weights = np.zeros(len(pairs), _LONG)
        np.add.at(weights, places, np.repeat(np.array(self.copies, _LONG), lengths))
        # Places rise within a text, so their differences are small.
        steps = np.diff(places, prepend=0).astype("<i4")
        links = np.concatenate([steps, np.concatenate(self.times).astype("<i4")])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.array([self.texts], _TEXTS_TYPE),
                pa.array([zstandard.ZstdCompressor(level=3).compress(links.tobytes())], pa.binary()),
                pa.array([pairs], pa.list_(pa.int64())),
                pa.array([weights], pa.list_(pa.int64())),
            ],
            names=["block", "texts", "links", "pairs", "weights"],
        )


_TEXTS_TYPE = pa.list_(
    pa.struct(
        [("digest", pa.binary())]
        + [(name, pa.int64()) for name in ("n_a", "n_b", "n_groups", "n_links")]
        + [("groups_sha256", pa.string()), ("n_pairs", pa.int32())]
    )
)


def _align_blocks(tokenizers, block_pairs: int) -> Callable[[_Batches], _Batches]:
    def run(batches: _Batches) -> _Batches:
        aligner = _aligner(*tokenizers.value)
        number, block = TaskContext.get().partitionId() << 32, _Block()
        for batch in batches:
            for digest, text, copies in zip(*batch.columns, strict=True):
                found = aligner.tokens(text.as_py())
                if found is None:
                    continue
                a, b = found
                block.add(digest.as_py(), copies.as_py(), len(a), len(b), aligner.align(a, b))
                if block.size >= block_pairs:
                    yield block.written(number)
                    number, block = number + 1, _Block()
        if block.texts:
            yield block.written(number)

    return run


def _measure(left: pa.Table, right: pa.Table) -> pa.Table:
    """Measures of the texts of one block, whose pairs come with their totals."""
    order = np.argsort(right.column("place").to_numpy())
    total = right.column("count").to_numpy()[order]
    best = right.column("best").to_numpy()[order]
    texts = left.column("texts").to_pylist()[0]
    packed = left.column("links").to_pylist()[0]
    coded = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), "<i4")
    half = len(coded) // 2
    places, times = np.cumsum(coded[:half].astype(_LONG)), coded[half:].astype(_LONG)
    starts = np.cumsum([0] + [t["n_pairs"] for t in texts])[:-1]
    columns = {name.split()[0]: [t[name.split()[0]] for t in texts] for name in _MEASURES.split(", ")}
    columns["n_best"] = np.add.reduceat(times * best[places], starts)
    columns["count_sum"] = np.add.reduceat(times * total[places], starts)
    columns["groups_sha256"] = [t["groups_sha256"] for t in texts]
    kinds = [pa.binary(), *[pa.int64()] * 6, pa.string()]
    return pa.table({n: pa.array(c, k) for (n, c), k in zip(columns.items(), kinds, strict=True)})
