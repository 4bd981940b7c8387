"""Packing of tokenised documents into sequences of balanced cost.

Method. The cost of a piece of n tokens is linear plus quadratic in n, as for a
layer with attention. Documents are taken in descending length and each goes to
the sequence of lowest cost among those with room for it; a document for which
no sequence has room is cut and fills the cheapest one. Documents longer than a
sequence are first cut into whole sequences.

Packing runs where the documents are read: a task packs block after block of
documents, a block being closed after ``BLOCK_TOKENS`` tokens. So there is no
shuffle, no group to gather and at most one sequence with padding per block.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

SEQUENCE_TOKENS = 2048
BLOCK_TOKENS = 2_000_000
#: Ends each document.
END_ID = 1
#: Cost of a piece of n tokens: n + n * n / COST_SCALE.
COST_SCALE = 1024.0

#: Entries of a worker's table of words; it is emptied when full.
CACHED_WORDS = 1_500_000
_TEXTS_AT_ONCE = 1000

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)


def cost(tokens: int | np.ndarray) -> float | np.ndarray:
    return tokens + tokens * tokens / COST_SCALE


class WordTokenizer:
    """Token ids of texts, for a tokenizer that never joins text across a space or line feed.

    Ids are kept by word, and by the parts into which the tokenizer's own
    pre-tokenizer cuts a word, since words repeat far more often than texts.
    """

    def __init__(self, definition: str):
        self.tokenizer = Tokenizer.from_str(definition)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _of_word(self, word: str) -> bytes:
        if any(s in word for s in self.special):
            return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        normal = self.tokenizer.normalizer.normalize_str(word)
        found = []
        for part, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal):
            ids = self.parts.get(part)
            if ids is None:
                if len(self.parts) >= CACHED_WORDS:
                    self.parts.clear()
                ids = np.array([t.id for t in self.tokenizer.model.tokenize(part)], "<u4").tobytes()
                self.parts[part] = ids
            found.append(ids)
        return b"".join(found)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, each with ``END_ID`` at the end."""
        words = [t.replace("\n", " ").split(" ") for t in texts]
        known, out = self.words, []
        for of_text in words:
            parts = []
            for word in of_text:
                ids = known.get(word)
                if ids is None:
                    if len(known) >= CACHED_WORDS:
                        known.clear()
                    ids = known[word] = self._of_word(word)
                parts.append(ids)
            parts.append(_END)
            out.append(np.frombuffer(b"".join(parts), "<u4"))
        return out


_END = np.array([END_ID], "<u4").tobytes()
_workers: dict[int, WordTokenizer] = {}


def _tokenizer(definition: str) -> WordTokenizer:
    key = zlib.crc32(definition.encode())
    if key not in _workers:
        _workers[key] = WordTokenizer(definition)
    return _workers[key]


def place(lengths: list[int], capacity: int = SEQUENCE_TOKENS) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of each piece.

    Together the sequences have room for less than one sequence more than the
    tokens. Ties go to the earlier document and to the sequence with the
    smaller number.
    """
    pieces, waiting, sequence = [], [], 0
    for doc, n in enumerate(lengths):
        whole = n // capacity
        for i in range(whole):
            pieces.append((doc, i * capacity, capacity, sequence, 0))
            sequence += 1
        if n % capacity:
            waiting.append((n % capacity, -doc, whole * capacity))
    waiting.sort(reverse=True)
    count = -(-sum(n for n, _, _ in waiting) // capacity)
    used, costs = np.zeros(count, np.int64), np.zeros(count)
    for n, doc, start in waiting:
        while n:
            fits = used <= capacity - n
            if fits.any():
                best, take = int(np.where(fits, costs, np.inf).argmin()), n
            else:
                best = int(np.where(used < capacity, costs, np.inf).argmin())
                take = int(capacity - used[best])
            pieces.append((-doc, start, take, sequence + best, int(used[best])))
            used[best] += take
            costs[best] += cost(take)
            start, n = start + take, n - take
    return pieces


def _packed(block: list[tuple[int | None, np.ndarray]], first: int) -> tuple[pa.RecordBatch, int]:
    placed = place([len(ids) for _, ids in block])
    rows = [
        (
            block[doc][0],
            start,
            length,
            zlib.crc32(block[doc][1][start : start + length].tobytes()),
            len(block[doc][1]),
            first + sequence,
            offset,
        )
        for doc, start, length, sequence, offset in placed
    ]
    names = [field.split()[0] for field in PIECES.split(", ")]
    columns = [pa.array(column, pa.int64()) for column in zip(*rows, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=names), 1 + max(p[3] for p in placed)


def pack(docs: DataFrame, tokenizer_file: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Pieces of all documents; ``docs`` needs ``doc_id`` and ``text``.

    A null text is empty; an empty text is the end id alone. Equal rows are
    packed each by itself, also with equal or null ids. Other columns of
    ``docs`` are not read. An empty table gives no pieces. A text of any
    length is tokenised whole; a block holds at least one document.

    ``tokenizer_file`` is read by the driver only. ``sequence_id`` is unique
    within the result; rows of a sequence come from one task.
    """
    with open(tokenizer_file, encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())
    chosen = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    return chosen.mapInArrow(_packer(definition, block_tokens), PIECES)


def _packer(definition, block_tokens: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _tokenizer(definition.value)
        next_sequence = TaskContext.get().partitionId() << 40
        block, tokens = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, _TEXTS_AT_ONCE):
                part = batch.slice(at, _TEXTS_AT_ONCE)
                for doc, ids in zip(
                    part.column(0).to_pylist(), words.ids(part.column(1).to_pylist()), strict=True
                ):
                    block.append((doc, ids))
                    tokens += len(ids)
                    if tokens >= block_tokens:
                        out, used = _packed(block, next_sequence)
                        yield out
                        next_sequence += used
                        block, tokens = [], 0
        if block:
            yield _packed(block, next_sequence)[0]

    return run
