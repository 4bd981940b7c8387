"""Search of benchmark passages in documents by Wu-Manber multi-pattern matching.

Method. The symbols are words. Every window of ten words of a benchmark text is
a pattern. A table gives, for each block of two words, how far a search may
move on without missing a pattern that could end later; blocks at the end of no
pattern within reach allow the full shift. Where the shift is zero the block
leads to the patterns that end with it, which are compared word by word.

Patterns of one length share tables, so that a short benchmark text does not
shorten the shifts for all others.

A benchmark of up to ``TABLE_BYTES`` is broadcast with its buckets, and the
documents are searched where they lie. A larger one stays a table of windows.
Its shift tables, by hash of the block and therefore of a fixed size, are all
that is broadcast; the windows at which they stop a search, and whose prefix
block goes with the suffix block, are joined with the buckets. Both ways compare
whole windows and give the same rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import row_of
from tickloom.session import materialise

WINDOW = 10
#: Bytes of benchmark text up to which its tables are broadcast.
TABLE_BYTES = 4_000_000
#: Places of a shift table that is broadcast for a larger benchmark, a power of two; there is one
#: for each length of a window and one for prefixes, so at most 11 of a byte a place.
SLOTS = 1 << 20
#: Parts into which the documents' candidates for one window are dealt.
SPREAD = 64
#: Rows of one batch that a search or a listing of windows puts out.
BATCH_ROWS = 20_000

#: What ``_WORD_BYTES`` makes of a text, as a pattern.
_WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: Bytes of words: digits, letters (as small ones) and everything outside ASCII.
_WORD_BYTES = bytes(
    b + 32
    if 65 <= b <= 90
    else b
    if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128
    else 32
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return text.encode().translate(_WORD_BYTES).split() if text else []


class PatternTables:
    """Shift and bucket tables for the windows of some benchmark texts."""

    def __init__(self, items: list[tuple[str, str | None]], window: int = WINDOW):
        by_length: dict[int, dict[tuple[bytes, ...], set[str]]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            words = words_of(text)
            n = min(window, len(words))
            for i in range(len(words) - n + 1 if n else 0):
                by_length[n][tuple(words[i : i + n])].add(item)
        self.groups = [self._tables(n, patterns) for n, patterns in sorted(by_length.items())]

    @staticmethod
    def _tables(n: int, patterns: dict[tuple[bytes, ...], set[str]]):
        width = min(2, n)
        shifts: dict[tuple[bytes, ...], int] = {}
        buckets: dict[tuple[bytes, ...], list[tuple[list[bytes], tuple[str, ...]]]] = defaultdict(list)
        for pattern, items in patterns.items():
            for end in range(width, n + 1):
                block = pattern[end - width : end]
                shifts[block] = min(shifts.get(block, n), n - end)
            buckets[pattern[n - width :]].append((list(pattern), tuple(sorted(items))))
        return n, width, shifts, dict(buckets)

    def search(self, words: list[bytes]) -> tuple[set[int], set[str]]:
        """Places of words inside an occurrence, and the items that occur."""
        places: set[int] = set()
        items: set[str] = set()
        for n, width, shifts, buckets in self.groups:
            full, at, end = n - width + 1, n - 1, len(words)
            get = shifts.get
            while at < end:
                block = (words[at - 1], words[at]) if width == 2 else (words[at],)
                shift = get(block, full)
                if shift:
                    at += shift
                    continue
                first = at - n + 1
                here = words[first : at + 1]
                for pattern, of_items in buckets[block]:
                    if pattern == here:
                        places.update(range(first, at + 1))
                        items.update(of_items)
                at += 1
        return places, items


def _texts(benchmark: DataFrame) -> DataFrame:
    return benchmark.select(F.col("item_id").cast("string").alias("item"), "text").dropDuplicates()


def find_benchmark(
    docs: DataFrame, benchmark: DataFrame, carry: list[str] | None = None
) -> DataFrame:
    """``row`` (the columns ``carry`` of ``docs``, or all), ``n_words``, ``hits`` and ``items``.

    ``hits`` are the places (from 0) of the words inside an occurrence of a
    benchmark window, in order; ``items`` the ids, as text and in order, of the
    benchmark texts with an occurring window. Null and empty texts have no
    words, on either side. A benchmark text with a null id marks words but is
    not listed. Equal rows of ``docs`` are searched each by itself; equal
    benchmark rows count once. Other columns may have any names.

    A benchmark of up to ``TABLE_BYTES`` passes through the driver and documents
    are not shuffled; beyond that see ``_joined``. The rows do not depend on it.
    """
    texts = _texts(benchmark)
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > TABLE_BYTES:
        return _joined(docs, texts, carry)
    found = docs.select(
        row_of(docs, carry),
        F.col("text").cast("string").alias("_text"),
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<int>").alias("hits"),
        F.array().cast("array<string>").alias("items"),
    )
    tables = PatternTables([(r["item"], r["text"]) for r in texts.collect()])
    shared = docs.sparkSession.sparkContext.broadcast(tables)
    return found.mapInArrow(_searcher(shared), found.schema).drop("_text")


def _joined(docs: DataFrame, texts: DataFrame, carry: list[str] | None) -> DataFrame:
    """``find_benchmark`` for a benchmark of any size: no text of it reaches the driver.

    Documents move only in the last join, by a digest of their text, which adaptive execution splits
    where many are copies; each text is matched once. A window that very many texts hold is dealt to
    ``SPREAD`` places, for which the benchmark windows that occur are repeated.
    """
    window = ["n", "window"]
    listed = texts.mapInArrow(_list_windows, "n int, window binary, item string")
    patterns = materialise(listed.groupBy(*window).agg(F.collect_set("item").alias("of_items")))
    slots = patterns.select(*window).mapInArrow(_lister_of_slots(SLOTS), "n int, slot int, shift int")
    slots = slots.groupBy("n", "slot").agg(F.min("shift").alias("shift"))
    tables = docs.sparkSession.sparkContext.broadcast(_shift_tables(slots.toArrow(), SLOTS))
    stops = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(
        _stops(tables), "digest string, n int, first int, window binary"
    )
    stops = materialise(stops.distinct())
    occurring = patterns.join(stops.select(*window).distinct(), window)
    places = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("place")
    dealt = stops.withColumn("place", F.pmod(F.xxhash64("digest"), F.lit(SPREAD)).cast("int"))
    matched = dealt.join(occurring.select("*", places), [*window, "place"])
    found = matched.groupBy("digest").agg(
        F.collect_set(F.struct("first", "n")).alias("spans"), F.collect_set("of_items").alias("lists")
    )
    every = F.flatten(F.transform("spans", lambda s: F.sequence(s["first"], s["first"] + s["n"] - 1)))
    # Written, so that the join reads two shuffles and adaptive execution can split copies of one text.
    found = materialise(
        found.select(
            "digest",
            F.array_sort(F.array_distinct(every)).alias("hits"),
            F.array_sort(F.array_distinct(F.flatten("lists"))).alias("items"),
        )
    )
    text = F.col("text").cast("string")
    rows = docs.select(
        row_of(docs, carry),
        F.coalesce(F.regexp_count(text, F.lit(_WORDS)), F.lit(0)).cast("long").alias("n_words"),
        F.sha2(text, 256).alias("digest"),
    )
    return rows.join(found, "digest", "left").select(
        "row",
        "n_words",
        F.coalesce("hits", F.array().cast("array<int>")).alias("hits"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _in_batches(rows: Iterator[tuple], fields: list[tuple[str, pa.DataType]]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(fields)
    while held := list(islice(rows, BATCH_ROWS)):
        columns = zip(*held, strict=True)
        arrays = [pa.array(column, kind) for column, kind in zip(columns, schema.types, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def _slot(block: bytes, slots: int) -> int:
    return zlib.crc32(block) & (slots - 1)


def _list_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of benchmark texts; a text of fewer words is one window."""

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words = words_of(text)
                n = min(WINDOW, len(words))
                for i in range(len(words) - n + 1 if n else 0):
                    yield n, b" ".join(words[i : i + n]), item

    return _in_batches(rows(), [("n", pa.int32()), ("window", pa.binary()), ("item", pa.string())])


def _lister_of_slots(slots: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Slots with the shift that each block of a window allows; under length 0 those of prefix and suffix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least: dict[tuple[int, int], int] = {}
            for n, window in zip(batch.column("n").to_pylist(), batch.column("window").to_pylist(), strict=True):
                words = window.split(b" ")
                width = min(2, n)
                for end in range(width, n + 1):
                    at = n, _slot(b" ".join(words[end - width : end]), slots)
                    least[at] = min(least.get(at, n), n - end)
                least[0, _slot(b" ".join([*words[:width], *words[-width:]]), slots)] = 0
            rows = ((n, slot, shift) for (n, slot), shift in least.items())
            yield from _in_batches(rows, [(name, pa.int32()) for name in ("n", "slot", "shift")])

    return run


def _shift_tables(found: pa.Table, slots: int) -> dict[int, bytes]:
    """A table of ``slots`` bytes for each length: the shift, or the full one where no block is."""
    tables: dict[int, bytearray] = {}
    for batch in found.to_batches():
        for n, slot, shift in zip(*(batch.column(c).to_pylist() for c in ("n", "slot", "shift")), strict=True):
            if n not in tables:
                tables[n] = bytearray([n - min(2, n) + 1 if n else 1]) * slots
            tables[n][slot] = shift
    return {n: bytes(table) for n, table in sorted(tables.items())}


def _stops(tables) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Windows of documents at which the shift tables stop and prefix and suffix may go together."""

    def of(words: list[bytes]) -> Iterator[tuple[int, int, bytes]]:
        prefixes = tables.value.get(0, b"")
        slots = len(prefixes)
        for n, shifts in tables.value.items():
            width = min(2, n)
            at = n - 1
            while n and at < len(words):
                suffix = words[at - width + 1 : at + 1]
                shift = shifts[_slot(b" ".join(suffix), slots)]
                if shift:
                    at += shift
                    continue
                first = at - n + 1
                if not prefixes[_slot(b" ".join([*words[first : first + width], *suffix]), slots)]:
                    yield n, first, b" ".join(words[first : at + 1])
                at += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for batch in batches:
                for text in batch.column("text").to_pylist():
                    digest = None
                    for stop in of(words_of(text)):
                        digest = digest or hashlib.sha256(text.encode()).hexdigest()
                        yield digest, *stop

        fields = [("digest", pa.string()), ("n", pa.int32()), ("first", pa.int32()), ("window", pa.binary())]
        return _in_batches(rows(), fields)

    return run


def _searcher(tables) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.schema.names
            n_words, hits, items = [], [], []
            for text, old_hits, old_items in zip(
                batch.column(names.index("_text")).to_pylist(),
                batch.column(names.index("hits")).to_pylist(),
                batch.column(names.index("items")).to_pylist(),
                strict=True,
            ):
                words = words_of(text)
                places, found = tables.value.search(words)
                n_words.append(len(words))
                hits.append(sorted(places.union(old_hits)))
                items.append(sorted({i for i in found if i is not None}.union(old_items)))
            new = {
                "n_words": pa.array(n_words, pa.int64()),
                "hits": pa.array(hits, pa.list_(pa.int32())),
                "items": pa.array(items, pa.list_(pa.string())),
            }
            yield pa.RecordBatch.from_arrays(
                [new.get(n, batch.column(i)) for i, n in enumerate(names)], names=names
            )

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any hit, with the same columns."""
    return find_benchmark(docs, benchmark).where(F.size("hits") == 0).select("row.*")
