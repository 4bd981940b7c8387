"""Removal of long byte strings that occur more than once, by merging sorted suffixes of shards.

A window is a string of ``LENGTH`` bytes; a byte goes if a window over it also
starts anywhere else. Suffixes are compared in blocks of ``BLOCK`` bytes, eight
to a window: the symbol of a suffix is its first block, its successor lies one
block further on. The order of all suffixes is refined block by block, as when
Burrows-Wheeler transforms of shards are merged: an interval holds the suffixes
of all shards that agree so far, each round splits intervals by the next symbol,
an interval that splits ends a common prefix, and a suffix alone in its interval
is settled and takes part in no further round. Intervals left after eight rounds
are the repeated windows. Suffixes are never sorted as strings.

Spark deals the work out so that no round needs the whole corpus:

* Every window has an anchor, the place with the least hash of eight bytes among
  its first ``REACH`` places (the last one of equals). Equal windows have equal
  anchors, so only windows whose anchors start equal strings (of the length
  that all windows of an anchor share) can be equal.
* A scan task is a shard. It settles the anchors whose whole context it holds
  twice and sends each different context on once, as two hashes.
* The hashes meet by anchor. An anchor met once is settled as unique; a whole
  context met twice as repeated. For what is left, the context's bytes are
  fetched, brought together by anchor, and their suffixes are merged. An anchor
  with very many open contexts is dealt out by slices of ``SLICE`` windows and the
  bytes that all windows of a slice share.

Hashes have 64 bits; two different strings are taken for equal with a
probability of their number squared over 2**65.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import row_of
from tickloom.session import materialise

LENGTH = 400
BLOCK = 50
REACH = 128
#: Bytes after an anchor that lie in each of its windows.
SHARED = LENGTH - REACH + 1

#: Contexts a shard compares with each other at once, and bytes that one merge holds.
SHARD_CONTEXTS = 1_000_000
MERGE_BYTES = 1_000_000
#: Contexts of one anchor that are settled and merged in one piece.
ANCHOR_CONTEXTS = 20_000
SLICE = 8

_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)
_LOW = np.uint64(0xFFFFFFFF)
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))

#: What becomes of an anchor: its bytes are repeated; its windows are open; its context is a partner.
REPEATED, OPEN, PARTNER = 0, 1, 2

_FOUND = "class binary, kind int, start long, stop long, anchor long, key long, sliced int"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Prefixes:
    """Hashes of any substring of some bytes in constant time (polynomial, modulo 2**64)."""

    def __init__(self, data: np.ndarray):
        global _powers
        if len(_powers[0]) <= len(data):
            n = len(data) + len(data) // 4 + 1
            _powers = tuple(
                np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, base, np.uint64)]))
                for base in (_ODD, _INVERSE)
            )
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers[0][: len(data)], out=self.sums[1:])

    def hashes(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[stop] - self.sums[start]) * _powers[1][start] + (stop - start).astype(np.uint64))


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a text with the first and last window of each, in order."""
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, 8)).view("<u8").ravel()
    # The upper half orders by hash; the lower half makes the last of equals the least.
    least = (_mixed(words) & ~_LOW) | (_LOW - np.arange(len(words), dtype=np.uint64))
    width = 1
    while 2 * width <= REACH:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < REACH:
        least = np.minimum(least[: len(least) - (REACH - width)], least[REACH - width :])
    place = (_LOW - (least[: len(data) - LENGTH + 1] & _LOW)).astype(np.int64)
    changes = np.flatnonzero(np.diff(place)) + 1
    first = np.concatenate([[0], changes])
    return place[first], first, np.concatenate([changes, [len(place)]]) - 1


def _batch(schema: str, columns: dict[str, object]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[name], kinds[kind]) for name, kind in fields], names=[n for n, _ in fields]
    )


_CONTEXTS = "key long, context long, times int, class binary, start long, stop long, anchor long"


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


class _Shard:
    """Anchor contexts of the texts of a scan task."""

    def __init__(self) -> None:
        self.held: list[tuple] = []
        self.classes: list[bytes] = []
        self.size = 0

    def add(self, text_class: bytes, text: bytes) -> None:
        if len(text) < LENGTH:
            return
        data = np.frombuffer(text, np.uint8)
        place, first, last = anchors(data)
        prefixes = Prefixes(data)
        key = prefixes.hashes(place, place + SHARED)
        context = _mixed(prefixes.hashes(first, last + LENGTH) + (place - first).astype(np.uint64))
        owner = np.full(len(place), len(self.classes))
        self.classes.append(text_class)
        self.held.append((key, context, owner, first, last + LENGTH, place))
        self.size += len(place)

    def flush(self) -> Iterator[pa.RecordBatch]:
        """Each context once; of contexts held twice also all their places, as settled rows."""
        if not self.held:
            return
        key, context, owner, first, stop, place = (np.concatenate(c) for c in zip(*self.held, strict=True))
        _, one, of, times = np.unique(context, return_index=True, return_inverse=True, return_counts=True)
        names = np.array(self.classes, dtype=object)
        self.__init__()
        for at in range(0, len(one), 50_000):
            i = one[at : at + 50_000]
            yield _batch(_CONTEXTS, {
                "key": _signed(key[i]), "context": _signed(context[i]),
                "times": np.minimum(times[at : at + 50_000], 2).astype(np.int32), "class": names[owner[i]],
                "start": first[i], "stop": stop[i], "anchor": place[i],
            })
        settled = np.flatnonzero(times[of] > 1)
        if not len(settled):
            return
        # Neighbouring contexts of a text overlap, so runs of them are one stretch of bytes.
        new = np.ones(len(settled), bool)
        new[1:] = (owner[settled][1:] != owner[settled][:-1]) | (first[settled][1:] > stop[settled][:-1])
        begin = np.flatnonzero(new)
        end = np.concatenate([begin[1:], [len(settled)]]) - 1
        i, j = settled[begin], settled[end]
        for at in range(0, len(i), 50_000):
            a, b = i[at : at + 50_000], j[at : at + 50_000]
            yield _batch(_CONTEXTS, {
                # times 0: settled; the key only deals the rows out evenly.
                "key": _signed(_mixed(context[a])), "context": np.zeros(len(a), np.int64),
                "times": np.zeros(len(a), np.int32), "class": names[owner[a]],
                "start": first[a], "stop": stop[b], "anchor": np.zeros(len(a), np.int64),
            })


def _scan(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    shard, seen = _Shard(), set()
    for batch in batches:
        for text_class, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if text_class in seen:
                continue
            seen.add(text_class)
            shard.add(text_class, text)
            if shard.size >= most:
                yield from shard.flush()
    yield from shard.flush()


def _settle(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Kinds of contexts, for rows sorted by key, then context.

    A key with more than ``most`` rows is settled piece by piece, cut
    between contexts. Its pieces are known to be met more than once, and all its
    repeated contexts count as possible partners.
    """
    held: list[pa.RecordBatch] = []
    long_key: int | None = None

    def settled(more: pa.RecordBatch) -> pa.RecordBatch:
        rows = pa.Table.from_batches([*held, more]).combine_chunks().to_batches()[0]
        held.clear()
        return _kinds(rows, long_key, most)

    for batch in batches:
        if not batch.num_rows:
            continue
        keys, contexts = batch.column("key").to_numpy(), batch.column("context").to_numpy()
        if held and held[-1].column("key")[0].as_py() != keys[0]:
            yield settled(batch.slice(0, 0))
        cut = int(np.searchsorted(keys, keys[-1]))
        if not cut and sum(b.num_rows for b in held) + batch.num_rows > most:
            # All of one key: cut where the last context begins, in this batch or before it.
            cut = int(np.searchsorted(contexts, contexts[-1]))
            before = held[-1].column("context")[-1].as_py() if held else contexts[0]
            if cut or before != contexts[0]:
                long_key = int(keys[-1])
                yield settled(batch.slice(0, cut))
        elif cut:
            yield settled(batch.slice(0, cut))
        held.append(batch.slice(cut))
    if held:
        yield settled(held[0].slice(0, 0))


def _kinds(rows: pa.RecordBatch, long_key: int | None, most: int) -> pa.RecordBatch:
    col = {n: rows.column(n).to_numpy(zero_copy_only=False) for n in rows.schema.names if n != "class"}
    key, context, times = col["key"], col["context"], col["times"]
    live = times > 0
    new_key = key[1:] != key[:-1]
    group = np.cumsum(np.concatenate([[True], new_key])) - 1
    new = np.concatenate([[True], new_key | (context[1:] != context[:-1]) | ~live[1:] | ~live[:-1]])
    of = np.cumsum(new) - 1
    in_piece = key == long_key if long_key is not None else np.zeros(len(key), bool)
    met = np.bincount(of, times)[of]
    in_group = np.bincount(group, times)[group] + 2 * in_piece
    repeated = ~live | (met > 1)
    is_open = live & (met == 1) & (in_group > 1)
    with_open = (np.bincount(group, is_open) > 0)[group] | in_piece
    partner = live & (met > 1) & with_open & new
    sliced = in_piece | (np.bincount(group, new & live)[group] > most)
    pick = np.concatenate([np.flatnonzero(x) for x in (repeated, is_open, partner)])
    kind = np.repeat([REPEATED, OPEN, PARTNER], [repeated.sum(), is_open.sum(), partner.sum()])
    return _batch(_FOUND, {
        "class": rows.column("class").take(pa.array(pick)).to_pylist(), "kind": kind.astype(np.int32),
        "start": col["start"][pick], "stop": col["stop"][pick], "anchor": col["anchor"][pick], "key": key[pick],
        "sliced": sliced[pick].astype(np.int32),
    })


def merged_windows(
    contexts: list[bytes], group: np.ndarray, anchor: np.ndarray, windows: np.ndarray
) -> np.ndarray:
    """Which windows of the contexts occur twice, as flags over all windows in order.

    ``anchor`` is the place of the anchor in its context, ``group`` numbers the
    anchors' strings, ``windows`` counts the windows of each context.
    """
    prefixes = Prefixes(np.frombuffer(b"".join(contexts), np.uint8))
    sizes = np.array([len(c) for c in contexts])
    base = np.cumsum(sizes) - sizes
    within = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    suffix = np.repeat(base, windows) + within
    # Before the first symbol an interval is an anchor and the distance to it.
    interval = np.repeat(group, windows) * REACH + np.repeat(anchor, windows) - within
    alive = np.arange(len(suffix))
    for depth in range(0, LENGTH, BLOCK):
        at = suffix[alive] + depth
        symbol = prefixes.hashes(at, at + BLOCK)
        state = _mixed(interval.astype(np.uint64) * np.uint64(_ODD) + symbol)
        _, interval, size = np.unique(state, return_inverse=True, return_counts=True)
        stays = size[interval] > 1
        alive, interval = alive[stays], interval[stays]
    found = np.zeros(len(suffix), bool)
    found[alive] = True
    return found


def _merge(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Repeated stretches of open contexts, for rows sorted by key."""

    def done(rows: list[tuple]) -> pa.RecordBatch:
        keys, classes, kinds, starts, stops, places, contexts = zip(*rows, strict=True)
        start, stop, place = np.array(starts), np.array(stops), np.array(places)
        windows = stop - start - LENGTH + 1
        _, group = np.unique(np.array(keys), return_inverse=True)
        found = merged_windows(list(contexts), group, place - start, windows)
        owner = np.repeat(np.arange(len(rows)), windows)
        at = np.repeat(start - (np.cumsum(windows) - windows), windows) + np.arange(len(owner))
        found &= np.repeat(np.array(kinds) == OPEN, windows)
        i = np.flatnonzero(found)
        new = np.ones(len(i), bool)
        new[1:] = (owner[i][1:] != owner[i][:-1]) | (at[i][1:] != at[i][:-1] + 1)
        begin = np.flatnonzero(new)
        end = np.concatenate([begin[1:], [len(i)]]) - 1 if len(i) else begin
        a, b = i[begin], i[end]
        return _batch(_FOUND, {
            "class": [classes[o] for o in owner[a]], "kind": np.zeros(len(a), np.int32),
            "start": at[a], "stop": at[b] + LENGTH, "anchor": np.zeros(len(a), np.int64),
            "key": np.zeros(len(a), np.int64), "sliced": np.zeros(len(a), np.int32),
        })

    held, size = [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if size >= most and held[-1][0] != row[0]:
                yield done(held)
                held, size = [], 0
            held.append(row)
            size += len(row[6])
    if held:
        yield done(held)


def _squeeze(names: list[str]):
    """Texts compressed for an exchange; other columns unchanged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            packed = pa.array([pack.compress(t) for t in batch.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [packed if n == "text" else batch.column(n) for n in names], names=names
            )

    return run


def _cut_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        rows = []
        for text_class, packed, wanted in zip(
            *(batch.column(n).to_pylist() for n in ("class", "text", "wanted")), strict=True
        ):
            text = unpack.decompress(packed)
            for w in wanted:
                for key, start, stop in _slices(w, text):
                    rows.append((key, text_class, w["kind"], start, stop, w["anchor"], text[start:stop]))
            if len(rows) > 5_000:
                yield _batch(_CUT, dict(zip(_CUT_NAMES, zip(*rows, strict=True), strict=True)))
                rows = []
        if rows:
            yield _batch(_CUT, dict(zip(_CUT_NAMES, zip(*rows, strict=True), strict=True)))


def _slices(w: dict, text: bytes) -> Iterator[tuple[int, int, int]]:
    """Key and bytes of a context, or of its slices: windows at most ``SLICE`` apart from their anchor.

    Equal windows lie in slices of the same number, and all windows of a slice
    share its middle, so they get the same key.
    """
    if not w["sliced"]:
        yield w["key"], w["start"], w["stop"]
        return
    first, last, anchor = w["start"], w["stop"] - LENGTH, w["anchor"]
    for number in range((anchor - last) // SLICE, (anchor - first) // SLICE + 1):
        high = anchor - number * SLICE
        low = high - SLICE + 1
        middle = text[high : low + LENGTH]
        digest = hashlib.blake2b(middle, digest_size=8, key=f"{w['key']}:{number}".encode()).digest()
        yield int.from_bytes(digest, "little", signed=True), max(first, low), min(last, high) + LENGTH


_CUT = "key long, class binary, kind int, start long, stop long, anchor long, bytes binary"
_CUT_NAMES = [f.split()[0] for f in _CUT.split(", ")]


def _bytes() -> Column:
    return F.encode(F.coalesce("text", F.lit("")), "UTF-8")


def _class() -> Column:
    return F.unhex(F.md5(_bytes()))


def repeated_stretches(
    docs: DataFrame,
    shard_contexts: int = SHARD_CONTEXTS,
    anchor_contexts: int = ANCHOR_CONTEXTS,
    merge_bytes: int = MERGE_BYTES,
) -> DataFrame:
    """``class`` (MD5 of a text) and ``stretches``: (start, stop) of bytes to remove, unmerged.

    The numbers bound what a task holds and do not change the result.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(_class().alias("class"), _bytes().alias("text"))
    found = materialise(
        texts.mapInArrow(lambda b: _scan(b, shard_contexts), _CONTEXTS)
        .repartition(n, "key")
        .sortWithinPartitions("key", "context")
        .mapInArrow(lambda b: _settle(b, anchor_contexts), _FOUND)
    )
    wanted = (
        found.where(F.col("kind") != REPEATED)
        .groupBy("class")
        .agg(F.collect_set(F.struct("key", "kind", "start", "stop", "anchor", "sliced")).alias("wanted"))
        .withColumnRenamed("class", "of")
    )
    one_each = (
        texts.mapInArrow(_squeeze(["class", "text"]), texts.schema)
        .groupBy("class")
        .agg(F.any_value("text").alias("text"))
    )
    merged = materialise(
        one_each.join(wanted, F.col("class") == F.col("of"))
        .select("class", "text", "wanted")
        .mapInArrow(_cut_contexts, _CUT)
        .repartition(n, "key")
        .sortWithinPartitions("key")
        .mapInArrow(lambda b: _merge(b, merge_bytes), _FOUND)
    )
    copies = (
        docs.select(_class().alias("class"), F.octet_length(_bytes()).cast("long").alias("stop"))
        .where(F.col("stop") >= LENGTH)
        .groupBy("class", "stop")
        .agg(F.count("*").alias("n"))
        .where("n > 1")
        .select("class", F.lit(0).cast("long").alias("start"), "stop")
    )
    return (
        found.where(F.col("kind") == REPEATED)
        .select("class", "start", "stop")
        .union(merged.select("class", "start", "stop"))
        .union(copies)
        .groupBy("class")
        .agg(F.collect_set(F.struct("start", "stop")).alias("stretches"))
    )


def remove_repeats(
    docs: DataFrame, carry: list[str] | None = None, **bounds: int
) -> DataFrame:
    """``row`` (the columns ``carry`` of ``docs``, or all), ``n_bytes``, ``n_removed``, ``n_spans``,
    ``kept`` (bytes left) and ``kept_sha256``.

    Texts are UTF-8 bytes, null is empty; what is left need not be valid UTF-8.
    Strings are judged on the input. Texts shorter than ``LENGTH`` bytes stay
    whole; equal rows are repeats of each other. Other columns may have any
    names. An empty table gives no rows. ``bounds`` are those of ``repeated_stretches``.
    """
    marks = repeated_stretches(docs, **bounds).withColumnRenamed("class", "of")
    names = ["row", "class", "text"]
    given = docs.select(row_of(docs, carry), _class().alias("class"), _bytes().alias("text"))
    joined = (
        given.mapInArrow(_squeeze(names), given.schema)
        .join(marks, F.col("class") == F.col("of"), "left")
        .select("row", "text", "stretches")
    )
    out = joined.select(
        "row",
        *[F.lit(0).cast("long").alias(c) for c in ("n_bytes", "n_removed", "n_spans")],
        F.col("text").alias("kept"),
        F.lit("").alias("kept_sha256"),
    ).schema
    return joined.mapInArrow(_removed, out)


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        sizes, removed, spans, kept, digests = [], [], [], [], []
        for packed, stretches in zip(batch.column("text").to_pylist(), batch.column("stretches").to_pylist(), strict=True):
            text = unpack.decompress(packed)
            parts, at, n = [], 0, 0
            for start, stop in _united(stretches or []):
                parts.append(text[at:start])
                at, n = stop, n + 1
            parts.append(text[at:])
            left = b"".join(parts)
            sizes.append(len(text))
            removed.append(len(text) - len(left))
            spans.append(n)
            kept.append(left)
            digests.append(hashlib.sha256(left).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("row"),
                *[pa.array(c, pa.int64()) for c in (sizes, removed, spans)],
                pa.array(kept, pa.binary()),
                pa.array(digests, pa.string()),
            ],
            names=["row", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
        )


def _united(stretches: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of bytes; stretches that touch are one run."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted((s["start"], s["stop"]) for s in stretches):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out
