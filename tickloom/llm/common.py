"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space that separates words: space and tab to carriage return.
WHITE_SPACE = " \t\n\x0b\x0c\r"

_PREFIX_BLOCK = 256


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` names it.

    The optimizer may copy a column's expression to every place that names it,
    also into a lambda that runs once per array element; a lambda variable
    cannot be copied.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def counter(first: Column | int, last: Column) -> Column:
    """The whole numbers from ``first`` to ``last``; empty where ``last`` is smaller."""
    start = F.lit(first) if isinstance(first, int) else first
    return F.when(last >= start, F.sequence(start, last)).otherwise(F.array().cast("array<int>"))


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda total, x: total + x)


def total_before(numbers: Column, then: Callable[[Callable[[Column], Column]], Column]) -> Column:
    """``then(before)`` where ``before(i)`` is the sum of the first ``i`` numbers.

    Sums go over blocks of 256, so that a long array does not cost its square.
    """

    def with_blocks(n: Column, blocks: Column) -> Column:
        def before(i: Column) -> Column:
            block = F.floor(i / _PREFIX_BLOCK).cast("int")
            inside = F.slice(n, block * _PREFIX_BLOCK + 1, i % _PREFIX_BLOCK)
            return _total(F.slice(blocks, 1, block)) + _total(inside)

        return then(before)

    def block_totals(n: Column) -> Column:
        return F.transform(
            counter(0, F.floor((F.size(n) - 1) / _PREFIX_BLOCK).cast("int")),
            lambda b: _total(F.slice(n, b * _PREFIX_BLOCK + 1, _PREFIX_BLOCK)),
        )

    return let(numbers, lambda n: let(block_totals(n), lambda blocks: with_blocks(n, blocks)))


def matches(text: Column, pattern: str, context: int = 0) -> Column:
    """Leftmost non-overlapping matches as an array of (start, end, value, before, after).

    Positions are code points, the end is exclusive. ``before`` and ``after``
    are up to ``context`` code points on either side, not beyond the next match.
    """

    def located(found: Column, pieces: Column) -> Column:
        def one(before: Callable[[Column], Column]) -> Callable[[Column, Column], Column]:
            def of(value: Column, i: Column) -> Column:
                start = before(i) + F.length(F.get(pieces, i))
                return F.struct(
                    start.alias("start"),
                    (start + F.length(value)).alias("end"),
                    value.alias("value"),
                    F.right(F.get(pieces, i), F.lit(context)).alias("before"),
                    F.left(F.get(pieces, i + 1), F.lit(context)).alias("after"),
                )

            return of

        # The piece after the last match has no match of its own.
        lengths = F.zip_with(
            found, F.slice(pieces, 1, F.size(found)), lambda m, p: F.length(m) + F.length(p)
        )
        return total_before(lengths, lambda before: F.transform(found, one(before)))

    none = F.array().cast("array<struct<start:int,end:int,value:string,before:string,after:string>>")
    return let(
        F.regexp_extract_all(text, F.lit(pattern), 0),
        lambda found: F.when(F.size(found) == 0, none).otherwise(
            let(F.split(text, pattern, -1), lambda pieces: located(found, pieces))
        ),
    )


def replaced(text: Column, spans: Column, mark: Callable[[Column, Column], Column]) -> Column:
    """``text`` with every run of overlapping ``spans`` replaced by ``mark(start, end)``.

    ``spans`` is an array of structs with start and end, in any order.
    """

    def joined(starts: Column, ends: Column) -> Column:
        # Start of the i-th run and end of the run before it: as many spans have started
        # as have ended there, which holds for sorted starts and ends of any intervals.
        firsts = F.filter(starts, lambda s, i: (i == 0) | (F.get(ends, i - 1) < s))
        lasts = F.filter(ends, lambda e, i: (i == F.size(ends) - 1) | (e < F.get(starts, i + 1)))
        return let(firsts, lambda a: let(lasts, lambda b: pieces(a, b)))

    def pieces(firsts: Column, lasts: Column) -> Column:
        def piece(i: Column) -> Column:
            begin = F.coalesce(F.get(lasts, i - 1), F.lit(0))
            end = F.coalesce(F.get(firsts, i), F.length(text))
            return F.substring(text, begin + 1, end - begin)

        def marked(i: Column) -> Column:
            return F.concat(mark(F.get(firsts, i - 1), F.get(lasts, i - 1)), piece(i))

        return F.concat_ws(
            "",
            F.transform(
                counter(0, F.size(firsts)), lambda i: F.when(i == 0, piece(i)).otherwise(marked(i))
            ),
        )

    return F.when(F.size(spans) == 0, text).otherwise(
        let(
            F.sort_array(F.transform(spans, lambda s: s["start"])),
            lambda starts: let(
                F.sort_array(F.transform(spans, lambda s: s["end"])), lambda ends: joined(starts, ends)
            ),
        )
    )


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def row_of(docs: DataFrame, carry: list[str] | None = None) -> Column:
    """The columns ``carry`` of ``docs``, or all, as one struct whose names clash with nothing."""
    return F.struct(*[F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)]).alias("row")
