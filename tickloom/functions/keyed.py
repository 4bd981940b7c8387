"""Keyed 64-bit ids of text: SipHash-2-4 (Aumasson and Bernstein, 2012) as a column expression.

Ids made with a secret key tell nothing about the text to those who lack it, and texts that
collide cannot be made up. For ids that anybody may check see ``functions.ids``.

The state of the hash is a struct of four numbers that an aggregate takes through the words of
the text, half a round at a time. Nothing leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_BYTES = 8
KEY_BYTES = 16
_LOW_32 = 0xFFFFFFFF

# Fixed values of the hash: the text "somepseudorandomlygeneratedbytes" in words that start high.
_START = [int.from_bytes(text, "big") for text in (b"somepseu", b"dorandom", b"lygenera", b"tedbytes")]
# Bits by which the two numbers of a half round turn, for the first and the second half.
_TURNS = ((13, 16), (17, 21))
_CLOSING_MARK = 0xFF
_CLOSING_ROUNDS = 4


def keyed_id(text: Column | str, key: bytes) -> Column:
    """SipHash-2-4 of the UTF-8 bytes of ``text`` (or of a binary column) under a key of 16 bytes.

    The 64 bits are a bigint, so half of all ids are negative. A null has a null id.
    """
    if len(key) != KEY_BYTES:
        raise ValueError(f"the key must have {KEY_BYTES} bytes, not {len(key)}")
    text = F.col(text) if isinstance(text, str) else text
    halves = [int.from_bytes(key[i : i + WORD_BYTES], "little") for i in (0, WORD_BYTES)]
    start = [_long(word ^ halves[i % 2]) for i, word in enumerate(_START)]
    state = F.struct(*[value.alias(f"v{i}") for i, value in enumerate(start)])
    return F.aggregate(_steps(text.cast("binary")), state, _step, _joined)


def _long(value: int) -> Column:
    """The 64 bits of ``value`` as a bigint."""
    return F.lit(value - (1 << 64) if value >> 63 else value).cast("bigint")


def _words(content: Column) -> Column:
    """Words of eight bytes, the first byte lowest; the last holds what is left and the length on top."""
    length = F.octet_length(content)
    whole = F.floor(length / WORD_BYTES).cast("int")
    padding = F.repeat(F.lit("00"), WORD_BYTES - 1 - length % WORD_BYTES)
    digits = F.concat(F.hex(content), padding, F.lpad(F.hex(length % 256), 2, "0"))

    def word(i: Column) -> Column:
        piece = F.substring(digits, i * 2 * WORD_BYTES + 1, F.lit(2 * WORD_BYTES))
        turned = F.regexp_replace(piece, "(..)" * WORD_BYTES, "$8$7$6$5$4$3$2$1")
        return F.conv(turned, 16, -10).cast("bigint")

    return F.transform(F.sequence(F.lit(0), whole), word)


def _steps(content: Column) -> Column:
    """What to mix in around every round: into ``v3`` and ``v2`` before it, into ``v0`` after it."""

    def step(before: Column, mark: Column, after: Column) -> Column:
        return F.struct(before.alias("before"), mark.alias("mark"), after.alias("after"))

    none = _long(0)
    of_words = F.flatten(
        F.transform(_words(content), lambda w: F.array(step(w, none, none), step(none, none, w)))
    )
    closing = [step(none, _long(0 if i else _CLOSING_MARK), none) for i in range(_CLOSING_ROUNDS)]
    return F.concat(of_words, F.array(*closing))


def _step(state: Column, step: Column) -> Column:
    opened = _state(
        state["v0"],
        state["v1"],
        state["v2"].bitwiseXOR(step["mark"]),
        state["v3"].bitwiseXOR(step["before"]),
    )
    return _let(
        _let(opened, lambda s: _half(s, ("v0", "v1", "v2", "v3"), _TURNS[0])),
        lambda s: _let(
            _half(s, ("v2", "v1", "v0", "v3"), _TURNS[1]),
            lambda r: _state(r["v0"].bitwiseXOR(step["after"]), r["v1"], r["v2"], r["v3"]),
        ),
    )


def _half(state: Column, names: tuple[str, str, str, str], turns: tuple[int, int]) -> Column:
    """Half a round: two sums, each mixed into the number that was added; the first sum turns by 32."""
    a, b, c, d = names
    sums = F.struct(_sum(state[a], state[b]).alias("ab"), _sum(state[c], state[d]).alias("cd"))

    def mixed(s: Column) -> Column:
        new = {
            a: _turned(s["ab"], 32),
            b: _turned(state[b], turns[0]).bitwiseXOR(s["ab"]),
            c: s["cd"],
            d: _turned(state[d], turns[1]).bitwiseXOR(s["cd"]),
        }
        return _state(*[new[name] for name in sorted(new)])

    return _let(sums, mixed)


def _joined(state: Column) -> Column:
    return state["v0"].bitwiseXOR(state["v1"]).bitwiseXOR(state["v2"]).bitwiseXOR(state["v3"])


def _state(*values: Column) -> Column:
    return F.struct(*[value.alias(f"v{i}") for i, value in enumerate(values)])


def _sum(a: Column, b: Column) -> Column:
    """Sum modulo 2^64 by halves of 32 bits, since a bigint sum that overflows fails the query."""
    low = a.bitwiseAND(_long(_LOW_32)) + b.bitwiseAND(_long(_LOW_32))
    high = F.shiftrightunsigned(a, 32) + F.shiftrightunsigned(b, 32) + F.shiftrightunsigned(low, 32)
    return F.shiftleft(high, 32).bitwiseOR(low.bitwiseAND(_long(_LOW_32)))


def _turned(value: Column, bits: int) -> Column:
    return F.shiftleft(value, bits).bitwiseOR(F.shiftrightunsigned(value, 64 - bits))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once: a lambda variable is not copied into its uses."""
    return F.element_at(F.transform(F.array(value), body), 1)
