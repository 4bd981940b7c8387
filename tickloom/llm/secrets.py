"""Secret scan that links the parts of multipart credentials.

Method. Strong findings (assignments of secrets, access key ids, long hex runs)
stand by themselves. Weak candidates (a bare base64 or url-safe run of ``LEAST_BARE``
characters or more, padded or not, with digits and letters of both cases; a
named identifier; an endpoint) say little alone. They become parts with a place, and an interval
join of parts within a scope of ``SCOPE`` characters reports a weak candidate
only where the parts that complete it occur: a bare secret near an identifier,
an identifier near a secret, an endpoint near both.

The interval join is an equi-join on cells of ``SCOPE`` characters. A cell keeps
the first and last place of each role only, which decides the question exactly
and never makes a row per pair of parts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import listed, matches, replaced, row_of
from tickloom.session import materialise

SCOPE = 400
MARK = "[SECRET]"

_ASSIGN_HEAD = (
    "(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\\x20*[:=]\\x20*[\"']?"
)
ASSIGN = _ASSIGN_HEAD + "[A-Za-z0-9+/_.=-]+"
_LONG_ASSIGN = "^" + _ASSIGN_HEAD + "[A-Za-z0-9+/_.=-]{6,}$"
#: A run that is too short cannot hold a longer one, so the least length may stand in the pattern.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"

#: A run that is too short cannot hold a longer one, as above; so a run is matched whole.
LEAST_BARE = 20
#: Weak candidates: pattern, and what a value must contain besides.
_BARE = f"[A-Za-z0-9+/_-]{{{LEAST_BARE},}}+={{0,2}}"
_NAMED = (
    "(?i:access_?key_?id|client_?id|account_?id|user_?name|login)[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9_.@-]{4,}"
)
_ENDPOINT = "(?:https?|postgres|mysql|mongodb|redis|amqp|s3)://[A-Za-z0-9._:@/?&=%~+-]{4,}"

BASE = ("assign", "access", "hex")
WEAK = ("secret", "ident", "endpoint")
#: What a part counts as when others look for complements.
_ROLE = {"assign": "s", "hex": "s", "secret": "s", "access": "i", "ident": "i", "endpoint": "e"}


def _spans(kind: str, found: Column) -> Column:
    order = (BASE + WEAK).index(kind)
    return F.transform(
        found,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(order).alias("order"), m["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    )


def _strong(text: Column) -> dict[str, Column]:
    return {
        "assign": F.filter(matches(text, ASSIGN), lambda m: m["value"].rlike(_LONG_ASSIGN)),
        "access": matches(text, ACCESS),
        "hex": matches(text, HEX),
    }


def _weak(text: Column) -> dict[str, Column]:
    mixed = lambda m: (
        m["value"].rlike("[0-9]") & m["value"].rlike("[A-Z]") & m["value"].rlike("[a-z]")
    )
    return {
        "secret": F.filter(matches(text, _BARE), mixed),
        "ident": matches(text, _NAMED),
        "endpoint": matches(text, _ENDPOINT),
    }


def scan(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``carry`` of ``docs``, or all), ``base`` and ``spans``.

    Both are arrays of (start, order, end, kind) in order of start, then kind;
    positions are code points. ``base`` has the strong findings, ``spans`` also
    the linked weak ones. A null text is empty; texts without a finding have
    empty arrays. Equal rows are scanned each by itself. Other columns may have
    any names. An empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    parts = materialise(
        docs.select(
            row_of(docs, carry),
            F.monotonically_increasing_id().alias("id"),
            F.sort_array(F.concat(*[_spans(k, m) for k, m in _strong(text).items()])).alias("base"),
            F.concat(*[_spans(k, m) for k, m in _weak(text).items()]).alias("weak"),
        )
    )
    # Written, so that a short table of links is broadcast and documents are not shuffled.
    linked = materialise(linked_parts(parts))
    return parts.join(linked, parts["id"] == linked["of"], "left").select(
        "row",
        "base",
        F.sort_array(
            F.concat("base", F.coalesce("linked", F.array().cast(parts.schema["weak"].dataType)))
        ).alias("spans"),
    )


def linked_parts(parts: DataFrame) -> DataFrame:
    """``of`` and ``linked``: the weak candidates of each ``id`` that other parts complete."""
    cell = F.floor(F.col("p.start") / SCOPE)
    with_weak = parts.where(F.size("weak") > 0)
    every = with_weak.select("id", F.explode(F.concat("base", "weak")).alias("p"))
    role = reduce(
        lambda out, kind: out.when(F.col("p.kind") == kind, _ROLE[kind]), _ROLE, F.when(F.lit(False), "")
    )
    cells = every.groupBy("id", cell.alias("cell")).agg(
        *[
            how(F.when(role == r, F.col("p.start"))).alias(f"{r}_{name}")
            for r in ("s", "i")
            for name, how in (("first", F.min), ("last", F.max))
        ]
    )
    weak = with_weak.select("id", F.explode("weak").alias("p")).select(
        F.col("id").alias("of"), "p", F.explode(F.array(cell - 1, cell, cell + 1)).alias("at")
    )

    def near(r: str) -> Column:
        start = F.col("p.start")
        within = (F.col(f"{r}_first") <= start + SCOPE) & (F.col(f"{r}_last") >= start - SCOPE)
        return F.max(F.coalesce(within, F.lit(False)))

    complete = (
        F.when(F.col("p.kind") == "secret", F.col("has_i"))
        .when(F.col("p.kind") == "ident", F.col("has_s"))
        .otherwise(F.col("has_i") & F.col("has_s"))
    )
    return (
        weak.join(cells, (F.col("of") == F.col("id")) & (F.col("at") == F.col("cell")))
        .groupBy("of", "p")
        .agg(near("i").alias("has_i"), near("s").alias("has_s"))
        .where(complete)
        .groupBy("of")
        .agg(F.collect_list("p").alias("linked"))
    )


def redact(docs: DataFrame) -> DataFrame:
    """The rows and columns of ``docs`` with every finding replaced by ``MARK``.

    ``n_chars`` is set anew in changed rows, if there is such a column.
    """
    found = scan(docs)
    text = replaced(F.coalesce("row.text", F.lit("")), F.col("spans"), lambda *_: F.lit(MARK))
    changed = found.withColumn(
        "new", F.when(F.size("spans") > 0, text).otherwise(F.col("row.text"))
    )
    out = []
    for name in docs.columns:
        old = F.col("row").getField(name)
        if name == "text":
            out.append(F.col("new").alias(name))
        elif name == "n_chars":
            kind = docs.schema[name].dataType
            out.append(F.when(F.size("spans") > 0, F.length("new").cast(kind)).otherwise(old).alias(name))
        else:
            out.append(old.alias(name))
    return changed.select(*out)


def span_columns() -> list[Column]:
    """Counts of the strong findings, digest of their spans, and all spans."""
    of = lambda kind: F.filter("base", lambda s: s["kind"] == kind)
    return [
        *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in BASE],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    ]
