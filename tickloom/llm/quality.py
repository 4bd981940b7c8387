"""Quality rules with thresholds from quantile sketches per language and source.

Method. One pass computes the features of each document. Mergeable quantile
sketches (KLL) of four ratios are built per language and source, and merged to a
language and to the whole table. The fence of a group lies beyond a high quantile of its sketch,
by a multiple of the range between that quantile and its mirror image. Since few
documents say little about a quantile, the fence of a pair of n documents is its own with weight n and
that of its language with weight ``SHRINKAGE``, and that of a language is drawn to the whole table's in the
same way: there is no size at which a group changes from one to the other. A join
with the fences decides each document.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import WHITE_SPACE, counter, let, row_of
from tickloom.session import materialise

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Accuracy of the sketches: up to so many values are kept exactly.
SKETCH_SIZE = 1024
#: Documents that the fence of the wider group counts for.
SHRINKAGE = 1000
#: For each ratio: the quantile, how many ranges between it and its mirror image the fence lies beyond
#: it, and a margin so small that it only keeps equal values of a group from being outside.
#: Word lengths and symbols are told by the middle half of the documents, which a quarter of bad
#: ones does not move. Repeats are absent from most documents, so their tail is looked at.
RULES = {
    "word_length": (0.75, 6.0, 0.05),
    "symbol_ratio": (0.75, 6.0, 0.01),
    "dup_line_ratio": (0.99, 0.5, 0.01),
    "repeat_ratio": (0.99, 0.5, 0.01),
}
#: Ratios that are also too small below the lower fence.
TWO_SIDED = ("word_length",)

#: Matched at line starts only, so that a long line of white space fails once.
LINE_WITH_WORD = "(?<![^\\n])[\\x20\\x09\\x0B-\\x0D]*+[^\\x20\\x09-\\x0D][^\\n]*+"

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(words: Column) -> Column:
    """Words inside a window of three words that the text has at least twice."""

    def covered(windows: Column) -> Column:
        in_order = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def same(rows: Column, i: Column, h: Column) -> Column:
            return F.coalesce(F.get(rows, i).getField("h") == h, F.lit(False))

        repeated = let(
            in_order,
            lambda rows: F.sort_array(
                F.transform(
                    F.filter(
                        rows,
                        lambda r, i: same(rows, i - 1, r["h"]) | same(rows, i + 1, r["h"]),
                    ),
                    lambda r: r["i"],
                )
            ),
        )
        return let(
            repeated,
            lambda at: F.aggregate(
                F.transform(
                    at, lambda p, i: F.least(F.lit(3), F.coalesce(p - F.get(at, i - 1), F.lit(3)))
                ),
                F.lit(0),
                lambda total, n: total + n,
            ),
        )

    hashes = F.transform(
        counter(0, F.size(words) - 3),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    return let(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)),
    )


def features(text: Column) -> Column:
    """Struct of the counts of a text and of the ratios made from them.

    A null text counts as empty. Windows of words are compared by a 64-bit hash.
    Ratios of a text without words are null.
    """
    value = F.coalesce(text, F.lit(""))

    def counts(words: Column, lines: Column) -> Column:
        plain_length = F.length(F.translate(value, WHITE_SPACE, ""))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            plain_length.cast("long").alias("word_chars"),
            (F.length(value) - F.length(F.translate(value, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            _repeat_words(words).cast("long").alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
        )

    # No lambdas: these run for each word and line, and interpreted trees cost the executor memory beside its heap.
    words = F.array_remove(F.split(value, "[\\x20\\x09-\\x0D]+", -1), "")
    lines = F.regexp_extract_all(value, F.lit(LINE_WITH_WORD), 0)
    counted = let(words, lambda w: let(lines, lambda ls: counts(w, ls)))

    def with_ratios(c: Column) -> Column:
        some = F.when(c["n_words"] > 0, c["n_words"])
        return F.struct(
            *[c[name].alias(name) for name in COUNTS],
            (c["word_chars"] / some).alias("word_length"),
            (c["n_symbols"] / some).alias("symbol_ratio"),
            (c["n_dup_lines"] / F.when(c["n_lines"] > 0, c["n_lines"])).alias("dup_line_ratio"),
            (c["n_repeat_words"] / some).alias("repeat_ratio"),
        )

    return let(counted, with_ratios)


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def _fences(level: DataFrame) -> DataFrame:
    """Sketches replaced by the lower and upper fence of each ratio."""

    def fence(name: str) -> Column:
        high, spreads, margin = RULES[name]

        def of(quantiles: Column) -> Column:
            reach = spreads * (quantiles["high"] - quantiles["low"]) + margin
            lower = quantiles["low"] - reach if name in TWO_SIDED else F.lit(None).cast("double")
            return F.struct(lower.alias("low"), (quantiles["high"] + reach).alias("high"))

        quantile = lambda q: F.kll_sketch_get_quantile_double(name, F.lit(q))
        low = round(1 - high, 9)
        return let(F.struct(quantile(low).alias("low"), quantile(high).alias("high")), of)

    return level.select(
        *[c for c in level.columns if c not in RULES],
        F.struct(*[fence(name).alias(name) for name in RULES]).alias("fences"),
    )


def _drawn(own: Column, n: Column, wider: Column) -> Column:
    """Fences of a group of ``n`` documents, drawn to those of the wider group."""

    def bound(name: str, side: str) -> Column:
        mixed = (n * own[name][side] + SHRINKAGE * wider[name][side]) / (n + SHRINKAGE)
        return F.when(own.isNull(), wider[name][side]).otherwise(mixed).alias(side)

    return F.struct(*[F.struct(bound(name, "low"), bound(name, "high")).alias(name) for name in RULES])


def adaptive_fences(measured: DataFrame) -> DataFrame:
    """``lang``, ``source`` and ``fences`` for every pair in ``measured``.

    ``measured`` has ``lang``, ``source`` and ``features``. Documents that fail
    the base rules are left out of the sketches; pairs without any other
    document take the fences of their language or of the whole table. Null is
    a language or source of its own. Without any usable document the fences
    are null and reject nothing.
    """
    f = F.col("features")
    usable = (f["n_words"] > 0) & ~base_failed(f["n_words"], f["n_repeat_words"])
    groups = materialise(
        measured.groupBy("lang", "source").agg(
            F.count(F.when(usable, 1)).alias("n"),
            *[
                F.kll_sketch_agg_double(F.when(usable, f[name]), F.lit(SKETCH_SIZE)).alias(name)
                for name in RULES
            ],
        )
    )
    merged = [F.kll_merge_agg_double(name).alias(name) for name in RULES]
    some = groups.where("n > 0")
    of_pair = _fences(some).select(
        F.col("lang").alias("_l"), F.col("source").alias("_s"), F.col("n").alias("_n"), F.col("fences").alias("_f1")
    )
    of_lang = _fences(some.groupBy("lang").agg(F.sum("n").alias("n"), *merged)).select(
        F.col("lang").alias("_m"), F.col("n").alias("_n2"), F.col("fences").alias("_f2")
    )
    # No row where no document is usable: a merge of nothing is no sketch.
    of_all = _fences(some.agg(F.count("*").alias("n"), *merged).where("n > 0")).select(
        F.col("fences").alias("_f3")
    )
    return (
        groups.select("lang", "source")
        .join(of_pair, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")), "left")
        .join(of_lang, F.col("lang").eqNullSafe(F.col("_m")), "left")
        .join(F.broadcast(of_all), F.lit(True), "left")  # one row at most
        .withColumn("_f2", _drawn(F.col("_f2"), F.col("_n2"), F.col("_f3")))
        .select("lang", "source", _drawn(F.col("_f1"), F.col("_n"), F.col("_f2")).alias("fences"))
    )


def _outside(name: str) -> Column:
    value, fence = F.col("features")[name], F.col("fences")[name]
    too_small = F.coalesce(value < fence["low"], F.lit(False))
    return too_small | F.coalesce(value > fence["high"], F.lit(False))


def judge(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``carry`` of ``docs``, or all), ``features``, ``base_failed`` and ``kept``.

    ``docs`` needs ``text``, ``lang`` and ``source``; other columns, whatever
    their names, only ride along in ``row``. Null and empty texts have no words
    and fail the base rules. Equal rows are judged alike. An empty table gives
    an empty result.
    """
    measured = materialise(
        docs.select(
            row_of(docs, carry),
            F.col("lang"),
            F.col("source"),
            features(F.col("text")).alias("features"),
        )
    )
    # Written, so that a short table of fences is broadcast and documents are not shuffled.
    fences = materialise(adaptive_fences(measured)).withColumnsRenamed(
        {"lang": "_lang", "source": "_source"}
    )
    failed = base_failed(F.col("features")["n_words"], F.col("features")["n_repeat_words"])
    outside = F.lit(False)
    for name in RULES:
        outside = outside | _outside(name)
    return measured.join(
        fences,
        F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")),
        "left",
    ).select(
        "row",
        "features",
        failed.alias("base_failed"),
        (~failed & ~outside).alias("kept"),
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with the same columns."""
    return judge(docs).where("kept").select("row.*")
