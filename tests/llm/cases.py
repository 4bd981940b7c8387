"""Documents with the awkward cases that every operator must handle."""

import random

WORDS = "river stone quiet ladder amber fields under moving seven lanterns cold bright over paper".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def frame(spark, rows, schema="doc_id long, text string, lang string, source string, n_chars long"):
    return spark.createDataFrame(rows, schema)


def awkward(spark):
    """Nulls in every column, empty, blank, long and repeated texts, and clashing extra columns."""
    long_text = prose(1, 30_000)
    rows = [
        (1, prose(2, 120), "en", "a", 5),
        (2, prose(2, 120), "en", "a", 5),
        (2, prose(2, 120), "en", "a", 5),
        (3, "", "en", None, 0),
        (4, None, None, "b", None),
        (None, prose(3, 80), None, None, None),
        (None, None, None, None, None),
        (5, " \n\t ", "fr", "b", 4),
        (6, long_text, "fr", "b", len(long_text)),
        (7, "x" * 50_000, "fr", "b", 50_000),
        (8, "one", "fr", "b", 3),
    ]
    names = "row, id, class, features, spans, base, kept, shard, slot, _text, found, key, of, node, n".split(", ")
    return frame(
        spark,
        [(*r, *["c"] * len(names)) for r in rows],
        "doc_id long, text string, lang string, source string, n_chars long, "
        + ", ".join(f"{n} string" for n in names),
    )


def empty(spark):
    return awkward(spark).where("false")
