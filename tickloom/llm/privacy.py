"""Sanitisation of personal data and of the terms that reveal it.

Method. Personal data are found by pattern. Corpus counts tell how strongly a
term reveals an entity (one address, one number): with N different texts and the entity in ``n_e`` of them,
the entity carries IC = log2(N / n_e) bits, and a term of whose sightings a share p is with the
entity loses log2(1 / p) of them: their pointwise mutual information is IC - log2(1 / p).

How p is judged depends on how the two are seen together. Sightings are counted, over different texts.
Beside the entity (within ``NEAR`` code points) a name may be met once, so the share of its sightings that are
there counts as it is, smoothed by half a sighting. Words that merely stand in the same text are held
against their rate elsewhere: p is the lower end of Wilson's interval of the share of sightings in the entity's
texts, so a word met once, as most words are, reveals nothing, and one met again and again there
and nowhere else does. A text in which several entities stand is shared among them. With more than
``MOST_ENTITIES`` it is a list, which gives each of them so small a share that a pair met in lists only
never discloses: pairs are made from the other texts, and lists add what they hold of these. So pairs of
term and entity grow with the text, and every text counts.

A term that loses at most ``REMOVED`` bits is removed, one that loses at most ``GENERALISED`` is
replaced by a mark, wherever it stands in the texts of that entity. Both are bits below the
entity's own, so the thresholds do not move with the size of the corpus. Entities with fewer than
``LEAST_INFORMATION`` bits are met everywhere and identify nobody. Words inside an entity count as
terms of the text. Entities of the same texts are judged as one group. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import let, listed, matches, replaced, row_of
from tickloom.session import materialise

#: Bits of an entity's information that a term may lose and still reveal it.
REMOVED = 1.0
GENERALISED = 1.5
LEAST_INFORMATION = 3.0
#: Code points around an entity in which the words beside it stand.
NEAR = 48
#: Sightings of term and entity side by side that are added to those counted.
PRIOR = 0.5
#: Standard deviations by which a share is taken lower for words that are not beside the entity.
DOUBT = 1.64
#: Groups of entities in a text up to which its words are paired with each; longer texts are lists. A list gives a
#: pair less than 1 in ``MOST_ENTITIES`` of its sightings, which must be below the share that discloses.
MOST_ENTITIES = 4
#: Parts into which the texts of an entity are dealt where they are joined by entity.
SALTS = 16

# A run of name characters without "@" fails once, at its start, not at each character.
# After the first dot, labels go on as long as each dot has a label behind it: a loop over
# single characters, since a loop over labels would use the stack of the regex engine.
EMAIL = (
    "(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\\.[A-Za-z0-9-]"
    "(?:(?!\\.(?![A-Za-z0-9-]))[A-Za-z0-9.-])*+"
)
IP = "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++"
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: Digits with single separators. One digit alone also matches; it fails the length test.
CARD = "[0-9](?:(?![\\x20-](?![0-9]))[0-9\\x20-])*+"
PHONE = "\\+[0-9][\\x20().0-9-]+[0-9]"
TERM = "\\p{L}{2,}"

KINDS = ("email", "ip", "card", "phone")


def _digits(value: Column) -> Column:
    return F.translate(value, " ()+.-", "")


def _entities(text: Column) -> dict[str, Column]:
    found = lambda pattern: matches(text, pattern)
    return {
        "email": found(EMAIL),
        "ip": F.filter(found(IP), lambda m: m["value"].rlike(f"^{_BYTE}(?:\\.{_BYTE}){{3}}$")),
        "card": F.filter(
            found(CARD),
            lambda m: F.length(_digits(m["value"])).between(16, 19) & F.call_function("luhn_check", _digits(m["value"])),
        ),
        "phone": F.filter(found(PHONE), lambda m: F.length(_digits(m["value"])).between(8, 15)),
    }


def _as_spans(kind: str, found: Column) -> Column:
    return F.transform(
        found,
        lambda m: F.struct(
            F.lit(KINDS.index(kind)).alias("order"),
            m["start"].alias("start"),
            m["end"].alias("end"),
            F.lit(kind).alias("kind"),
            F.lower(m["value"]).alias("value"),
        ),
    )


def _placed(spans: Column) -> Column:
    names = ("order", "start", "end", "kind")
    return F.transform(spans, lambda s: F.struct(*[s[n].alias(n) for n in names]))


def find_personal_data(docs: DataFrame, carry: list[str] | None = None) -> DataFrame:
    """``row`` (the columns ``carry`` of ``docs``, or all), ``base`` and ``spans``.

    Both are arrays of (order, start, end, kind), by kind and start; positions
    are code points. ``base`` has the personal data, ``spans`` also the ``term`` and ``general``
    spans of words that disclose it. A null text is empty and texts without personal
    data have empty arrays. Equal rows get equal results, as do documents
    with equal or null ids. Other columns may have any names. An empty table
    gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    found = F.concat(*[_as_spans(k, m) for k, m in _entities(text).items()])
    entities = materialise(
        docs.select(
            row_of(docs, carry),
            F.xxhash64(text).alias("text_hash"),
            let(
                found, lambda f: F.struct(f.alias("found"), F.when(F.size(f) > 0, text).alias("text"))
            ).alias("of"),
        )
    ).select("row", "text_hash", "of.*")
    # Written, so that a short table of terms is broadcast and documents are not shuffled.
    terms = materialise(disclosing_spans(entities, docs))
    base = F.sort_array(_placed(F.col("found")))
    none = F.array().cast(terms.schema["terms"].dataType)
    with_entities = entities.where(F.size("found") > 0).join(terms, F.col("text_hash") == terms["of"], "left")
    # Documents without personal data need no join.
    return with_entities.select(
        "row", base.alias("base"), F.concat(base, F.coalesce(F.sort_array("terms"), none)).alias("spans")
    ).unionAll(
        entities.where(F.size("found") == 0).select("row", none.alias("base"), none.alias("spans"))
    )


def _term_hashes(text: Column) -> Column:
    """The words of a text, each as often as it stands there."""
    return F.transform(F.regexp_extract_all(text, F.lit(TERM), 0), lambda w: F.xxhash64(F.lower(w)))


def _beside(text: Column, span: Column) -> Column:
    """The different words that stand whole within ``NEAR`` code points of an entity."""
    # One more on either side tells whether the word at the edge is cut.
    first = F.greatest(span["start"] - NEAR - 1, F.lit(0))
    before = F.substring(text, first + 1, span["start"] - first)
    after = F.substring(text, span["end"] + 1, F.lit(NEAR + 1))
    cut = lambda side, pattern, is_cut: F.when(is_cut, F.regexp_replace(side, pattern, "")).otherwise(side)
    whole_before = cut(before, "^(?:\\p{L}+|[^\\p{L}])", first > 0)
    whole_after = cut(after, "(?:\\p{L}+|[^\\p{L}])$", F.length(after) > NEAR)
    return F.array_distinct(_term_hashes(F.concat_ws(" ", whole_before, whole_after)))


def _groups_of_texts(texts: DataFrame) -> DataFrame:
    """``text_hash``, ``group``, ``n_e`` and ``near``, the words beside entities of the group in the text.

    Entities that stand in the same texts are one group.
    """
    of = F.transform(
        "found",
        lambda s: F.struct(s["order"].alias("kind"), s["value"].alias("value"), _beside(F.col("text"), s).alias("near")),
    )
    each = (
        texts.select("text_hash", F.explode(of).alias("e"))
        .groupBy("text_hash", F.col("e.kind").alias("kind"), F.col("e.value").alias("value"))
        .agg(F.array_distinct(F.flatten(F.collect_list("e.near"))).alias("near"))
        .withColumn("salt", F.pmod("text_hash", F.lit(SALTS)))
    )
    seeds = {"a": F.xxhash64("text_hash"), "b": F.xxhash64("text_hash", F.lit(1))}
    groups = (
        each.groupBy("kind", "value", "salt")
        .agg(F.count("*").alias("n"), *[F.bit_xor(h).alias(name) for name, h in seeds.items()])
        .groupBy("kind", "value")
        .agg(
            F.sum("n").alias("n_e"),
            *[F.bit_xor(name).alias(name) for name in seeds],
            F.collect_list("salt").alias("salts"),
        )
        .select("kind", "value", "n_e", F.xxhash64("n_e", *seeds).alias("group"), F.explode("salts").alias("salt"))
    )
    return (
        each.join(groups, ["kind", "value", "salt"])
        .groupBy("text_hash", "group")
        .agg(F.max("n_e").alias("n_e"), F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    )


def _lower_share(n: Column, of: Column) -> Column:
    """Lower end of Wilson's interval for ``n`` of ``of``; ``n`` need not be whole."""
    share, z2 = n / of, DOUBT * DOUBT
    spread = DOUBT * F.sqrt(share * (1 - share) / of + z2 / (4 * of * of))
    return (share + z2 / (2 * of) - spread) / (1 + z2 / of)


def disclosing_spans(entities: DataFrame, docs: DataFrame) -> DataFrame:
    """``of`` (a text hash of ``entities``) with ``terms``, the spans that disclose an entity."""
    texts = materialise(entities.where(F.size("found") > 0).select("text_hash", "text", "found").distinct())
    n_texts = entities.select("text_hash").distinct().agg(F.count("*").alias("n_texts"))
    groups = materialise(
        _groups_of_texts(texts)
        .crossJoin(F.broadcast(n_texts))  # one row
        .where(F.log2(F.col("n_texts") / F.col("n_e")) >= LEAST_INFORMATION)
        .drop("n_texts")
    )
    of_term = (
        docs.select("text")
        .distinct()
        .select(F.explode(_term_hashes(F.col("text"))).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("n_t"))
    )
    beside = (
        groups.select("group", F.explode("near").alias("term")).groupBy("group", "term").agg(F.count("*").alias("n"))
    )
    # The lower end for n of n sightings is n / (n + DOUBT ** 2), so fewer do not disclose.
    least = DOUBT * DOUBT / (2**GENERALISED - 1)
    shared = groups.groupBy("text_hash").agg(F.count("*").alias("among"))
    members = groups.select("text_hash", "group").join(shared, "text_hash")
    is_list = F.col("among") > MOST_ENTITIES
    in_lists = members.where(is_list).select("group", F.lit(True).alias("in_list")).distinct()
    words = (
        texts.join(shared, "text_hash")
        .select("text_hash", "among", F.explode(_term_hashes(F.col("text"))).alias("term"))
        .groupBy("text_hash", "among", "term")
        .agg(F.count("*").alias("n"))
    )
    apart = (
        words.where(~is_list)
        .join(groups.select("text_hash", "group"), "text_hash")
        .groupBy("group", "term")
        .agg(F.sum(F.col("n") / F.col("among")).alias("n"), F.sum("n").alias("held"))
        .join(in_lists, "group", "left")
        .where((F.col("n") >= least) | F.col("in_list"))
    )
    none = [F.lit(None).cast("long").alias("held"), F.lit(None).cast("boolean").alias("in_list")]
    seen = beside.select("group", "term", F.col("n").cast("double"), *none, F.lit(True).alias("beside")).union(
        apart.select("group", "term", "n", "held", "in_list", F.lit(False))
    )
    share = F.when(F.col("beside"), (F.col("n") + PRIOR) / (F.col("n_t") + PRIOR)).otherwise(
        _lower_share(F.least("n", "n_t"), F.col("n_t"))
    )
    lost = -F.log2(share)
    # Sightings that are not in the texts so far are in lists at most. What lists cannot lift over the bounds
    # goes here, so that a term is left in pairs with few entities.
    lifted = F.col("n") + (F.col("n_t") - F.col("held")) / (MOST_ENTITIES + 1)
    liftable = F.col("in_list") & (lifted >= least) & (lifted >= F.col("n_t") * 2**-GENERALISED)
    pairs = materialise(seen.join(of_term, "term").where((lost <= GENERALISED) | F.coalesce(liftable, F.lit(False))))
    from_lists = (
        pairs.where("in_list")
        .select("group", "term")
        .join(words.where(is_list), "term")
        .join(members.where(is_list).select("text_hash", "group"), ["text_hash", "group"])
        .groupBy("group", "term")
        .agg(F.sum(F.col("n") / F.col("among")).alias("more"))
    )
    revealing = (
        pairs.join(from_lists, ["group", "term"], "left")
        .withColumn("n", F.when(F.col("beside"), F.col("n")).otherwise(F.col("n") + F.coalesce("more", F.lit(0.0))))
        .where(lost <= GENERALISED)
        .groupBy("group", "term")
        .agg(F.min(lost).alias("lost"))
        .select("group", F.struct("term", (F.col("lost") <= REMOVED).alias("is_removed")).alias("term"))
    )
    hidden = (
        groups.select("text_hash", "group")
        .join(revealing, "group")
        .groupBy("text_hash")
        .agg(F.sort_array(F.collect_set("term")).alias("hidden"))
    )
    # Finding places is work, not bytes, so adaptive execution must not put many texts into one task.
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    marked = texts.join(hidden, "text_hash").repartition(n, "text_hash")
    return marked.select(
        F.col("text_hash").alias("of"), _places(F.col("text"), F.col("hidden"), F.col("found")).alias("terms")
    )


def _places(text: Column, hidden: Column, found: Column) -> Column:
    """The spans of the words of ``text`` in the sorted ``hidden``, but those inside personal data.

    Their kind is ``term`` where they are removed and ``general`` where a mark takes their place.
    """

    def below(numbers: Column, value: Column) -> Column:
        # Bisection, so that a long text with many such words does not cost their product.
        steps = F.transform(F.sequence(F.lit(30), F.lit(0), F.lit(-1)), lambda i: F.pow(F.lit(2), i).cast("int"))
        return F.aggregate(
            F.filter(steps, lambda step: step <= F.size(numbers)),
            F.lit(0),
            lambda n, step: F.when(F.get(numbers, n + step - 1) < value, n + step).otherwise(n),
        )

    def placed(starts: Column, ends: Column, hashes: Column) -> Column:
        def level(w: Column) -> Column:
            """0 where the word is not hidden, 1 where it is generalised, 2 where it is removed."""

            def at(n: Column, h: Column) -> Column:
                # A term that reveals several entities comes twice if they disagree; the last removes it.
                last = F.when(F.get(hashes, n + 1) == h, n + 1).otherwise(n)
                found = F.get(hidden, last)["is_removed"].cast("int") + 1
                return F.when(F.get(hashes, n) == h, found).otherwise(0)

            return let(F.xxhash64(F.lower(w["value"])), lambda h: let(below(hashes, h), lambda n: at(n, h)))

        def inside(w: Column) -> Column:
            ended = below(ends, w["start"] + 1)
            return (below(starts, w["start"] + 1) > ended) & (below(ends, w["end"]) == ended)

        leveled = F.transform(
            F.filter(matches(text, TERM), lambda w: ~inside(w)),
            lambda w: F.struct(w["start"].alias("start"), w["end"].alias("end"), F.coalesce(level(w), F.lit(0)).alias("level")),
        )
        return F.filter(leveled, lambda w: w["level"] > 0)

    hashes = F.transform(hidden, lambda h: h["term"])
    order = F.lit(len(KINDS)).alias("order")
    return F.transform(
        let(
            F.sort_array(F.transform(found, lambda s: s["start"])),
            lambda starts: let(
                F.sort_array(F.transform(found, lambda s: s["end"])),
                lambda ends: let(hashes, lambda h: placed(starts, ends, h)),
            ),
        ),
        lambda w: F.struct(
            order,
            w["start"].alias("start"),
            w["end"].alias("end"),
            F.when(w["level"] == 2, "term").otherwise("general").alias("kind"),
        ),
    )


def sanitise(docs: DataFrame) -> DataFrame:
    """The rows and columns of ``docs`` with personal data and disclosing terms out of ``text``.

    Disclosing terms are removed, weaker ones become ``[general]``, and personal data are generalised to
    their kind, as ``[email]``. Where kinds overlap, the run is called ``[personal]``.
    """
    found = find_personal_data(docs)
    text = F.coalesce("row.text", F.lit(""))
    new = F.when(F.size("spans") > 0, generalised(text, F.col("spans"))).otherwise(F.col("row.text"))
    return found.withColumn("new", new).select(
        *[(F.col("new") if n == "text" else F.col("row").getField(n)).alias(n) for n in docs.columns]
    )


def generalised(text: Column, spans: Column) -> Column:
    def mark(begin: Column, end: Column) -> Column:
        exact = F.filter(spans, lambda s: (s["start"] == begin) & (s["end"] == end))
        kind = F.get(exact, F.lit(0))["kind"]
        return F.when(kind == "term", "").otherwise(
            F.concat(F.lit("["), F.coalesce(kind, F.lit("personal")), F.lit("]"))
        )

    return replaced(text, spans, mark)


def span_columns() -> list[Column]:
    """Counts of the personal data, digest of their spans, and all spans."""
    of = lambda kind: F.filter("base", lambda s: s["kind"] == kind)
    return [
        *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    ]
