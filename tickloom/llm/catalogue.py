"""One query per training-data operator over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import privacy, secrets
from tickloom.llm.alignment import align_tokens
from tickloom.llm.chat import PART_BYTES, TURN_BYTES, rotate
from tickloom.llm.classifier import classify
from tickloom.llm.common import read_table
from tickloom.llm.decontamination import find_benchmark
from tickloom.llm.packing import pack
from tickloom.llm.quality import (
    COUNTS,
    MAX_REPEAT_PERCENT,
    MIN_WORDS,
    RULES,
    SHRINKAGE,
    TWO_SIDED,
    judge,
)
from tickloom.llm.sharding import shuffle_into_shards
from tickloom.llm.similarity import join_similar
from tickloom.llm.substrings import remove_repeats
from tickloom.llm.warc import archive_and_read
from tickloom.llm.whitening import whiten


WORD_BPE_FILE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE_FILE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_FILE = public_tokenizers.path("piece_bpe_32k.model")


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    return archive_and_read(read_table(spark, folder, "pages"))


OP1_SQL = """
WITH hashed AS (
  SELECT page_id, url, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h
  FROM pages
), found AS (
  SELECT *, min(page_id) OVER (PARTITION BY h) AS first,
    array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + ((('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::INTEGER) & 31), 1)
      for i in range(0, 32)], '') AS payload_digest
  FROM hashed
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to, url
FROM found
"""


def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    sharded = shuffle_into_shards(read_table(spark, folder, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return sharded.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    left = remove_repeats(read_table(spark, folder, "documents"), ["doc_id"])
    return left.select("row.doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = privacy.find_personal_data(read_table(spark, folder, "documents"), ["doc_id"])
    return found.select("row.doc_id", *privacy.span_columns())


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return judge(read_table(spark, folder, "documents"), ["doc_id"]).select(
        "row.doc_id", *[f"features.{name}" for name in COUNTS], "base_failed", "kept"
    )


def _fences_sql(name: str) -> str:
    high, spreads, margin = RULES[name]
    least, most = (f"quantile_disc({name}, {q})" for q in (round(1 - high, 9), high))
    reach = f"({spreads}::DOUBLE * ({most} - {least}) + {margin}::DOUBLE)"
    low = f"{least} - {reach}" if name in TWO_SIDED else "NULL::DOUBLE"
    return f"{low} AS {name}_low, {most} + {reach} AS {name}_high"


_FENCES = ", ".join(_fences_sql(name) for name in RULES)
_BOUNDS = [f"{name}_{side}" for name in RULES for side in ("low", "high")]


def _drawn_sql(own: str, wider: str) -> str:
    return ", ".join(
        f"CASE WHEN {own}.n IS NULL THEN {wider}.{b} "
        f"ELSE ({own}.n * {own}.{b} + {SHRINKAGE} * {wider}.{b}) / ({own}.n + {SHRINKAGE}) END AS {b}"
        for b in _BOUNDS
    )


_OUTSIDE = " OR ".join(
    f"coalesce({n} < g.{n}_low, false) OR coalesce({n} > g.{n}_high, false)" for n in RULES
)
#: With exact quantiles, which the sketches are for groups of up to ``SKETCH_SIZE`` documents.
OP5_SQL = f"""
WITH docs AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM docs)
), repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM windows
    QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1)
  GROUP BY doc_id
), lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM docs)
  WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id
), counts AS (
  SELECT doc_id, lang, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words, n_lines
  FROM docs LEFT JOIN repeats USING (doc_id) LEFT JOIN lines USING (doc_id)
), features AS (
  SELECT *, word_chars / nullif(n_words, 0) AS word_length, n_symbols / nullif(n_words, 0) AS symbol_ratio,
    n_dup_lines / n_lines AS dup_line_ratio, n_repeat_words / nullif(n_words, 0) AS repeat_ratio,
    n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed
  FROM counts
), by_pair AS (
  SELECT lang, source, count(*) AS n, {_FENCES} FROM features WHERE NOT base_failed GROUP BY lang, source
), by_lang AS (
  SELECT lang, count(*) AS n, {_FENCES} FROM features WHERE NOT base_failed GROUP BY lang
), by_all AS (
  SELECT {_FENCES} FROM features WHERE NOT base_failed
), lang_fences AS (
  SELECT l.lang, {_drawn_sql("l", "a")} FROM by_lang l CROSS JOIN by_all a
), wider AS (
  SELECT k.lang, k.source, {", ".join(f"CASE WHEN l.{b} IS NULL THEN a.{b} ELSE l.{b} END AS {b}" for b in _BOUNDS)}
  FROM (SELECT DISTINCT lang, source FROM features) k
    LEFT JOIN lang_fences l ON k.lang IS NOT DISTINCT FROM l.lang CROSS JOIN by_all a
), fences AS (
  SELECT w.lang, w.source, {_drawn_sql("p", "w")}
  FROM wider w LEFT JOIN by_pair p ON w.lang IS NOT DISTINCT FROM p.lang AND w.source IS NOT DISTINCT FROM p.source
), judged AS (
  SELECT d.*, {_OUTSIDE} AS outside
  FROM features d
    LEFT JOIN fences g ON d.lang IS NOT DISTINCT FROM g.lang AND d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT outside AS kept
FROM judged
"""


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(read_table(spark, folder, "documents"), WORD_BPE_FILE)


def op7_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.scan(read_table(spark, folder, "documents"), ["doc_id"])
    return found.select("row.doc_id", *secrets.span_columns())


def op8_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    return rotate(read_table(spark, folder, "conversations"))


OP8_SQL = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
), placed AS (
  SELECT *, row_number() OVER w AS n,
    coalesce(sum(strlen(role) + strlen(text) + {TURN_BYTES}) OVER (
      w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT // {PART_BYTES} AS part
  FROM said WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), others AS (
  SELECT conv_id, min(n) FILTER (role <> 'system') AS n FROM placed GROUP BY conv_id
), shown AS (
  SELECT conv_id, part, n, role, text, true AS own FROM placed
  UNION ALL
  SELECT p.conv_id, q.part, p.n, p.role, p.text, false
  FROM placed p JOIN others o ON p.conv_id IS NOT DISTINCT FROM o.conv_id
    JOIN (SELECT DISTINCT conv_id, part FROM placed WHERE part > 0) q ON p.conv_id IS NOT DISTINCT FROM q.conv_id
  WHERE p.part = 0 AND (o.n IS NULL OR p.n < o.n)
), sides AS (
  SELECT DISTINCT conv_id, part, role AS perspective FROM placed WHERE role <> 'system'
), messages AS (
  SELECT p.conv_id, perspective, p.part, n, own, role = perspective AS mine,
    '<|im_start|>' || CASE WHEN role = perspective THEN 'assistant' WHEN role = 'system' THEN role
      ELSE 'user name=' || replace(role, '<|', '< |') END || chr(10) AS head,
    replace(text, '<|', '< |') || '<|im_end|>' AS body
  FROM shown p JOIN sides s ON p.conv_id IS NOT DISTINCT FROM s.conv_id AND p.part = s.part
), offsets AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (
    PARTITION BY conv_id, perspective, part ORDER BY n
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + length(head) AS first
  FROM messages
)
SELECT conv_id, perspective, part, count(*) FILTER (own) AS n_turns,
  string_agg(head || body || chr(10), '' ORDER BY n) AS text,
  coalesce(string_agg(first || ':' || (first + length(body)), ',' ORDER BY n) FILTER (mine), '') AS mask,
  coalesce(sum(length(body)) FILTER (mine), 0)::BIGINT AS n_masked
FROM offsets GROUP BY ALL
"""


def op9_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    joined = join_similar(read_table(spark, folder, "documents"), ["doc_id"])
    return joined.select("row.doc_id", "class_id", "n_links")


OP9_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), grams AS (
  SELECT doc_id, list_distinct([array_to_string(w[i:i + least(5, len(w)) - 1], ' ')
    for i in range(1, len(w) - least(5, len(w)) + 2)]) AS g
  FROM words WHERE len(w) > 0
), each AS (
  SELECT doc_id, len(g) AS size, unnest(g) AS gram FROM grams
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM each a JOIN each b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.size, b.size
  HAVING 5 * count(*) >= 4 * (a.size + b.size - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT a AS doc_id, min(b) AS class_id,
  (SELECT count(*) FROM links l WHERE l.a = r.a) AS n_links
FROM reach r GROUP BY a
"""


def op10_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, benchmark = read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark")
    found = find_benchmark(docs, benchmark, ["doc_id"])
    return found.select(
        "row.doc_id",
        "n_words",
        F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
    )


OP10_SQL = """
WITH docs AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark
), patterns AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, unnest([array_to_string(w[i:i + least(10, len(w)) - 1], ' ')
    for i in range(1, len(w) - least(10, len(w)) + 2)]) AS pattern
  FROM items WHERE len(w) > 0
), windows AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM docs, (SELECT DISTINCT n FROM patterns)
), hits AS (
  SELECT doc_id, i, x.n, item_id
  FROM windows x JOIN patterns p ON p.n = x.n AND p.pattern = array_to_string(w[i:i + x.n - 1], ' ')
), places AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hits)
  GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN places USING (doc_id) LEFT JOIN found USING (doc_id)
"""


def op11_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return classify(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def op12_cross_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align_tokens(read_table(spark, folder, "documents"), BYTE_BPE_FILE, PIECE_FILE)


def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(read_table(spark, folder, "embeddings"))


_QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_warc": (op1_warc, OP1_SQL),
    "op2_sharding": (op2_sharding, None),
    "op3_suffix_array_dedup": (op3_suffix_array_dedup, None),
    "op4_pii": (op4_pii, None),
    "op5_quality_rules": (op5_quality_rules, OP5_SQL),
    "op6_packing": (op6_packing, None),
    "op7_secret_scans": (op7_secret_scans, None),
    "op8_chat_formatting": (op8_chat_formatting, OP8_SQL),
    "op9_ngram_jaccard_join": (op9_ngram_jaccard_join, OP9_SQL),
    "op10_benchmark_decontamination": (op10_benchmark_decontamination, OP10_SQL),
    "op11_quality_classifier": (op11_quality_classifier, None),
    "op12_cross_tokenizer_alignment": (op12_cross_tokenizer_alignment, None),
    "op13_embedding_whitening": (op13_embedding_whitening, None),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, (query, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _QUERIES.items() if sql is not None}
