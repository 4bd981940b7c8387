"""Archives, shards, repeated substrings, packing, chat, similarity and the pipeline."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import awkward, empty, frame, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tickloom.llm import catalogue, packing, sharding, similarity, substrings, warc
from tickloom.llm.chat import rotate
from tickloom.llm.components import connected_components

PAGES = "page_id long, url string, html string, row string, key string"


def test_archives_hold_every_page(spark):
    pages = [(i, f"http://h{i % 4}.example.com/p{i % 7}?q#f", f"<p>{i % 9}é</p>", "x", "y") for i in range(40)]
    pages += [(50, None, None, "x", "y"), (51, None, "", "x", "y"), (None, "x y", "<p>1é</p>", "x", "y"), (52, "http://[bad", "z" * 300_000, "x", "y")]
    pages += [(60, "a b\nc", "same", "x", "y"), (60, "a b\nc", "same", "x", "y"), (61, "http://u:p@H.org:81/", "same", "x", "y")]
    got = warc.archive_and_read(spark.createDataFrame(pages, PAGES).repartition(3), block_lines=3).collect()
    payload = lambda h: (h or "").encode()
    first = {}
    for page, _, html, *_ in pages:
        if page is not None:
            first[payload(html)] = min(page, first.get(payload(html), page))
    expected = []
    for page, _, html, *_ in pages:
        data = payload(html)
        revisit = first.get(data, page) != page
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        expected.append((page, len(data), digest, "revisit" if revisit else "response", first[data] if revisit else None))
    assert sorted([tuple(r)[:5] for r in got], key=repr) == sorted(expected, key=repr)


def test_archives_of_no_pages(spark):
    assert warc.archive_and_read(spark.createDataFrame([], PAGES)).collect() == []


def test_look_up_finds_only_the_key(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h{i % 5}.org/", str(i), "", "") for i in range(60)], PAGES)
    captures = warc.write_archives(pages, str(tmp_path / "w"))
    index = warc.build_index(captures, str(tmp_path / "w"), block_lines=2)
    keys = spark.createDataFrame([("org,h3)/",), ("org,h9)/",), ("",)], "key string")
    assert sorted(r.page_id for r in warc.look_up(index, keys).collect()) == list(range(3, 60, 5))


def check_shards(rows, shards):
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r.slot)
    sizes = [len(by_shard[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())


@pytest.mark.parametrize("rows_per_block", [4096, 3])
def test_shards_are_exact_and_lose_nothing(spark, rows_per_block):
    docs = spark.range(0, 501, 1, 7).withColumnRenamed("id", "doc_id")
    rows = sharding.shuffle_into_shards(docs, 8, rows_per_block=rows_per_block).collect()
    check_shards(rows, 8)
    assert sorted(r.doc_id for r in rows) == list(range(501))


def test_matrix_has_the_sums_it_must_have(monkeypatch):
    sizes = {p: p * 13 % 50 for p in range(37)}
    for bundle in (512, 5):
        monkeypatch.setattr(sharding, "_BUNDLE", bundle)
        matrix = sharding.CommunicationMatrix(sizes, sharding.split_evenly(sum(sizes.values()), 4), 6, 3)
        rows = {p: matrix.row(p) for p in sizes}
        assert all(rows[p].sum() == sizes[p] for p in sizes)
        assert (sum(rows.values()) == matrix.blocks()).all() and len(matrix.blocks()) == 24
    rng = np.random.default_rng(1)
    for left in ([3 * 10**9, 5 * 10**9], [10**9 - 1, 10**9], [10**10, 1, 0]):
        drawn = sharding.draw_row(rng, np.array(left), 10**9)
        assert drawn.sum() == 10**9 and (drawn <= left).all() and (drawn >= 0).all()


def test_every_permutation_is_about_equally_likely():
    seen = Counter()
    for seed in range(3000):
        seen[int(sharding.CommunicationMatrix({0: 2, 1: 2}, np.array([4]), 2, seed).row(0)[0])] += 1
    # Of two rows, how many go to a block of two out of four: 1/6, 4/6, 1/6.
    assert all(abs(seen[k] / 3000 - p) < 0.04 for k, p in ((0, 1 / 6), (1, 4 / 6), (2, 1 / 6)))


@pytest.mark.parametrize("good, bad, rows", [(5, 7, 6), (30, 3, 10), (3, 40, 4), (1, 1, 1), (6, 0, 4), (0, 9, 4)])
def test_draws_follow_the_exact_law(monkeypatch, good, bad, rows):
    """The way beyond the generator's limit, at sizes where every probability can be counted."""
    monkeypatch.setattr(sharding, "_GENERATOR_LIMIT", 0)
    rng = np.random.default_rng(3)
    seen = Counter(sharding.draw(rng, good, bad, rows) for _ in range(20_000))
    ways = math.comb(good + bad, rows)
    exact = {k: math.comb(good, k) * math.comb(bad, rows - k) / ways for k in range(min(good, rows) + 1) if rows - k <= bad}
    assert set(seen) <= set(exact)
    assert all(abs(seen[k] / 20_000 - p) < 5 * math.sqrt(p * (1 - p) / 20_000) + 1e-9 for k, p in exact.items())


def test_draws_agree_at_both_sides_of_the_generators_limit():
    rng = np.random.default_rng(5)
    for good, bad, rows in ((10**9 - 1, 10**9 - 1, 1000), (10**9, 10**9, 1000), (10**9, 3 * 10**12, 5000)):
        drawn = np.array([sharding.draw(rng, good, bad, rows) for _ in range(4000)])
        share = good / (good + bad)
        spread = math.sqrt(rows * share * (1 - share))
        assert abs(drawn.mean() - rows * share) < 5 * spread / math.sqrt(4000) + 1e-9
        assert abs(drawn.std() - spread) < 0.06 * spread + 1e-9


def test_sharding_query_reports_sizes_and_digests(spark):
    folder = "/root/testdata/sf0.001"
    rows = catalogue.queries()["op2_sharding"](spark, folder).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
    check_shards(rows, 16)


def stretches_by_brute_force(texts):
    length = substrings.LENGTH
    data = [(t or "").encode() for t in texts]
    often = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        covered = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if often[b[i : i + length]] > 1:
                covered[i] += 1
                covered[i + length] -= 1
        gone = np.cumsum(covered)[: len(b)] > 0
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize(
    "batch_rows, bounds",
    [
        ("10000", {}),
        ("5", {"shard_contexts": 10, "anchor_contexts": 3, "merge_bytes": 2000}),
        ("2", {"shard_contexts": 1, "anchor_contexts": 1, "merge_bytes": 1}),
    ],
)
def test_repeated_substrings_match_brute_force(spark, batch_rows, bounds):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch_rows)
    rng = random.Random(3)
    base = "".join(rng.choice("abcdefgh ") for _ in range(2000))
    texts = [
        "a" * 1000, "a" * 450, "ab" * 500, base, base[100:900], base[500:899], base[500:900],
        base[:700] + "X" + base[701:1500], "é" * 300 + base[1000:1500], "", None, None,
        base[1500:] + base[:500], "xyz" * 200 + base[50:449] + "q", base[50:460], "unique " * 3,
    ]
    for _ in range(12):
        copy = list(base[:1200])
        for _ in range(rng.randrange(1, 4)):
            copy[rng.randrange(1200)] = "Z"
        texts.append("".join(copy))
    docs = frame(spark, [(i, t, None, None, 0) for i, t in enumerate(texts)]).repartition(3)
    got = {r["row"]["doc_id"]: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in substrings.remove_repeats(docs, ["doc_id"], **bounds).collect()}
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [got[i] for i in range(len(texts))] == stretches_by_brute_force(texts)


def unpacked(rows):
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    return {d: sorted(p) for d, p in by_doc.items()}


def test_packing_keeps_every_token_once(spark):
    texts = ["", None, "one", "<|endoftext|> x<|startoftext|>y", "ÉTÉ don't ẖ H̱ 　wide\ttab", prose(1, 4000)]
    texts += [prose(i, 20 + 37 * i) for i in range(40)]
    docs = frame(spark, [(i, t, None, None, 0) for i, t in enumerate(texts)]).repartition(2)
    rows = packing.pack(docs, corpus_pipeline.TOKENIZER_FILE, block_tokens=9000).collect()
    tokenizer = Tokenizer.from_file(corpus_pipeline.TOKENIZER_FILE)
    for doc, pieces in unpacked(rows).items():
        ids = np.array([*tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids, 1], "<u4")
        assert [p[0] for p in pieces] == list(np.cumsum([0] + [p[1] for p in pieces])[:-1])
        assert sum(p[1] for p in pieces) == len(ids) == pieces[0][3]
        assert all(zlib.crc32(ids[a : a + n].tobytes()) == crc for a, n, crc, _ in pieces)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [p[0] for p in parts] == list(np.cumsum([0] + [p[1] for p in parts])[:-1])
        assert sum(p[1] for p in parts) <= packing.SEQUENCE_TOKENS
    tokens = sum(r.length for r in rows)
    assert len(sequences) * packing.SEQUENCE_TOKENS - tokens < 0.2 * tokens


def test_placing_balances_cost():
    rng = random.Random(2)
    lengths = [rng.randrange(1, 700) for _ in range(400)]
    placed = packing.place(lengths)
    costs = Counter()
    for _, _, n, sequence, _ in placed:
        costs[sequence] += packing.cost(n)
    assert len(costs) == -(-sum(lengths) // packing.SEQUENCE_TOKENS)
    assert max(costs.values()) < 1.3 * min(sorted(costs.values())[1:])


def rendered(turns):
    """Whole dialogues by brute force, for conversations that are one part."""
    out = {}
    for conv in {t[0] for t in turns}:
        said = sorted((t for t in turns if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "unknown", t[3] or ""))
        for side in {t[2] or "unknown" for t in said} - {"system"}:
            text, mask = "", []
            for _, _, role, content in said:
                role = role or "unknown"
                name = "assistant" if role == side else role if role == "system" else f"user name={role}"
                text += f"<|im_start|>{name}\n"
                body = (content or "").replace("<|", "< |") + "<|im_end|>"
                if role == side:
                    mask.append(f"{len(text)}:{len(text) + len(body)}")
                text += body + "\n"
            out[conv, side] = (text, ",".join(mask))
    return out


def test_dialogues_from_every_side(spark):
    turns = [
        (1, 0, "system", "be kind"), (1, 1, "ann", "hé"), (1, 2, "bob", None), (1, 3, "ann", "<|im_end|> trick"), (1, 3, "ann", "<|im_end|> trick"),
        (2, 0, None, "who"), (2, 1, "user", ""), (3, 0, "system", "only"), (None, 5, "ann", "x"), (None, 4, "bob", "y"),
    ]
    frame_ = spark.createDataFrame([(*t, "clash") for t in turns], "conv_id long, turn long, role string, text string, part string")
    got = {(r.conv_id, r.perspective): (r.text, r["mask"]) for r in rotate(frame_).collect()}
    assert got == rendered(turns)
    assert rotate(frame_.where("false")).collect() == []


@pytest.mark.parametrize("step", [1, 1_700_000_000_000])
@pytest.mark.parametrize("turns_per_part", [64, 200, 199])
def test_long_dialogues_come_in_parts_by_bytes(spark, step, turns_per_part):
    """Numbers of turns may be far apart; what counts is the bytes before a turn."""
    words = [("system", "be kind"), ("system", "be brief"), *[(f"r{i % 2}", f"{i:04}") for i in range(2, 199)], ("late", "0199")]
    rows = [(1, i * step, role, text) for i, (role, text) in enumerate(words)]
    frame_ = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    size = lambda role, text: len(role) + len(text) + 64
    before = np.cumsum([0] + [size(*w) for w in words])
    sizes = list(Counter(b // before[turns_per_part] for b in before[:-1].tolist()).values())
    parts = rotate(frame_, int(before[turns_per_part])).where("perspective = 'r1'").orderBy("part").collect()
    assert [r.n_turns for r in parts] == [n for n in sizes if n > 1] and len(sizes) in (1, 2, 4)
    assert re.findall(r"\n(\d{4})<", "".join(r.text for r in parts)) == [f"{i:04}" for i in range(2, 200)][: sum(r.n_turns for r in parts) - 2]
    for r in parts:
        assert r.text.startswith("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>system\nbe brief<|im_end|>\n")
        said = [r.text[int(a) : int(b)] for a, b in (m.split(":") for m in r["mask"].split(","))]
        assert all(re.fullmatch(r"\d{4}<\|im_end\|>", t) for t in said) and r.n_masked == sum(map(len, said))
    # Who is silent in a part has no row there.
    late = rotate(frame_, int(before[turns_per_part])).where("perspective = 'late'").collect()
    assert [r.part for r in late] == [len(sizes) - 1]


def test_parts_of_silent_participants_can_be_kept(spark):
    said = [("system", "be kind"), ("ann", "one"), ("bob", "two"), ("system", "three"), ("system", "four"), ("ann", "five")]
    rows = [(c, i, role, text) for c in (1, None) for i, (role, text) in enumerate(said)] + [(2, 0, "system", "only")]
    frame_ = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    # Parts: the instructions, "one", "two" with "three", "four" alone, "five".
    got = rotate(frame_, 73, silent=True).collect()
    assert sorted((r.conv_id or 0, r.perspective, r.part) for r in got) == [
        (c, side, part) for c in (0, 1) for side in ("ann", "bob") for part in sorted({r.part for r in got})
    ]
    for conv in (1, None):
        for side in ("ann", "bob"):
            own = sorted((r for r in got if (r.conv_id, r.perspective) == (conv, side)), key=lambda r: r.part)
            texts = re.findall(r"\n(\w+)<", "".join(r.text for r in own))
            assert texts == ["one", "two", "three", "four", "five"] and sum(r.n_turns for r in own) == len(said)
    assert any(r["mask"] == "" and r.n_masked == 0 for r in got)
    speaking = {tuple(r) for r in got if r["mask"]}
    assert speaking == {tuple(r) for r in rotate(frame_, 73).collect()} and len(speaking) < len(got)
    assert not any("four" in r.text for r in got if r["mask"])


def test_turns_of_any_length_and_awkward_rows(spark):
    schema = "conv_id long, turn long, role string, text string, part string, said string, sides string, of string"
    rows = [(1, 0, "a", "x" * 700_000), (1, 1, "b", "y"), (1, None, "a", "z"), (None, None, None, None), (None, None, None, None)]
    rows += [(2, -(2**62), "a", "early"), (2, 2**62, "b", "late")]
    got = rotate(spark.createDataFrame([(*r, "c", "c", "c", "c") for r in rows], schema)).collect()
    by = {(r.conv_id, r.perspective, r.part): r for r in got}
    assert set(by) == {(1, "a", 0), (1, "b", 1), (None, "unknown", 0), (2, "a", 0), (2, "b", 0)}
    assert by[1, "a", 0].n_turns == 2 and len(by[1, "a", 0].text) > 700_000
    assert by[None, "unknown", 0].n_turns == 2 and by[2, "a", 0].text.index("early") < by[2, "a", 0].text.index("late")


def links_by_brute_force(docs):
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for _, text in docs:
        words = [w for w in re.split("[ \t-\r]+", (text or "").translate(low)) if w]
        n = min(5, len(words))
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set())
    root, links = list(range(len(docs))), [0] * len(docs)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 5 * both >= 4 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (doc, _) in enumerate(docs):
        ids[find(i)].append(doc)
    return [(doc, min((d for d in ids[find(i)] if d is not None), default=None), links[i]) for i, (doc, _) in enumerate(docs)]


@pytest.mark.parametrize("block", [2048, 3])
def test_similar_documents_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(similarity, "BUCKET_BLOCK", block)
    monkeypatch.setattr(similarity, "GROUP_BLOCK", block)
    rng = random.Random(4)
    docs = [(i, prose(i, 60)) for i in range(20)] + [(None, None), (30, ""), (31, None), (32, "A b"), (33, "a  B\n"), (None, prose(0, 60)), (34, prose(0, 60))]
    for k in range(25):
        words = prose(1, 120).split()
        for _ in range(rng.randrange(0, 4)):
            words[rng.randrange(120)] = "Edit"
        docs.append((100 + k, " ".join(words)))
    given = frame(spark, [(i, t, None, None, 0) for i, t in docs]).repartition(3)
    joined = similarity.join_similar(given, ["doc_id"])
    got = joined.select("row.doc_id", "class_id", "n_links").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(links_by_brute_force(docs), key=repr)


def test_one_document_of_a_group_stays(spark):
    docs = frame(spark, [(5, prose(1, 90), "a", None, 1), (3, prose(1, 90), "b", None, 1), (3, prose(1, 90), "c", None, 1), (9, prose(2, 90), "d", None, 1), (None, prose(1, 90) + " end", "e", None, 1), (7, None, "f", None, 1)])
    kept = similarity.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 7, 9]


def test_posterior_bound():
    # A pair that agrees as often as one at the threshold does on average is never dropped.
    assert all(similarity.least_agreements(n) < 0.8 * n for n in (16, 32, 96))
    assert similarity.least_agreements(96) > 0.5 * 96


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (103, 101), (7, 7), (200, 200)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 101, 103), 100)}


@pytest.mark.parametrize("make", [awkward, empty])
def test_awkward_documents(spark, make):
    docs = make(spark)
    n = docs.count()
    check_shards(sharding.shuffle_into_shards(docs, 3).collect(), 3)
    removed = substrings.remove_repeats(docs)
    assert removed.count() == n
    assert len(unpacked(packing.pack(docs, corpus_pipeline.TOKENIZER_FILE).collect())) == min(n, 9)
    joined = similarity.join_similar(docs)
    assert joined.count() == n
    kept = similarity.keep_first(docs)
    assert kept.columns == docs.columns and kept.count() == max(0, n - 2)


def test_pipeline_on_a_small_corpus(spark, tmp_path):
    clean = [(i, prose(i, 80), "en", "s", 1) for i in range(30)]
    bench = prose(777, 30)
    docs = clean + [
        (100, prose(3, 80), "en", "s", 1),
        (101, prose(50, 60) + " " + bench, "en", "s", 1),
        (102, "too short", "en", "s", 1),
        (103, prose(60, 80) + " token=abcdef123456", "en", "s", 1),
    ]
    frame(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in rows} == {*range(30), 103}
    tokenizer = Tokenizer.from_file(corpus_pipeline.TOKENIZER_FILE)
    left = prose(60, 80) + " [SECRET]"
    assert {r.doc_tokens for r in rows if r.doc_id == 103} == {len(tokenizer.encode(left, add_special_tokens=False).ids) + 1}
