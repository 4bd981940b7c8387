"""Alignment against a version that compares every token with every other."""

import hashlib
import json
import random
from collections import Counter

import pytest
import sentencepiece
from cases import awkward, empty, frame
from public_tokenizers import path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickloom.llm import catalogue
from tickloom.llm.alignment import _byte_of_character, align_tokens

BYTE_BPE, PIECES = path("byte_bpe_50k.json"), path("piece_bpe_32k.model")
NOTHING = (0, 0, 0, 0, 0, 0, "")


def tokenizers():
    first = Tokenizer.from_file(BYTE_BPE)
    first.encode_special_tokens = True
    byte_of = _byte_of_character()
    entries = {i: e for e, i in json.load(open(BYTE_BPE, encoding="utf-8"))["model"]["vocab"].items()}
    second = sentencepiece.SentencePieceProcessor(model_file=PIECES)

    def a(text):
        ids = first.encode(f" {text}", add_special_tokens=False).ids
        return [(i, bytes(byte_of[c] for c in entries[i])) for i in ids]

    def b(text):
        pieces = [(i, second.id_to_piece(i)) for i in second.encode(text)]
        return [
            (i, bytes([int(p[3:5], 16)]) if p.startswith("<0x") else p.replace("▁", " ").encode())
            for i, p in pieces
        ]

    return a, b


def ranges(tokens):
    at, out = 0, []
    for i, data in tokens:
        out.append((i, at, at + len(data)))
        at += len(data)
    return out


def brute_force(texts):
    """The contract's columns of every text, one after the other."""
    a_of, b_of = tokenizers()
    aligned = []
    for text in texts:
        if not text:
            aligned.append(None)
            continue
        a, b = a_of(text), b_of(text)
        whole = f" {text}".encode()
        if any(b"".join(d for _, d in side) != whole for side in (a, b)):
            aligned.append(None)
            continue
        a, b = ranges(a), ranges(b)
        links, j = [], 0
        for i, start, end in a:
            while b[j][2] <= start:
                j += 1
            k = j
            while k < len(b) and b[k][1] < end:
                links.append((i, b[k][0]))
                k += 1
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, last = [], 0
        for end in ends:
            sides = [",".join(str(i) for i, s, e in side if s >= last and e <= end) for side in (a, b)] if len(ends) < 400 else None
            groups.append("|".join(sides) if sides else "")
            last = end
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if len(ends) < 400 else None
        aligned.append((len(a), len(b), len(ends), links, sha))
    docs = Counter(pair for x in aligned if x for pair in set(x[3]))
    most = {}
    for (a, _), n in docs.items():
        most[a] = max(n, most.get(a, 0))
    return [
        NOTHING
        if x is None
        else (
            x[0],
            x[1],
            x[2],
            len(x[3]),
            sum(docs[p] == most[p[0]] for p in x[3]),
            sum(docs[p] for p in x[3]),
            x[4],
        )
        for x in aligned
    ]


def check(rows, docs):
    expected = sorted(((i, *e) for (i, _), e in zip(docs, brute_force([t for _, t in docs]))), key=repr)
    got = sorted(
        ((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows),
        key=repr,
    )
    assert [g[:7] for g in got] == [e[:7] for e in expected]
    assert all(e[7] in (None, g[7]) for g, e in zip(got, expected))


@pytest.mark.parametrize("block_pairs", [1 << 21, 1, 300])
def test_every_link_counts(spark, block_pairs):
    rng = random.Random(4)
    words = "naïve Straße déjà 東京 don't it's 12345 foo_bar  \n\t <|endoftext|> <s> x▁y 🙂 ### $$$ the The tokens".split(" ")
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 60)))) for i in range(60)]
    docs += [(100 + i, docs[i % 3][1]) for i in range(40)]
    docs += [(200, "▁"), (201, " "), (202, "\x00"), (203, "a b"), (204, "ﬁ"), (205, "  two  spaces  ")]
    frame_ = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    check(align_tokens(frame_, BYTE_BPE, PIECES, block_pairs).collect(), docs)


def test_awkward_documents(spark):
    docs = awkward(spark).withColumns({n: F.lit("c") for n in ("digest", "copies", "n_a", "pair", "block", "place")})
    got = align_tokens(docs, BYTE_BPE, PIECES)
    assert got.columns == "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    check(got.collect(), [(r.doc_id, r.text) for r in docs.collect()])
    assert align_tokens(empty(spark), BYTE_BPE, PIECES).collect() == []


def test_one_text_in_many_copies(spark):
    docs = [(i, "the same text") for i in range(500)] + [(1000, "the other text")]
    check(align_tokens(frame(spark, [(*d, None, None, 1) for d in docs]).repartition(6), BYTE_BPE, PIECES).collect(), docs)


def test_query_is_whole(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    check(catalogue.queries()["op12_cross_tokenizer_alignment"](spark, folder).collect(), docs)
