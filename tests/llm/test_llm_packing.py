import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from feedlens.llm import packing as P

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))


HARD = ["", " ", "It's 'quoted' they'll we've I'd'x", "école Straße ÀÉ ½ ² 12,345.67", "日本語 text и кириллица", "é combining",
        "İstanbul", "tab\tnew\nline\x0bv\x0cf\x85n\xa0b\x1cq", "<|endoftext|> a <|startoftext|>", "<|EndOfText|>", "''s 's's \"'t",
        "ΑΣ ΟΔΟΣ", "a" * 5000, "!?!?...,,,", "​ zero", "ªº ǅ ŉ ß ẞ", "emoji 😀 x", "don't DON'T Don'T"]


def test_ids_are_the_tokenizers_own(spark, plain):
    texts = HARD + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").limit(200).collect()]
    got = P.WordEncoder(public_tokenizers.path(P.TOKENIZER)).encode(texts)
    for t, ids in zip(texts, got):
        assert np.frombuffer(ids, np.uint32).tolist() == plain.encode(t, add_special_tokens=False).ids, t[:50]


def _check_packing(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(by)


def test_documents_round_trip(spark, plain, make_docs):
    rng = random.Random(2)
    words = "alpha beta gamma delta it's 42 naïve über".split()
    rows = [(k, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 5, 50, 400, 2100, 5000])))) for k in range(120)]
    rows += [(1, "repeated row"), (1, "repeated row"), (None, "no id"), (500, None), (501, "")]
    rows += [(600 + k, t) for k, t in enumerate(HARD)]
    got = P.pack_documents(make_docs(rows), with_ids=True).collect()
    want = []
    for i, t in rows:
        ids = plain.encode(t or "", add_special_tokens=False).ids + [0]
        for k, a in enumerate(range(0, len(ids), P.CAPACITY)):
            part = np.array(ids[a:a + P.CAPACITY], "<u4").tobytes()
            want.append((i is None, i or 0, k, a, len(part) // 4, zlib.crc32(part), part))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in got) == sorted(want)
    n = _check_packing(got, P.CAPACITY)
    assert n <= -(-sum(r.length for r in got) // P.CAPACITY) + 3


def test_empty_and_one(make_docs):
    assert P.pack_documents(make_docs([])).collect() == []
    row, = P.pack_documents(make_docs([(4, None)])).collect()
    assert (row.length, row.piece, row.offset) == (1, 0, 0)


def test_small_capacity_against_first_fit(spark, make_docs):
    rng = random.Random(4)
    rows = [(k, "a " * rng.randrange(0, 60)) for k in range(300)]
    got = P.pack_documents(make_docs(rows), capacity=32).collect()
    n = _check_packing(got, 32)
    bins = []
    for r in sorted(got, key=lambda r: -r.length):
        fit = [b for b in range(len(bins)) if bins[b] + r.length <= 32]
        if fit:
            bins[max(fit, key=lambda b: bins[b])] += r.length
        else:
            bins.append(r.length)
    assert n <= len(bins)


@pytest.mark.parametrize("seed", range(6))
def test_plan_holds_every_piece_once(seed):
    rng = np.random.RandomState(seed)
    capacity = [64, 64, 2048, 2048, 10, 512][seed]
    counts = np.zeros(capacity + 1, np.int64)
    for n in rng.randint(1, capacity + 1, 200):
        counts[n] += rng.randint(0, 50)
    if seed == 3:
        counts[3:] = 0
    plan = P.pack_plan(counts)
    held = np.zeros_like(counts)
    for runs, n in plan:
        assert sum(a * b for a, b in runs) <= capacity
        for length, times in runs:
            held[length] += times * n
    assert (held == counts).all()
    total = sum(n for _, n in plan)
    assert -(-int((counts * np.arange(capacity + 1)).sum()) // capacity) <= total <= sum(n for _, n in P.best_fit(counts))


def test_fit_recovers_an_exact_mixture():
    counts = np.zeros(101, np.int64)
    for pattern, n in (((60, 40), 300), ((50, 30, 20), 200), ((70, 30), 100)):
        for length in pattern:
            counts[length] += n
    found = P.patterns(counts)
    back = np.bincount(found.ravel(), np.repeat(P.fit_repeats(found, counts), 3), 101)
    assert np.abs(back[1:] - counts[1:]).max() < 5
    assert sum(n for _, n in P.pack_plan(counts)) == 600


def test_whole_fixture(spark):
    got = P.op9_packing(spark, SF).collect()
    assert len({r.doc_id for r in got}) == 1000
    assert _check_packing(got, P.CAPACITY) <= 1.01 * sum(r.length for r in got) / P.CAPACITY + 2


def test_ids_stay_in_python_unless_asked_for(make_docs):
    for with_ids in (False, True):
        made = P.token_pieces(make_docs([(1, "a b")]), with_ids=with_ids)
        assert ("ids:binary" in P.pieces_udf(P.TOKENIZER, 8, 0, with_ids).returnType.simpleString()) == with_ids
        assert made.columns == ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
        assert made.first().ids_crc32 == P.token_pieces(make_docs([(1, "a b")])).first().ids_crc32
