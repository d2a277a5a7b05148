import random

import numpy as np
import pytest

from feedlens.llm import decontaminate as D

SF = "/root/testdata/sf0.01"


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _brute(x, text):
    return min(_distance(x, text[a:b]) for a in range(len(text) + 1) for b in range(a, len(text) + 1))


def test_nearest_stretch_against_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        x = [rng.randrange(1, 5) for _ in range(rng.randrange(1, 8))]
        text = [rng.randrange(0, 5) for _ in range(rng.randrange(0, 12))]
        d, a, b = D.nearest_stretch(np.array(x), np.array(text, np.int64))
        assert d == _brute(x, text) == _distance(x, text[a:b])


def _edited(rng, words, k):
    words = list(words)
    for _ in range(k):
        at = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[at] = f"zz{rng.randrange(9)}"
        elif kind == 1:
            words.insert(at, rng.choice(["the", "qq"]))
        else:
            del words[at]
    return words


def test_edited_items_are_found_and_others_left():
    rng = random.Random(6)
    vocabulary = [f"w{k}" for k in range(300)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([5, 12, 30, 31, 60])))) for i in range(60)]
    index = D.ItemIndex(items)
    found = 0
    for n in range(300):
        i, t = rng.choice(items)
        words = t.split()
        body = _edited(rng, words, D.allowed(len(words)))
        around = [rng.choice(vocabulary) for _ in range(200)]
        hits, = index.search([" ".join(around[:90]) + ". " + " ".join(body) + "! " + " ".join(around[90:])])
        assert all(h["distance"] <= D.allowed(h["item_words"]) for h in hits)
        found += any(h["item_id"] == i for h in hits)
    assert found >= 0.97 * 300
    for n in range(50):  # twice the edits: beyond the limit in almost all cases
        text = " ".join(rng.choice(vocabulary) for _ in range(400))
        long_hits = [h for h in index.search([text])[0] if h["item_words"] >= 12]
        assert long_hits == []


def test_screen_and_hashing_lose_nothing_against_brute_force():
    rng = random.Random(9)
    vocabulary = [f"w{k}" for k in range(30)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 6, 10])))) for i in range(12)]
    index = D.ItemIndex(items, target=0.999)
    missed = total = 0
    for _ in range(40):
        text = [rng.choice(vocabulary) for _ in range(25)]
        i, t = rng.choice(items)
        text[8:8] = _edited(rng, t.split(), rng.randrange(0, 3))
        got = {h["item_id"] for h in index.search([" ".join(text)])[0]}
        want = {j for j, s in items if _brute(s.split(), text) <= D.allowed(len(s.split()))}
        assert got <= want
        total += len(want)
        missed += len(want - got)
    assert missed <= 0.02 * total


def _exact(x, text, k):
    """Whether ``x`` stands in ``text`` with at most k edits: dynamic programming over all of it."""
    return int(D._last_row(np.array(x), np.array(text), True).min()) <= k


@pytest.mark.parametrize("pattern", D.PATTERNS)
def test_recall_of_every_pattern_of_edits_against_the_exact_search(pattern):
    """Items of every length, edited at the limit, hashed; exact search says which are leaks."""
    rng, draw = random.Random(31), np.random.RandomState(4)
    vocabulary = [f"w{k}" for k in range(400)]
    lengths = [5, 9, 14, 20, 33, 47, 59, 100]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(lengths[i % 8]))) for i in range(96)]
    index = D.ItemIndex(items)
    for n in lengths:
        mine = [k for k, x in enumerate(index.items) if len(x) == n]
        found = leaks = 0
        for t in range(100):
            item = mine[t % len(mine)]
            body = D.edited(index.items[item], pattern, draw).tolist()
            words = [f"w{rng.randrange(400)}" for _ in range(50)] + [f"zz{rng.randrange(9)}" if w == 0 else list(index.known)[w - 1] for w in body]
            words += [f"w{rng.randrange(400)}" for _ in range(50)]
            leaks += _exact(index.items[item], [index.known.get(w, 0) for w in words], D.allowed(n))
            found += any(h["item_id"] == index.ids[item] for h in index.search([" ".join(words)])[0])
        assert leaks == 100 and found >= 99, (n, pattern, found)


def test_classes_reach_the_recall_asked_for():
    rng = random.Random(2)
    items = [(i, " ".join(f"w{rng.randrange(900)}" for _ in range(3 + i))) for i in range(80)]
    for c in D.ItemIndex(items).classes:
        assert set(c.recall) == set(D.PATTERNS) and min(c.recall.values()) >= D.TARGET_RECALL


def test_edits_that_stand_together_are_found():
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(300)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(n))) for i, n in enumerate([5, 9, 20, 38, 59, 60] * 5)]
    index = D.ItemIndex(items)
    for i, t in items:
        words = t.split()
        k, n = D.allowed(len(words)), len(words)
        for at in (0, (n - k) // 2, n - k):
            for put in ([], ["zz"] * k):
                body = words[:at] + put + words[at + k:]
                hits, = index.search([" ".join(["qq"] * 40 + body + ["qq"] * 40)])
                assert [h["distance"] for h in hits if h["item_id"] == i] == [_distance(words, body)]


def test_every_place_of_a_repeated_item_is_given():
    item = "alpha beta gamma delta epsilon zeta"
    edited = "alpha beta XX delta epsilon zeta"
    index = D.ItemIndex([(1, item)])
    for parts in ([item] * 3, [edited, item, edited], [item, "gamma", item], [edited] + [item] * 300, ["y", item, "zeta y y alpha", edited]):
        text = " ".join(parts)
        hits, = index.search([text])
        assert [text[h["start_char"]:h["end_char"]] for h in hits] == [p for p in parts if len(p) > 20]
        assert [h["distance"] for h in hits] == [int(p == edited) for p in parts if len(p) > 20]


def test_near_stretches_leave_nothing():
    rng = random.Random(5)
    for _ in range(150):
        x = [rng.randrange(1, 4) for _ in range(rng.randrange(2, 6))]
        text, k = [rng.randrange(0, 4) for _ in range(rng.randrange(0, 30))], rng.randrange(2)
        got = D.near_stretches(np.array(x), np.array(text, np.int64), k)
        edges = [0] + [e for d, a, b in got for e in (a, b)] + [len(text)]
        assert edges == sorted(edges)
        for d, a, b in got:
            assert d == _distance(x, text[a:b]) <= k
        for a, b in zip(edges[::2], edges[1::2]):
            assert _brute(x, text[a:b]) > k


def test_exact_items_are_always_found():
    items = [(1, "one"), (2, "two words"), (3, "a b c d e f g h i j"), (4, ""), (5, "?!"), (3, "a b c d e f g h i j")]
    index = D.ItemIndex(items)
    hits = index.search(["One", "x TWO, words y", "A b-c d e f g h i j", None, "", "nothing here"])
    assert [sorted(h["item_id"] for h in x) for x in hits] == [[1], [2], [3, 3], [], [], []]
    h = hits[1][0]
    assert (h["start_char"], h["end_char"], h["distance"]) == (2, 12, 0)
    apart = " ".join(["two words"] + ["x"] * 9 + ["two words"])
    assert len(index.search([apart])[0]) == 2


def test_table_form(spark, make_docs):
    items = spark.createDataFrame([(7, "alpha beta gamma delta epsilon zeta"), (8, None), (9, "")], "item_id long, text string")
    docs = make_docs([(1, "x alpha beta gamma delta epsilon zeta y"), (1, "x alpha beta gamma delta epsilon zeta y"),
                      (2, "clean"), (3, None), (4, ""), (None, "alpha beta gamma XX delta epsilon zeta"),
                      (5, ("word " * 30_000) + "alpha beta gamma delta epsilon zeta")])
    got = D.benchmark_leaks(docs, items).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.item_id, r.distance) for r in got) == [
        (False, 1, 7, 0), (False, 1, 7, 0), (False, 5, 7, 0), (True, 0, 7, 1)]
    assert D.benchmark_leaks(make_docs([]), items).collect() == []
    assert D.benchmark_leaks(docs, items.filter("item_id > 7")).collect() == []


def test_blocks_cover_all_items(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_ITEMS", 7)
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    blocks = list(D.item_blocks(items))
    assert len(blocks) > 3 and sorted(x for b in blocks for x in b) == sorted(map(tuple, items.collect()))


def test_benchmarks_of_many_blocks(spark, make_docs, monkeypatch):
    """Each block is searched for in all documents, and what one leaves is written before the
    next is built."""
    rng = random.Random(12)
    items = [(i, " ".join(f"w{rng.randrange(200)}" for _ in range(12))) for i in range(40)]
    rows = [(k, f"clean text {k}") for k in range(10)] + [(100 + i, f"x {t} y") for i, t in items[::4]] + [(None, items[1][1]), (7, None)]
    docs = make_docs(rows)
    table = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(str, D.benchmark_leaks(docs, table).collect()))
    monkeypatch.setattr(D, "BLOCK_ITEMS", 9)
    assert len(list(D.item_blocks(table))) > 3
    assert sorted(map(str, D.benchmark_leaks(docs, table).collect())) == whole and len(whole) == 11
    monkeypatch.setattr(D, "read_table", lambda *a: table)
    kept = D.decontamination_stage(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.select("doc_id", "text").collect())) == sorted(map(str, docs.filter("text IS NULL OR text LIKE 'clean%'").select("doc_id", "text").collect()))


def test_fixture_has_its_planted_passages(spark):
    items = {r.item_id: D.words_of(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = set()
    for d in docs:
        joined = " " + " ".join(D.words_of(d.text)) + " "
        want |= {(d.doc_id, i) for i, w in items.items() if " " + " ".join(w) + " " in joined}
    got = {(r.doc_id, r.item_id) for r in D.op5_decontamination(spark, SF).collect()}
    assert want and want <= got and len(got) <= len(want) + 5


def test_stage_keeps_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = D.decontamination_stage(spark, docs, SF)
    assert kept.columns == docs.columns
    leaking = {r.doc_id for r in D.op5_decontamination(spark, SF).collect()}
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - leaking
