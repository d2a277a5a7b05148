import random
from collections import defaultdict

import duckdb
import numpy as np
import pytest
import xxhash

from feedlens.llm import exact_dedup, simhash

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def _brute_exact(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups["".join(c for c in t or "" if c not in " \t\n\v\f\r")].append((-len(t or ""), i is None, i or 0, i))
    return {k: (len(v), min(v)[3]) for k, v in groups.items()}


@pytest.mark.parametrize("id_bytes", [16, 1])
def test_exact_groups(make_docs, id_bytes):
    rng = random.Random(5)
    long = "".join(rng.choice("abcdefgh \n") for _ in range(60_000))
    rows = [(1, "a b"), (2, "ab"), (3, "a  b"), (4, None), (5, ""), (6, " \t\n"), (7, "é x"), (8, "é x"), (8, "é x"),
            (9, long), (10, long.replace(" ", "")), (11, long[:-1] + "!"), (None, "zz"), (None, "zz"), (12, "a\xa0b")]
    rows += [(100 + k, f"text {k % 40} " + "w" * (k % 40)) for k in range(400)]
    rows += [(1000 + k, "".join(rng.choice("abcdefgh") for _ in range(9000))) for k in range(30)]
    got = exact_dedup.exact_duplicates(make_docs(rows), id_bytes=id_bytes).collect()
    assert len(got) == len(rows)
    want = _brute_exact(rows)
    text = {i: t for i, t in rows}
    for r in got:
        size, keep = want["".join(c for c in text[r.doc_id] or "" if c not in " \t\n\v\f\r")]
        assert (r.group_size, r.keep_id) == (size, keep), r
    assert sum(r.kept for r in got) == len(want)


def test_exact_empty_table_and_columns(make_docs, spark):
    assert exact_dedup.exact_duplicates(make_docs([])).collect() == []
    docs = make_docs([(1, "a"), (2, "a"), (3, "b")])
    out = exact_dedup.exact_dedup_stage(spark, docs, "")
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [1, 3]


def test_chunks_rejoin_and_resynchronise():
    data = np.random.RandomState(1).bytes(200_000)
    parts = exact_dedup.split_chunks(data)
    assert b"".join(parts) == data
    assert all(exact_dedup.MIN_CHUNK <= len(c) <= exact_dedup.MAX_CHUNK for c in parts[:-1])
    other = exact_dedup.split_chunks(b"inserted bytes" + data)
    assert len(set(parts) & set(other)) > 0.9 * len(parts)


def test_exact_matches_sql(spark):
    got = sorted(map(tuple, exact_dedup.op7_exact_dedup(spark, SF).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert got == sorted(con.execute(exact_dedup.OP7_SQL).fetchall())


def _plain_fingerprint(text, width=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    sh = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "One two", "One two three", "É a\xa0b C d", "a b c a b c a b c x",
                                  "tie tie tie tie end of it"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == _plain_fingerprint(text)


def test_fingerprint_equals_sparks_hash(spark):
    row = spark.sql("SELECT xxhash64('one two three') AS h").first()
    assert simhash.fingerprint("One TWO three") == row.h % (1 << 64)


@pytest.mark.parametrize("radius", [0, 1, 2])
def test_linked_pairs_are_exact(radius):
    rng = np.random.RandomState(3)
    base = rng.randint(0, 2**62, 20).astype(np.uint64)
    values = np.unique(np.concatenate([base ^ sum(np.uint64(1) << np.uint64(b) for b in rng.choice(64, k, False))
                                       for k in (0, 1, 2, 3, 4) for _ in range(6)]))
    bucket = np.sort(rng.randint(0, 3, len(values)))
    got = {(int(a), int(b)) for i, j in simhash.linked_pairs(values, bucket, radius) for a, b in zip(i, j)}
    want = {(a, b) for a in range(len(values)) for b in range(a + 1, len(values)) if bucket[a] == bucket[b]
            and bin(int(values[a]) ^ int(values[b])).count("1") <= radius}
    assert got == want


def _brute_components(prints):
    ids = list(range(len(prints)))
    for a in range(len(prints)):
        for b in range(a):
            if bin(prints[a] ^ prints[b]).count("1") <= 2:
                x, y = ids[a], ids[b]
                ids = [min(x, y) if z in (x, y) else z for z in ids]
    return ids


def test_components_against_brute_force(spark):
    rng = random.Random(8)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(240):  # chains of near fingerprints
        prints.append(rng.choice(prints) ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 2, 4]))))
    prints = list(dict.fromkeys(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    links = simhash.fingerprint_links(spark.createDataFrame([(p,) for p in signed], "fp long"))
    got = {r.node: r.component for r in simhash.components(links).collect()}
    want = _brute_components(prints)
    groups = defaultdict(set)
    for p, c in zip(signed, want):
        groups[c].add(p)
    for members in groups.values():
        if len(members) > 1:
            assert {got.get(p) for p in members} == {min(members)}
        else:
            assert not members & set(got)


def test_long_path_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)], "u long, v long")
    got = simhash.components(links).collect()
    assert len(got) == 301 and {r.component for r in got} == {0}


def test_simhash_rows(make_docs, spark):
    base = " ".join(f"word{k}" for k in range(400))
    rows = [(5, base), (3, base), (3, base), (9, base + " x"), (7, None), (8, ""), (2, "something else here now"), (None, "q w e")]
    docs = make_docs(rows)
    got = simhash.simhash_components(docs).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.fingerprint): r.component_id for r in got}
    assert {c for (i, _), c in by.items() if i in (5, 3, 9)} == {3}
    assert by[(7, "0" * 16)] == by[(8, "0" * 16)] == 7
    assert simhash.simhash_components(make_docs([])).collect() == []
    out = simhash.simhash_stage(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in out.collect()) == [(False, 2), (False, 3), (False, 7), (True, None)]


def test_simhash_fixture(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in simhash.op8_simhash(spark, SF).collect()}
    rows = docs.select("doc_id", "text").orderBy("doc_id").collect()
    prints = [_plain_fingerprint(r.text) for r in rows[:40]]
    assert [got[r.doc_id].fingerprint for r in rows[:40]] == [f"{p:016x}" for p in prints]
    allp = [int(got[r.doc_id].fingerprint, 16) for r in rows]
    want = _brute_components(allp)
    assert [got[r.doc_id].component_id for r in rows] == [rows[c].doc_id for c in want]


def test_stage_groups_by_component_not_by_id(spark, make_docs):
    texts = ["the quick brown fox jumps over the lazy dog near a river", "seven grey wolves were walking home through deep snow",
             "invoices are due on the first day of every month", "a compiler turns source text into instructions"]
    docs = make_docs([(None, texts[0]), (None, texts[1]), (None, texts[0]), (4, texts[2]), (4, texts[3]), (9, texts[3])])
    prints = [simhash.fingerprint(t) for t in texts]
    assert min(bin(a ^ b).count("1") for a in prints for b in prints if a != b) > simhash.RADIUS
    out = simhash.simhash_stage(spark, docs, "")
    assert out.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in out.collect()) == sorted(zip((0, 0, 4, 4), texts))


@pytest.mark.parametrize("radius", [1, 2])
def test_split_masks_keep_every_pair_within_the_radius(radius):
    rng = random.Random(radius)
    for mask in simhash.bucket_masks(radius):
        finer = simhash.split_masks(mask, radius)
        free = [p for p in range(64) if not mask >> p & 1]
        assert all(m & mask == mask and bin(m).count("1") >= 64 - 10 for m in finer)
        for _ in range(200):
            a = rng.getrandbits(64)
            b = a
            for p in rng.sample(free, radius):
                b ^= 1 << p
            assert any(a & m == b & m for m in finer)


def test_a_hot_bucket_is_spread_and_links_alike(spark, monkeypatch):
    """Fingerprints that share 42 bits: one bucket of all, cut into many by their other bits."""
    mask = simhash.bucket_masks()[0]
    free = [p for p in range(64) if not mask >> p & 1]
    rng = np.random.RandomState(3)
    picked = rng.choice(1 << len(free), 3_000, False)
    values = np.zeros(len(picked), np.uint64)
    for k, p in enumerate(free):
        values |= ((picked >> k & 1).astype(np.uint64)) << np.uint64(p)
    table = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")

    def joined():
        return {r.node: r.component for r in simhash.components(simhash.fingerprint_links(table)).collect()}

    whole = joined()
    monkeypatch.setattr(simhash, "SPLIT", 100)
    assert joined() == whole and len(set(whole.values())) > 1


def test_a_bucket_of_200000_goes_to_many_tasks(spark):
    mask = simhash.bucket_masks()[0]
    free = [p for p in range(64) if not mask >> p & 1]
    place = sum((F.pmod(F.shiftright("id", k), F.lit(2)) * F.lit(1 << p if p < 63 else -(1 << 63)) for k, p in enumerate(free[:18])), F.lit(0))
    table = spark.range(200_000).select(place.cast("long").alias("fp"))
    links = simhash.fingerprint_links(table)
    assert "large" in links._jdf.queryExecution().analyzed().toString()
    sizes = [r["n"] for r in links.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) > 1 and sum(sizes) >= 199_999
    # every value is linked to one that differs in its lowest bit, so all are one component
    assert simhash.components(links).agg(F.count_distinct("component"), F.count("*")).first() == (1, 200_000)
