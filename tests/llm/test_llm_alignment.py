import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from feedlens.llm import alignment as A

SF = "/root/testdata/sf0.001"


def test_alphabet_has_the_tokenizers_characters():
    table = A.byte_level_alphabet()
    assert set(table) == set(ByteLevel.alphabet()) and sorted(table.values()) == list(range(256))
    split = ByteLevel(add_prefix_space=False, use_regex=False)
    for text in ("é\n\t ~\x7f\xad", "日本語", "😀"):
        shown = "".join(piece for piece, _ in split.pre_tokenize_str(text))
        assert bytes(table[c] for c in shown) == text.encode()


class Plain:
    """Every contract figure by its definition, token by token."""

    def __init__(self):
        self.a = Tokenizer.from_file(public_tokenizers.path(A.TOKENIZER_A))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(A.TOKENIZER_B))
        self.table = A.byte_level_alphabet()

    def tokens(self, text):
        whole = b" " + text.encode()
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        a = [(k, bytes(self.table[c] for c in self.a.id_to_token(k))) for k in a]
        b = []
        for k in self.b.encode(text):
            p = self.b.id_to_piece(k)
            b.append((k, bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()))
        return (a, b) if all(b"".join(x for _, x in s) == whole for s in (a, b)) else ([], [])

    def groups(self, text):
        if not text:
            return [], [], []
        a, b = self.tokens(text)
        ends = [set(np.cumsum([len(x) for _, x in s]).tolist()) for s in (a, b)]
        cuts = sorted(ends[0] & ends[1])
        found, at = [], [[0, 0], [0, 0]]
        for cut in cuts:
            group = []
            for s, place in zip((a, b), at):
                ids = []
                while place[0] < len(s) and place[1] < cut:
                    ids.append(s[place[0]][0])
                    place[1] += len(s[place[0]][1])
                    place[0] += 1
                group.append(ids)
            found.append(tuple(group))
        return a, b, found

    def rows(self, docs):
        made = [(i, *self.groups(t)) for i, t in docs]
        counts = Counter()
        for _, _, _, groups in made:
            counts.update({(x, y) for ga, gb in groups for x in ga for y in gb})
        best = defaultdict(int)
        for (x, _), n in counts.items():
            best[x] = max(best[x], n)
        out = []
        for i, a, b, groups in made:
            links = [(x, y) for ga, gb in groups for x in ga for y in gb]
            said = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
            out.append((str(i), len(a), len(b), len(groups), len(links), sum(counts[p] == best[p[0]] for p in links),
                        sum(counts[p] for p in links), hashlib.sha256(said.encode()).hexdigest() if said else ""))
        return sorted(out)


@pytest.fixture(scope="module")
def plain():
    return Plain()


def as_rows(df):
    return sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


HARD = [None, "", " ", "  two  spaces ", "a▁b", "ﬁ ligature", "café é", "日本語テキスト 😀👩‍👩‍👧", "<s> </s> <unk> <|endoftext|> <0x41>", "\n\n\t x \r\n",
        "a" * 3000, " " * 999, "\u0000 nul", "don't DON'T 12,345.67", "ｆｕｌｌ width", "Ω Ω K K", "​﻿ bom", "😀" * 300, "x y " * 500,
        "　ideographic", "a\xa0b \xa0\xa0 c", "µ² ¼½ ǅ ª º", "x\x1cy\x85z", "a\n b \t c\t\td  \n  e ", " \n", "\n ", "'s 't''s they're", "a ' b"]


def test_query_rows_by_hand(spark, make_docs, plain):
    rows = [(k, t) for k, t in enumerate(HARD)] + [(None, "no id the same"), (None, "no id the same"), (3, "the the the"), (3, "the the the"), (77, "a third")]
    assert as_rows(A.align_tokenizers(make_docs(rows))) == plain.rows(rows)


def test_fixture_rows_by_hand(spark, plain):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert as_rows(A.op13_tokenizer_alignment(spark, SF)) == plain.rows(rows)


def test_slices_and_merges_give_the_same_rows(spark, make_docs, plain, monkeypatch):
    rng = random.Random(1)
    rows = [(k, "".join(rng.choice("ab é日😀 \n") for _ in range(rng.choice([3, 40, 900])))) for k in range(60)]
    monkeypatch.setattr(A, "SLICE", 7)      # shipped by value with the functions
    assert as_rows(A.align_tokenizers(make_docs(rows))) == plain.rows(rows)


def test_counts_beyond_a_broadcast_join_alike(spark, make_docs, plain, monkeypatch):
    monkeypatch.setattr(A, "BROADCAST_PAIRS", 3)
    rows = [(k, "the same words of all and %d more" % (k % 5)) for k in range(80)]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        made = A.align_tokenizers(make_docs(rows), keep_groups=True)
        assert "BroadcastHashJoin" not in made._jdf.queryExecution().executedPlan().toString()
        assert as_rows(made) == plain.rows(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert made.filter("sha2(groups, 256) <> groups_sha256").count() == 0


def test_empty_table(spark, make_docs):
    assert A.align_tokenizers(make_docs([])).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=30), st.integers(0, 10**6))
def test_coalescing_equals_common_ends(sizes, seed):
    total, rng = sum(sizes), random.Random(seed)
    other = []
    while sum(other) < total:
        other.append(min(rng.randint(1, 6), total - sum(other)))
    spans = [(e - s, e, k) for k, side in enumerate((sizes, other)) for s, e in zip(side, np.cumsum(side).tolist())]
    spans.sort(key=lambda x: (x[0], x[2]))
    group = A.coalesce(np.array([x[0] for x in spans]), np.array([x[1] for x in spans]))
    cuts = sorted(set(np.cumsum(sizes).tolist()) & set(np.cumsum(other).tolist()))
    assert group.tolist() == [int(np.searchsorted(cuts, e)) for _, e, _ in spans]
