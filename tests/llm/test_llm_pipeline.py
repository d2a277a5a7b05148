import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from feedlens.llm import decontaminate as D, packing as P, quality as Q, simhash as H

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows of documents and of every stage's result."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs.collect())]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, docs.collect()))
    return dict(out)


def test_columns_and_order(stages):
    names = list(stages)
    assert names[1:] == ["quality", "exact_dedup", "simhash_near_dedup", "decontamination", "packing"]
    for name in names[:-1]:
        assert list(stages[name][0].asDict()) == COLUMNS
    for a, b in zip(names, names[1:-1]):
        assert {r.doc_id for r in stages[b]} <= {r.doc_id for r in stages[a]}


def test_quality_stage_is_the_operators_decision(spark, stages):
    predicted = {r.doc_id: r.predicted for r in Q.op3_quality(spark, SF).collect()}
    assert {r.doc_id for r in stages["quality"]} == {i for i, p in predicted.items() if p}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages["quality"]}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in good) >= 0.99 * len(good)


def test_exact_stage_against_brute_force(stages):
    groups = defaultdict(list)
    for r in stages["quality"]:
        groups["".join(c for c in r.text or "" if c not in " \t\n\v\f\r")].append((-len(r.text or ""), r.doc_id))
    assert sorted(r.doc_id for r in stages["exact_dedup"]) == sorted(min(g)[1] for g in groups.values())


def test_near_stage_against_brute_force(stages):
    rows = sorted(stages["exact_dedup"], key=lambda r: r.doc_id)
    prints = np.array([H.fingerprint(r.text) for r in rows], np.uint64)
    root = list(range(len(rows)))
    for a in range(len(rows)):
        near = np.flatnonzero([bin(int(x)).count("1") <= 2 for x in prints[:a] ^ prints[a]])
        for b in near.tolist():
            x, y = root[a], root[b]
            root = [min(x, y) if z in (x, y) else z for z in root]
    assert sorted(r.doc_id for r in stages["simhash_near_dedup"]) == [rows[k].doc_id for k in sorted(set(root))]


def test_decontamination_stage_against_brute_force(spark, stages):
    items = [" " + " ".join(D.words_of(r.text)) + " " for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before, after = ({r.doc_id: r.text for r in stages[k]} for k in ("simhash_near_dedup", "decontamination"))
    whole = {i for i, t in before.items() if any(x in " " + " ".join(D.words_of(t)) + " " for x in items)}
    assert whole and not whole & set(after)
    assert len(set(before) - set(after) - whole) <= 3


def test_packing_stage_round_trip(stages):
    plain = Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))
    text = {r.doc_id: r.text for r in stages["decontamination"]}
    got = stages["packing"]
    want = []
    for i, t in text.items():
        ids = plain.encode(t or "", add_special_tokens=False).ids + [0]
        for k, a in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[a:a + 2048], "<u4").tobytes()
            want.append((i, k, a, len(part) // 4, zlib.crc32(part)))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        ends = [o + n for o, n in sorted(parts)]
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in got.collect()) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in stages["packing"])


def test_empty_documents(spark, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_entry_registers_everything(spark):
    import __spark_entry__ as E
    names = [n for n in E.queries() if n == "pipeline" or n.startswith("op")]
    assert len([n for n in names if n.startswith("op")]) == 13 and "pipeline" in names
    assert set(E.oracle_sql()) <= set(E.queries())


def test_stages_on_odd_rows_and_clashing_columns(spark, tmp_path):
    good = [r for r in spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()]
    clash = "recipe, kept, group_size, fp, hit, p, r, score, path, length, row, key, component_id, text_sha256"
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in good]
    rows += [(None, None, None, None, None), (None, "", None, None, 0), (None, None, None, None, None), rows[0], rows[0],
             (5_000, "x" * 300_000, "en", None, 5), (5_001, "word " * 60_000, None, "s", None), (5_002, "\u0000 ​", "en", "s", 3)]
    docs = spark.createDataFrame([(*r, *["c"] * len(clash.split(", "))) for r in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in clash.split(", ")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = str(tmp_path / name)
        stage(spark, docs, SF).write.parquet(path)
        kept = spark.read.parquet(path)
        assert kept.columns == docs.columns
        if name == "exact_dedup":
            texts = ["".join(c for c in r.text or "" if c not in " \t\n\v\f\r") for r in kept.collect()]
            assert len(texts) == len(set(texts))
        docs = kept
    name, stage = corpus_pipeline.STAGES[-1]
    assert stage(spark, docs, SF).count() >= docs.count()


def test_run_leaves_only_its_result_behind(spark):
    from feedlens.llm.common import written
    before = set(written())
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0
    left = set(written()) - before
    assert len(left) == 1 and all(f.split("/part-")[0].endswith(left.copy().pop()) or left.copy().pop() in f for f in out.inputFiles())
