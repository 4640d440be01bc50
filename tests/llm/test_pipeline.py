"""The pipeline's stages against plain versions, each on what its predecessor kept."""

import sys
from pathlib import Path

import public_tokenizers
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from tests.llm.test_linededup import _plain
from tests.llm.test_packing import _check, _ids
from tests.llm.test_simhash import _components, _fingerprint

import corpus_pipeline

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_dedup", "best_fit_packing"]
    frames, now = [], docs
    for name, stage in corpus_pipeline.STAGES:
        now = corpus_pipeline.stored(stage(spark, now, SF), name)
        frames.append(now)
        if name != "best_fit_packing":
            assert now.columns == docs.columns
    clean, lines, single, packed = frames
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id: r.text for r in clean.collect()}
    toxic = [k for k, y in labels.items() if y]
    assert sum(k not in kept for k in toxic) >= 0.8 * len(toxic)
    assert sum(k in kept for k, y in labels.items() if not y) >= 0.98 * (len(labels) - len(toxic))
    want = {k: v[0] for k, v in _plain(kept.items()).items()}
    got = lines.collect()
    assert {r.doc_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)
    groups = _components([(k, _fingerprint(t)) for k, t in want.items()], 2)
    assert {r.doc_id: r.text for r in single.collect()} == {k: t for k, t in want.items() if groups[k] == k}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {r.doc_id: _ids(library, r.text) for r in single.collect()}
    bins = _check([r.asDict() for r in packed.collect()], ids, 1024)
    assert bins <= 1.01 * sum(map(len, ids.values())) / 1024 + 1


def test_odd_documents(spark):
    rows = [(1, None, "en", "s", 0), (2, "", None, None, None), (2, "", None, None, None), (None, "some text", "en", "s", 9)]
    now = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for empty in (False, True):
        step = now.limit(0) if empty else now
        for _, stage in corpus_pipeline.STAGES:
            step = stage(spark, step, "/root/testdata/sf0.001")
        assert (step.count() == 0) == empty


def test_one_row_of_each_group_stays(spark):
    """A key with two texts loses only the copy; equal rows and copies without a key go."""
    copy = "one two three four five six seven eight nine ten"
    own = "quite other words that nobody else in this table has ever used before"
    lone = "a third kind of sentence about rivers and mountains far away from here"
    rows = [(1, copy), (2, copy), (2, own), (2, own), (None, copy), (None, lone), (None, lone)]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_near_copies(spark, docs.repartition(3), SF)
    assert got.columns == docs.columns
    assert {(r.doc_id, r.text) for r in got.collect()} == {(1, copy), (2, own), (None, lone)} and got.count() == 3
