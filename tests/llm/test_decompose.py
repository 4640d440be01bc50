"""Power-of-two packing: ids against the tokenizers library, laws of pieces and buckets."""

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from pitchmetrics.llm import decompose, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


def _ids(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 2]


def _check(rows, docs, size):
    """rows: packed pieces; docs: {doc_id: ids}, each document once."""
    found = {}
    for r in rows:
        ids = docs[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(ids) == r["length"] and zlib.crc32(np.array(ids, "<u4").tobytes()) == r["ids_crc32"]
        assert r["doc_tokens"] == len(docs[r["doc_id"]]) and r["offset"] == 0 and 1 << r["bucket"] == r["length"] <= size
        found.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
    assert found.keys() == docs.keys()
    for doc, parts in found.items():
        n, at = len(docs[doc]), 0
        assert [p[1] for p in sorted(parts)] == decompose.cuts(n, size)
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == n
    assert sorted(r["sequence_id"] for r in rows) == list(range(len(rows)))
    for b in {r["bucket"] for r in rows}:
        own = sorted(r["place"] for r in rows if r["bucket"] == b)
        assert own == list(range(len(own)))


def test_cuts():
    assert decompose.cuts(1, 8) == [1] and decompose.cuts(8, 8) == [8] and decompose.cuts(23, 8) == [8, 8, 4, 2, 1]
    for n in range(1, 300):
        assert sum(decompose.cuts(n, 16)) == n and all(k & (k - 1) == 0 for k in decompose.cuts(n, 16))


def test_encoder_is_the_library():
    library, encode = Tokenizer.from_file(PATH), decompose.Encoder(PATH)
    rng = random.Random(3)
    letters = " \n\t\x1c\x85\xa0\x0b'sSTtreRE'llvemdÀéÉß×÷µªº²½0９日İΣς😀.,!<|>éÅ a"
    texts = ["", None, "x <|endoftext|> y", "<|startoftext|>", "<|ENDOFTEXT|>", "a" * 100_000, "é" * 70 + " it's I'LL we'd", "\n \n" * 900 + "b",
             "Ａ x", "é̂ ́x", "İstanbul ΣΑΣ", "!!'s 12's ''' 'S"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(4000)]
    texts += ["a" + chr(c) + "B'" for c in range(1, 0x180)]
    for t, ids in zip(texts, encode(texts), strict=True):
        assert ids.tolist() == _ids(library, t)[:-1], (t or "")[:80]
    encode.forget()
    assert encode(["again it's"])[0].tolist() == _ids(library, "again it's")[:-1]


def test_edge_cases(spark):
    library = Tokenizer.from_file(PATH)
    texts = {1: None, 2: "", 3: "word " * 5000, 4: "a b c", 5: "a b c", 6: "longer text of some words " * 9}
    df = spark.createDataFrame([(k, t, 7, 8) for k, t in texts.items()], "doc_id long, text string, length int, task int").repartition(3)
    got = decompose.pack(df, PATH, size=64, with_ids=True)
    rows = [r.asDict() for r in got.collect()]
    docs = {k: _ids(library, t) for k, t in texts.items()}
    _check(rows, docs, 64)
    for r in rows:
        assert r["ids"] == docs[r["doc_id"]][r["start"]:r["start"] + r["length"]]
    dealt = decompose.batches(got, 128).collect()
    assert max(r.row * r.length for r in dealt) < 128
    assert len({(r.bucket, r.batch, r.row) for r in dealt}) == len(dealt)
    assert decompose.pack(df.limit(0), PATH).collect() == []
    twice = spark.createDataFrame([(None, "same"), (None, "same"), (7, "same"), (7, "same")], "doc_id long, text string")
    again = decompose.pack(twice, PATH).collect()
    assert len({r.sequence_id for r in again}) == len(again) and {r.doc_id for r in again} == {None, 7}


def test_query_on_whole_table(spark):
    library = Tokenizer.from_file(PATH)
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: _ids(library, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    _check([r.asDict() for r in queries.op12_packing(spark, sf).collect()], docs, 4096)
