"""Packing: pieces against the tokenizers library, and the law of the sequences."""

import random
import zlib
from itertools import product

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from pitchmetrics.llm import packing, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


def _ids(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 2]


def _check(rows, docs, size):
    """rows: packed pieces as dicts; docs: {doc_id: ids}."""
    seen = {}
    for r in rows:
        ids = docs[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert len(ids) == r["length"] and zlib.crc32(np.array(ids, "<u4").tobytes()) == r["ids_crc32"]
        seen.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"]))
    for doc, ids in docs.items():
        parts = sorted(seen.pop(doc))
        assert [p[0] for p in parts] == list(range(len(parts)))
        assert sum(p[2] for p in parts) == len(ids) and all(p[2] == size for p in parts[1:])
        assert [p[1] for p in parts] == [sum(q[2] for q in parts[:i]) for i in range(len(parts))]
    assert not seen
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(bins)


def test_encoder_is_the_library():
    library = Tokenizer.from_file(PATH)
    rng = random.Random(3)
    letters = " \n\t'sabZ0９é日😀.,! 　\r-aaaa"
    texts = ["", "x <|endoftext|> y", " " * 300_000 + "a", "a" * 300_000, "\n \n" * 900 + "b"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(3000)]
    encode = packing._encoder(PATH)
    for t in texts:
        assert encode(t).tolist() == library.encode(t, add_special_tokens=False).ids, t[:80]


def test_fullest_is_the_fullest():
    rng = random.Random(4)
    for _ in range(200):
        count = {rng.randrange(1, 30): rng.randrange(1, 4) for _ in range(4)}
        room = rng.randrange(0, 60)
        found = packing._fullest(sorted(count, reverse=True), count, room)
        assert all(k <= count[n] for n, k in found.items())
        sums = [sum(n * k for n, k in zip(count, ks, strict=True)) for ks in product(*(range(c + 1) for c in count.values()))]
        assert sum(n * k for n, k in found.items()) == max(s for s in sums if s <= room)


def test_plan_is_near_the_bound():
    rng = random.Random(5)
    histogram = {}
    for _ in range(20_000):
        n = min(1024, int(rng.lognormvariate(5.5, 1)) + 1)
        histogram[n] = histogram.get(n, 0) + 1
    rows = packing.plan(histogram, 1024)
    bins = max(r[4] + (r[2] - r[1]) // r[3] for r in rows)
    assert bins <= -(-sum(n * c for n, c in histogram.items()) // 1024) + 2
    assert {n: sum(r[2] - r[1] for r in rows if r[0] == n) for n in histogram} == histogram


def test_edge_cases(spark):
    library = Tokenizer.from_file(PATH)
    texts = {1: None, 2: "", 3: "word " * 5000, 4: "a b c", 5: "a b c", 6: "longer text of some words " * 9}
    df = spark.createDataFrame([(k, t, 7) for k, t in texts.items()], "doc_id long, text string, length int").repartition(3)
    got = packing.pack(df, PATH, size=64, with_ids=True)
    rows = [r.asDict() for r in got.collect()]
    docs = {k: _ids(library, t) for k, t in texts.items()}
    assert _check(rows, docs, 64) == -(-sum(map(len, docs.values())) // 64)
    whole = {r.sequence_id: r.ids for r in packing.sequences(got).collect()}
    for r in rows:
        assert whole[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == r["ids"]
    assert packing.pack(df.limit(0), PATH).collect() == []
    twice = spark.createDataFrame([(None, "same"), (None, "same"), (7, "same"), (7, "same")], "doc_id long, text string")
    again = packing.pack(twice, PATH, size=1024).collect()
    assert len({(r.sequence_id, r.offset) for r in again}) == len(again) == 4


def test_query_on_whole_table(spark):
    library = Tokenizer.from_file(PATH)
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: _ids(library, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = [r.asDict() for r in queries.op5_best_fit_packing(spark, sf).collect()]
    assert _check(rows, docs, 1024) <= -(-sum(map(len, docs.values())) // 1024) + 1
