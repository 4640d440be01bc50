"""BPE against the tokenizers library, and exact round trips."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pitchmetrics.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", None, " ", "   ", "a ", "  a  b", "a \n b", "\n\n x", "a\tb \tc", "<|endoftext|>", "x <|endoftext|> y",
       " <|endoftext|>  a", "don't I'll 'sx", "aaaaaaa" * 40, "日本語 ñandú ①② x y\u0085z", "\x1c a \x1cb", "😀 👍🏽",
       "é é", "²³¼ 12ⅷ", "\x00a \x00", "word " * 5000, "x" * 30000, "dup", "dup"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def _pairs(texts):
    flat, n = bpe.bpe(PATH).encode(texts)
    end = np.cumsum(n)
    return [flat[e - c:e] for e, c in zip(end, n, strict=True)]


def test_odd_texts_match_the_library(library):
    for text, ids in zip(ODD, _pairs(ODD), strict=True):
        want = library.encode(text or "", add_special_tokens=False).ids
        assert ids.tolist() == want, text
        assert bpe.bpe(PATH).decode_bytes(ids).decode() == library.decode(want, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t'sabtheZ0９é日😀.,!　\r- ", max_size=60), max_size=5))
def test_random_texts_match_the_library(texts):
    library = Tokenizer.from_file(PATH)
    assert [x.tolist() for x in _pairs(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_broken_utf8_decodes_as_the_library_does(library):
    ids = [i for i in _pairs(["日"])[0].tolist()][:1] + _pairs(["a"])[0].tolist()
    assert bpe.bpe(PATH).decode_bytes(np.array(ids)).decode() == library.decode(ids, skip_special_tokens=False)


def test_frames(spark, library):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)], "doc_id long, text string, ids string")
    back = bpe.decode(bpe.encode(df, PATH), PATH).select("doc_id", "decoded", F.size("ids").alias("n")).collect()
    assert {r.doc_id: r.decoded for r in back} == {i: t or "" for i, t in enumerate(ODD)}
    got = {r.doc_id: r for r in bpe.roundtrip_digests(df, PATH).collect()}
    assert len(got) == len(ODD)
    for i, text in enumerate(ODD):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.roundtrip_digests(df.limit(0), PATH).collect() == []
    nulls = spark.createDataFrame([(None, "a"), (None, "a")], "doc_id long, text string")
    assert [r.n_tokens for r in bpe.roundtrip_digests(nulls, PATH).collect()] == [1, 1]


def test_query_on_whole_table(spark, library):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: r.ids_sha256 for r in queries.op1_bpe_roundtrip(spark, sf).collect()}
    want = {k: hashlib.sha256(np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes()).hexdigest()
            for k, t in texts.items()}
    assert got == want
