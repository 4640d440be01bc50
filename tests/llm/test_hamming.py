"""Exact top-k by Hamming distance against brute force and DuckDB."""

import random

import duckdb

from pitchmetrics.llm import hamming, queries


def _brute(asked, rows, k):
    rows, out = {r for r in rows if None not in r}, set()
    for qid, q in {r for r in asked if None not in r}:
        best = sorted((((q ^ c) % 2**64).bit_count(), i, c) for i, c in rows if (i, c) != (qid, q))[:k]
        out |= {(qid, q, n + 1, i, c, d) for n, (d, i, c) in enumerate(best)}
    return out


def _signed(x):
    return x - 2**64 if x >= 2**63 else x


def test_clusters_copies_and_cases(spark):
    rng = random.Random(1)
    centres = [rng.getrandbits(64) for _ in range(4)]
    rows = [(i, _signed(rng.choice(centres) ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(12))))) for i in range(300)]
    rows += [(1000 + i, 77) for i in range(40)] + [(2000, _signed(rng.getrandbits(64))), (5, 99), (5, 99), (None, 3), (9, None)]
    asked = [r for r in rows if r[0] is not None and r[0] % 20 == 0] + [(5, 99), (5, 99), (None, 3)]
    df = spark.createDataFrame(rows, "id long, code long")
    got = hamming.top_k(spark.createDataFrame(asked, "id long, code long"), df, 7)
    rows_got = [tuple(r) for r in got.collect()]
    assert len(rows_got) == len(set(rows_got)) and set(rows_got) == _brute(asked, rows, 7)
    few = [(1, 5), (2, 6), (20, -1)]
    small = spark.createDataFrame(few, "id long, code long")
    assert {tuple(r) for r in hamming.top_k(small, small, 10).collect()} == _brute(few, few, 10)
    assert hamming.top_k(small.limit(0), small, 10).collect() == hamming.top_k(small, small.limit(0), 10).collect() == []


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.01"
    got = sorted(tuple(r) for r in queries.op7_exact_top_k(spark, sf).collect())
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf}/embeddings.parquet'")
    want = sorted(con.sql(queries.ORACLE["op7_exact_top_k"]).fetchall())
    assert got == want and len(got) == 250


def test_sign_code(spark):
    df = spark.createDataFrame([([1.0, -1.0, 0.0, float("nan"), None, 2.0],), (None,), ([],)], "v array<float>")
    assert [r[0] for r in df.select(hamming.sign_code("v")).collect()] == [1 + 32, None, 0]
