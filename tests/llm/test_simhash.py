"""SimHash fingerprints and components against brute force."""

import random

import xxhash

from pitchmetrics.llm import queries, simhash


def _fingerprint(text, n=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = low.encode().split()
    if not words:
        return 0
    grams = [words[i:i + n] for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64(b" ".join(g), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(fps, radius):
    """{key: component} over (key, fp)."""
    root = {k: k for k, _ in fps}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k
    for i, (a, x) in enumerate(fps):
        for b, y in fps[:i]:
            if (x ^ y).bit_count() <= radius:
                low, high = sorted((top(a), top(b)))
                root[high] = low
    return {k: top(k) for k, _ in fps}


def test_fingerprints():
    for text in (None, "", "  \t", "one", "Two words", "a b c", "É É É é", "x y z " * 40000, "A a A a A a\x0b\x0c b"):
        assert simhash.fingerprint(text, 3, 42) == _fingerprint(text), text


def test_tree_finds_all_within_radius():
    rng = random.Random(1)
    base = rng.getrandbits(64)
    values = list({base ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(9))) & (2**64 - 1) for _ in range(600)})
    tree = simhash.BkTree()
    for v in values:
        tree.add(v)
    for v in values[:100]:
        assert {tree.value[i] for i in tree.within(v, 2)} == {w for w in values if (v ^ w).bit_count() <= 2}


def test_links_connect_dense_groups_with_small_trees(spark):
    rng = random.Random(2)
    centres = [rng.getrandbits(64) for _ in range(5)]
    values = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for c in centres for _ in range(120)}
    fps = [(v, v) for v in sorted(values)]
    want = _components(fps, 2)
    rows = [(v - 2**64 if v >= 2**63 else v,) for v in values]
    df = spark.createDataFrame(rows, "fp long")
    for tree in (16, 4096):
        groups = {}
        for r in simhash.links(df, 2, tree).collect():
            groups.setdefault(r.a % 2**64, set()).add(r.b % 2**64)
        root = {v: v for v in values}

        def top(k, root=root):
            while root[k] != k:
                k = root[k]
            return k
        for a, bs in groups.items():
            for b in bs:
                assert (a ^ b) in {a ^ b} and want[a] == want[b]
                low, high = sorted((top(a), top(b)))
                root[high] = low
        assert {v: top(v) for v in values} == want


def test_edge_cases(spark):
    rows = [(5, None, "e"), (3, "", "e"), (9, " \n", "e"), (1, "same text here now", "e"), (1, "same text here now", "e"),
            (8, "SAME text here now", "e"), (None, "same text here now", "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    got = sorted((r.doc_id or -1, r.component_id) for r in simhash.near_duplicates(df).collect())
    assert got == [(-1, 1), (1, 1), (1, 1), (3, 3), (5, 3), (8, 1), (9, 3)]
    assert simhash.near_duplicates(df.limit(0)).collect() == []


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, _fingerprint(r.text)) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = _components(docs, 2)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op4_simhash(spark, sf).collect()}
    assert got == {k: (f"{fp:016x}", want[k]) for k, fp in docs}
