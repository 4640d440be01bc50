"""Spelling variants against a plain comparison of all words."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pitchmetrics.llm import queries, variants


def _near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _plain(docs, slip, least_length=5, least_count=3, factor=2):
    """{word: (form, root, n, n_near, form_n)}."""
    count = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if slip and h % slip == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least_length:
                count[run] += 1
    words = {w: n for w, n in count.items() if n >= least_count}
    near = {w: [] for w in words}
    ordered = sorted(words)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1:]:
            if abs(len(a) - len(b)) < 2 and _near(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda o: (-words[o], o))
            if words[best] >= factor * words[w]:
                form[w] = best
    out = {}
    for w in words:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, words[w], len(near[w]), words[form[w]] if w in form else None)
    return out


def _rows(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert _rows(queries.op13_spelling_variants(spark, sf)) == _plain(docs, 97)


@pytest.mark.parametrize("letters", ["ab", "aé", "abcÿ", "aaab"])
def test_all_short_words_of_few_letters(spark, letters):
    """Repeated bigrams, ties in the order, and edits at every place."""
    import random
    rng = random.Random(len(letters))
    words = {"".join(rng.choice(letters) for _ in range(rng.randrange(4, 9))) for _ in range(150)}
    docs = [(i, " ".join([w] * rng.choice((1, 2, 4, 9)))) for i, w in enumerate(sorted(words))]
    got = variants.group_variants(spark.createDataFrame(docs, "doc_id long, text string"), least_length=4, least_count=1)
    assert _rows(got) == _plain(docs, 0, 4, 1)


def test_chains_of_forms(spark):
    """A long chain: every word is twice as frequent as the one before."""
    chain = ["aaaaaaaa"[:8 - i] + "bbbbbbbb"[:i] for i in range(9)]
    docs = [(i, " ".join([w] * 2 ** i)) for i, w in enumerate(chain)]
    got = _rows(variants.group_variants(spark.createDataFrame(docs, "doc_id long, text string"), least_count=1))
    assert {v[1] for v in got.values()} == {chain[-1]} and got[chain[0]][0] == chain[1]


def test_pivots_are_the_rarest_disjoint_pair():
    import random
    rng = random.Random(7)
    words = ["banana", "bandana", "cabana", "xylophone", "xylophones", "zzzzz", "éÿéÿéÿé"]
    words += ["".join(rng.choice("abcd") for _ in range(rng.randrange(4, 12))) for _ in range(300)]
    count = Counter(w[i:i + 2] for w in words for i in range(len(w) - 1))
    freq = np.zeros(1 << 16, np.int64)
    for g, n in count.items():
        freq[ord(g[0]) * 256 + ord(g[1])] = n
    rank = np.empty(1 << 16, np.int64)
    rank[np.lexsort((np.arange(1 << 16), freq))] = np.arange(1 << 16)
    grams = variants.Grams(words, freq, rank)
    a, b = grams.pivots.reshape(2, -1)
    for k, w in enumerate(words):
        order = sorted((count[w[i:i + 2]], w[i:i + 2]) for i in range(len(w) - 1))
        prefix = [i for i in range(len(w) - 1) if (count[w[i:i + 2]], w[i:i + 2]) <= order[2]]
        assert grams.pos[grams.word == k].tolist() == prefix
        x, y = grams.pos[a[k]], grams.pos[b[k]]
        assert grams.word[a[k]] == grams.word[b[k]] == k and y - x >= 2 and {x, y} <= set(prefix)
        least = min(count[w[i:i + 2]] + count[w[j:j + 2]] for i in prefix for j in prefix if j - i >= 2)
        assert count[w[x:x + 2]] + count[w[y:y + 2]] == least


def test_edge_cases(spark):
    docs = [(None, "Colour COLOUR colour colour"), (1, None), (2, ""), (3, "color color color ÉCOLE école École"), (3, "color color color"),
            (4, "colour " * 20_000 + ("x" * 9_000 + " ") * 3 + ("x" * 4_000 + "y" + "x" * 4_999 + " ") * 3 + ("x" * 9_001 + " ") * 7),
            (4, " ".join((("ab" * 31 + "c" * k) + " ") * (3 + 4 * k) for k in range(5))), (5, "nano,nano;nano near_near ÀÀÀÀÀÀ×÷")]
    df = spark.createDataFrame([(k, t, 1, "w") for k, t in docs], "doc_id long, text string, n long, word string")
    for slip in (0, 3):
        assert _rows(variants.group_variants(df, slip=slip)) == _plain(docs, slip)
    assert variants.group_variants(df.limit(0)).collect() == []
    with pytest.raises(ValueError):
        variants.group_variants(df, least_length=3)
