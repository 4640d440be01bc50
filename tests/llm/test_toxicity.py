"""Toxicity: held-out accuracy, whole-text scores, and defined cases."""

import random

import numpy as np

from pitchmetrics.llm import queries, toxicity


def _made(n, seed, bad=("vile", "grubmo", "grubza")):
    rng = random.Random(seed)
    syllables = ["ta", "re", "mi", "son", "el", "ka", "dor"]
    rows = []
    for i in range(n):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(10, 60))]
        y = int(rng.random() < 0.3)
        for _ in range(3 * y):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words) + ".", ("en", "fr")[i % 2], y))
    return rows


def _model(rows):
    return toxicity.train([r[1] for r in rows], np.array([r[3] for r in rows]), [r[2] for r in rows],
                          np.array([r[0] % 5 == 0 for r in rows]))


def test_held_out_accuracy_and_whole_texts(spark):
    rows = _made(400, 1)
    model = _model(rows)
    fresh = _made(200, 2, bad=("vile", "Grubka,", "grubson"))  # the family is known, two members are new
    long = [(900, "mi re " * 40_000 + "vile grubmo vile", "en", 1), (901, "mi re " * 40_000, "en", 0)]
    got = {r.doc_id: r for r in toxicity.score(spark.createDataFrame(fresh + long, "doc_id long, text string, lang string, y int"), model).collect()}
    right = sum((got[r[0]].score >= 0.7) == bool(r[3]) for r in fresh)
    assert right >= 190
    assert got[900].score > 0.7 > got[901].score
    assert all(0 <= r.score <= 1 and r.toxic == (r.score >= r.threshold) for r in got.values())
    assert set(model.thresholds) == {"en", "fr"}


def test_fit_is_repeatable_and_cases(spark):
    rows = _made(120, 3)
    docs = spark.createDataFrame([(r[0], r[1], r[2], "old") for r in rows] + [(500, None, None, "old"), (None, "", "xx", "old"), (500, None, None, "old")],
                                 "doc_id long, text string, lang string, score string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows] + [(3, 1), (None, 1), (4, None)], "doc_id long, toxic int")
    scores = [sorted((-1 if r.doc_id is None else r.doc_id, r.score) for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()) for _ in range(2)]
    assert scores[0] == scores[1] and len(scores[0]) == 123
    empty = {s for k, s in scores[0] if k in (-1, 500)}
    assert len(empty) == 1 and 0 <= min(empty) <= 1
    one_class = toxicity.fit(docs, labels.filter("toxic = 0"))
    assert {r.score for r in toxicity.score(docs, one_class).collect()} == {0.0}
    nothing = toxicity.fit(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, nothing).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), one_class).collect() == []


def test_query_learns_from_its_folds_only(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op8_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic"), "doc_id", "left").collect()
    assert len(rows) == 1000
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out and r.toxic is not None]
    pairs = [(a.score, b.score) for a in held if a.toxic for b in held if not b.toxic]
    assert sum((a > b) + 0.5 * (a == b) for a, b in pairs) / len(pairs) > 0.75  # some 30 toxic texts to learn from


def test_thresholds_come_from_all_labels(spark):
    """Thresholds have the fewest errors on all texts not learnt from at their true shares,
    though the sample is cut; a rare language and long texts count."""
    rows = []
    for i, text, lang, y in _made(1500, 4):
        # the bad words of a fourth of the clean texts: the scores of the classes overlap
        rows.append((i, text + (" vile" if i % 4 == 1 and not y else ""), "xx" if i % 12 == 0 else lang, y))
    rows += [(2000 + i, "mi re " * 5000 + ("vile grubmo vile" if i % 2 else ""), "zz", i % 2) for i in range(24)]
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, sample=60)
    assert set(model.thresholds) == {"en", "fr", "xx", "zz"}
    label = {r[0]: r[3] for r in rows}
    got = toxicity.score(docs, model).collect()
    for lang, mine in model.thresholds.items():
        own = [r for r in got if r.lang == lang]
        errors = [sum((r.score >= t) != bool(label[r.doc_id]) for r in own) for t in toxicity.GRID]
        assert sum((r.score >= mine) != bool(label[r.doc_id]) for r in own) <= min(errors) + 0.02 * len(own)
