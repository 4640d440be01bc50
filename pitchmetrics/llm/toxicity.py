"""Toxicity: a convolutional text classifier over hashed word embeddings.

A word's embedding is the mean of the rows of three hashed features: the word and its
first four and five letters.  Filters of widths 1 to 3 run over the words of the whole
text, the largest value of each filter is kept, and a logistic unit gives the score.  The
model is trained in numpy, in one task, on a bounded sample (``SAMPLE`` labelled
documents of each class, by hash of the key, of at most ``LONGEST`` characters), but for
a fifth of it, by hash too.  All labelled texts that were not learnt from, whole and of
any length, set the threshold of each language, with the classes (and long texts) at the
shares they have among all labels of the language.  Scoring covers every text as a whole.

Defined cases: a null or empty text has no words and gets the score of an empty text; a
null or missing label is no label; a key labelled twice has its larger label; rows with
a null key are scored but never learnt from; a language without enough labels, or null,
has the common threshold; with no labels of one of the classes every score is the share
of toxic labels (0 without labels); repeated rows get equal scores; an empty table gives
an empty one; clashing input columns are replaced by the added ones.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import slices

#: most labelled documents of each class that are learnt from, and their most characters
SAMPLE, LONGEST = 3000, 20_000
#: most hashed features with an embedding row
ROWS = 1 << 17
DIMS, FILTERS, WIDTHS = 16, 8, (1, 2, 3)
STEPS, BATCH = 700, 48
#: words kept with their feature rows in one Python worker
CACHE_WORDS = 400_000
#: labelled documents of each class that a language needs for a threshold of its own
OWN_THRESHOLD = 8
#: thresholds that are tried
GRID = np.linspace(0.05, 0.95, 91)
_EDGE = ".,;:!?\"'()[]{}<>«»„“”’…-–—*"


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def features(word: str) -> tuple[int, int, int]:
    w = word.strip(_EDGE)
    digest = xxhash.xxh3_64_intdigest
    return digest("w" + w), digest("4" + w[:4]), digest("5" + w[:5])


class Cnn:
    """Embedding rows by hashed feature (row 0: unknown, always zero) and the filters."""

    def __init__(self, known: list[int], seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        self.row = {h: i + 1 for i, h in enumerate(known)}
        self.emb = rng.normal(0, 0.1, (len(known) + 1, DIMS)).astype(np.float32)
        self.emb[0] = 0
        self.conv = [rng.normal(0, 0.5 / np.sqrt(w), (w, DIMS, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.shift = np.zeros(FILTERS * len(WIDTHS), np.float32)
        self.out = rng.normal(0.3, 0.1, FILTERS * len(WIDTHS)).astype(np.float32)
        self.bias = np.float32(-1)
        self.constant: float | None = None
        self.thresholds: dict[str | None, float] = {}
        self.common = 0.5
        self.words: dict[str, int] = {}
        self.word_rows: list[np.ndarray] = []

    def rows(self, word: str) -> list[int]:
        return [self.row.get(h, 0) for h in features(word)]

    def pooled(self, x: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Largest filter values of each text, ``begins`` being where its words start in
        ``x``; and the filter values.  Every text ends with words of zeros."""
        values, best = [], []
        for w, conv in zip(WIDTHS, self.conv, strict=True):
            v = x @ conv[0]
            for j in range(1, w):
                v[:-j] += x[j:] @ conv[j]
            values.append(v)
            best.append(np.maximum.reduceat(v, begins, axis=0))
        return np.concatenate(best, 1) + self.shift, values

    def scores(self, x: np.ndarray, begins: np.ndarray) -> np.ndarray:
        h = np.maximum(self.pooled(x, begins)[0], 0)
        return 1 / (1 + np.exp(-np.clip(h.astype(np.float64) @ self.out + float(self.bias), -40, 40)))

    def __getstate__(self):
        return self.__dict__ | {"words": {}, "word_rows": []}


def _flat(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Word rows of the texts, each followed by the widest filter's words of row 0."""
    pad = np.zeros((max(WIDTHS), 3), np.int32)
    begins = np.cumsum([0, *(len(d) + len(pad) for d in docs[:-1])])
    return np.concatenate([a for d in docs for a in (d, pad)]), begins


def train(texts: list[str], labels: np.ndarray, langs: list, tune: np.ndarray, seed: int = 7) -> Cnn:
    """tune: marks the texts that set the thresholds and are not learnt from."""
    learn = np.flatnonzero(~tune)
    cut = [words_of(t) for t in texts]
    seen: dict[int, int] = {}
    for i in learn:
        for h in {h for w in set(cut[i]) for h in features(w)}:
            seen[h] = seen.get(h, 0) + 1
    known = sorted((h for h, n in seen.items() if n > 1), key=lambda h: (-seen[h], h))[:ROWS]
    model = Cnn(known, seed)
    y = labels.astype(np.float32)
    positive, negative = learn[y[learn] == 1], learn[y[learn] == 0]
    if not len(positive) or not len(negative):
        model.constant = float(y.mean()) if len(y) else 0.0
        return model
    memo: dict[str, list[int]] = {}
    docs = []
    for words in cut:
        for w in words:
            if w not in memo:
                memo[w] = model.rows(w)
        docs.append(np.array([memo[w] for w in words], np.int32).reshape(-1, 3))
    rng = np.random.default_rng(seed)
    dense = [*model.conv, model.shift, model.out]
    first, second = [np.zeros_like(p) for p in dense], [np.zeros_like(p) for p in dense]
    grown = np.full(len(model.emb), 1e-6, np.float32)
    bias_m = bias_v = 0.0
    steps = STEPS
    for step in range(1, steps + 1):
        some = np.concatenate([rng.choice(positive, BATCH // 3), rng.choice(negative, BATCH - BATCH // 3)])
        rows, begins = _flat([docs[i] for i in some])
        keep = rng.random(rows.shape) > 0.4  # features left out at random, so that each can stand alone
        rows = np.where(keep, rows, 0)
        x = model.emb[rows].mean(1)
        h, values = model.pooled(x, begins)
        act = np.maximum(h, 0)
        p = 1 / (1 + np.exp(-(act @ model.out + model.bias)))
        d = (p - y[some]) / len(some)
        grads = [np.zeros_like(c) for c in model.conv] + [np.zeros_like(model.shift), act.T @ d]
        dh = d[:, None] * model.out * (h > 0)
        grads[-2] = dh.sum(0)
        touched, amount = [], []
        ends = np.append(begins[1:], len(rows))
        for k, (w, v) in enumerate(zip(WIDTHS, values, strict=True)):
            at = np.stack([b + v[b:e].argmax(0) for b, e in zip(begins, ends, strict=True)])  # text x filter
            g = dh[:, k * FILTERS:(k + 1) * FILTERS]
            for j in range(w):
                where = np.minimum(at + j, len(rows) - 1)
                grads[k][j] = np.einsum("tfd,tf->df", x[where], g)
                touched.append(where.ravel())
                amount.append((g[:, :, None] * model.conv[k][j].T[None]).reshape(-1, DIMS))
        where, amount = np.concatenate(touched), np.concatenate(amount) / 3
        ids, back = np.unique(rows[where].ravel(), return_inverse=True)
        sums = np.zeros((len(ids), DIMS), np.float32)
        np.add.at(sums, back, np.repeat(amount, 3, axis=0))
        sums += 1e-4 * model.emb[ids]
        grown[ids] += (sums ** 2).mean(1)
        model.emb[ids] -= 0.1 * sums / np.sqrt(grown[ids])[:, None]
        model.emb[0] = 0
        for i, (param, grad) in enumerate(zip(dense, grads, strict=True)):
            first[i] = 0.9 * first[i] + 0.1 * grad
            second[i] = 0.999 * second[i] + 0.001 * grad ** 2
            param -= 0.02 * (first[i] / (1 - 0.9 ** step)) / (np.sqrt(second[i] / (1 - 0.999 ** step)) + 1e-8)
        bias_m, bias_v = 0.9 * bias_m + 0.1 * d.sum(), 0.999 * bias_v + 0.001 * d.sum() ** 2
        model.bias -= np.float32(0.02 * (bias_m / (1 - 0.9 ** step)) / (np.sqrt(bias_v / (1 - 0.999 ** step)) + 1e-8))
    _calibrate(model, [docs[i] for i in np.flatnonzero(tune)], y[tune], [langs[i] for i in np.flatnonzero(tune)])
    return model


def _calibrate(model: Cnn, docs: list[np.ndarray], y: np.ndarray, langs: list) -> None:
    """Per language the middle of the thresholds with the fewest errors."""
    def best(score: np.ndarray, label: np.ndarray) -> float:
        errors = np.array([((score >= t) != (label == 1)).sum() for t in GRID])
        return float(np.median(GRID[errors == errors.min()]))

    if not docs:
        return
    score = np.concatenate([model.scores(model.emb[rows].mean(1), begins) for rows, begins in (_flat([d]) for d in docs)])
    if len(set(y)) > 1:
        model.common = best(score, y)
    for lang in {x for x in langs if x is not None}:
        own = np.array([x == lang for x in langs])
        if min((y[own] == 1).sum(), (y[own] == 0).sum()) >= OWN_THRESHOLD:
            model.thresholds[lang] = best(score[own], y[own])


def _thresholds(model: Cnn, docs: DataFrame, marks: DataFrame, learnt: DataFrame) -> None:
    """Sets the thresholds from all labelled rows of ``docs`` (k, t, g) that were not learnt
    from; ``marks`` (k, y) are all labels, ``learnt`` (k) the keys of the sample learnt from."""
    # at most two samples of keys are sent to every task
    rows = (docs.filter(F.col("k").isNotNull()).withColumn("short", F.length(F.coalesce("t", F.lit(""))) <= LONGEST)
            .join(F.broadcast(learnt.withColumn("seen", F.lit(True))), "k", "left")
            .withColumn("held", ~(F.coalesce("seen", F.lit(False)) & F.col("short"))))
    reached = F.size(F.filter(F.array(*map(F.lit, GRID.tolist())), lambda t: t <= F.col("score"))).alias("bin")
    # scores meet the labels after the texts are gone, so that no text is shuffled
    scored = score(rows, model, "t", "g").groupBy("k", "g", "short", "held", reached).count()
    table = scored.join(marks, "k").groupBy("g", "y", "short", "held", "bin").agg(F.sum("count").alias("n")).toPandas()

    def best(part: pd.DataFrame, least: int) -> float | None:
        """The middle of the thresholds with the fewest errors; None: too few rows of a class."""
        held = part[part["held"]]
        if min(held.loc[held["y"] == y, "n"].sum() for y in (0, 1)) < least:
            return None
        counts = np.zeros((2, len(GRID) + 1))
        for (y, _), some in part.groupby(["y", "short"]):
            kept = some[some["held"]]
            if len(kept):
                np.add.at(counts[y], kept["bin"].to_numpy(), kept["n"].to_numpy() * (some["n"].sum() / kept["n"].sum()))
        below = np.cumsum(counts, 1)[:, :-1]
        errors = below[1] + counts[0].sum() - below[0]
        return float(np.median(GRID[errors <= errors.min() + 1e-9 * counts.sum()]))

    common = best(table, 1)
    model.common = 0.5 if common is None else common
    own = {lang: best(part, OWN_THRESHOLD) for lang, part in table.groupby("g")}
    model.thresholds = {lang: t for lang, t in own.items() if t is not None}


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
        label: str = "toxic", sample: int = SAMPLE) -> Cnn:
    """Learns from ``labels`` (key, label 0 or 1); at most ``sample`` documents a class.  The
    thresholds are set by all the others."""
    spark = docs.sparkSession
    marks = (labels.filter(F.col(key).isNotNull() & F.col(label).isin(0, 1))
             .groupBy(F.col(key).alias("k")).agg(F.max(label).cast("int").alias("y")))
    chosen = None
    for value in (0, 1):
        part = marks.filter(F.col("y") == value).orderBy(F.xxhash64("k"), "k").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    docs = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"), F.col(lang).cast("string").alias("g"))
    tune = F.pmod(F.xxhash64(F.lit("tune"), "k"), F.lit(5)) == 0
    # at most two samples of keys are sent to every task
    rows = (docs.filter(F.length(F.coalesce("t", F.lit(""))) <= LONGEST).join(F.broadcast(chosen), "k")
            .groupBy("k").agg(F.min("t").alias("t"), F.min("g").alias("g"), F.min("y").alias("y"))
            .withColumn("tune", tune))

    def learn(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("k")
        langs = [g if isinstance(g, str) else None for g in frame["g"]]
        texts = [t if isinstance(t, str) else "" for t in frame["t"]]
        model = train(texts, frame["y"].to_numpy(), langs, frame["tune"].to_numpy(bool))
        return pd.DataFrame({"model": [pickle.dumps(model)]})

    made = rows.groupBy().applyInPandas(learn, "model binary").collect()
    if made:
        model = pickle.loads(made[0].model)
        if model.constant is None:
            _thresholds(model, docs, marks, chosen.filter(~tune).select("k"))
        return model
    model = Cnn([])
    model.constant = 0.0
    return model


def score(docs: DataFrame, model: Cnn, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with score, threshold (of the row's language) and toxic (score >= threshold)."""
    added = [T.StructField("score", T.DoubleType()), T.StructField("threshold", T.DoubleType()), T.StructField("toxic", T.BooleanType())]
    names = {f.name for f in added}
    schema = T.StructType([f for f in docs.schema if f.name not in names] + added)
    # the model has at most ROWS embedding rows
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        table: np.ndarray = np.zeros((0, DIMS), np.float32)
        for batch in batches:
            for begin, texts in slices(batch.column(batch.schema.get_field_index(text))):
                part = batch.slice(begin, len(texts))
                if m.constant is not None:
                    p = np.full(len(texts), m.constant)
                else:
                    if len(m.words) > CACHE_WORDS:
                        m.words, m.word_rows = {}, []
                        table = table[:0]
                    index, rows = m.words, m.word_rows
                    docs_at = []
                    for t in texts:
                        ws = words_of(t)
                        for w in set(ws).difference(index):
                            index[w] = len(rows)
                            rows.append(m.rows(w))
                        docs_at.append(np.fromiter(map(index.__getitem__, ws), np.int64, len(ws)))
                    if len(table) < len(rows):
                        table = np.concatenate([table, m.emb[np.array(rows[len(table):], np.int64)].mean(1)])
                    p = np.array([_long(m, table, at) for at in docs_at])
                g = part.column(part.schema.get_field_index(lang)).cast(pa.string()).to_pylist()
                limit = np.array([m.thresholds.get(x, m.common) for x in g])
                new = {"score": pa.array(p), "threshold": pa.array(limit), "toxic": pa.array(p >= limit)}
                yield pa.RecordBatch.from_arrays([new[f] if f in new else part.column(part.schema.get_field_index(f))
                                                  for f in schema.names], schema.names)

    return docs.mapInArrow(run, schema)


def _long(model: Cnn, table: np.ndarray, at: np.ndarray, step: int = 20_000) -> float:
    """The score of one text of any length: the largest filter values of its stretches."""
    widest = max(WIDTHS)
    pad = np.zeros((widest, DIMS), np.float32)
    best = None
    for i in range(0, max(1, len(at)), step):
        x = table[at[i:i + step + widest - 1]]
        if i + step >= len(at):
            x = np.concatenate([x, pad])
        h = model.pooled(x, np.array([0]))[0]
        best = h if best is None else np.maximum(best, h)
    z = float(np.maximum(best[0], 0).astype(np.float64) @ model.out.astype(np.float64) + float(model.bias))
    return 1 / (1 + float(np.exp(-max(-40.0, min(40.0, z)))))


def fold(key: str, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``."""
    return F.crc32(F.col(key).cast("string")) % parts
