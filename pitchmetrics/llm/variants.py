"""Spelling variant grouping with pivotal bigrams.

Words that differ by exactly one inserted, deleted or replaced code point are near.  A word
has its bigrams in one global order, the rarest first; its prefix is its first three, with
all that tie with the third.  One edit can spoil at most one of two disjoint bigrams, so of
two near words, the one whose prefix ends earlier in the order has a pivot, one of two
disjoint bigrams of its prefix, unspoilt in the prefix of the other.  A dynamic programme
over the positions picks the two with the fewest occurrences.  Pivots are indexed against
the prefixes of other words; an unspoilt pivot has everything on one of its sides unspoilt
too, which fixes its position there from that end: the key of the index is a hash of that
side with the bigram, and the other word's length, which is at most one off.  Where that
side is no longer than ``WEAK``, so that many words share it, the key also has a part of the
other side: the edit spoils either the ``NEAR`` code points next to the bigram's side or the
rest, so one of two keys stays.  What meets is verified by edit distance: in the join, or, for words of ``LONG`` code points and more, whose
texts do not go through the index, after it.

A word's form is its near word of largest n, the smallest in code-point order of equal
ones, if that n is at least ``factor`` times the word's own; following forms, n grows at
every step, so the last one is found by doubling pointers in about log2 of that many rounds.

Defined cases: a null text has no words; a null key counts as the empty text in the typing
slips below; repeated rows count each; a word without near words has n_near 0 and is its
own root; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, stored

#: fixed value: letters of a run; 90 of them once lower-cased, so there are at most 8,100 bigrams
RUN = r"[A-Za-zÀ-ÿ]+"
#: words of this length on go through the index without their texts
LONG = 64
#: sides up to this length, whose keys have more in them
WEAK = 3
NEAR = 3
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_FAR = np.int64(1) << 40


def words(docs: DataFrame, key: str = "doc_id", text: str = "text", slip: int = 97, least_length: int = 5,
          least_count: int = 3) -> DataFrame:
    """(word, n): the runs of letters of all texts, A-Z lower-cased, of at least
    ``least_length`` code points and ``least_count`` occurrences.  ``slip`` plants typing
    slips: where it divides the run's crc32 together with the key, one code point goes
    (0: none)."""
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"),
                       F.explode(F.regexp_extract_all(lower_ascii(F.col(text).cast("string")), F.lit(f"({RUN})"), F.lit(1))).alias("run"))
    word = F.col("run")
    if slip:
        runs = (runs.filter(F.length("run") >= least_length)
                .withColumn("h", F.crc32(F.concat_ws(":", "k", "run").cast("binary"))))
        at = (F.col("h") % F.length("run")).cast("int")
        word = F.when(F.col("h") % slip == 0, F.concat(F.col("run").substr(F.lit(1), at), F.col("run").substr(at + 2, F.length("run")))).otherwise(F.col("run"))
    return (runs.select(word.alias("word")).filter(F.length("word") >= least_length)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least_count))


def two_rarest(word: np.ndarray, pos: np.ndarray, freq: np.ndarray, rank: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each word's bigrams, given word by word in the order of their positions, the two
    that do not overlap with the fewest occurrences together (places in the given arrays).
    ``rank`` is their place in the global order, which does not fall as ``freq`` grows.  The programme goes over the positions: the best mate of a bigram is the rarest one that
    ends before it starts, which is its neighbour in the list or the rarest before that."""
    n = len(word)
    index = np.arange(n)
    # (word falling, rank, place) as one number, so that a running minimum starts anew with each word
    running = np.minimum.accumulate((((words - word) << 16 | rank) << 30) + index) if n else index
    mate, cost = np.full(n, -1), np.full(n, _FAR)
    first = np.searchsorted(word, word)
    for back in (1, 2):  # the neighbour, if it does not overlap; the rarest up to the one before it
        at = index - back
        there = (at >= first) & ((back == 2) | (pos[np.maximum(at, 0)] <= pos - 2))
        at = np.maximum(at, 0)
        other = running[at] & ((1 << 30) - 1) if back == 2 else at
        other = np.where(there, other, 0)
        total = freq + freq[other]
        better = there & (total < cost)
        mate[better], cost[better] = other[better], total[better]
    order = np.lexsort((index, cost, word))
    best = order[np.searchsorted(word, np.arange(words))]
    return mate[best], best


def _ranks(vocabulary: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Of every bigram (as 256 * first + second code point): occurrences, and place in the
    global order.  At most 8,100 rows reach the driver."""
    grams = vocabulary.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.col("word").substr(i, F.lit(2)))).alias("gram"))
    freq = np.zeros(1 << 16, np.int64)
    for r in grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).collect():
        freq[ord(r.gram[0]) * 256 + ord(r.gram[1])] = r.n
    rank = np.empty(1 << 16, np.int64)
    rank[np.lexsort((np.arange(1 << 16), freq))] = np.arange(1 << 16)
    return freq, rank


class Grams:
    """Prefixes and pivots of a batch of words, and the keys of their index."""

    def __init__(self, words: list[str], freq: np.ndarray, rank: np.ndarray) -> None:
        size = np.array([len(w) for w in words], np.int64)
        start = np.concatenate([[0], np.cumsum(size)])
        code = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        owner = np.repeat(np.arange(len(words)), size)
        place = np.arange(len(code)) - start[owner]
        at = np.flatnonzero(place < size[owner] - 1)
        gram = code[at] * 256 + code[at + 1]
        word = owner[at]
        order = np.lexsort((rank[gram], word))
        third = rank[gram[order[np.searchsorted(word, np.arange(len(words))) + 2]]]
        kept = rank[gram] <= third[word]
        self.word, self.pos, self.freq = word[kept], place[at][kept], freq[gram[kept]]
        self.pivots = np.concatenate(two_rarest(self.word, self.pos, self.freq, rank[gram[kept]], len(words)))
        # sums of letter * base^place, from which any part's hash follows
        most = max(size.max(initial=0), 1)
        power = np.concatenate([[np.uint64(1)], np.cumprod(np.full(most, _BASE, np.uint64))])
        self.back = np.concatenate([[np.uint64(1)], np.cumprod(np.full(most, _INVERSE, np.uint64))])
        self.up = np.concatenate([[np.uint64(0)], np.cumsum((code + 1).astype(np.uint64) * power[place])])
        self.start, self.size = start[self.word], size[self.word]

    def _part(self, of: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the code points begin to end of the words of the bigrams ``of``."""
        return (self.up[self.start[of] + end] - self.up[self.start[of] + begin]) * self.back[begin]

    def rows(self, of: np.ndarray, pivot: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word, key, length of the word on the prefix side) of the bigrams ``of``."""
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        pos, size, zero = self.pos[of], self.size[of], np.zeros(len(of), np.int64)
        for tail in (False, True):
            side = size - pos if tail else pos + 2
            key = (self._part(of, pos, size) if tail else self._part(of, zero, pos + 2)) * np.uint64(3) + np.uint64(tail)
            other = size - side

            def stretch(begin: np.ndarray, end: np.ndarray, tag: int) -> np.ndarray:
                """The key with a part of the other side, counted from the bigram's side on."""
                part = self._part(of, other - end, other - begin) if tail else self._part(of, side + begin, side + end)  # noqa: B023
                return (key * _BASE + part) * np.uint64(5) + np.uint64(tag)  # noqa: B023

            # by the length of the prefix's word less that of the pivot's: (that word's length, the shorter other side)
            cases = [(size + d, other + min(d, 0), d == 1) for d in (-1, 0, 1)] if pivot else [(size, other, False), (size, other - 1, True)]
            for k, (length, shorter, grown) in enumerate(cases):
                weak = (side <= WEAK) & (length - side > NEAR)
                far = stretch(np.minimum(other - shorter + NEAR, other), other, 2 + grown)
                if pivot or k == 0:  # a prefix has one key for all lengths of the pivot's word here
                    out.append((of[~weak], key[~weak], length[~weak]))
                    near = stretch(zero, np.minimum(zero + NEAR, other), 1)
                    out.append((of[weak], near[weak], length[weak]))
                out.append((of[weak], far[weak], length[weak]))
        word, key, length = (np.concatenate(x) for x in zip(*out, strict=True))
        return self.word[word], key.view(np.int64), length


def index(vocabulary: DataFrame) -> DataFrame:
    """(id, n, word, pivot, key, length): the keys of the pivots of (id, word, n), where
    ``pivot``, and of the prefixes.  Rows for the long words have the id, others the word."""
    freq, rank = _ranks(vocabulary)
    names = ["id", "n", "word", "pivot", "key", "length"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(1).to_pylist()
            for begin, end in _slices(words):
                part, lengths = words[begin:end], np.array([len(w) for w in words[begin:end]], np.int64)
                grams = Grams(part, freq, rank)
                for of, pivot in ((grams.pivots, True), (np.arange(len(grams.word)), False)):
                    word, key, length = grams.rows(of, pivot)
                    for long in (False, True):
                        own = np.flatnonzero(lengths[word] >= LONG if long else lengths[word] <= LONG)
                        if not len(own):
                            continue
                        rows = pa.array(begin + word[own])
                        yield pa.RecordBatch.from_arrays(
                            [batch.column(0).take(rows) if long else pa.nulls(len(own), pa.int64()), batch.column(2).take(rows),
                             pa.nulls(len(own), pa.string()) if long else batch.column(1).take(rows).cast(pa.string()),
                             pa.array(np.full(len(own), pivot)), pa.array(key[own]), pa.array(length[own].astype(np.int32))], names)

    return vocabulary.select("id", "word", "n").mapInArrow(run, "id long, n long, word string, pivot boolean, key long, length int")


def _slices(words: list[str], letters: int = 500_000) -> Iterator[tuple[int, int]]:
    begin, size = 0, 0
    for i, w in enumerate(words):
        size += len(w)
        if size >= letters or i == len(words) - 1:
            yield begin, i + 1
            begin, size = i + 1, 0


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(a, b, n_a, n_b) of (id, word, n): every pair of near words once, a < b."""
    keys = stored(index(vocabulary), "index")
    on = (F.col("p.key") == F.col("q.key")) & (F.col("p.length") == F.col("q.length"))
    ends = F.array_sort(F.array(F.struct("p.word", "p.n"), F.struct("q.word", "q.n")))

    def sides(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        return rows.filter("pivot").alias("p"), rows.filter("not pivot").alias("q")

    p, q = sides(keys.filter("word is not null"))
    short = p.join(q, on & (F.levenshtein(F.col("p.word"), F.col("q.word"), 1) == 1)).select(ends.alias("e"))
    p, q = sides(keys.filter("word is null"))
    met = p.join(q, on & (F.col("p.id") != F.col("q.id"))).select(F.least("p.id", "q.id").alias("x"), F.greatest("p.id", "q.id").alias("y")).distinct()
    p, q = vocabulary.alias("p"), vocabulary.alias("q")
    long = (met.join(p, F.col("x") == F.col("p.id")).join(q, F.col("y") == F.col("q.id"))
            .filter(F.levenshtein(F.col("p.word"), F.col("q.word"), 1) == 1).select(ends.alias("e")))
    return (short.unionByName(long).distinct()
            .select(F.col("e")[0]["word"].alias("a"), F.col("e")[1]["word"].alias("b"),
                    F.col("e")[0]["n"].alias("n_a"), F.col("e")[1]["n"].alias("n_b")))


def _roots(forms: DataFrame, rounds: int = 64) -> DataFrame:
    """(word, root) of the words that have a form: the last one that following forms
    reaches.  Every round doubles the distance followed."""
    reached = forms.select("word", F.col("form").alias("root")).checkpoint()
    for _ in range(rounds):
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        reached = (reached.join(further, "root", "left")
                   .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")).checkpoint())
        if not reached.filter("moved").limit(1).count():
            return reached.select("word", "root")
        reached = reached.select("word", "root")
    raise RuntimeError("forms did not end")


def group_variants(docs: DataFrame, key: str = "doc_id", text: str = "text", slip: int = 0, least_length: int = 5,
                   least_count: int = 3, factor: int = 2) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    if least_length < 4:
        raise ValueError("two disjoint bigrams of three need words of four code points")
    vocabulary = stored(words(docs, key, text, slip, least_length, least_count)
                        .withColumn("id", F.monotonically_increasing_id()), "words")
    pairs = near_words(vocabulary)
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("n_b").alias("n_a"), F.col("n_a").alias("n_b")))
    best = F.min(F.struct((-F.col("n_b")).alias("minus_n"), F.col("b").alias("word")))
    near = stored(both.groupBy(F.col("a").alias("word")).agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"), F.first("n_a").alias("own")), "near")
    kept = -F.col("best.minus_n") >= factor * F.col("own")
    near = near.select("word", "n_near", F.when(kept, F.col("best.word")).alias("form"), F.when(kept, -F.col("best.minus_n")).alias("form_n"))
    roots = _roots(near.filter(F.col("form").isNotNull()))
    return (vocabulary.drop("id").join(near, "word", "left").join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n"))


def sql(documents: str, slip: int = 97) -> str:
    """The same rows in DuckDB: near words by what is left when one place is taken out."""
    return f"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, r: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
low AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS k,
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS s FROM {documents}),
runs AS (SELECT k, unnest(regexp_extract_all(s, '[A-Za-zÀ-ÿ]+')) AS run FROM low),
counted AS (SELECT k, run, count(*) AS c, hex(encode(k || ':' || run)) AS x FROM runs WHERE length(run) >= 5 GROUP BY k, run),
hashed AS (SELECT run, c, xor(list_reduce([4294967295] || list_transform(range(0, length(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT),
             lambda h, b: xor(h >> 8, t[(xor(h, b) & 255) + 1])), 4294967295) AS h FROM counted, crc_table),
typed AS (SELECT c, CASE WHEN h % {slip} = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM hashed),
words AS (SELECT word, sum(c)::BIGINT AS n FROM typed WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
holes AS (SELECT word, n, i, left(word, i) AS a, substr(word, i + 2) AS z FROM (SELECT word, n, unnest(range(0, length(word)))::INT AS i FROM words)),
near AS (
  SELECT p.word AS w, q.word AS o, p.n AS n, q.n AS m FROM holes p JOIN holes q ON p.i = q.i AND p.a = q.a AND p.z = q.z AND p.word <> q.word
  UNION SELECT p.word, q.word, p.n, q.n FROM holes p JOIN words q ON q.word = p.a || p.z
  UNION SELECT q.word, p.word, q.n, p.n FROM holes p JOIN words q ON q.word = p.a || p.z),
best AS (SELECT w, count(*) AS n_near, first(o ORDER BY m DESC, encode(o)) AS o, max(m) AS m, max(n) AS n FROM near GROUP BY w),
forms AS (SELECT w AS word, o AS form, m AS form_n FROM best WHERE m >= 2 * n),
steps AS (SELECT word, form AS e FROM forms UNION ALL SELECT s.word, f.form FROM steps s JOIN forms f ON f.word = s.e),
ends AS (SELECT word, e FROM steps WHERE NOT EXISTS (SELECT 1 FROM forms f WHERE f.word = steps.e))
SELECT w.word, f.form, coalesce(x.e, w.word) AS root, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near, f.form_n
FROM words w LEFT JOIN best b ON b.w = w.word LEFT JOIN forms f ON f.word = w.word LEFT JOIN ends x ON x.word = w.word
"""
