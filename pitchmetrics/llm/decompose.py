"""Packing by power-of-two decomposition.

A document's ids are cut into pieces whose lengths are the binary digits of their number,
the longest first (as many pieces of ``size`` as there are, then one of each smaller power
of two that the rest holds).  A piece is a sequence of its own: its length is a power of
two, so nothing is padded and no sequence crosses documents.  Pieces of equal length are a
bucket and are numbered in it without gaps, so that a trainer draws batches of one length
from it (:func:`batches`).  Numbers are counted in the task that makes the pieces and
shifted by the counts of the tasks before it; there are at most log2(``size``) + 1 buckets.

The ids are those of the ``tokenizers`` library.  No token crosses white space or the
pre-tokenizer's words, so the library is asked once for each word a worker meets; a text
with characters beyond Latin-1 or with a special token's string goes to it as a whole.

Defined cases: a null text is the empty text; every document has its closing id, so it has
at least one piece; repeated rows are cut each on its own; a null key is kept; an empty
table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bpe import ragged, slices
from .common import stored

#: words kept with their ids in one Python worker
CACHE_WORDS = 1_000_000
#: longer words are not kept
LONG_WORD = 64

# fixed values: the vocabulary's pre-tokenizer for lower-cased Latin-1 text
_LETTERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
_DIGITS = "0-9\xb2\xb3\xb9\xbc-\xbe"
_SPACE = " \t-\r\x85\xa0"
_WORDS = re.compile(f"[{_LETTERS}]+|[{_DIGITS}]|'s|'t|'re|'ve|'m|'ll|'d|[^{_SPACE}{_LETTERS}{_DIGITS}]+")
_WIDE = re.compile("[^\x00-\xff]").search


class _Words(dict):
    """Word -> its number; words met for the first time wait in ``new``."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        n = len(self)
        self[word] = n
        self.new.append(word)
        return n


class Encoder:
    """Ids of texts as one vocabulary file's library gives them, without its special frame."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel part
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.words, self.flat, self.offsets = _Words(), np.zeros(0, np.uint32), np.zeros(1, np.int64)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def _learn(self) -> None:
        new, self.words.new = self.words.new, []
        if new:
            ids = [e.ids for e in self.library.encode_batch(new, add_special_tokens=False)]
            lengths = np.array([len(i) for i in ids], np.int64)
            self.flat = np.concatenate([self.flat, np.array([x for i in ids for x in i], np.uint32)])
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(lengths)])

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text; a null text has none."""
        if len(self.words) > CACHE_WORDS:
            self.forget()
        plan: list = []
        for text in texts:
            if not text:
                plan.append(np.zeros(0, np.uint32))
            elif _WIDE(text) or any(s in text for s in self.special):
                plan.append(self._whole(text))
            else:
                words = _WORDS.findall(text.lower())
                if max(map(len, words), default=0) > LONG_WORD:
                    plan.append(self._whole(text))
                else:
                    plan.append((np.fromiter(map(self.words.__getitem__, words), np.int64, len(words)),))
        self._learn()
        return [ragged(self.flat, self.offsets, p[0])[0] if isinstance(p, tuple) else p for p in plan]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cuts(n: int, size: int) -> list[int]:
    """The lengths of the pieces of ``n`` ids, longest first."""
    rest = n % size
    return [size] * (n // size) + [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]


def pieces(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", size: int = 4096, closing: int = 2,
           with_ids: bool = False) -> DataFrame:
    """Per piece: key, start, length, ids_crc32, doc_tokens, and the piece's rank among
    those of its length in its task; ``ids`` too if asked for."""
    if size < 1 or size & (size - 1):
        raise ValueError("size must be a power of two")
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("t"))
    fields = [T.StructField("key", rows.schema["key"].dataType), T.StructField("start", T.LongType()),
              T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
              T.StructField("doc_tokens", T.LongType()), T.StructField("task", T.IntegerType()),
              T.StructField("rank", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, met = encoder(path), TaskContext.get().partitionId(), dict.fromkeys((1 << b for b in range(size.bit_length())), 0)
        for batch in batches:
            for begin, texts in slices(batch.column(1), 2_000_000):
                owner, cols, cut = [], [], []
                for i, ids in enumerate(encode(texts)):
                    ids = np.append(ids, np.uint32(closing)).astype("<u4")
                    raw, at = memoryview(ids).cast("B"), 0
                    for n in cuts(len(ids), size):
                        cols.append((at, n, zlib.crc32(raw[at * 4:(at + n) * 4]), len(ids), met[n]))
                        met[n] += 1
                        owner.append(i)
                        if with_ids:
                            cut.append(ids[at:at + n].astype(np.int32))
                        at += n
                a = np.array(cols, np.int64).reshape(-1, 5)
                out = [batch.column(0).slice(begin, len(texts)).take(pa.array(owner, pa.int64())), *(pa.array(a[:, j]) for j in range(4)),
                       pa.array(np.full(len(a), task, np.int32)), pa.array(a[:, 4])]
                yield pa.RecordBatch.from_arrays([*out, pa.array(cut, pa.list_(pa.int32()))] if with_ids else out, names)

    return rows.mapInArrow(run, T.StructType(fields))


def pack(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", size: int = 4096, closing: int = 2,
         with_ids: bool = False) -> DataFrame:
    """A sequence for every piece: key, start, length, ids_crc32, doc_tokens, sequence_id,
    offset (always 0), bucket (log2 of the length) and place (gapless in its bucket)."""
    made = stored(pieces(df, path, key, text, size, closing, with_ids), "pieces")
    counts = made.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    shift = counts.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    # at most log2(size) + 1 rows reach the driver
    totals = {r.length: r.n for r in made.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    first, base = 0, F.lit(0)
    for n in sorted(totals, reverse=True):
        base = F.when(F.col("length") == n, F.lit(first)).otherwise(base)
        first += totals[n]
    placed = made.join(shift, ["task", "length"]).withColumn("place", F.col("rank") + F.col("shift"))
    return placed.select(
        F.col("key").alias(key), "start", "length", "ids_crc32", "doc_tokens",
        (base + F.col("place")).cast("bigint").alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"),
        F.round(F.log2("length")).cast("int").alias("bucket"), "place", *(["ids"] if with_ids else []))


def batches(packed: DataFrame, tokens: int) -> DataFrame:
    """``packed`` with ``batch`` and ``row``: sequences of one length, ``tokens`` ids a batch
    (one sequence where ``tokens`` is less than that); a bucket's last batch may be smaller."""
    per = F.greatest(F.floor(F.lit(tokens) / F.col("length")), F.lit(1)).cast("bigint")
    return packed.withColumn("batch", F.floor(F.col("place") / per).cast("bigint")).withColumn("row", F.col("place") % per)
