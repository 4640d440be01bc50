"""Best-fit packing by minimum bin slack.

Documents become token pieces of at most ``size`` tokens; which pieces share a sequence
depends on their lengths alone.  The plan is therefore made on the histogram of lengths
(at most ``size`` numbers however many documents there are): the longest length still
there opens a bin, a subset-sum dynamic programme over the lengths still there, kept as
bitsets, finds the fullest feasible combination for the rest of the bin, and that
combination is removed as many times as the histogram holds it.  Plans that let a bin
keep a little more slack, and its short lengths for later, are made too (``ALLOWED``); the
one with the fewest sequences is taken.  A piece finds its place
in closed form from its length and its rank among the pieces of that length.  Ranks are
counted in the task that makes the pieces and shifted by the counts of the tasks before
it, so a length that most documents share is never gathered in one task.

Defined cases: a null text is the empty text; every document has its closing id, so it
has at least one token and a place; repeated rows are packed each on its own; a null key
is kept; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bpe
from .common import stored

#: runs over this length are encoded by numpy merge rounds, as the compiled encoder
#: backtracks over them
LONG_RUN = 2000


class _Encoder:
    """The ids of a vocabulary file by the compiled encoder of ``tiktoken``."""

    def __init__(self, path: str) -> None:
        self.path = path
        own = bpe.bpe(path)
        special = own.special
        ranks = {t: i for i, t in enumerate(own.token) if i not in set(special.values())}
        self.fast = tiktoken.Encoding("file", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.allowed = set(special)
        self.long = re.compile(r"\s{%d}|\S{%d}" % (LONG_RUN, LONG_RUN)).search

    def __call__(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if len(text) >= LONG_RUN and self.long(text):
            return bpe.bpe(self.path).encode([text])[0].astype(np.uint32)
        return self.fast.encode_to_numpy(text, allowed_special=self.allowed)


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> _Encoder:
    return _Encoder(path)


def pieces(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", size: int = 1024, closing: int = 2,
           with_ids: bool = False) -> DataFrame:
    """Per piece: key, piece, start, length, ids_crc32, and the piece's rank among those of
    its length in its task; ``ids`` too if asked for."""
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("t"))
    fields = [T.StructField("key", rows.schema["key"].dataType), T.StructField("piece", T.IntegerType()),
              T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
              T.StructField("ids_crc32", T.LongType()), T.StructField("task", T.IntegerType()),
              T.StructField("rank", T.LongType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, met = _encoder(path), TaskContext.get().partitionId(), [0] * (size + 1)
        for batch in batches:
            for begin, texts in bpe.slices(batch.column(1)):
                owner, cols, cut = [], [], []
                for i, t in enumerate(texts):
                    ids = np.append(encode(t), np.uint32(closing)).astype("<u4")
                    first = len(ids) % size or size
                    ends = range(first, len(ids) + 1, size)
                    for k, end in enumerate(ends):
                        start = end - (size if k else first)
                        cols.append((k, start, end - start, zlib.crc32(ids[start:end].tobytes()), met[end - start]))
                        met[end - start] += 1
                        owner.append(i)
                        if with_ids:
                            cut.append(ids[start:end].astype(np.int32))
                a = np.array(cols, np.int64).reshape(-1, 5)
                out = [batch.column(0).slice(begin, len(texts)).take(pa.array(owner, pa.int64())),
                       pa.array(a[:, 0].astype(np.int32)), *(pa.array(a[:, j]) for j in (1, 2, 3)),
                       pa.array(np.full(len(a), task, np.int32)), pa.array(a[:, 4])]
                yield pa.RecordBatch.from_arrays([*out, pa.array(cut, pa.list_(pa.int32()))] if with_ids else out,
                                                 [f.name for f in fields])

    return rows.mapInArrow(run, T.StructType(fields))


#: slacks beyond the least one that a plan may allow a bin; the plan with the fewest sequences is kept
ALLOWED = (0, 4, 16, 64)


def _fullest(lengths: list[int], count: dict[int, int], room: int, allowed: int = 0) -> dict[int, int]:
    """Of the combinations of the lengths (longest first) whose sum is at most ``room`` and
    at most ``allowed`` below the largest such sum, the one with the longest members, so
    that short ones stay for later bins."""
    reach, steps, mask = 1, [], (1 << (room + 1)) - 1
    for n in reversed(lengths):
        if n > room:
            break
        steps.append((n, reach))
        copies, left = 1, min(count[n], room // n)
        while left > 0:
            copies = min(copies, left)
            reach |= (reach << n * copies) & mask
            left -= copies
            copies *= 2
    high = reach.bit_length() - 1
    low, found = max(0, high - allowed), {}
    for n, shorter in reversed(steps):
        for k in range(min(count[n], high // n), 0, -1):
            least = max(0, low - k * n)
            if shorter >> least & ((1 << (high - k * n - least + 1)) - 1):
                found[n] = k
                low, high = least, high - k * n
                break
    return found


def _filled(histogram: dict[int, int], size: int, allowed: int) -> tuple[int, list[tuple[int, int, int, int, int, int]]]:
    count = {n: c for n, c in histogram.items() if c}
    used = dict.fromkeys(count, 0)
    lengths = sorted(count, reverse=True)
    rows, sequence = [], 0
    while lengths:
        longest = lengths[0]
        count[longest] -= 1
        found = _fullest([n for n in lengths if count[n]], count, size - longest, allowed)
        count[longest] += 1
        found[longest] = found.get(longest, 0) + 1
        times = min(count[n] // k for n, k in found.items())
        offset = 0
        for n in sorted(found, reverse=True):
            k = found[n]
            rows.append((n, used[n], used[n] + times * k, k, sequence, offset))
            offset += n * k
            used[n] += times * k
            count[n] -= times * k
        sequence += times
        lengths = [n for n in lengths if count[n]]
    return sequence, rows


def plan(histogram: dict[int, int], size: int) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, copies in a sequence, first sequence, first offset)."""
    least, best = -(-sum(n * c for n, c in histogram.items()) // size), (0, [])
    for allowed in ALLOWED:
        made = _filled(histogram, size, allowed)
        if allowed == ALLOWED[0] or made[0] < best[0]:
            best = made
        if best[0] == least:
            break
    return best[1]


def pack(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", size: int = 1024, closing: int = 2,
         with_ids: bool = False) -> DataFrame:
    """A place for every piece: key, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    made = stored(pieces(df, path, key, text, size, closing, with_ids), "pieces")
    spark = made.sparkSession
    counts = made.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    # at most ``size`` rows reach the driver
    histogram = {r.length: r.n for r in made.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = spark.createDataFrame(plan(histogram, size),
                                   "length long, low long, high long, copies long, first_sequence long, first_offset long")
    earlier = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    shift = counts.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    ranked = made.join(shift, ["task", "length"]).withColumn("rank", F.col("rank") + F.col("shift"))
    # the plan's size depends on ``size``, not on the documents
    placed = ranked.join(F.broadcast(places), "length").filter("rank >= low and rank < high")
    local = F.col("rank") - F.col("low")
    return placed.select(
        F.col("key").alias(key), "piece", "start", "length", "ids_crc32",
        (F.col("first_sequence") + F.expr("(rank - low) div copies")).alias("sequence_id"),
        (F.col("first_offset") + local % F.col("copies") * F.col("length")).alias("offset"),
        *(["ids"] if with_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids) of pieces packed ``with_ids``; a sequence holds at most ``size`` ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
