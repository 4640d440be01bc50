"""Exact top-k search in 64-bit binary codes by incremental multi-index hashing.

Codes are cut into m segments, each with an index from segment value to code.  A step
looks up all values of one segment at exactly one more bit of distance, verifies what it
finds by the whole Hamming distance, and keeps the k best of each query.  When segments
0..s have been searched to radius r and the others to r - 1, every code within m * r + s
bits has been found; a query ends once that many bits hold its k-th result, so its answer
is exact.

Codes that repeat are searched once, with the smallest ids of each, of which no more than
k + 1 can be in an answer.  Hot segment values are split by the skew handling of
the join; the best of a query are cut down per task before they meet.

Defined cases: rows without an id or a code have no place in the index or among the
queries; repeated rows (equal id and code) count once; a query does not find itself, but
finds other codes under its own id; equal distances are in the order of ids and then codes; a
table of k rows or fewer gives all others; an empty one gives nothing.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored

#: radius up to which a step has all segments
TOGETHER = 3


def sign_code(vector: str, bits: int = 64) -> Column:
    """Bit i: component i is over zero (null and NaN are not); null for a null vector."""
    code = F.lit(0).cast("bigint")
    for i in range(bits):
        v = F.get(F.col(vector), F.lit(i))
        code = code.bitwiseOR(F.when((v > 0) & ~F.isnan(v), F.shiftleft(F.lit(1).cast("bigint"), i)).otherwise(F.lit(0).cast("bigint")))
    return F.when(F.col(vector).isNotNull(), code)


def _segments(rows: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the segments: at most about log2(rows) bits each."""
    m = max(2, min(16, math.ceil(64 / max(4.0, math.log2(max(rows, 2))))))
    cut = [64 * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cut, cut[1:], strict=False)]


def _value(code: str, begin: int, bits: int) -> Column:
    return F.shiftrightunsigned(F.col(code), begin).bitwiseAND(F.lit((1 << bits) - 1))


def top_k(queries: DataFrame, rows: DataFrame, k: int = 10, id_col: str = "id", code: str = "code") -> DataFrame:
    """(query_id, query_code, rank, id, code, distance): the k nearest rows of each query."""
    spark = rows.sparkSession
    found_cols = [F.col(id_col).alias("id"), F.col(code).cast("bigint").alias("code")]
    every = rows.select(*found_cols).dropna().distinct()
    first = W.partitionBy("code").orderBy("id")
    ids = stored(every.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= k + 1), "ids")
    codes = stored(ids.groupBy("code").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n")), "codes")
    asked = stored(queries.select(*found_cols).dropna().distinct(), "queries")
    size = codes.agg(F.count(F.lit(1)).alias("codes"), F.coalesce(F.sum("n"), F.lit(0)).alias("ids")).first()
    parts = _segments(size.codes)
    index = stored(codes.select("code", "low", "n", F.explode(F.array(*[
        F.struct(F.lit(s).alias("seg"), _value("code", a, b).alias("val")) for s, (a, b) in enumerate(parts)])).alias("x"))
        .select("x.seg", "x.val", "code", "low", "n"), "index")
    best = W.partitionBy("q").orderBy("d", "low", "code")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    open_ = asked.select(F.col("code").alias("q")).distinct().withColumn("bound", F.lit(64)).repartition(tasks, "q").checkpoint()
    state = spark.createDataFrame([], "q long, code long, low long, n long, d int").select(
        "q", "code", F.col("low").cast(codes.schema["low"].dataType), "n", "d")
    everywhere = list(range(len(parts)))
    steps = []
    for radius in range(max(b for _, b in parts) + 1):
        steps += [(radius, everywhere)] if radius <= TOGETHER else [(radius, [s]) for s in everywhere]
    for radius, segments in steps:
        if open_.isEmpty():
            break
        probes = None
        for s in segments:
            begin, bits = parts[s]
            # C(bits, radius) masks; bits is about log2 of the number of codes
            flips = [sum(1 << i for i in c) for c in combinations(range(bits), radius)]
            if not flips:
                continue
            array = F.split(F.lit(",".join(map(str, flips))), ",").cast("array<bigint>")  # folded into one literal
            part = (open_.withColumn("flip", F.explode(array))
                    .select("q", "bound", F.lit(s).alias("s"), _value("q", begin, bits).bitwiseXOR(F.col("flip")).alias("v")))
            probes = part if probes is None else probes.unionByName(part)
        if probes is not None:
            # Spark's estimate does not see how many probes a query has: no broadcast.  What is
            # farther than the last of a full answer cannot enter it
            d = F.bit_count(F.col("q").bitwiseXOR(F.col("code")))
            met = (probes.hint("merge").join(index, (F.col("s") == F.col("seg")) & (F.col("v") == F.col("val")) & (d <= F.col("bound")))
                   .select("q", "code", "low", "n", d.alias("d")))
            # a code is found through several segments: once for a query
            fresh = met.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= (k + 1) * len(segments)).drop("nth")
            both = fresh.unionByName(state).distinct()
            state = both.withColumn("nth", F.row_number().over(best)).filter(F.col("nth") <= k + 1).drop("nth").checkpoint()
        covered = len(parts) * radius + segments[-1]
        near = state.groupBy("q").agg(F.sum(F.when(F.col("d") <= covered, F.col("n")).otherwise(0)).alias("sure"), F.sum("n").alias("all"),
                                      F.when(F.count(F.lit(1)) > k, F.max("d")).otherwise(64).alias("last"))
        ended = (F.col("sure") > k) | (F.col("all") >= size.ids) | F.lit(covered >= 64)
        open_ = (open_.select("q").join(near, "q", "left").filter(~F.coalesce(ended, F.lit(False)))
                 .select("q", F.coalesce("last", F.lit(64)).alias("bound")).repartition(tasks, "q").checkpoint())
    hits = state.select("q", "code", "d").join(ids.select("id", "code"), "code")
    pairs = asked.select(F.col("id").alias("query_id"), F.col("code").alias("q")).join(hits, "q")
    pairs = pairs.filter((F.col("query_id") != F.col("id")) | (F.col("q") != F.col("code")))
    rank = F.row_number().over(W.partitionBy("query_id", "q").orderBy("d", "id", "code"))
    return (pairs.withColumn("rank", rank).filter(F.col("rank") <= k)
            .select("query_id", F.col("q").alias("query_code"), "rank", "id", "code", F.col("d").cast("int").alias("distance")))


def sql(source: str, key: str = "vec_id", vector: str = "embedding", every: int = 20, k: int = 10) -> str:
    """DuckDB SQL: the k nearest by sign code for each row whose key ``every`` divides."""
    bit = f"CASE WHEN {vector}[i + 1] > 0 AND NOT isnan({vector}[i + 1]) THEN 1::UBIGINT << i ELSE 0::UBIGINT END"
    return f"""
WITH c AS (SELECT DISTINCT {key} AS id, list_sum(list_transform(range(64), lambda i: ({bit})::HUGEINT))::UBIGINT AS code
           FROM {source} WHERE {vector} IS NOT NULL AND {key} IS NOT NULL),
r AS (SELECT q.id AS query_id, v.id AS {key}, bit_count(xor(q.code, v.code))::INT AS distance,
             row_number() OVER (PARTITION BY q.id, q.code ORDER BY bit_count(xor(q.code, v.code)), v.id, v.code) AS rank
      FROM c AS q JOIN c AS v ON q.id % {every} = 0 AND (q.id <> v.id OR q.code <> v.code))
SELECT query_id, rank::INT AS rank, {key}, distance FROM r WHERE rank <= {k}"""
