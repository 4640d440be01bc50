"""Sharding by balanced label propagation, with as many rows in every shard.

Documents are linked by equal texts.  Linked documents start dealt evenly over the
shards; in each round, the documents of a group move towards the shard that holds most of
their neighbours (of the shards with room, while there is room for one in twenty), under quotas: between two
shards as many may change sides as want to in both directions, and a shard with room
takes as many more as it has room for.  A group whose larger part sits in a full shard follows its smaller part if all of it
fits there.  Documents of one group in one shard are alike, so a round works on the counts of a
group in each shard instead of on links.  Documents without links then fill the shards to
their exact sizes.

Counts, flows and quotas are small tables of shards; ranks inside groups and shards are
salted running totals, so no group or shard is gathered in one task.

Defined cases: a null text is the empty text with size 1; repeated rows are documents of
their own with equal texts; null keys are kept; with fewer documents than shards some
shards stay empty; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import running_total, salts_for, stored, text_or_empty

#: at most so many rounds; they end earlier when two in a row move nothing
ROUNDS = 12


def _quotas(wants: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], int]:
    """How many may move from one shard to another: swaps, and what the room admits."""
    allowed = {st: min(n, wants.get(st[::-1], 0)) for st, n in wants.items()}
    for t, free in enumerate(room):
        rest = {st: n - allowed[st] for st, n in wants.items() if st[1] == t and n > allowed[st]}
        for st, n in sorted(rest.items(), key=lambda x: -x[1]):
            more = min(n, free)
            allowed[st] += more
            free -= more
    return {st: n for st, n in allowed.items() if n}


def _propagate(groups: DataFrame, capacity: list[int], rounds: int, salts: int) -> DataFrame:
    """groups: _g, _h and ``c``, the array of its documents in each shard."""
    spark, shards = groups.sparkSession, len(capacity)
    now = groups.checkpoint()
    still = 0
    for _ in range(rounds):
        sums = now.agg(*[F.coalesce(F.sum(F.col("c")[j]), F.lit(0)).alias(str(j)) for j in range(shards)]).first()
        room = [capacity[j] - sums[j] for j in range(shards)]
        roomy = (sum(room) * 20 > sum(sums)) != (still == 1)
        open_ = [j for j in range(shards) if not roomy or room[j] > 0] or list(range(shards))
        best = F.array_max(F.array(*[F.struct(F.col("c")[j].alias("n"), F.xxhash64("_g", "_h", F.lit(j)).alias("p"), F.lit(j).alias("t"),
                                              F.lit(room[j]).alias("room")) for j in open_]))
        whole = sum((F.col("c")[j] for j in range(shards)), F.lit(0))
        aimed = now.withColumn("best", best).withColumn("whole", whole)
        moves = aimed.select("_g", "_h", "best.t", "best.room", F.col("best.n").alias("most"), "whole", F.posexplode("c").alias("s", "n"))
        # a larger part leaves a full shard only if its group then is in one shard
        moves = (moves.filter("n > 0 and s <> t and (n <= most or whole <= room)")
                 .select("_g", "_h", "s", "t", "n").checkpoint())
        # at most shards x shards rows
        wants = {(r.s, r.t): r.n for r in moves.groupBy("s", "t").agg(F.sum("n").alias("n")).collect()}
        allowed = _quotas(wants, room)
        still = 0 if allowed else still + 1
        if still == 2:
            break
        if not allowed:
            continue
        quota = spark.createDataFrame([(s, t, n) for (s, t), n in allowed.items()], "s int, t int, quota long")
        ranked = running_total(moves.join(F.broadcast(quota), ["s", "t"]), ["s", "t"], ["_g", "_h"], "n", "before", salts, ["_g", "_h"])
        taken = (ranked.withColumn("m", F.least("n", F.greatest(F.col("quota") - F.col("before"), F.lit(0)))).filter("m > 0")
                 .select("_g", "_h", F.explode(F.array(F.struct(F.col("s").alias("j"), (-F.col("m")).alias("d")),
                                                       F.struct(F.col("t").alias("j"), F.col("m").alias("d")))).alias("x")))
        change = taken.groupBy("_g", "_h").agg(F.array(*[F.coalesce(F.sum(F.when(F.col("x.j") == j, F.col("x.d"))), F.lit(0))
                                                         for j in range(shards)]).alias("d"))
        now = (now.join(change, ["_g", "_h"], "left")
               .select("_g", "_h", F.coalesce(F.zip_with("c", "d", lambda a, b: a + b), F.col("c")).alias("c")).checkpoint())
    return now


def _filled(rank: str, counts: list) -> F.Column:
    """The shard of a rank when shard 0 takes the first counts[0] ranks, and so on."""
    upto, shard = F.lit(0).cast("bigint"), F.lit(len(counts) - 1)
    cases = []
    for j, n in enumerate(counts):
        upto = upto + n
        cases.append((F.col(rank) < upto, j))
    for when, j in reversed(cases):
        shard = F.when(when, F.lit(j)).otherwise(shard)
    return shard.cast("int")


def shard(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 8, rounds: int = ROUNDS) -> DataFrame:
    """Per document: key, size, text_crc32, shard, slot, and its group's size ``copies``."""
    t = text_or_empty(text)
    base = stored(docs.select(F.col(key).alias("_key"), (F.octet_length(t) + 1).cast("bigint").alias("size"), F.crc32(t).alias("text_crc32"),
                              F.xxhash64(t).alias("_g"), F.xxhash64(F.lit("group"), t).alias("_h"))
                  .withColumn("_id", F.monotonically_increasing_id()), "sizes")
    groups = base.groupBy("_g", "_h").agg(F.count(F.lit(1)).alias("copies"))
    # the counts of all and of linked documents
    total = groups.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("n"),
                       F.coalesce(F.sum(F.when(F.col("copies") > 1, F.col("copies"))), F.lit(0)).alias("linked")).first()
    salts = salts_for(total.n)
    capacity = [total.n // shards + (j < total.n % shards) for j in range(shards)]
    grouped = stored(base.join(groups, ["_g", "_h"]).withColumn("_linked", F.col("copies") > 1).withColumn("_one", F.lit(1)), "groups")
    linked = running_total(grouped.filter("_linked"), ["_linked"], ["_id"], "_one", "_rank", salts, ["_id"])
    start = linked.groupBy("_g", "_h").agg(F.array(*[F.sum((F.col("_rank") % shards == j).cast("bigint")) for j in range(shards)]).alias("c"))
    placed = _propagate(start, capacity, rounds, salts)
    held = placed.agg(*[F.coalesce(F.sum(F.col("c")[j]), F.lit(0)).alias(str(j)) for j in range(shards)]).first()
    ranked = running_total(grouped.filter("_linked"), ["_g", "_h"], ["_id"], "_one", "_rank", salts, ["_id"]).join(placed, ["_g", "_h"])
    columns = ["_key", "size", "text_crc32", "copies", "_id"]
    together = ranked.select(*columns, _filled("_rank", [F.col("c")[j] for j in range(shards)]).alias("shard"))
    alone = running_total(grouped.filter(~F.col("_linked")), ["_linked"], ["_id"], "_one", "_rank", salts, ["_id"])
    alone = alone.select(*columns, _filled("_rank", [F.lit(capacity[j] - held[j]) for j in range(shards)]).alias("shard"))
    both = stored(together.unionByName(alone).withColumn("_one", F.lit(1)), "placed")
    out = running_total(both, ["shard"], ["_id"], "_one", "slot", salts, ["_id"])
    return out.select(F.col("_key").alias(key), "size", "text_crc32", "shard", "slot", "copies")
