"""Rating history: r0 = 0.5 and r_n = (r_{n-1} + performance_n) / 2 per player, in
(match_date, match_id) order (ids compare as text), for every participant.

A window partitioned by player would put a hot player's whole history into one task,
and Spark has no ordered-fold window.  Instead a player's matches are cut into fixed
blocks of ``BLOCK_DAYS`` days, whose ids depend on the data only:

1. a block's matches become one sorted list (a few days of one player), whose fold from
   0 is the block's end; a block takes a start x to x * 2^-n + end;
2. the (block, n, end) of a player, one per ``BLOCK_DAYS`` days of the season, are folded
   into the start of each block;
3. each block is folded again from its start, which gives its rows.

All folds are built-in JVM expressions over lists bounded by the calendar.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes as C

BLOCK_DAYS = 16


def _fold(items: str, start: Column, carry: tuple[str, ...]) -> Column:
    """The rows of a sorted block: old and new rating of each match."""
    row = ("struct<match_date:date,match_id:string,"
           + "".join(f"{c}:string," for c in carry) + "old_rating:double,rating:double>")
    init = F.struct(start.alias("x"), F.array().cast(f"array<{row}>").alias("rows"))

    def step(acc: Column, item: Column) -> Column:
        new = (acc["x"] + item["perf"]) / 2
        made = F.struct(item["match_date"].alias("match_date"), item["match_id"].alias("match_id"),
                        *[item[c].alias(c) for c in carry], acc["x"].alias("old_rating"), new.alias("rating"))
        return F.struct(new.alias("x"), F.array_append(acc["rows"], made).alias("rows"))

    return F.aggregate(items, init, step)["rows"]


def rating_history(facts: DataFrame, initial: float = C.INITIAL_RATING, block_days: int = BLOCK_DAYS,
                   carry: tuple[str, ...] = (), base: DataFrame | None = None) -> DataFrame:
    """(player_id, match_date, match_id, old_rating, rating, change_in_rating), one row
    per fact row, and the fact columns named in ``carry`` as text.  ``facts`` needs
    player_id, match_date, match_id, player_performance.  ``base`` (player_id, rating):
    players whose history goes on from that rating instead of ``initial``."""
    block = F.floor(F.datediff("match_date", F.lit("1970-01-01").cast("date")) / block_days).cast("bigint")
    item = F.struct("match_date", "match_id", *[F.col(c).cast("string").alias(c) for c in carry],
                    F.col("player_performance").cast("double").alias("perf"))
    blocks = (facts.select("player_id", F.coalesce(block, F.lit(-1)).alias("block"), item.alias("item"))
              .groupBy("player_id", "block").agg(F.sort_array(F.collect_list("item")).alias("items")))
    end = F.aggregate("items", F.lit(0.0).cast("double"), lambda acc, x: (acc + x["perf"]) / 2)
    chains = (blocks.select("player_id", F.struct("block", F.size("items").alias("n"), end.alias("end")).alias("b"))
              .groupBy("player_id").agg(F.sort_array(F.collect_list("b")).alias("chain")))
    chains = chains.withColumn("initial", F.lit(float(initial)))
    if base is not None:
        chains = (chains.join(base.select("player_id", F.col("rating").alias("reached")), "player_id", "left")
                  .withColumn("initial", F.coalesce("reached", "initial")))
    start = F.struct(F.col("initial").alias("x"), F.array().cast("array<struct<block:bigint,x:double>>").alias("starts"))

    def step(acc: Column, b: Column) -> Column:
        return F.struct((acc["x"] * F.pow(F.lit(2.0), -b["n"].cast("double")) + b["end"]).alias("x"),
                        F.array_append(acc["starts"], F.struct(b["block"].alias("block"), acc["x"].alias("x"))).alias("starts"))

    starts = (chains.select("player_id", F.explode(F.aggregate("chain", start, step)["starts"]).alias("s"))
              .select("player_id", "s.block", "s.x"))
    rows = (blocks.join(starts, ["player_id", "block"])
            .select("player_id", F.explode(_fold("items", F.col("x"), carry)).alias("r")))
    return rows.select("player_id", "r.match_date", "r.match_id", *[f"r.{c}" for c in carry], "r.old_rating", "r.rating",
                       (F.col("r.rating") - F.col("r.old_rating")).alias("change_in_rating"))
