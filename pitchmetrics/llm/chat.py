"""Chat formatting after collapsing cumulative snapshots.

Logs hold the same conversation again and again as it grows.  A turn is hashed with its
place to 128 bits and the exclusive or of a conversation's first hashes is its rolling
prefix hash.  Whole conversations are anti-joined with the proper prefixes of all
conversations; of equal conversations the one with the smallest id stays.  What remains
is rendered.

A conversation of any length is worked on in blocks of ``BLOCK`` turn numbers and
rendered in parts of ``PART`` turns, so that none is gathered in one task.

Defined cases: a null role or text is empty; a turn logged twice with equal content
counts once, with different content both stay, in the order of role and text; null turns
come first; rows without a conversation id are one conversation; gaps in the turn numbers
do not matter; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK, PART = 256, 64
OPEN, BETWEEN, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def _same(a: str, b: str) -> F.Column:
    return F.col(a).eqNullSafe(F.col(b))


def placed(df: DataFrame, conv: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Turns (conv, pos, role, text, x, y) with their place and hashes, and blocks
    (conv, block, n, last, shift)."""
    rows = df.select(F.col(conv).alias("conv"), F.col(turn).cast("bigint").alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                     F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).distinct()
    rows = rows.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62))))
    along = W.partitionBy("conv").orderBy("block")
    blocks = (rows.groupBy("conv", "block").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("shift", F.coalesce(F.sum("n").over(along.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
              .withColumn("last", F.lead("block").over(along).isNull()))
    nth = F.row_number().over(W.partitionBy("conv", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text"))
    b = blocks.select(F.col("conv").alias("c2"), F.col("block").alias("b2"), "n", "shift", "last")
    turns = (rows.withColumn("nth", nth).join(b, _same("conv", "c2") & (F.col("block") == F.col("b2")))
             .withColumn("pos", (F.col("shift") + F.col("nth") - 1).cast("bigint")))
    turns = (turns.withColumn("x", F.xxhash64("pos", "role", "text")).withColumn("y", F.xxhash64(F.lit("turn"), "pos", "role", "text"))
             .withColumn("final", F.col("last") & (F.col("nth") == F.col("n"))))
    return turns.select("conv", "block", "pos", "role", "text", "x", "y", "final"), blocks


def maximal(turns: DataFrame) -> DataFrame:
    """(conv, n_turns, copies) of the conversations that are kept."""
    hashes = turns.select("conv", "block", "pos", "x", "y", "final")
    totals = hashes.groupBy("conv", "block").agg(F.bit_xor("x").alias("bx"), F.bit_xor("y").alias("by"))
    before = W.partitionBy("conv").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    start = totals.select(F.col("conv").alias("c2"), F.col("block").alias("b2"), F.coalesce(F.bit_xor("bx").over(before), F.lit(0)).alias("sx"),
                          F.coalesce(F.bit_xor("by").over(before), F.lit(0)).alias("sy"))
    inside = W.partitionBy("conv", "block").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    rolled = (hashes.withColumn("rx", F.bit_xor("x").over(inside)).withColumn("ry", F.bit_xor("y").over(inside))
              .join(start, _same("conv", "c2") & (F.col("block") == F.col("b2")))
              .select("conv", (F.col("pos") + 1).alias("n_turns"), F.col("rx").bitwiseXOR(F.col("sx")).alias("px"),
                      F.col("ry").bitwiseXOR(F.col("sy")).alias("py"), "final"))
    whole = rolled.filter("final").groupBy("n_turns", "px", "py").agg(
        F.min(F.struct("conv")).alias("low"), F.count(F.lit(1)).alias("copies"))
    prefixes = rolled.filter("not final").select("n_turns", "px", "py").distinct()
    return whole.join(prefixes, ["n_turns", "px", "py"], "left_anti").select("low.conv", "n_turns", "copies")


def format_chats(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Per part of a kept conversation: conv, part, n_turns and copies of the whole
    conversation, part_turns, and the rendered ``chat``."""
    turns, _ = placed(df, conv, turn, role, text)
    kept = maximal(turns).withColumnRenamed("conv", "kept")
    segment = F.concat(F.lit(OPEN), F.col("role"), F.lit(BETWEEN), F.col("text"), F.lit(CLOSE))
    shown = (turns.select("conv", "pos", segment.alias("segment")).join(kept, _same("conv", "kept"))
             .groupBy("conv", F.floor(F.col("pos") / PART).alias("part"), "n_turns", "copies")
             .agg(F.sort_array(F.collect_list(F.struct("pos", "segment"))).alias("s")))
    return shown.select(F.col("conv").alias(conv), F.col("part").cast("bigint"), "n_turns", "copies",
                        F.size("s").cast("bigint").alias("part_turns"),
                        F.array_join(F.transform("s", lambda x: x["segment"]), "").alias("chat"))


def sql(source: str, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> str:
    """DuckDB SQL of :func:`format_chats` over ``source``; compares whole lists of turns."""
    nl = "chr(10)"
    return f"""
WITH t AS (SELECT DISTINCT {conv} AS c, {turn} AS n, coalesce({role}, '') AS r, coalesce({text}, '') AS x FROM {source}),
p AS (SELECT c, r, x, row_number() OVER (PARTITION BY c ORDER BY n NULLS FIRST, r, x) - 1 AS pos FROM t),
l AS (SELECT c, list({{'r': r, 'x': x}} ORDER BY pos) AS turns, count(*) AS n FROM p GROUP BY c),
u AS (SELECT turns, n, min(c) AS c, count(*) AS copies FROM l GROUP BY turns, n),
k AS (SELECT u.c, u.n, u.copies FROM u WHERE NOT EXISTS (
        SELECT 1 FROM l AS o WHERE o.n > u.n AND o.turns[1] = u.turns[1] AND o.turns[1:u.n] = u.turns))
SELECT p.c AS {conv}, p.pos // {PART} AS part, k.n AS n_turns, k.copies, count(*) AS part_turns,
       string_agg('{OPEN}' || p.r || {nl} || p.x || '<|im_end|>' || {nl}, '' ORDER BY p.pos) AS chat
FROM p JOIN k ON p.c = k.c GROUP BY ALL"""
