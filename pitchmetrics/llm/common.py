"""Helpers the operators share: shared-folder tables, salted running totals, components.

Tables that cut lineage go to the cluster's ``spark.checkpoint.dir`` (see
``pitchmetrics.session.checkpoint_dir``), which the driver and all executors see.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: rows a salted group is dealt to one task in
SALT_ROWS = 2_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as a Parquet table in the shared folder and reads it back."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def salts_for(rows: int) -> int:
    return max(8, -(-rows // SALT_ROWS))


def running_total(df: DataFrame, keys: list[str], order: list[str], value: str, out: str, salts: int,
                  salt_on: list[str]) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of the same ``keys`` that come
    before, where rows come in the order of a salt and then of ``order``.  A key of any
    size is dealt over ``salts`` windows; only keys x salts subtotals meet in one window."""
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*salt_on), F.lit(salts)).cast("int"))
    before = (salted.groupBy(*keys, "_salt").agg(F.sum(value).alias("_sum"))
              .withColumn("_before", F.coalesce(F.sum("_sum").over(
                  W.partitionBy(*keys).orderBy("_salt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
              .drop("_sum"))
    inside = W.partitionBy(*keys, "_salt").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (salted.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(before, [*keys, "_salt"])
            .withColumn(out, (F.col("_before") + F.col("_inside")).cast("bigint"))
            .drop("_salt", "_before", "_inside"))


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable over ``links`` (a, b).

    Alternating large and small stars: every round is a join and an aggregate on the
    links, whose number never grows.  The last round's links are stars on the
    smallest node.  Raises if ``rounds`` do not suffice (a chain of 2^rounds nodes)."""
    def undirected(e: DataFrame) -> DataFrame:
        return e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    edges = links.select("a", "b").filter("a <> b").distinct().checkpoint()
    seen = None
    for _ in range(rounds):
        both = undirected(edges)
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        joined = down.join(low, "a")
        edges = (joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct().checkpoint())
        state = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    lows = edges.groupBy("a").agg(F.min("b").alias("component"))
    roots = edges.select(F.col("b").alias("a")).distinct().join(lows.select("a"), "a", "left_anti")
    return (lows.select(F.col("a").alias("node"), "component")
            .unionByName(roots.select(F.col("a").alias("node"), F.col("a").alias("component"))))
