"""The corpus pipeline: toxicity, line dedup, SimHash near-dedup, best-fit packing.

A stage is (name, function); the function takes (spark, docs, sf_dir) and returns what the
next one gets.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchmetrics.llm import linededup, packing, queries, simhash, toxicity
from pitchmetrics.llm.common import stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is under the threshold of their language; the model learns
    from the labels of the documents that are there."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).filter(~F.col("toxic")).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines of windows that came before; n_chars follows."""
    cleaned = linededup.dedup_lines(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast("bigint")).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each SimHash group: that of the smallest key, rows without a key last; of
    equal keys, that of the smallest hash of the text, and one of equal rows."""
    # the ids of rows are fixed once they are written
    rows = stored(docs.withColumn("row", F.monotonically_increasing_id()), "rows")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), "row").alias("order")
    groups = simhash.near_duplicates(rows.select(order, "text"), key="order")
    gone = groups.filter("order.row <> component_id.row").select("order.row")
    return rows.join(gone, "row", "left_anti").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A place in a training sequence for every piece."""
    return packing.pack(docs, queries.VOCABULARY)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("simhash_dedup", drop_near_copies),
          ("best_fit_packing", pack)]

#: the trained model and the tokenizer have no SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
