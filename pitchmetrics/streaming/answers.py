"""Requests as a stream (S13, Q1-Q4): each micro-batch of request lines is joined with the
stored tables of job 1, and its answers are written under its batch id.

A micro-batch is answered by the operators that answer a table of requests, so the answers
do not depend on how the lines are cut into batches; a batch that is replayed after a failure
overwrites its own answers.  A request that comes again in a later batch is answered again;
:func:`stored_answers` gives the last answer of each request.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans import jobs
from ..sources.requests import requests_from_lines

KINDS = ("profiles", "matches", "forecasts", "rejected")


def answer_batch(tables: str, players: DataFrame, teams: DataFrame, out: str, group_col: str = "prediction"):
    """The ``foreachBatch`` function: answers of the batch's requests into the folder ``out``."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        path = f"{out}/requests/batch_id={batch_id}"
        requests_from_lines(batch).write.mode("overwrite").parquet(path)
        season = jobs.stored_season(spark, tables, players, teams, spark.read.parquet(path))
        for kind, answers in jobs.answer_requests(season, group_col).items():
            answers.write.mode("overwrite").parquet(f"{out}/{kind}/batch_id={batch_id}")

    return run


def start_answers(lines: DataFrame, tables: str, players: DataFrame, teams: DataFrame, out: str, checkpoint_location: str,
                  *, group_col: str = "prediction", **trigger) -> StreamingQuery:
    """Starts answering ``lines`` (a stream of request documents, column ``value``) from the
    tables that :func:`pitchmetrics.plans.jobs.build_season_tables` wrote."""
    return (lines.writeStream.foreachBatch(answer_batch(tables, players, teams, out, group_col))
            .option("checkpointLocation", checkpoint_location).trigger(**trigger).start())


def stored_answers(spark: SparkSession, out: str, kind: str) -> DataFrame:
    """The last answer of each request of a kind."""
    rows = spark.read.parquet(f"{out}/{kind}")
    rest = [c for c in rows.columns if c not in ("request_id", "batch_id")]
    return (rows.groupBy("request_id").agg(F.max_by(F.struct(*rest), "batch_id").alias("a"))
            .select("request_id", *[F.col(f"a.{c}").alias(c) for c in rest]))
