"""The two jobs of the application, as Spark jobs over tables.

* :func:`build_season_tables` — after ingestion (or from any events + matches),
  writes match facts, ratings, chemistry, player totals, stream pass accuracy, match
  details, and the k-means model (its centres and every player's cluster).  Facts are written first and read back, so the later tables
  start from a written table (lineage cut, executor loss costs one stage).
* :func:`answer_requests` — reads a batch of requests and answers all of them
  with joins against the stored tables: profiles, match details, forecasts.  No model
  is fitted there: clusters are the stored ones.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..operators import requests as _requests
from ..sinks import writers
from .season import Season

TABLES = ("match_facts", "ratings", "chemistry", "player_totals", "stream_pass_accuracy", "match_details",
          "cluster_centres", "clusters")


def build_season_tables(season: Season, out_dir: str) -> dict[str, str]:
    spark = season.events.sparkSession
    paths = {t: os.path.join(out_dir, t) for t in TABLES}
    writers.write_table(season.match_facts, paths["match_facts"], partition_by=["match_date"])
    season.__dict__["match_facts"] = spark.read.parquet(paths["match_facts"])
    writers.write_table(season.ratings, paths["ratings"])
    season.__dict__["ratings"] = spark.read.parquet(paths["ratings"])
    for t in ("chemistry", "stream_pass_accuracy", "player_totals", "match_details", "cluster_centres", "clusters"):
        writers.write_table(getattr(season, t), paths[t])
        season.__dict__[t] = spark.read.parquet(paths[t])
    return paths


def stored_season(spark: SparkSession, tables_dir: str, players: DataFrame, teams: DataFrame,
                  requests: DataFrame | None = None) -> Season:
    """A Season whose derived tables are the stored ones (no recomputation)."""
    s = Season(events=None, matches=None, players=players, teams=teams, requests=requests)
    for t in TABLES:
        s.__dict__[t] = spark.read.parquet(os.path.join(tables_dir, t))
    return s


def answer_requests(season: Season, group_col: str = "prediction", legacy: bool = False) -> dict[str, DataFrame]:
    """All answers for the season's requests table, one DataFrame per request kind,
    each keyed by request_id.  The number of Spark jobs does not depend on the
    number of requests."""
    return {
        "profiles": season.profiles,
        "matches": season.match_lookups,
        "forecasts": season.forecasts(group_col, legacy=legacy),
        "rejected": _requests.rejected_requests(season.requests),
    }


def write_answers(answers: dict[str, DataFrame], out_dir: str) -> None:
    for kind, df in answers.items():
        writers.write_results(df, os.path.join(out_dir, kind))
