"""Writers for the derived tables.  Parquet is canonical; the JSON exports keep the
nested key structs of the source's files (rating key (player_id, date), chemistry
pair (player_id_1, player_id_2)).  All writes overwrite, so a rerun is idempotent."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None,
                mode: str = "overwrite") -> None:
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_player_totals(totals: DataFrame, path: str, fmt: str = "json") -> None:
    write_table(totals, path, fmt)


def rating_export(ratings: DataFrame) -> DataFrame:
    return ratings.select(F.struct("player_id", F.date_format("match_date", "yyyy-MM-dd").alias("date")).alias("key"),
                          "match_id", "rating")


def chemistry_export(chemistry: DataFrame) -> DataFrame:
    return chemistry.select(F.struct("player_id_1", "player_id_2").alias("pair"), "chemistry")


def write_ratings(ratings: DataFrame, path: str) -> None:
    write_table(rating_export(ratings), path, "json")


def write_chemistry(chemistry: DataFrame, path: str) -> None:
    write_table(chemistry_export(chemistry), path, "json")


def write_match_details(details: DataFrame, path: str, fmt: str = "json") -> None:
    """One record per match, partitioned by match date."""
    write_table(details, path, fmt, partition_by=["date"])


def write_results(results: DataFrame, path: str, fmt: str = "json") -> None:
    """Request answers keyed by request_id."""
    write_table(results, path, fmt)
