"""Dimension files and stored tables, always read with a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import parse_count, parse_date


def read_players_csv(spark: SparkSession, path: str) -> DataFrame:
    """players.csv (header, every column text) -> canonical players; a malformed birth
    date or number is NULL."""
    raw = spark.read.schema(schemas.PLAYERS_CSV).option("header", True).csv(path)
    return raw.select(
        F.col("Id").alias("player_id"), "name", "role", "foot",
        parse_date("birthDate").alias("birth_date"),
        F.col("birthArea").alias("birth_area"), F.col("passportArea").alias("passport_area"),
        parse_count("height").alias("height"), parse_count("weight").alias("weight"))


def read_teams_csv(spark: SparkSession, path: str) -> DataFrame:
    """teams.csv (header) -> (team_id, name)."""
    raw = spark.read.schema(schemas.TEAMS_CSV).option("header", True).csv(path)
    return raw.select(F.col("Id").alias("team_id"), "name")


def read_table(spark: SparkSession, path: str, schema=None, fmt: str = "parquet") -> DataFrame:
    """A stored table (parquet by default; JSON for exports), with a declared schema
    when given so nothing is inferred."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


SENTINEL_DATE = "0000-00-00"   # fixed value: date key of the initial rating in imported histories


def read_rating_export(spark: SparkSession, path: str) -> DataFrame:
    """Rating history as exported with a nested key struct -> flat columns.  Rows keyed
    by the sentinel date (an initial rating stored as a row) are dropped: the initial
    rating is the fold's start value, not a match."""
    df = spark.read.json(path, schema="key struct<player_id:string,date:string>, match_id string, rating double")
    return (df.filter(F.col("key.date") != SENTINEL_DATE)
            .select(F.col("key.player_id").alias("player_id"), parse_date("key.date").alias("match_date"),
                    "match_id", "rating"))


def read_chemistry_export(spark: SparkSession, path: str) -> DataFrame:
    """Chemistry exported with a nested pair struct -> flat columns."""
    df = spark.read.json(path, schema="pair struct<player_id_1:string,player_id_2:string>, chemistry double")
    return df.select("pair.player_id_1", "pair.player_id_2", "chemistry")
