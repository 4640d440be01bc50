"""The record stream: text lines holding one JSON object each, of two kinds.

A *match* record has the key ``status``; an *event* record has ``eventId``.  Each
line is parsed once with ``from_json`` against the superset schema (PERMISSIVE:
a malformed line gives a NULL struct and is kept, tagged 'corrupt'), then split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import schemas
from ..functions.columns import match_date_of


CORRUPT = "_corrupt_record"
_PARSE_SCHEMA = StructType(schemas.STREAM_RECORD.fields + [StructField(CORRUPT, StringType())])


def parse_records(lines: DataFrame, value_col: str = "value") -> DataFrame:
    """(value, r, kind): kind is 'match', 'event', 'corrupt' (not JSON) or 'other'."""
    r = F.from_json(F.col(value_col), _PARSE_SCHEMA,
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    parsed = lines.select(F.col(value_col).alias("value"), r.alias("r"))
    kind = (F.when(F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull(), "corrupt")
            .when(F.col("r.status").isNotNull(), "match")
            .when(F.col("r.eventId").isNotNull(), "event")
            .otherwise("other"))
    return parsed.withColumn("kind", kind)


def event_columns() -> list[Column]:
    """The fields of a canonical event from a parsed line (ids as text, as the source has them)."""
    return [F.col("r.matchId").cast("string").alias("match_id"),
            F.col("r.seq").alias("seq"),
            F.col("r.playerId").cast("string").alias("player_id"),
            F.col("r.eventId").alias("event_id"),
            F.col("r.subEventId").alias("sub_event_id"),
            F.coalesce(F.col("r.tags"), F.array().cast(schemas.TAGS)).alias("tags")]


def match_columns() -> list[Column]:
    """The fields of a canonical match record from a parsed line; the date is the first 10
    characters of ``dateutc``, NULL where they are no date."""
    return [F.col("r.wyId").cast("string").alias("match_id"),
            F.col("r.label").alias("label"),
            match_date_of("r.dateutc").alias("match_date"),
            F.col("r.duration").alias("duration"),
            F.col("r.winner").cast("string").alias("winner"),
            F.col("r.venue").alias("venue"),
            F.col("r.gameweek").alias("gameweek"),
            F.col("r.teamsData").alias("teams_data"),
            F.coalesce("r.arrival", F.lit(0)).cast("bigint").alias("arrival")]


def events_from_records(parsed: DataFrame) -> DataFrame:
    """Canonical events from parsed records."""
    return parsed.filter(F.col("kind") == "event").select(*event_columns())


def matches_from_records(parsed: DataFrame) -> DataFrame:
    """Canonical match records from parsed records."""
    return parsed.filter(F.col("kind") == "match").select(*match_columns())


def read_records(spark, path: str) -> DataFrame:
    """Batch read of record files (one JSON object per line)."""
    return spark.read.text(path)
