"""Declared schemas: stream records, dimension files, requests, canonical tables.

Nothing is inferred at read time: every source is read with one of these.
"""

from pyspark.sql.types import (
    ArrayType, DateType, DoubleType, IntegerType, LongType, MapType, StringType,
    StructField, StructType,
)

TAG = StructType([StructField("id", IntegerType())])
TAGS = ArrayType(TAG)

# One squad entry of a match record; counts may arrive quoted and as "null".
SQUAD_PLAYER = StructType([
    StructField("playerId", LongType()),
    StructField("goals", StringType()),
    StructField("ownGoals", StringType()),
    StructField("yellowCards", StringType()),
    StructField("redCards", StringType()),
])
SUBSTITUTION = StructType([
    StructField("playerIn", LongType()),
    StructField("playerOut", LongType()),
    StructField("minute", IntegerType()),
])
FORMATION = StructType([
    StructField("lineup", ArrayType(SQUAD_PLAYER)),
    StructField("bench", ArrayType(SQUAD_PLAYER)),
    StructField("substitutions", ArrayType(SUBSTITUTION)),
])
TEAM_DATA = StructType([StructField("formation", FORMATION)])
TEAMS_DATA = MapType(StringType(), TEAM_DATA)

# Superset of both record kinds on the stream: a match record has ``status``,
# an event record has ``eventId``.  ``matchId`` and ``seq`` key and order events.
STREAM_RECORD = StructType([
    # match record
    StructField("status", StringType()),
    StructField("wyId", LongType()),
    StructField("label", StringType()),
    StructField("dateutc", StringType()),
    StructField("duration", StringType()),
    StructField("winner", LongType()),
    StructField("venue", StringType()),
    StructField("gameweek", IntegerType()),
    StructField("teamsData", TEAMS_DATA),
    StructField("arrival", LongType()),   # order of the records of one match; added by us
    # event record
    StructField("eventId", IntegerType()),
    StructField("subEventId", IntegerType()),
    StructField("playerId", LongType()),
    StructField("matchId", LongType()),
    StructField("seq", LongType()),
    StructField("tags", TAGS),
])

# Canonical events: one row per in-match event.
EVENTS = StructType([
    StructField("match_id", StringType()),
    StructField("seq", LongType()),
    StructField("player_id", StringType()),
    StructField("event_id", IntegerType()),
    StructField("sub_event_id", IntegerType()),
    StructField("tags", TAGS),
])

# Canonical matches: one row per match record (nested squads kept as they came).
MATCHES = StructType([
    StructField("match_id", StringType()),
    StructField("label", StringType()),
    StructField("match_date", DateType()),
    StructField("duration", StringType()),
    StructField("winner", StringType()),
    StructField("venue", StringType()),
    StructField("gameweek", IntegerType()),
    StructField("teams_data", TEAMS_DATA),
])
# Match records as they arrive: of those of one match the largest ``arrival`` counts.
MATCH_RECORDS = StructType(MATCHES.fields + [StructField("arrival", LongType())])

# Dimension files: CSV with a header, every column read as text, then typed.
PLAYERS_CSV = StructType([StructField(n, StringType()) for n in (
    "Id", "name", "role", "foot", "birthDate", "birthArea", "passportArea", "height", "weight")])
TEAMS_CSV = StructType([StructField("Id", StringType()), StructField("name", StringType())])

PLAYERS = StructType([
    StructField("player_id", StringType()),
    StructField("name", StringType()),
    StructField("role", StringType()),
    StructField("foot", StringType()),
    StructField("birth_date", DateType()),
    StructField("birth_area", StringType()),
    StructField("passport_area", StringType()),
    StructField("height", IntegerType()),
    StructField("weight", IntegerType()),
])
TEAMS = StructType([StructField("team_id", StringType()), StructField("name", StringType())])

# Requests, one JSON document per line (req_type 1 forecast, 2 profile, none: match).
REQUEST_RECORD = StructType([
    StructField("request_id", LongType()),
    StructField("req_type", IntegerType()),
    StructField("name", StringType()),
    StructField("label", StringType()),
    StructField("date", StringType()),
    StructField("team1", MapType(StringType(), StringType())),
    StructField("team2", MapType(StringType(), StringType())),
])
REQUESTS = StructType([
    StructField("request_id", LongType()),
    StructField("request_kind", StringType()),
    StructField("name", StringType()),
    StructField("label", StringType()),
    StructField("date", DateType()),
    StructField("team1", MapType(StringType(), StringType())),
    StructField("team2", MapType(StringType(), StringType())),
])

RATINGS = StructType([
    StructField("player_id", StringType()),
    StructField("match_date", DateType()),
    StructField("match_id", StringType()),
    StructField("old_rating", DoubleType()),
    StructField("rating", DoubleType()),
    StructField("change_in_rating", DoubleType()),
])
