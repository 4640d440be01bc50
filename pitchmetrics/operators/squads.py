"""Match participants from nested match records: squads, minutes played, record fields.

Minutes follow three ordered writes per player, the last one wins: every squad
member 0, every lineup member 90, then each substitution of side 1 and then side 2
writes ``playerIn = 90 - minute`` and ``playerOut = minute``.  All writes become
rows of one table and a single ``max_by`` over the write order picks the last one,
so the operator is one shuffle on (match_id, player_id), with no join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions.columns import parse_count

_SQUAD_ENTRY = "struct<playerId:bigint,goals:string,ownGoals:string,yellowCards:string,redCards:string>"
_SUB_ENTRY = "struct<playerIn:bigint,playerOut:bigint,minute:int>"


def latest_matches(matches: DataFrame) -> DataFrame:
    """One record per match: the one with the largest ``arrival`` (a missing one counts
    as 0; of equal ones, the one with the larger hash of its label and winner)."""
    rest = [c for c in matches.columns if c not in ("match_id", "arrival")]
    arrival = F.coalesce(F.col("arrival"), F.lit(0)) if "arrival" in matches.columns else F.lit(0)
    tie = F.xxhash64(*[c for c in rest if c in ("label", "winner", "match_date", "duration", "venue", "gameweek")])
    return (matches.groupBy("match_id").agg(F.max_by(F.struct(*rest), F.struct(arrival.cast("bigint"), tie)).alias("r"))
            .select("match_id", *[F.col(f"r.{c}").alias(c) for c in rest]))


def match_sides(matches: DataFrame) -> DataFrame:
    """One row per (match, side) in document order: ``team_pos`` 0 and 1."""
    return (matches
            .select("match_id", "match_date",
                    F.posexplode(F.map_entries("teams_data")).alias("team_pos", "t"))
            .select("match_id", "match_date", F.col("team_pos").cast("int").alias("team_pos"),
                    F.col("t.key").alias("team_id"), F.col("t.value.formation").alias("f")))


def squad_entries(matches: DataFrame) -> DataFrame:
    """One row per squad entry (lineup then bench of each side), with its index in
    the side's squad list and the record fields parsed to INT ('null' counts 0)."""
    empty = F.array().cast(f"array<{_SQUAD_ENTRY}>")
    entries = F.concat(
        F.transform(F.coalesce("f.lineup", empty), lambda x: F.struct(x.alias("p"), F.lit(True).alias("lineup"))),
        F.transform(F.coalesce("f.bench", empty), lambda x: F.struct(x.alias("p"), F.lit(False).alias("lineup"))),
    )
    return (match_sides(matches)
            .select("match_id", "match_date", "team_pos", "team_id",
                    F.posexplode(entries).alias("squad_index", "s"))
            .select("match_id", "match_date", "team_pos", "team_id",
                    F.col("squad_index").cast("int").alias("squad_index"),
                    F.col("s.p.playerId").cast("string").alias("player_id"),
                    F.col("s.lineup").alias("in_lineup"),
                    *[F.coalesce(parse_count(f"s.p.{src}"), F.lit(0)).alias(dst) for src, dst in (
                        ("goals", "goals"), ("ownGoals", "own_goals"), ("yellowCards", "yellow_cards"),
                        ("redCards", "red_cards"))]))


def participants(matches: DataFrame, unique: bool = False) -> DataFrame:
    """One row per (match, player) named in a squad or a substitution of the latest
    record of the match; ``unique``: there is one record a match.

    Columns: match_id, match_date, team_pos, team_id, player_id, squad
    ('lineup' | 'bench' | 'sub_only'), squad_index, minutes_played, goals,
    own_goals, yellow_cards, red_cards (record fields from the first squad entry)."""
    matches = matches if unique else latest_matches(matches)
    squad = squad_entries(matches).select(
        "match_id", "match_date", "player_id", "team_pos", "team_id", "squad_index", "in_lineup",
        "goals", "own_goals", "yellow_cards", "red_cards",
        F.when(F.col("in_lineup"), C.FULL_MATCH_MINUTES).otherwise(0).cast("int").alias("minutes"),
        # write order: squad zeros (phase 0) < lineup nineties (phase 1) < substitutions (phase 2)
        F.struct(F.when(F.col("in_lineup"), 1).otherwise(0).alias("phase"), F.col("team_pos").alias("a"),
                 F.col("squad_index").alias("b"), F.lit(0).alias("c")).alias("w"),
    )
    empty_subs = F.array().cast(f"array<{_SUB_ENTRY}>")
    subs = (match_sides(matches)
            .select("match_id", "match_date", "team_pos", "team_id",
                    F.posexplode(F.coalesce("f.substitutions", empty_subs)).alias("sub_index", "s"))
            .select("match_id", "match_date", "team_pos", "team_id", "sub_index",
                    F.explode(F.array(
                        F.struct(F.col("s.playerIn").cast("string").alias("pid"),
                                 (F.lit(C.FULL_MATCH_MINUTES) - F.col("s.minute")).alias("m"), F.lit(0).alias("io")),
                        F.struct(F.col("s.playerOut").cast("string").alias("pid"),
                                 F.col("s.minute").alias("m"), F.lit(1).alias("io")),
                    )).alias("x"))
            .select("match_id", "match_date", F.col("x.pid").alias("player_id"), "team_pos", "team_id",
                    F.lit(None).cast("int").alias("squad_index"), F.lit(None).cast("boolean").alias("in_lineup"),
                    *[F.lit(None).cast("int").alias(c) for c in ("goals", "own_goals", "yellow_cards", "red_cards")],
                    F.col("x.m").cast("int").alias("minutes"),
                    F.struct(F.lit(2).alias("phase"), F.col("team_pos").alias("a"),
                             F.col("sub_index").cast("int").alias("b"), F.col("x.io").alias("c")).alias("w")))
    writes = squad.unionByName(subs).filter(F.col("player_id").isNotNull())
    # the first squad entry of a player (sub-only players: their first substitution)
    first = F.struct(F.col("w.phase") == 2, F.col("w.a"), F.col("w.b"), F.col("w.c"))
    info = F.struct("team_pos", "team_id", "squad_index", "goals", "own_goals", "yellow_cards", "red_cards")
    grouped = writes.groupBy("match_id", "player_id").agg(
        F.max("match_date").alias("match_date"),
        F.max_by("minutes", "w").alias("minutes_played"),
        F.min_by(info, first).alias("i"),
        F.max(F.col("in_lineup").cast("int")).alias("in_lineup"),
    )
    return grouped.select(
        "match_id", "match_date", F.col("i.team_pos").alias("team_pos"), F.col("i.team_id").alias("team_id"),
        "player_id",
        F.when(F.col("in_lineup") == 1, "lineup").when(F.col("in_lineup") == 0, "bench")
         .otherwise("sub_only").alias("squad"),
        F.col("i.squad_index").alias("squad_index"),
        "minutes_played",
        F.col("i.goals").alias("goals"), F.col("i.own_goals").alias("own_goals"),
        F.col("i.yellow_cards").alias("yellow_cards"), F.col("i.red_cards").alias("red_cards"),
    )
