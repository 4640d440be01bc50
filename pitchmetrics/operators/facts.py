"""Match facts: participants joined with their metrics, contribution and performance,
and career totals derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes as C
from .metrics import METRIC_COLUMNS


def contribution(minutes: str = "minutes_played") -> F.Column:
    """(pass + duel + free kick + shots on target) / 4, times 1.05 for exactly 90
    minutes, times minutes/90 otherwise, 0 for 0 minutes."""
    s = (F.col("pass_accuracy") + F.col("duel_effectiveness") + F.col("free_kick_effectiveness")
         + F.col("no_of_shots_on_target"))
    m = F.col(minutes)
    return (F.when(m == C.FULL_MATCH_MINUTES, F.lit(C.FULL_MATCH_BONUS) * s / 4)
            .when(m != 0, m / F.lit(C.FULL_MATCH_MINUTES) * s / 4)
            .otherwise(F.lit(0.0)))


def performance() -> F.Column:
    return (F.col("player_contribution") - F.lit(C.FOUL_PENALTY) * F.col("number_of_fouls")
            - F.lit(C.OWN_GOAL_PENALTY) * F.col("number_of_own_goals"))


def match_facts(participants: DataFrame, metrics: DataFrame) -> DataFrame:
    """participants ⟕ metrics on (match_id, player_id); a participant without events
    gets zero metrics.  Events of players outside the squads drop out here.

    Both inputs come out of aggregates hash-partitioned on (match_id, player_id),
    so the join reuses that partitioning instead of shuffling again."""
    zeros = {c: 0 for c in METRIC_COLUMNS}
    joined = participants.join(metrics, ["match_id", "player_id"], "left").na.fill(zeros)
    return (joined
            .withColumn("player_contribution", contribution())
            .withColumn("player_performance", performance()))


def match_counts(players: DataFrame, facts: DataFrame) -> DataFrame:
    """(player_id, number_of_matches): matches with minutes > 0, 0 for players who
    never played.  The part of the career totals the forecast path needs; it reads
    facts only (no second pass over the events)."""
    n = facts.groupBy("player_id").agg(
        F.sum(F.when(F.col("minutes_played") > 0, 1).otherwise(0)).cast("bigint").alias("number_of_matches"))
    return (players.select("player_id").join(n, "player_id", "left")
            .na.fill({"number_of_matches": 0}))


def career_sums(facts: DataFrame) -> DataFrame:
    """Per player of ``facts``: fouls, goals, own goals, shots on target, matches with
    minutes > 0; sums of disjoint sets of matches add up."""
    return facts.groupBy("player_id").agg(
        F.sum("number_of_fouls").cast("bigint").alias("number_of_fouls"),
        F.sum("number_of_goals").cast("bigint").alias("number_of_goals"),
        F.sum("number_of_own_goals").cast("bigint").alias("number_of_own_goals"),
        F.sum("no_of_shots_on_target").cast("bigint").alias("number_of_shots_on_target"),
        F.sum(F.when(F.col("minutes_played") > 0, 1).otherwise(0)).cast("bigint").alias("number_of_matches"),
    )


def totals_from_sums(players: DataFrame, sums: DataFrame, pass_accuracy: DataFrame) -> DataFrame:
    """Career totals of every player, with zeros for those who never played."""
    pa = pass_accuracy.select("player_id", "pass_accuracy")
    out = (players.join(sums, "player_id", "left").join(pa, "player_id", "left")
           .na.fill({"number_of_fouls": 0, "number_of_goals": 0, "number_of_own_goals": 0,
                     "number_of_shots_on_target": 0, "number_of_matches": 0, "pass_accuracy": 0.0}))
    return out.select(
        "player_id", "name", "role", "foot", "birth_date", "birth_area", "passport_area", "height", "weight",
        "number_of_fouls", "number_of_goals", "number_of_own_goals", "number_of_matches",
        "number_of_shots_on_target", "pass_accuracy")


def player_totals(players: DataFrame, facts: DataFrame, pass_accuracy: DataFrame) -> DataFrame:
    """Career totals per player plus the whole-stream pass accuracy; every player is kept.
    One partial+final aggregate on player_id."""
    return totals_from_sums(players, career_sums(facts), pass_accuracy)
