"""Match-level outputs: winner label, goal / own-goal / card lists, detail records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes as C
from .squads import latest_matches, squad_entries


def winner_label(matches: DataFrame, teams: DataFrame) -> DataFrame:
    """``matches`` with winner as a label: 'DRAW' for winner id '0', else the winning
    team's name (NULL for an unknown team id; the row is kept)."""
    t = teams.select(F.col("team_id").alias("winner"), F.col("name").alias("winner_name"))
    label = F.when(F.col("winner") == C.DRAW_TEAM_ID, F.lit(C.DRAW_LABEL)).otherwise(F.col("winner_name"))
    return matches.join(t, "winner", "left").withColumn("winner", label).drop("winner_name")


def _entries_named(matches: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """Squad entries that appear in some list (a goal, own goal or card), with names.
    The filter runs before the name joins: most squad entries have none."""
    listed = ((F.col("goals") > 0) | (F.col("own_goals") > 0) | (F.col("yellow_cards") > 0)
              | (F.col("red_cards") > 0))
    return (squad_entries(matches).filter(listed)
            .join(players.select("player_id", F.col("name").alias("player_name")), "player_id", "left")
            .join(teams.select("team_id", F.col("name").alias("team_name")), "team_id", "left"))


def match_event_lists(matches: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """Per match, in squad order (side 1 lineup+bench, then side 2): goals and own goals
    as (player_name, team_name, number_of_goals), yellow and red cards as names.
    Each list is bounded by the match squads."""
    e = _entries_named(matches, players, teams)
    order = [F.col("team_pos"), F.col("squad_index")]

    def scored(col: str):
        item = F.struct(*order, F.col("player_name"), F.col("team_name"), F.col(col).alias("number_of_goals"))
        return F.transform(F.sort_array(F.collect_list(F.when(F.col(col) > 0, item))),
                           lambda x: F.struct(x["player_name"].alias("player_name"),
                                              x["team_name"].alias("team_name"),
                                              x["number_of_goals"].alias("number_of_goals")))

    def named(col: str):
        item = F.struct(*order, F.col("player_name"))
        return F.transform(F.sort_array(F.collect_list(F.when(F.col(col) > 0, item))),
                           lambda x: x["player_name"])

    return e.groupBy("match_id").agg(
        scored("goals").alias("goals"), scored("own_goals").alias("own_goals"),
        named("yellow_cards").alias("yellow_cards"), named("red_cards").alias("red_cards"))


def match_details(matches: DataFrame, players: DataFrame, teams: DataFrame) -> DataFrame:
    """One detail record per match: label, date, duration, winner, venue, gameweek,
    goals, own_goals, yellow_cards, red_cards.  The latest record of a match counts."""
    matches = latest_matches(matches)
    base = matches.select("match_id", "label", F.col("match_date").alias("date"), "duration", "winner",
                          "venue", "gameweek")
    scored = "array<struct<player_name:string,team_name:string,number_of_goals:int>>"
    empty = {"goals": scored, "own_goals": scored, "yellow_cards": "array<string>", "red_cards": "array<string>"}
    return (winner_label(base, teams)
            .join(match_event_lists(matches, players, teams), "match_id", "left")
            .select("match_id", "label", "date", "duration", "winner", "venue", "gameweek",
                    *[F.coalesce(F.col(c), F.array().cast(t)).alias(c) for c, t in empty.items()]))


def match_summary(participants: DataFrame, matches: DataFrame, teams: DataFrame) -> DataFrame:
    """Per match: winner label and the sums of the squad record fields."""
    sums = participants.groupBy("match_id").agg(
        *[F.sum(F.coalesce(F.col(c), F.lit(0))).cast("bigint").alias(f"total_{c}")
          for c in ("goals", "own_goals", "yellow_cards", "red_cards")])
    return winner_label(latest_matches(matches).select("match_id", "winner"), teams).join(sums, "match_id", "left")
