"""Pair chemistry: 0.5 plus, over every match two players shared a squad (lineup or
bench of either side), a signed |(Δ1 + Δ2) / 2| of their rating changes: plus when
team-mates' changes agree in sign, minus when they disagree; reversed for opponents.

The sum is order-free, so one grouped sum is exact.  Pairs are formed inside a
match only: an equi-join on match_id with ``p1 < p2`` — the pair table is the
output itself, and each match contributes at most squad² / 2 rows (a football
squad is bounded; AQE's skew-join split handles an oversized one).  The grouped
sum runs partial aggregation before the shuffle on (p1, p2); the reverse
direction is added after aggregation, so every pair is joined and summed once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes as C


def match_pair_steps(ratings: DataFrame) -> DataFrame:
    """(match_id, player_id_1 < player_id_2, step) for every pair in a match squad.
    ``ratings`` carry squad and team_pos of their fact rows, so nothing is joined back."""
    squad = (ratings.filter(F.col("squad").isin("lineup", "bench"))
             .select("match_id", "player_id", "team_pos", F.col("change_in_rating").alias("d")))
    a, b = squad.alias("a"), squad.alias("b")
    pairs = a.join(b, (F.col("a.match_id") == F.col("b.match_id"))
                   & (F.col("a.player_id") < F.col("b.player_id")))
    d1, d2 = F.col("a.d"), F.col("b.d")
    magnitude = F.abs((d1 + d2) / 2)
    agree = (d1 >= 0) == (d2 >= 0)
    same_side = F.col("a.team_pos") == F.col("b.team_pos")
    step = F.when(same_side == agree, magnitude).otherwise(-magnitude)
    return pairs.select(F.col("a.match_id").alias("match_id"), F.col("a.player_id").alias("player_id_1"),
                        F.col("b.player_id").alias("player_id_2"), step.alias("step"))


def pair_sums(steps: DataFrame) -> DataFrame:
    """(player_id_1 < player_id_2, steps): sums of a pair's steps; sums of disjoint sets of
    matches add up to the sum of their union."""
    return steps.groupBy("player_id_1", "player_id_2").agg(F.sum("step").alias("steps"))


def chemistry_from_sums(sums: DataFrame, initial: float = C.INITIAL_CHEMISTRY) -> DataFrame:
    """(player_id_1, player_id_2, chemistry), both directions of every pair."""
    both = F.explode(F.array(
        F.struct(F.col("player_id_1").alias("p1"), F.col("player_id_2").alias("p2")),
        F.struct(F.col("player_id_2").alias("p1"), F.col("player_id_1").alias("p2"))))
    return (sums.select(both.alias("e"), (F.lit(initial) + F.col("steps")).alias("chemistry"))
            .select(F.col("e.p1").alias("player_id_1"), F.col("e.p2").alias("player_id_2"), "chemistry"))


def player_chemistry(ratings: DataFrame, initial: float = C.INITIAL_CHEMISTRY) -> DataFrame:
    """(player_id_1, player_id_2, chemistry), both directions of every pair."""
    return chemistry_from_sums(pair_sums(match_pair_steps(ratings)), initial)


def group_chemistry(groups: DataFrame, chemistry: DataFrame, group_col: str = "prediction") -> DataFrame:
    """Mean chemistry of the pairs whose first player belongs to each group
    (groups: player_id -> group).  One partial+final aggregate for all groups."""
    per_player = (chemistry.groupBy(F.col("player_id_1").alias("player_id"))
                  .agg(F.sum("chemistry").alias("s"), F.count("chemistry").alias("n")))
    sums = (groups.select("player_id", group_col).join(per_player, "player_id")
            .groupBy(group_col).agg(F.sum("s").alias("s"), F.sum("n").cast("bigint").alias("n_pairs")))
    return sums.select(group_col, (F.col("s") / F.col("n_pairs")).alias("avg_chemistry"), "n_pairs")
