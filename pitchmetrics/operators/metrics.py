"""Per-match player metrics: pass accuracy, duel, free-kick and shot effectiveness,
fouls, own goals, shots on target and goals.

Split in two steps so the same counts serve batch, micro-batch and streaming use:

* :func:`metric_counts` — conditional counts per key.  Every column is a sum, so the
  aggregate is algebraic: Spark runs a partial (map-side) aggregate before the
  shuffle, a hot key costs one row per map task, and counts of disjoint event sets
  (micro-batches) add up to the counts of their union.
* :func:`metrics_from_counts` — the ratios, a projection on the counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions.columns import count_if, has_bit, is_tagged, ratio, tag_mask
from .events import TAG_BITS, player_events


def has_tag(tag_id: int) -> Column:
    """Tag membership from the per-event ``tag_bits`` column (see :func:`with_tag_bits`)."""
    return has_bit("tag_bits", TAG_BITS[tag_id])


def with_tag_bits(events: DataFrame) -> DataFrame:
    """Adds ``tag_bits``: the metric tags of each event, found in one pass."""
    return events.withColumn("tag_bits", tag_mask(TAG_BITS))


COUNT_COLUMNS = (
    "n_pass_events", "n_key_accurate", "n_key_inaccurate", "n_accurate", "n_inaccurate",
    "n_duel_events", "n_duels_won", "n_duels_neutral", "n_duels_lost",
    "n_free_kick_events", "n_free_kicks_effective", "n_free_kicks_not_effective", "n_penalties_scored",
    "n_shot_events", "n_shot_goals", "n_shots_on_target_no_goal", "n_shots_off_target",
    "n_fouls", "n_own_goals",
)

METRIC_COLUMNS = (
    "pass_accuracy", "duel_effectiveness", "free_kick_effectiveness", "shot_effectiveness",
    "number_of_fouls", "number_of_own_goals", "no_of_shots_on_target", "number_of_goals",
)


def _pass_kind() -> tuple[Column, Column, Column, Column]:
    """The four pass outcomes; the first matching one wins (key+accurate, key+inaccurate,
    accurate, inaccurate), so an event with both 1801 and 1802 counts as accurate."""
    key, acc, inacc = has_tag(C.TAG_KEY_PASS), has_tag(C.TAG_ACCURATE), has_tag(C.TAG_NOT_ACCURATE)
    return key & acc, key & ~acc & inacc, ~key & acc, ~key & ~acc & inacc


def pass_weights() -> tuple[Column, Column]:
    """Numerator and denominator weight of one tagged pass event (key passes weigh 2)."""
    ka, ki, a, i = _pass_kind()
    num = F.when(ka, 2).when(a, 1).otherwise(0)
    den = F.when(ka | ki, 2).when(a | i, 1).otherwise(0)
    return num.cast("bigint"), den.cast("bigint")


def metric_counts(events: DataFrame, keys: Sequence[str] = ("match_id", "player_id"), also: Sequence[Column] = ()) -> DataFrame:
    """Conditional counts per key over real-player events, and the aggregates ``also``.  Tag-based counts need a
    non-empty tag list; fouls count every foul event; own goals any tagged event."""
    ev = with_tag_bits(player_events(events))
    e = F.col("event_id")
    tagged = is_tagged()
    passes, duels = tagged & (e == C.EVENT_PASS), tagged & (e == C.EVENT_DUEL)
    kicks, shots = tagged & (e == C.EVENT_FREE_KICK), tagged & (e == C.EVENT_SHOT)
    penalty = F.coalesce(F.col("sub_event_id") == C.SUB_EVENT_PENALTY, F.lit(False))
    goal, acc, inacc = has_tag(C.TAG_GOAL), has_tag(C.TAG_ACCURATE), has_tag(C.TAG_NOT_ACCURATE)
    ka, ki, a, i = _pass_kind()
    return ev.groupBy(*keys).agg(
        count_if(passes).alias("n_pass_events"),
        count_if(passes & ka).alias("n_key_accurate"),
        count_if(passes & ki).alias("n_key_inaccurate"),
        count_if(passes & a).alias("n_accurate"),
        count_if(passes & i).alias("n_inaccurate"),
        count_if(duels).alias("n_duel_events"),
        count_if(duels & has_tag(C.TAG_DUEL_WON)).alias("n_duels_won"),
        count_if(duels & has_tag(C.TAG_DUEL_NEUTRAL)).alias("n_duels_neutral"),
        count_if(duels & has_tag(C.TAG_DUEL_LOST)).alias("n_duels_lost"),
        count_if(kicks).alias("n_free_kick_events"),
        # an accurate free kick that is not a penalty is counted twice (kept as is)
        F.sum(F.when(kicks & acc, F.when(penalty, 1).otherwise(2)).otherwise(0)).cast("bigint")
        .alias("n_free_kicks_effective"),
        count_if(kicks & inacc).alias("n_free_kicks_not_effective"),
        count_if(kicks & acc & penalty & goal).alias("n_penalties_scored"),
        count_if(shots).alias("n_shot_events"),
        # the goal test does not look at 1801 (kept as is)
        count_if(shots & goal).alias("n_shot_goals"),
        count_if(shots & acc & ~goal).alias("n_shots_on_target_no_goal"),
        count_if(shots & inacc).alias("n_shots_off_target"),
        count_if(e == C.EVENT_FOUL).alias("n_fouls"),
        count_if(tagged & has_tag(C.TAG_OWN_GOAL)).alias("n_own_goals"),
        *also,
    )


def sum_counts(counts: DataFrame, keys: Sequence[str] = ("match_id", "player_id")) -> DataFrame:
    """Re-aggregates partial counts (for example one row per micro-batch) per key."""
    return counts.groupBy(*keys).agg(*[F.sum(c).cast("bigint").alias(c) for c in COUNT_COLUMNS])


def pass_accuracy_of(c: DataFrame | None = None) -> Column:
    num = F.col("n_key_accurate") * 2 + F.col("n_accurate")
    den = (F.col("n_key_accurate") + F.col("n_key_inaccurate")) * 2 + F.col("n_accurate") + F.col("n_inaccurate")
    return ratio(num, den)


def duel_effectiveness_of() -> Column:
    won, neutral, lost = F.col("n_duels_won"), F.col("n_duels_neutral"), F.col("n_duels_lost")
    return ratio(won + neutral * F.lit(0.5), won + neutral + lost)


def free_kick_effectiveness_of() -> Column:
    eff, pens = F.col("n_free_kicks_effective"), F.col("n_penalties_scored")
    return ratio(eff + pens, eff + F.col("n_free_kicks_not_effective"))


def shot_effectiveness_of() -> Column:
    goal, ontng, off = F.col("n_shot_goals"), F.col("n_shots_on_target_no_goal"), F.col("n_shots_off_target")
    return ratio(goal + ontng * F.lit(0.5), goal + ontng + off)


def metrics_from_counts(counts: DataFrame, keys: Sequence[str] = ("match_id", "player_id")) -> DataFrame:
    """The metric record per key; a metric without events of its kind is 0, and so
    is a ratio whose denominator is 0 (the source raised there)."""
    return counts.select(
        *keys,
        pass_accuracy_of().alias("pass_accuracy"),
        duel_effectiveness_of().alias("duel_effectiveness"),
        free_kick_effectiveness_of().alias("free_kick_effectiveness"),
        shot_effectiveness_of().alias("shot_effectiveness"),
        F.col("n_fouls").alias("number_of_fouls"),
        F.col("n_own_goals").alias("number_of_own_goals"),
        (F.col("n_shot_goals") + F.col("n_shots_on_target_no_goal")).alias("no_of_shots_on_target"),
        (F.col("n_shot_goals") + F.col("n_penalties_scored")).alias("number_of_goals"),
    )


def match_metrics(events: DataFrame) -> DataFrame:
    """One metric record per (match, player) with at least one real-player event."""
    return metrics_from_counts(metric_counts(events))


# --- whole-stream pass accuracy ------------------------------------------------------

SEGMENT = ("t", "wn", "wd", "rn", "rd")


def pass_segments(events: DataFrame, bucket_width: int = 4096) -> DataFrame:
    """Running-sum states of the tagged passes, one per (match, player, bucket of seq): the
    number of passes t, the sums of their weights wn and wd, and the sums rn and rd of
    weight times rank, ranks counted inside the bucket.  The width bounds a window."""
    ev = with_tag_bits(player_events(events).filter(is_tagged() & (F.col("event_id") == C.EVENT_PASS)))
    num, den = pass_weights()
    ev = ev.select("match_id", "player_id", "seq", num.alias("wn"), den.alias("wd"),
                   F.floor(F.col("seq") / bucket_width).cast("bigint").alias("bucket"))
    local_rank = F.row_number().over(Window.partitionBy("match_id", "player_id", "bucket").orderBy("seq"))
    return (ev.withColumn("lr", local_rank.cast("bigint"))
            .groupBy("match_id", "player_id", "bucket")
            .agg(F.count(F.lit(1)).cast("bigint").alias("t"),
                 F.sum("wn").cast("bigint").alias("wn"), F.sum("wd").cast("bigint").alias("wd"),
                 F.sum(F.col("wn") * F.col("lr")).cast("bigint").alias("rn"),
                 F.sum(F.col("wd") * F.col("lr")).cast("bigint").alias("rd")))


def merge_pass_segments(segments: DataFrame, bucket: str = "bucket", keys: Sequence[str] = ("match_id", "player_id")) -> DataFrame:
    """The state of each key's passes from states of segments that follow each other in the
    order of ``bucket``.  Segment A before B merges to t = tA + tB, w = wA + wB and
    r = rA + rB + tA * wB, as B's ranks move up by A's passes; so any cut gives the same."""
    earlier = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    shifted = segments.withColumn("before", F.coalesce(F.sum("t").over(earlier), F.lit(0)).cast("bigint"))
    return shifted.groupBy(*keys).agg(
        F.sum("t").cast("bigint").alias("t"), F.sum("wn").cast("bigint").alias("wn"), F.sum("wd").cast("bigint").alias("wd"),
        F.sum(F.col("rn") + F.col("wn") * F.col("before")).cast("bigint").alias("rn"),
        F.sum(F.col("rd") + F.col("wd") * F.col("before")).cast("bigint").alias("rd"))


def stream_pass_sums(events: DataFrame, bucket_width: int = 4096) -> DataFrame:
    """Per (match, player): the sums of the *running* pass numerator and denominator
    over the match's tagged passes, i.e. sum_t N_t where N_t is the running total
    after the t-th pass.  With T passes and pass i at rank r_i this equals
    (T + 1) * sum(w) - sum(w * r).

    Skew-safe: windows are bounded by ``bucket_width``; a match's few segments are merged
    after.  All arithmetic is on BIGINT, so the result is exact."""
    whole = merge_pass_segments(pass_segments(events, bucket_width))
    return whole.select("match_id", "player_id",
                        ((F.col("t") + 1) * F.col("wn") - F.col("rn")).alias("running_numerator"),
                        ((F.col("t") + 1) * F.col("wd") - F.col("rd")).alias("running_denominator"))


def stream_pass_totals(sums: DataFrame) -> DataFrame:
    """(player_id, numerator, denominator) over all matches of ``sums``."""
    return sums.groupBy("player_id").agg(F.sum("running_numerator").cast("bigint").alias("numerator"),
                                         F.sum("running_denominator").cast("bigint").alias("denominator"))


def stream_pass_accuracy(events: DataFrame) -> DataFrame:
    """Whole-stream pass accuracy per player: sum of running numerators over sum of
    running denominators across all matches (0 when the denominator is 0).  Not
    restricted to match participants."""
    return with_pass_accuracy(stream_pass_totals(stream_pass_sums(events)))


def with_pass_accuracy(totals: DataFrame) -> DataFrame:
    return totals.withColumn("pass_accuracy", ratio(F.col("numerator"), F.col("denominator")))
