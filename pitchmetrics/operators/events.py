"""Event-level operators: system-player filter, tag flags, type dispatch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes as C
from ..functions.columns import count_if, has_bit, is_tagged, tag_mask

# Tag ids that any metric reads, in natural order.
METRIC_TAGS = (C.TAG_GOAL, C.TAG_OWN_GOAL, C.TAG_KEY_PASS, C.TAG_DUEL_LOST,
               C.TAG_DUEL_NEUTRAL, C.TAG_DUEL_WON, C.TAG_ACCURATE, C.TAG_NOT_ACCURATE)


def player_events(events: DataFrame) -> DataFrame:
    """Events that belong to a real player: drops the system player '0' and empty ids.

    A plain filter on the scan, so Catalyst pushes it to the parquet reader; the id stands
    in it once (a null one is no match either), as a computed id is computed again each time."""
    return events.filter(~F.col("player_id").isin(C.SYSTEM_PLAYER_ID, ""))


# one bit per metric tag, in the order of METRIC_TAGS
TAG_BITS = {t: 1 << i for i, t in enumerate(METRIC_TAGS)}


def with_tag_flags(events: DataFrame) -> DataFrame:
    """Adds ``tagged`` and one boolean ``has_<id>`` column per metric tag (the tag
    array is scanned once, into a bit mask)."""
    ev = events.withColumn("_tag_bits", tag_mask(TAG_BITS))
    cols = [is_tagged().alias("tagged")] + [has_bit("_tag_bits", b).alias(f"has_{t}") for t, b in TAG_BITS.items()]
    return ev.select("*", *cols).drop("_tag_bits")


def tag_membership(events: DataFrame) -> DataFrame:
    """Per real-player event: number of tags and 0/1 membership of every metric tag."""
    ev = with_tag_flags(player_events(events))
    return ev.select(
        "match_id", "seq", "player_id", "event_id",
        F.coalesce(F.size("tags"), F.lit(0)).cast("bigint").alias("n_tags"),
        *[F.col(f"has_{t}").cast("int").alias(f"has_{t}") for t in METRIC_TAGS],
    )


def event_type_counts(events: DataFrame) -> DataFrame:
    """Per (match, player): events of each metric type (dispatch on event id)."""
    ev = player_events(events)
    e = F.col("event_id")
    return ev.groupBy("match_id", "player_id").agg(
        count_if(e == C.EVENT_PASS).alias("n_passes"),
        count_if(e == C.EVENT_DUEL).alias("n_duels"),
        count_if(e == C.EVENT_FREE_KICK).alias("n_free_kicks"),
        count_if(e == C.EVENT_FOUL).alias("n_fouls"),
        count_if(e == C.EVENT_SHOT).alias("n_shots"),
        count_if(~e.isin(C.EVENT_PASS, C.EVENT_DUEL, C.EVENT_FREE_KICK, C.EVENT_FOUL, C.EVENT_SHOT)
                 | e.isNull()).alias("n_other"),
        F.count(F.lit(1)).cast("bigint").alias("n_events"),
    )
