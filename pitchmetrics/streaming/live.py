"""Operators on streams (T3, T4).

* :func:`live_metrics` — per-match running metrics as a native streaming aggregate
  (``groupBy(match_id, player_id)`` of the same algebraic counts as the batch
  operator, state in the state store), refreshed at every micro-batch in
  ``update`` mode.
* :func:`live_ratings` — the rating recurrence over a stream of match facts, corrected when
  facts come late, again, or are taken back.  Keyed state holds a player's matches in
  blocks of days and of each block its chain link (matches n, fold from 0): a block takes
  a start x to x * 2^-n + end, so a change refolds the blocks from its own on, and what is
  emitted are the rows from the changed match on.

The ingest keeps both for its open matches without a stream of their own (:mod:`.views`).
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions import codes as C
from ..operators.metrics import metric_counts, metrics_from_counts
from ..operators.ratings import BLOCK_DAYS

RATING_OUT = "player_id string, match_date date, match_id string, old_rating double, rating double, " \
             "change_in_rating double"
RATING_STATE = "history string"
KEYS = ("match_id", "player_id")


def live_metrics(events: DataFrame, event_time: str | None = None, lateness: str = "6 hours",
                 match_length: str = "1 day") -> DataFrame:
    """Streaming (or batch) per-(match, player) metrics; use output mode 'update'.

    With ``event_time`` (a timestamp column of ``events``) a match's counts belong to the
    ``match_length`` window it is played in and leave the state ``lateness`` after it; the
    result then has the window's start as ``window_start``.  Without it the state of every
    match stays, which suits a run over a bounded season only."""
    if event_time is None:
        return metrics_from_counts(metric_counts(events))
    timed = events.withWatermark(event_time, lateness).withColumn("window", F.window(event_time, match_length))
    counted = metric_counts(timed, keys=(*KEYS, "window"))
    start = F.col("window.start").alias("window_start")
    return metrics_from_counts(counted, keys=(*KEYS, "window")).select("*", start).drop("window")


class History:
    """A player's matches: blocks of [day, match id, performance, version], sorted, and the
    chain link [n, end] of each.  A performance of None marks a match that was taken back."""

    def __init__(self, text: str | None = None, block_days: int = BLOCK_DAYS) -> None:
        blocks, links = json.loads(text) if text else ({}, {})
        self.blocks: dict[int, list[list]] = {int(b): rows for b, rows in blocks.items()}
        self.links: dict[int, list] = {int(b): link for b, link in links.items()}
        self.block_days = block_days

    def text(self) -> str:
        return json.dumps([self.blocks, self.links])

    def change(self, facts: Iterable[tuple[int, str, float | None, int]]) -> list[tuple[int, str, float | None, float | None]]:
        """Takes in (day, match id, performance, version) and gives the rows (day, match id,
        old rating, rating) that are new or may have changed, in order; the ratings of a match
        taken back are None.  A fact older than what is known of its match changes nothing."""
        at = {row[1]: b for b, rows in self.blocks.items() for row in rows}
        first, dirty, gone = None, set(), []
        for day, match, perf, version in sorted(facts, key=lambda f: f[3]):
            block = day // self.block_days
            known = next(r for r in self.blocks[at[match]] if r[1] == match) if match in at else None
            if known and (known[3] > version or known[:3] == [day, match, perf]):
                known[3] = max(known[3], version)
                continue
            if known:
                self.blocks[at[match]].remove(known)
                dirty.add(at[match])
                first = min(first or (known[0], match), (known[0], match))
            self.blocks.setdefault(block, []).append([day, match, perf, version])
            at[match] = block
            dirty.add(block)
            first = min(first or (day, match), (day, match))
            if perf is None and known:
                gone.append((day, match, None, None))
        if first is None:
            return []
        for b in dirty:
            self.blocks[b].sort(key=lambda r: (r[0], r[1]))
            n, end = 0, 0.0
            for _, _, perf, _ in self.blocks[b]:
                if perf is not None:
                    n, end = n + 1, (end + perf) / 2
            self.links[b] = [n, end]
        return gone + self._rows_from(first)

    def _rows_from(self, first: tuple[int, str]) -> list[tuple[int, str, float, float]]:
        x, out = C.INITIAL_RATING, []
        for b in sorted(self.blocks):
            if b < first[0] // self.block_days:
                n, end = self.links[b]
                x = x * 2.0 ** -n + end
                continue
            for day, match, perf, _ in self.blocks[b]:
                if perf is not None:
                    old, x = x, (x + perf) / 2
                    if (day, match) >= first:
                        out.append((day, match, old, x))
        return out


_EPOCH = dt.date(1970, 1, 1)


def _fold_state(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    history = History(state.get[0] if state.exists else None)
    facts = []
    for pdf in pdfs:
        for date, match, perf, removed, version in zip(pdf["match_date"], pdf["match_id"], pdf["player_performance"], pdf["removed"],
                                                       pdf["version"], strict=True):
            facts.append(((date - _EPOCH).days, match, None if removed else float(perf), int(version)))
    rows = history.change(facts)
    state.update((history.text(),))
    out = pd.DataFrame(rows, columns=["day", "match_id", "old_rating", "rating"]).astype({"old_rating": "float64", "rating": "float64"})
    yield pd.DataFrame({
        "player_id": [key[0]] * len(out), "match_date": [_EPOCH + dt.timedelta(days=int(d)) for d in out["day"]],
        "match_id": out["match_id"], "old_rating": out["old_rating"], "rating": out["rating"],
        "change_in_rating": out["rating"] - out["old_rating"]})


def live_ratings(facts: DataFrame, mode: str = "append") -> DataFrame:
    """The log of a player's rating rows from a stream of match facts: of the rows of one
    (player_id, match_id) the last one counts (:func:`current_ratings`), one without a
    rating takes the match back.

    ``facts`` may come late, in any order and again; ``version`` (a column of ``facts``, 0
    where there is none) tells which of a match's facts counts, the later one of equal
    versions; ``removed`` (false where there is none) takes a player's match back.  Facts
    without a date, match or player are left out.  ``mode``: the query's output mode."""
    version = F.col("version").cast("bigint") if "version" in facts.columns else F.lit(0).cast("bigint")
    removed = F.col("removed") if "removed" in facts.columns else F.lit(False)
    return (facts.filter("player_id is not null and match_id is not null and match_date is not null")
            .select("player_id", "match_date", "match_id", F.coalesce("player_performance", F.lit(0.0)).alias("player_performance"),
                    F.coalesce(removed, F.lit(False)).alias("removed"), F.coalesce(version, F.lit(0)).cast("bigint").alias("version"))
            .groupBy("player_id")
            .applyInPandasWithState(_fold_state, RATING_OUT, RATING_STATE, mode, GroupStateTimeout.NoTimeout))


def current_ratings(log: DataFrame, order: str = "batch_id") -> DataFrame:
    """The rating history a log of :func:`live_ratings` amounts to; ``order``: the column that
    grows from micro-batch to micro-batch."""
    rest = [c for c in log.columns if c not in ("player_id", "match_id", order)]
    return (log.groupBy("player_id", "match_id").agg(F.max_by(F.struct(*rest), order).alias("r"))
            .select("player_id", "match_id", *[F.col(f"r.{c}").alias(c) for c in rest]).filter("rating is not null"))
