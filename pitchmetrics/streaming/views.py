"""Live views: what the ingest knows as of one commit of its store (T3, T4).

Every view adds what is frozen to what is open.  The open matches are closed anew in each
batch, so a record that comes again or late events change all views as if they had come
first; frozen sums are exact for integers and sums of doubles otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import chemistry as _chem
from ..operators import facts as _facts
from ..operators import metrics as _metrics
from .ingest import merged
from .store import Store


class LiveViews:
    """The views of the store ``root``, all as of the commit that was newest on construction."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.store = Store(spark, root)
        self.commit = self.store.commit()

    def metrics(self) -> DataFrame:
        """Running metrics per (match, player) of the open matches."""
        return _metrics.metrics_from_counts(self.store.hot(self.commit, "counts"))

    def waiting(self) -> DataFrame:
        """(match_id, first_batch): open matches whose record has not come yet."""
        open_ = self.store.hot(self.commit, "counts").groupBy("match_id").agg(F.min("first_batch").alias("first_batch"))
        return open_.join(self.store.hot(self.commit, "records").select("match_id"), "match_id", "left_anti")

    def facts(self) -> DataFrame:
        return self.store.history(self.commit, "facts")

    def ratings(self) -> DataFrame:
        return self.store.history(self.commit, "ratings")

    def _open(self, table: str) -> DataFrame:
        """``facts`` or ``ratings`` of the open matches."""
        if self.commit.batch < 0:
            return self.store.empty(table)
        return self.store.read(table, f"{table}/batch_id={self.commit.batch}", "hot")

    def totals(self, players: DataFrame) -> DataFrame:
        """Career totals of all players, as ``player_totals``."""
        sums = self.store.sums(self.commit, "totals").unionByName(_facts.career_sums(self._open("facts")))
        return _facts.totals_from_sums(players, merged("totals", sums), self.pass_accuracy())

    def chemistry(self) -> DataFrame:
        """Pair chemistry, as ``player_chemistry``."""
        steps = _chem.pair_sums(_chem.match_pair_steps(self._open("ratings")))
        return _chem.chemistry_from_sums(merged("pairs", self.store.sums(self.commit, "pairs").unionByName(steps)))

    def pass_accuracy(self) -> DataFrame:
        """Whole-stream pass accuracy, as ``stream_pass_accuracy``: of the archive only the
        batches that may hold events of open matches are read."""
        counts = self.store.hot(self.commit, "counts")
        first = counts.agg(F.min("first_batch")).first()[0]
        events = self.store.archive("event", 0 if first is None else first, self.commit.batch if first is not None else -1).select("event.*")
        live = _metrics.stream_pass_totals(_metrics.stream_pass_sums(
            events.join(counts.select("match_id").distinct(), "match_id", "left_semi")))
        both = self.store.sums(self.commit, "passes").unionByName(live)
        return _metrics.with_pass_accuracy(merged("passes", both))

    def late_records(self) -> DataFrame:
        return self.store.side(self.commit, "late_records")

    def orphans(self) -> DataFrame:
        return self.store.side(self.commit, "orphans")
