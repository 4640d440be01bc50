"""A season: the input tables and every table derived from them, built lazily.

Each property is a DataFrame (a logical plan) built on first use; nothing runs
until an action.  Tables that feed several consumers inside one job (facts,
ratings, totals, chemistry) can be cut with :meth:`Season.cut`: written as a
table into the cluster's shared ``spark.checkpoint.dir`` and read back, which
stops the recomputation of their lineage and survives lost executors.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes as C
from ..operators import chemistry as _chem
from ..operators import clustering as _clust
from ..operators import facts as _facts
from ..operators import matches as _matches
from ..operators import metrics as _metrics
from ..operators import ratings as _ratings
from ..operators import regression as _reg
from ..operators import requests as _requests
from ..operators import squads as _squads
from ..session import checkpoint_dir
from ..sources import testdata


class Season:
    """Inputs are given as DataFrames or as zero-argument loaders (built on first use)."""

    def __init__(self, events, matches, players, teams, requests=None):
        self._loaders: dict[str, Callable[[], DataFrame] | DataFrame | None] = {
            "events": events, "matches": matches, "players": players, "teams": teams, "requests": requests}
        self._folders: list[str] = []

    def _input(self, name: str) -> DataFrame:
        v = self._loaders[name]
        if callable(v) and not isinstance(v, DataFrame):
            v = v()
            self._loaders[name] = v
        return v

    @property
    def events(self) -> DataFrame:
        return self._input("events")

    @property
    def matches(self) -> DataFrame:
        return self._input("matches")

    @property
    def players(self) -> DataFrame:
        return self._input("players")

    @property
    def teams(self) -> DataFrame:
        return self._input("teams")

    @cached_property
    def requests(self) -> DataFrame:
        """One row per request id."""
        return _requests.unique_requests(self._input("requests"))

    @cached_property
    def forecast_requests(self) -> DataFrame:
        """The forecasts among :attr:`requests`; cut, they are told from the others once."""
        return self.requests.filter(F.col("request_kind") == "forecast")

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str) -> "Season":
        return cls(events=lambda: testdata.events(spark, sf_dir), matches=lambda: testdata.matches(spark, sf_dir),
                   players=lambda: testdata.players(spark, sf_dir), teams=lambda: testdata.teams(spark, sf_dir),
                   requests=lambda: testdata.requests(spark, sf_dir))

    def cut(self, *names: str) -> "Season":
        """Materialises the named derived tables, in the order given, as parquet
        tables in the shared checkpoint folder (``spark.checkpoint.dir``) and reads
        them back: one computation each, lineage cut (a lost executor costs a
        re-read, not a recomputation), and file statistics for later join choices."""
        if not names:
            return self
        run = uuid.uuid4().hex
        for name in names:
            df = getattr(self, name)
            folder = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/pitchmetrics-{run}"
            df.write.mode("overwrite").parquet(f"{folder}/{name}")
            self.__dict__[name] = df.sparkSession.read.parquet(f"{folder}/{name}")
        self._folders.append(folder)
        return self

    def discard(self) -> None:
        """Removes the tables that :meth:`cut` wrote, once no result reads them any more."""
        spark = SparkSession.getActiveSession()
        for folder in self._folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        self._folders.clear()

    @cached_property
    def match_metrics(self) -> DataFrame:
        return _metrics.match_metrics(self.events)

    @cached_property
    def participants(self) -> DataFrame:
        return _squads.participants(self.matches)

    @cached_property
    def match_facts(self) -> DataFrame:
        return _facts.match_facts(self.participants, self.match_metrics)

    @cached_property
    def ratings(self) -> DataFrame:
        # squad and side come along, so that chemistry needs no join back to the facts
        return _ratings.rating_history(self.match_facts, carry=("team_pos", "squad"))

    @cached_property
    def stream_pass_accuracy(self) -> DataFrame:
        return _metrics.stream_pass_accuracy(self.events)

    @cached_property
    def match_counts(self) -> DataFrame:
        return _facts.match_counts(self.players, self.match_facts)

    @cached_property
    def player_totals(self) -> DataFrame:
        return _facts.player_totals(self.players, self.match_facts, self.stream_pass_accuracy)

    @cached_property
    def chemistry(self) -> DataFrame:
        return _chem.player_chemistry(self.ratings)

    @cached_property
    def match_details(self) -> DataFrame:
        return _matches.match_details(self.matches, self.players, self.teams)

    @cached_property
    def match_summary(self) -> DataFrame:
        return _matches.match_summary(self.participants, self.matches, self.teams)

    @cached_property
    def profiles(self) -> DataFrame:
        return _requests.player_profiles(self.requests, self.player_totals)

    @cached_property
    def match_lookups(self) -> DataFrame:
        if "match_details" in self.__dict__:  # stored
            return _requests.match_lookups(self.requests, self.match_details)
        # details of the requested matches only
        asked = self.requests.filter(F.col("request_kind") == "match").select("label").distinct()
        wanted = _squads.latest_matches(self.matches).join(asked, "label", "left_semi")
        return _requests.match_lookups(self.requests, _matches.match_details(wanted, self.players, self.teams))

    # --- models -------------------------------------------------------------------
    @cached_property
    def cluster_centres(self) -> DataFrame:
        return _clust.fit_centres(_clust.cluster_features(self.player_totals))

    @cached_property
    def clusters(self) -> DataFrame:
        return _clust.player_clusters(self.player_totals, self.cluster_centres)

    def groups(self, group_col: str = "prediction") -> DataFrame:
        """player_id -> group: k-means cluster ('prediction') or any players column."""
        if group_col == "prediction":
            return self.clusters.select("player_id", "prediction")
        return self.players.select("player_id", group_col)

    def group_chemistry(self, group_col: str = "prediction") -> DataFrame:
        return _chem.group_chemistry(self.groups(group_col), self.chemistry, group_col)

    @cached_property
    def age_features(self) -> DataFrame:
        return _reg.age_features(self.ratings, self.players)

    @cached_property
    def player_fit(self) -> DataFrame:
        return _reg.player_models(self.age_features)

    def group_fit(self, group_col: str = "prediction") -> DataFrame:
        return _reg.group_models(self.age_features, self.groups(group_col), self.match_counts, group_col,
                                 C.EXPERIENCE_THRESHOLD)

    def predictions(self, targets: DataFrame, group_col: str = "prediction") -> DataFrame:
        """targets: rows with player_id and date."""
        return _reg.rating_predictions(targets, self.players, self.match_counts, self.player_fit,
                                       self.group_fit(group_col), self.groups(group_col), group_col,
                                       C.EXPERIENCE_THRESHOLD)

    # --- forecasts ----------------------------------------------------------------
    @cached_property
    def lineups(self) -> DataFrame:
        return _requests.lineup_players(self.forecast_requests, self.players)

    def lineup_roles(self, legacy: bool = False) -> DataFrame:
        return _requests.lineup_roles(self.forecast_requests, self.lineups, legacy=legacy)

    def lineup_chemistry(self, group_col: str = "prediction") -> DataFrame:
        return _requests.lineup_chemistry(self.lineups, self.match_counts, self.chemistry, self.groups(group_col),
                                          self.group_chemistry(group_col), group_col)

    def slot_ratings(self, group_col: str = "prediction") -> DataFrame:
        dates = self.forecast_requests.select("request_id", "date")
        targets = (self.lineups.filter(F.col("player_id").isNotNull())
                   .join(dates, "request_id").select("request_id", "side", "slot", "player_id", "date"))
        return self.predictions(targets, group_col)

    def forecasts(self, group_col: str = "prediction", legacy: bool = False) -> DataFrame:
        return _requests.forecasts(self.forecast_requests, self.lineup_roles(legacy), self.lineup_chemistry(group_col),
                                   self.slot_ratings(group_col), legacy=legacy)
