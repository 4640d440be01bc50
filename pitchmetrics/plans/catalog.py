"""Named queries over the test-data season, one per operator family.

Each entry takes (spark, sf_dir) and returns a DataFrame whose column names,
types and rounding equal its DuckDB twin in :mod:`pitchmetrics.plans.oracle`:
doubles rounded with ``round(x + 1e-9, 6)``, counts as BIGINT, dates as
'YYYY-MM-DD' text, lists as joined text.  The rounding lives here only, never
in the operators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import stable_round as R
from .season import Season

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _season(spark: SparkSession, sf_dir: str, *cut: str) -> Season:
    """The test-data season; ``cut`` names derived tables read by several consumers
    of the query, materialised once (see :meth:`Season.cut`)."""
    return Season.from_testdata(spark, sf_dir).cut(*cut)


SHARED = ("match_facts", "ratings", "match_counts")
# requests are told apart by id over all kinds, and every part of a forecast reads them
LINEUPS = ("forecast_requests", "lineups")


def _date(c: str) -> F.Column:
    return F.date_format(c, "yyyy-MM-dd").alias(c)


def _big(c: str) -> F.Column:
    return F.col(c).cast("bigint").alias(c)


def _int(c: str) -> F.Column:
    return F.col(c).cast("int").alias(c)


@query
def match_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _season(spark, sf_dir).match_metrics
    return m.select("match_id", "player_id",
                    *[R(c).alias(c) for c in ("pass_accuracy", "duel_effectiveness",
                                              "free_kick_effectiveness", "shot_effectiveness")],
                    *[_big(c) for c in ("number_of_fouls", "number_of_own_goals",
                                        "no_of_shots_on_target", "number_of_goals")])


@query
def participants(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _season(spark, sf_dir).participants
    return p.select("match_id", _date("match_date"), _int("team_pos"), "team_id", "player_id", "squad",
                    _int("minutes_played"), *[_int(c) for c in ("goals", "own_goals", "yellow_cards", "red_cards")])


@query
def match_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _season(spark, sf_dir).match_facts
    return f.select("match_id", "player_id", _int("minutes_played"),
                    *[R(c).alias(c) for c in ("pass_accuracy", "duel_effectiveness", "free_kick_effectiveness")],
                    *[_big(c) for c in ("no_of_shots_on_target", "number_of_fouls", "number_of_own_goals",
                                        "number_of_goals")],
                    R("player_contribution").alias("player_contribution"),
                    R("player_performance").alias("player_performance"))


@query
def player_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _season(spark, sf_dir).ratings
    return r.select("player_id", _date("match_date"), "match_id", R("rating").alias("rating"))


@query
def rating_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _season(spark, sf_dir).ratings
    return r.select("player_id", _date("match_date"), "match_id", R("old_rating").alias("old_rating"),
                    R("rating").alias("rating"), R("change_in_rating").alias("change_in_rating"))


# --- events -------------------------------------------------------------------------

@query
def event_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.events import player_events
    ev = player_events(_season(spark, sf_dir).events)
    return ev.select("match_id", _big("seq"), "player_id", _int("event_id"), _int("sub_event_id"),
                     F.coalesce(F.size("tags"), F.lit(0)).cast("bigint").alias("n_tags"),
                     F.array_join(F.transform("tags", lambda t: t["id"].cast("string")), ",").alias("tag_ids"))


@query
def tag_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.events import tag_membership as op
    return op(_season(spark, sf_dir).events).withColumn("seq", F.col("seq").cast("bigint"))


@query
def event_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.events import event_type_counts as op
    return op(_season(spark, sf_dir).events)


# --- metric components ----------------------------------------------------------------

def _component(spark: SparkSession, sf_dir: str, events_col: str, counts: list[str], value) -> DataFrame:
    from ..operators.metrics import metric_counts
    c = metric_counts(_season(spark, sf_dir).events)
    return (c.filter(F.col(events_col) > 0)
            .select("match_id", "player_id", *[_big(x) for x in counts], R(value).alias("value")))


@query
def pass_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.metrics import pass_accuracy_of
    return _component(spark, sf_dir, "n_pass_events",
                      ["n_key_accurate", "n_key_inaccurate", "n_accurate", "n_inaccurate"],
                      pass_accuracy_of()).withColumnRenamed("value", "pass_accuracy")


@query
def duel_effectiveness(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.metrics import duel_effectiveness_of
    return _component(spark, sf_dir, "n_duel_events", ["n_duels_won", "n_duels_neutral", "n_duels_lost"],
                      duel_effectiveness_of()).withColumnRenamed("value", "duel_effectiveness")


@query
def free_kick_effectiveness(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.metrics import free_kick_effectiveness_of
    return _component(spark, sf_dir, "n_free_kick_events",
                      ["n_free_kicks_effective", "n_free_kicks_not_effective", "n_penalties_scored"],
                      free_kick_effectiveness_of()).withColumnRenamed("value", "free_kick_effectiveness")


@query
def shot_effectiveness(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.metrics import shot_effectiveness_of
    return _component(spark, sf_dir, "n_shot_events",
                      ["n_shot_goals", "n_shots_on_target_no_goal", "n_shots_off_target"],
                      shot_effectiveness_of()).withColumnRenamed("value", "shot_effectiveness")


# --- career -------------------------------------------------------------------------

@query
def stream_pass_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _season(spark, sf_dir).stream_pass_accuracy
    return s.select("player_id", _big("numerator"), _big("denominator"), R("pass_accuracy").alias("pass_accuracy"))


_TOTAL_COUNTS = ("number_of_fouls", "number_of_goals", "number_of_own_goals", "number_of_matches",
                 "number_of_shots_on_target")


@query
def player_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _season(spark, sf_dir).player_totals
    return t.select("player_id", "name", "role", "foot", _date("birth_date"), "birth_area", "passport_area",
                    _int("height"), _int("weight"), *[_big(c) for c in _TOTAL_COUNTS],
                    R("pass_accuracy").alias("pass_accuracy"))


@query
def player_chemistry(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _season(spark, sf_dir, "match_facts", "ratings").chemistry
    return c.select("player_id_1", "player_id_2", R("chemistry").alias("chemistry"))


# --- matches ------------------------------------------------------------------------

def _scored_text(c: str) -> F.Column:
    return F.array_join(F.transform(c, lambda x: F.concat_ws(
        "|", F.coalesce(x["player_name"], F.lit("?")), F.coalesce(x["team_name"], F.lit("?")),
        x["number_of_goals"].cast("string"))), ";").alias(c)


def _names_text(c: str) -> F.Column:
    return F.array_join(F.transform(c, lambda x: F.coalesce(x, F.lit("?"))), ";").alias(c)


def _details_text(df: DataFrame) -> list[F.Column]:
    return ["match_id", "label", _date("date"), "duration", "winner", "venue", _int("gameweek"),
            _scored_text("goals"), _scored_text("own_goals"), _names_text("yellow_cards"),
            _names_text("red_cards")]


@query
def match_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _season(spark, sf_dir).match_summary
    return s.select("match_id", "winner", *[_big(f"total_{c}") for c in
                                            ("goals", "own_goals", "yellow_cards", "red_cards")])


@query
def match_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _season(spark, sf_dir).match_details
    return d.select(*_details_text(d))


@query
def match_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _season(spark, sf_dir).match_lookups
    return d.select(_big("request_id"), *_details_text(d), "error")


@query
def player_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _season(spark, sf_dir).profiles
    return p.select(_big("request_id"), "player_id", "name", "role", "foot", _date("birth_date"), "birth_area",
                    "passport_area", _int("height"), _int("weight"), *[_big(c) for c in _TOTAL_COUNTS],
                    R("pass_accuracy").alias("pass_accuracy"), "error")


# --- models (groups of players: roles, or k-means clusters) -------------------------------

ORACLE_GROUP = "role"
PREDICTION_DATE = "2024-02-15"


def _coef(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, _big("n_points"), _int("degree"), R("mean_age").alias("mean_age"), R("b0").alias("b0"),
                     R("b1", 9).alias("b1"), R("b2", 12).alias("b2"))


@query
def age_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _season(spark, sf_dir).age_features
    return f.select("player_id", _date("match_date"), "match_id", _big("age"),
                    F.col("age_sq").cast("bigint").alias("age_sq"), R("rating").alias("rating"))


@query
def rating_regression_player(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coef(_season(spark, sf_dir, "ratings").player_fit, "player_id")


@query
def rating_regression_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coef(_season(spark, sf_dir, *SHARED).group_fit(ORACLE_GROUP), ORACLE_GROUP)


@query
def rating_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _season(spark, sf_dir, *SHARED)
    targets = s.players.select("player_id", F.lit(PREDICTION_DATE).cast("date").alias("date"))
    p = s.predictions(targets, ORACLE_GROUP)
    return p.select("player_id", "route", R("predicted_rating").alias("predicted_rating"))


@query
def chemistry_group_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _season(spark, sf_dir, "match_facts", "ratings").group_chemistry(ORACLE_GROUP)
    return g.select(ORACLE_GROUP, R("avg_chemistry").alias("avg_chemistry"), _big("n_pairs"))


CLUSTERED = ("match_facts", "player_totals", "cluster_centres")


@query
def player_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _season(spark, sf_dir, *CLUSTERED).clusters
    return c.select("player_id", _big("number_of_matches"), _date("birth_date"), _int("prediction"))


@query
def cluster_centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _season(spark, sf_dir, "match_facts", "player_totals").cluster_centres
    return c.select("prediction", *[R(f).alias(f) for f in c.columns if f != "prediction"])


@query
def cluster_chemistry(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = _season(spark, sf_dir, "match_facts", "ratings", *CLUSTERED[1:], "chemistry").group_chemistry("prediction")
    return g.select(_int("prediction"), R("avg_chemistry").alias("avg_chemistry"), _big("n_pairs"))


@query
def rating_regression_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _season(spark, sf_dir, *SHARED, *CLUSTERED[1:])
    return _coef(s.group_fit("prediction"), "prediction")


@query
def cluster_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.clustering import FEATURES, cluster_features as op
    f = op(_season(spark, sf_dir).player_totals)
    return f.select("player_id", R("pass_accuracy").alias("pass_accuracy"), *[c for c in FEATURES if c != "pass_accuracy"])


@query
def cluster_invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.clustering import cluster_invariants as op
    s = _season(spark, sf_dir, *CLUSTERED)
    return op(s.player_totals, s.cluster_centres)


@query
def cluster_chemistry_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over all clusters, the pairs and their chemistry."""
    g = _season(spark, sf_dir, "match_facts", "ratings", *CLUSTERED[1:], "chemistry").group_chemistry("prediction")
    return g.agg(F.sum("n_pairs").alias("n_pairs"), R(F.sum(F.col("avg_chemistry") * F.col("n_pairs")), 4).alias("sum_chemistry"))


# --- requests -------------------------------------------------------------------------

@query
def lineup_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _season(spark, sf_dir, *LINEUPS).lineup_roles()
    return r.select(_big("request_id"), _int("side"), *[_big(c) for c in ("gk", "df", "md", "fw", "unknown")],
                    F.col("side_valid").cast("int").alias("side_valid"),
                    F.col("request_valid").cast("int").alias("request_valid"))


@query
def lineup_chemistry(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _season(spark, sf_dir, *SHARED, "chemistry", *LINEUPS).lineup_chemistry(ORACLE_GROUP)
    return c.select(_big("request_id"), _int("side"), "slot", "player_id",
                    R("chemistry_coefficient").alias("chemistry_coefficient"))


def _forecast_rows(f: DataFrame) -> DataFrame:
    return f.select(_big("request_id"), "team1_name", "team2_name", "result",
                    *[R(c).alias(c) for c in ("strength1", "strength2", "chance1", "chance2")])


@query
def match_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _forecast_rows(_season(spark, sf_dir, *SHARED, "chemistry", *LINEUPS).forecasts(ORACLE_GROUP))


@query
def match_forecast_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forecast of the source: groups are the k-means clusters."""
    s = _season(spark, sf_dir, *SHARED, "chemistry", *CLUSTERED[1:], *LINEUPS)
    return _forecast_rows(s.cut("clusters").forecasts("prediction"))
