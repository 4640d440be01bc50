"""Player profiles clustered by k-means (k = 5, unscaled features).

Features: [pass_accuracy, goals, own_goals, fouls, shots_on_target] from the career totals.
The model is fitted on all players, as the source does (its filter on played matches is
overwritten before the fit).

The model of the library is Lloyd's rounds written as DataFrame aggregates: one grouped mean
a round, from given centres or from the distinct profiles whose players come first in the
order of the md5 of their ids.  Its result depends on the data alone, not on partitions,
which MLlib's (:func:`fit_clusters`, seed = 1) does; centres are a table, so a stored model
assigns without a fit.
"""

from __future__ import annotations

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEATURES = ("pass_accuracy", "number_of_goals", "number_of_own_goals", "number_of_fouls",
            "number_of_shots_on_target")
K = 5
SEED = 1
ROUNDS = 20
#: digits of a squared distance that decide which centre is nearest
DIGITS = 6
CENTRES = "prediction int, " + ", ".join(f"{f} double" for f in FEATURES)


def cluster_features(totals: DataFrame) -> DataFrame:
    """(player_id, number_of_matches, birth_date and the features as doubles)."""
    return totals.select("player_id", "number_of_matches", "birth_date",
                         *[F.col(c).cast("double").alias(c) for c in FEATURES])


def first_centres(features: DataFrame, k: int = K) -> list[list[float]]:
    """The ``k`` distinct profiles with the smallest md5 of a player id (fewer, where there
    are fewer profiles)."""
    rows = (features.groupBy(*FEATURES).agg(F.min(F.md5(F.col("player_id").cast("binary"))).alias("h")).orderBy("h").limit(k).collect())
    return [[float(r[f]) for f in FEATURES] for r in rows]


def _nearest(centres: list[list[float]]) -> Column:
    """The centre with the smallest squared distance, the first of equal ones."""
    away = [F.round(sum(((F.col(f) - x) * (F.col(f) - x) for f, x in zip(FEATURES, c, strict=True)), F.lit(0.0)), DIGITS) for c in centres]
    if not away:
        return F.lit(None).cast("int")
    return F.array_min(F.array(*[F.struct(d.alias("d"), F.lit(i).alias("i")) for i, d in enumerate(away)]))["i"]


def fit_centres(features: DataFrame, k: int = K, centres: list[list[float]] | None = None, rounds: int = ROUNDS) -> DataFrame:
    """(prediction, features): the centres after ``rounds`` of Lloyd, or once none moves.  An
    empty cluster keeps its centre.  ``features`` is read once a round; what reaches the
    driver are the centres."""
    centres = first_centres(features, k) if centres is None else [list(map(float, c)) for c in centres]
    points = features.select(*FEATURES)
    for _ in range(rounds if centres else 0):
        means = points.groupBy(_nearest(centres).alias("i")).agg(*[F.avg(f).alias(f) for f in FEATURES]).collect()
        moved = {r.i: [float(r[f]) for f in FEATURES] for r in means}
        after = [moved.get(i, c) for i, c in enumerate(centres)]
        if after == centres:
            break
        centres = after
    return features.sparkSession.createDataFrame([(i, *c) for i, c in enumerate(centres)], CENTRES)


def assign(features: DataFrame, centres: DataFrame) -> DataFrame:
    """``features`` with ``prediction``, the nearest of ``centres`` (one row per cluster)."""
    rows = sorted(centres.collect(), key=lambda r: r.prediction)
    ids = F.array(*[F.lit(r.prediction).cast("int") for r in rows]) if rows else F.array().cast("array<int>")
    return features.withColumn("prediction", F.get(ids, _nearest([[r[f] for f in FEATURES] for r in rows])))


def player_clusters(totals: DataFrame, centres: DataFrame | None = None, k: int = K) -> DataFrame:
    """(player_id, number_of_matches, birth_date, prediction) for every player."""
    features = cluster_features(totals)
    return (assign(features, fit_centres(features, k) if centres is None else centres)
            .select("player_id", "number_of_matches", "birth_date", "prediction"))


def fit_clusters(features: DataFrame, k: int = K, seed: int = SEED) -> tuple[DataFrame, list[list[float]]]:
    """MLlib's k-means: the features with ``prediction``, and the cluster centres."""
    vec = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(features)
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="prediction").fit(vec)
    return (model.transform(vec).drop("features").withColumn("prediction", F.col("prediction").cast("int")),
            [[float(x) for x in c] for c in model.clusterCenters()])


def cluster_invariants(totals: DataFrame, centres: DataFrame, k: int = K) -> DataFrame:
    """One row of counts: players, players assigned, ids out of range, and players that
    are nearer to another centre than to their own."""
    assigned = assign(cluster_features(totals), centres)
    rows = sorted(centres.collect(), key=lambda r: r.prediction)
    away = F.array(*[sum(((F.col(f) - r[f]) * (F.col(f) - r[f]) for f in FEATURES), F.lit(0.0)) for r in rows])
    own = F.get(away, F.col("prediction"))

    def n(cond) -> Column:
        return F.count(F.when(cond, F.lit(1)))

    return assigned.agg(F.count(F.lit(1)).alias("players"), F.count("prediction").alias("assigned"),
                        n((F.col("prediction") < 0) | (F.col("prediction") >= k)).alias("out_of_range"),
                        n(own > F.array_min(away) * (1 + 1e-9) + 1e-6).alias("not_nearest"))
