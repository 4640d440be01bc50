"""Quadratic rating-on-age regression, fitted for every group at once.

label = rating at each match, features = age in days and its square, no
regularisation (ordinary least squares).  Instead of one MLlib fit per player or
per cluster, *all* groups are fitted from mergeable moments:

1. :func:`age_moments`, one aggregate over the rows: per group and block of 64 days of
   age, the count, the power sums of u = age - (the block's middle) up to u^4, the sums of
   y, u*y and u^2*y, and a bit per age that occurs.  |u| is at most 32, so nothing cancels,
   and all of it is a sum (or a bitwise or): moments of disjoint sets of rows add up
   (:func:`merge_moments`), so they can be kept per player and brought up to date by batch;
2. :func:`fit_from_moments`, over the few blocks of a group: the mean age, the moments
   shifted to it (binomially), and the normal equations in closed form (Cramer's rule).

With one distinct age the fit is the mean, with two it is a line, otherwise a
parabola (the degree a least-squares fit supports).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import age_days

COEFFICIENTS = ("n_points", "degree", "mean_age", "b0", "b1", "b2")


def age_features(ratings: DataFrame, players: DataFrame) -> DataFrame:
    """Rating rows with the player's age in days at the match and its square."""
    p = players.select("player_id", "birth_date")
    return (ratings.join(p, "player_id")
            .withColumn("age", age_days("match_date", "birth_date"))
            .withColumn("age_sq", (F.col("age").cast("double") * F.col("age").cast("double"))))


def _det3(a, b, c, d, e, f, g, h, i) -> Column:
    return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)


#: days of age in a block, one bit each
BLOCK = 64
MOMENTS = ("n", "s1", "s2", "s3", "s4", "t0", "t1", "t2")


def age_moments(training: DataFrame, keys: Sequence[str], x: str = "age", y: str = "rating") -> DataFrame:
    """(keys, block, moments, ages): the moments of the rows that have an ``x`` (whole days)
    and a ``y``, per block of ages."""
    t = (training.select(*keys, F.col(x).cast("bigint").alias("x"), F.col(y).cast("double").alias("y"))
         .filter(F.col("x").isNotNull() & F.col("y").isNotNull())
         .withColumn("block", F.floor(F.col("x") / BLOCK).cast("bigint")))
    u = (F.col("x") - F.col("block") * BLOCK - BLOCK // 2).cast("double")
    bit = F.expr(f"shiftleft(1L, cast(x - block * {BLOCK} as int))")
    return t.groupBy(*keys, "block").agg(
        F.count(F.lit(1)).cast("bigint").alias("n"), F.sum(u).alias("s1"), F.sum(u * u).alias("s2"), F.sum(u * u * u).alias("s3"),
        F.sum(u * u * u * u).alias("s4"), F.sum("y").alias("t0"), F.sum(u * F.col("y")).alias("t1"),
        F.sum(u * u * F.col("y")).alias("t2"), F.bit_or(bit).alias("ages"))


def merge_moments(moments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per group and block from moments of disjoint sets of rows."""
    return moments.groupBy(*keys, "block").agg(*[F.sum(c).alias(c) for c in MOMENTS], F.bit_or("ages").alias("ages"))


def fit_from_moments(moments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per group: (n_points, degree, mean_age, b0, b1, b2) of y ~ b0 + b1*u + b2*u^2,
    u = x - mean_age."""
    keys = list(keys)
    middle = F.col("block") * BLOCK + BLOCK // 2
    first = moments.groupBy(*keys).agg(
        F.sum("n").alias("n_points"), (F.sum(F.col("n") * middle + F.col("s1")) / F.sum("n")).alias("mean_age"),
        F.sum(F.bit_count("ages")).alias("distinct"))
    d = middle - F.col("mean_age")
    n, s1, s2, s3, s4 = (F.col(c) for c in ("n", "s1", "s2", "s3", "s4"))
    t0, t1, t2 = F.col("t0"), F.col("t1"), F.col("t2")
    sums = (moments.join(first, keys).groupBy(*keys, "n_points", "mean_age", "distinct").agg(
        F.sum(s1 + n * d).alias("s1"),
        F.sum(s2 + s1 * d * 2 + n * d * d).alias("s2"),
        F.sum(s3 + s2 * d * 3 + s1 * d * d * 3 + n * d * d * d).alias("s3"),
        F.sum(s4 + s3 * d * 4 + s2 * d * d * 6 + s1 * d * d * d * 4 + n * d * d * d * d).alias("s4"),
        F.sum(t0).alias("t0"), F.sum(t1 + t0 * d).alias("t1"), F.sum(t2 + t1 * d * 2 + t0 * d * d).alias("t2")))
    n = F.col("n_points").cast("double")
    det = _det3(n, s1, s2, s1, s2, s3, s2, s3, s4)
    q0 = _det3(t0, s1, s2, t1, s2, s3, t2, s3, s4) / det
    q1 = _det3(n, t0, s2, s1, t1, s3, s2, t2, s4) / det
    q2 = _det3(n, s1, t0, s1, s2, t1, s2, s3, t2) / det
    det2 = n * s2 - s1 * s1
    l0 = (t0 * s2 - s1 * t1) / det2
    l1 = (n * t1 - s1 * t0) / det2
    degree = F.least(F.col("distinct") - 1, F.lit(2)).cast("int")
    return sums.select(
        *keys, F.col("n_points").cast("bigint").alias("n_points"), degree.alias("degree"), "mean_age",
        F.when(degree == 0, t0 / n).when(degree == 1, l0).otherwise(q0).alias("b0"),
        F.when(degree == 0, F.lit(0.0)).when(degree == 1, l1).otherwise(q1).alias("b1"),
        F.when(degree == 2, q2).otherwise(F.lit(0.0)).alias("b2"))


def fit_quadratic(training: DataFrame, keys: Sequence[str], x: str = "age", y: str = "rating") -> DataFrame:
    """Per key: (n_points, degree, mean_age, b0, b1, b2); rows without x or y are no points."""
    return fit_from_moments(age_moments(training, keys, x, y), keys)


def predict(coef_prefix: str = "") -> Column:
    """b0 + b1*u + b2*u^2 at u = age - mean_age (columns ``age`` and the coefficients)."""
    p = coef_prefix
    u = F.col("age").cast("double") - F.col(f"{p}mean_age")
    return F.col(f"{p}b0") + F.col(f"{p}b1") * u + F.col(f"{p}b2") * u * u


def player_models(features: DataFrame) -> DataFrame:
    """One fit per player over all of the player's rating rows."""
    return fit_quadratic(features, ["player_id"])


def group_models(features: DataFrame, groups: DataFrame, totals: DataFrame, group_col: str,
                 max_matches: int) -> DataFrame:
    """One fit per group over the rating rows of the group's players that have
    fewer than ``max_matches`` matches (each row with that player's own age)."""
    members = (groups.select("player_id", group_col)
               .join(totals.select("player_id", "number_of_matches"), "player_id")
               .filter(F.col("number_of_matches") < max_matches).select("player_id", group_col))
    return fit_quadratic(features.join(members, "player_id"), [group_col])


def rating_predictions(targets: DataFrame, players: DataFrame, totals: DataFrame, player_fit: DataFrame,
                       group_fit: DataFrame, groups: DataFrame, group_col: str, threshold: int) -> DataFrame:
    """Predicted rating of each target row (player_id, date): the player's own model
    when the player has at least ``threshold`` matches, else the model of the
    player's group, evaluated at the player's age on ``date``."""
    t = (targets.join(players.select("player_id", "birth_date"), "player_id", "left")
         .join(totals.select("player_id", "number_of_matches"), "player_id", "left")
         .join(groups.select("player_id", group_col), "player_id", "left")
         .withColumn("age", age_days("date", "birth_date")))
    pf = player_fit.select("player_id", *[F.col(c).alias(f"p_{c}") for c in ("mean_age", "b0", "b1", "b2")])
    gf = group_fit.select(group_col, *[F.col(c).alias(f"g_{c}") for c in ("mean_age", "b0", "b1", "b2")])
    j = t.join(pf, "player_id", "left").join(gf, group_col, "left")
    use_group = F.coalesce(F.col("number_of_matches"), F.lit(0)) < threshold
    return j.select(
        *targets.columns,
        F.when(use_group, F.lit("group")).otherwise(F.lit("player")).alias("route"),
        F.when(use_group, predict("g_")).otherwise(predict("p_")).alias("predicted_rating"))
