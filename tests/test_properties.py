"""Properties over the sf0.001 season."""

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from pitchmetrics.operators import metrics
from pitchmetrics.plans.season import Season
from pitchmetrics.sources import testdata


@pytest.fixture(scope="module")
def season(spark):
    return Season.from_testdata(spark, SF001).cut("match_facts", "ratings", "match_counts", "chemistry")


def test_ratios_in_unit_interval(season):
    m = season.match_metrics
    for c in ("pass_accuracy", "duel_effectiveness", "shot_effectiveness"):
        assert m.filter((F.col(c) < 0) | (F.col(c) > 1)).count() == 0, c


def test_chemistry_is_symmetric(season):
    c = season.chemistry
    a, b = c.alias("a"), c.alias("b")
    j = a.join(b, (F.col("a.player_id_1") == F.col("b.player_id_2")) & (F.col("a.player_id_2") == F.col("b.player_id_1")))
    assert j.count() == c.count()
    assert j.filter(F.abs(F.col("a.chemistry") - F.col("b.chemistry")) > 1e-12).count() == 0


def test_chances_sum_to_100(season):
    f = season.forecasts("role").filter(F.col("result") == "ok")
    assert f.count() > 0
    assert f.filter(F.abs(F.col("chance1") + F.col("chance2") - 100) > 1e-9).count() == 0


def test_rating_change_is_rating_minus_previous(season):
    r = season.ratings
    assert r.filter(F.abs(F.col("rating") - (F.col("old_rating") + F.col("change_in_rating"))) > 1e-12).count() == 0


def test_system_player_events_change_nothing(spark):
    ev = testdata.events(spark, SF001)
    extra = ev.limit(200).withColumn("player_id", F.lit("0")).withColumn("seq", F.col("seq") + 10_000_000)
    a = {tuple(r) for r in metrics.match_metrics(ev).collect()}
    b = {tuple(r) for r in metrics.match_metrics(ev.unionByName(extra)).collect()}
    assert a == b


def test_input_row_order_changes_nothing(spark):
    ev = testdata.events(spark, SF001)
    shuffled = ev.repartition(7, F.rand(seed=3))
    a = {tuple(r) for r in metrics.stream_pass_accuracy(ev).collect()}
    b = {tuple(r) for r in metrics.stream_pass_accuracy(shuffled).collect()}
    assert a == b
