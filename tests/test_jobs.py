"""Answering requests is set-based: the number of Spark jobs for forecasts does not
"""

import os

from pyspark.sql import functions as F

from conftest import SF001
from pitchmetrics.plans.season import Season
from pitchmetrics.sources import testdata


def _jobs_for(spark, requests, group):
    s = Season(events=testdata.events(spark, SF001), matches=testdata.matches(spark, SF001),
               players=testdata.players(spark, SF001), teams=testdata.teams(spark, SF001), requests=requests)
    s.cut("match_facts", "ratings", "player_totals", "chemistry")
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    rows = s.forecasts("role").collect()
    n = len(sc.statusTracker().getJobIdsForGroup(group))
    sc.setJobGroup("", "")
    folders = list(s._folders)
    assert folders and all(os.path.isdir(f.removeprefix("file:")) for f in folders)
    s.discard()
    assert not any(os.path.exists(f.removeprefix("file:")) for f in folders)
    return n, rows


def test_forecast_job_count_does_not_grow_with_requests(spark):
    reqs = testdata.requests(spark, SF001)
    forecasts = reqs.filter(F.col("request_kind") == "forecast")

    def copies(n):   # every forecast request n times under new ids: same plan shape for any n
        return (forecasts.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("k"), "*")
                .withColumn("request_id", F.col("request_id") * 1000 + F.col("k")).drop("k"))

    n1, r1 = _jobs_for(spark, copies(1), "one")
    n2, r2 = _jobs_for(spark, copies(200), "many")
    assert len(r2) == 200 * len(r1)
    assert n2 <= n1 + 2, (n1, n2)
