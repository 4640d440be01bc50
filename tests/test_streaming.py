"""Streaming = batch: the sf0.001 season replayed as record files through the
file source (no port opened) must give the same match facts as the batch plan,
in one batch, one file per trigger, with matches split over two files, and
after a restart from the checkpoint."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from pitchmetrics.operators import facts as _facts
from pitchmetrics.operators import metrics as _metrics
from pitchmetrics.operators import squads as _squads
from pitchmetrics.sources import testdata
from pitchmetrics.streaming import ingest, live

FACT_COLS = ["match_id", "player_id", "minutes_played", "pass_accuracy", "duel_effectiveness",
             "free_kick_effectiveness", "no_of_shots_on_target", "number_of_fouls", "number_of_own_goals",
             "number_of_goals", "player_contribution", "player_performance"]


def _rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                  for r in df.select(*FACT_COLS).collect())


@pytest.fixture(scope="module")
def batch_facts(spark):
    f = _facts.match_facts(_squads.participants(testdata.matches(spark, SF001)),
                           _metrics.match_metrics(testdata.events(spark, SF001)))
    return _rows(f)


def _write_files(spark, root, split=False):
    """One text file per day (events, then the day's match records); with
    ``split`` every day becomes two files and the match record sits in the second."""
    lines = testdata.stream_lines(spark, SF001)
    if split:
        lines = lines.withColumn("day", F.col("day") * 2 + F.when(
            (F.col("part") == 1) | (F.col("ord") % 2 == 0), 1).otherwise(0))
    for r in lines.select("day").distinct().orderBy("day").collect():
        d = r.day
        sub = lines.filter(F.col("day") == d).orderBy("part", "ord").select("value").coalesce(1)
        tmp = os.path.join(root, f"_tmp_{d:04d}")
        sub.write.mode("overwrite").text(tmp)
        part = [f for f in os.listdir(tmp) if f.startswith("part-")][0]
        os.link(os.path.join(tmp, part), os.path.join(root, "in", f"day_{d:04d}.jsonl"))


def _run(spark, root, files_per_trigger=None, **settings):
    lines = ingest.record_stream(spark, os.path.join(root, "in"), max_files_per_trigger=files_per_trigger)
    q = ingest.start_ingest(lines, os.path.join(root, "store"), os.path.join(root, "ckpt"), available_now=True, **settings)
    q.awaitTermination(600)
    assert q.exception() is None


@pytest.mark.parametrize("files_per_trigger,split", [(None, False), (8, False), (16, True)])
def test_stream_equals_batch(spark, scratch, batch_facts, files_per_trigger, split):
    os.makedirs(os.path.join(scratch, "in"))
    _write_files(spark, scratch, split=split)
    _run(spark, scratch, files_per_trigger)
    got = _rows(ingest.stored_facts(spark, os.path.join(scratch, "store")))
    assert got == batch_facts


def test_restart_from_checkpoint_does_not_double_count(spark, scratch, batch_facts):
    staging = os.path.join(scratch, "staging")
    os.makedirs(os.path.join(staging, "in"))
    _write_files(spark, staging)
    files = sorted(os.listdir(os.path.join(staging, "in")))
    os.makedirs(os.path.join(scratch, "in"))
    for f in files[: len(files) // 2]:
        os.link(os.path.join(staging, "in", f), os.path.join(scratch, "in", f))
    _run(spark, scratch, 8)
    for f in files[len(files) // 2:]:
        os.link(os.path.join(staging, "in", f), os.path.join(scratch, "in", f))
    _run(spark, scratch, 8)
    got = _rows(ingest.stored_facts(spark, os.path.join(scratch, "store")))
    assert got == batch_facts


def test_live_metrics_streaming_aggregate_equals_batch(spark, scratch):
    events = testdata.events(spark, SF001)
    src = os.path.join(scratch, "events")
    events.repartition(4).write.parquet(src)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(src)
    out = os.path.join(scratch, "out")
    q = (live.live_metrics(stream).writeStream.outputMode("update")
         .foreachBatch(lambda b, i: b.write.parquet(f"{out}/batch_id={i}"))
         .option("checkpointLocation", os.path.join(scratch, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(600)
    assert q.exception() is None
    got = ingest.latest(spark.read.parquet(out), ["match_id", "player_id"])
    want = _metrics.match_metrics(events)
    assert {tuple(r) for r in got.select(*want.columns).collect()} == {tuple(r) for r in want.collect()}


def test_live_metrics_with_watermark_drop_old_windows_from_state(spark, scratch):
    events = (testdata.events(spark, SF001)
              .withColumn("at", F.timestamp_seconds(1704067200 + F.col("match_id").cast("bigint") % testdata.SEASON_DAYS * 86400 + 3600)))
    src = os.path.join(scratch, "events")
    for day in range(0, 30, 10):  # files in the order of their days
        part = F.col("match_id").cast("bigint") % testdata.SEASON_DAYS
        events.filter((part >= day) & (part < day + 10)).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = os.path.join(scratch, "out")
    q = (live.live_metrics(stream, "at").writeStream.outputMode("update")
         .foreachBatch(lambda b, i: b.write.parquet(f"{out}/batch_id={i}"))
         .option("checkpointLocation", os.path.join(scratch, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(600)
    assert q.exception() is None
    want = _metrics.match_metrics(events)
    got = ingest.latest(spark.read.parquet(out), ["match_id", "player_id"])
    assert {tuple(r) for r in got.select(*want.columns).collect()} == {tuple(r) for r in want.collect()}
    state = q.lastProgress["stateOperators"][0]["numRowsTotal"]
    assert state < want.count()  # the windows of earlier days have left


def test_two_records_of_a_match_in_one_batch(spark, scratch):
    def record(arrival, goals):
        return ('{"status":"Played","wyId":7,"label":"L","dateutc":"2024-01-01 15:00:00","winner":0,"arrival":%d,"teamsData":'
                '{"1":{"formation":{"lineup":[{"playerId":1,"goals":"%d"}],"bench":[],"substitutions":[]}}}}' % (arrival, goals))
    for k, lines in enumerate(([record(2, 2), record(1, 1)], [record(1, 1), record(2, 2)])):
        root = os.path.join(scratch, str(k))
        os.makedirs(os.path.join(root, "in"))
        with open(os.path.join(root, "in", "a.jsonl"), "w") as f:
            f.write("\n".join([*lines, '{"eventId":2,"subEventId":21,"playerId":1,"matchId":7,"seq":1,"tags":[]}']))
        _run(spark, root)
        store = os.path.join(root, "store")
        facts = ingest.stored_facts(spark, store).collect()
        assert [(r.match_id, r.player_id, r.number_of_fouls) for r in facts] == [("7", "1", 1)]
        assert [r.goals for r in _squads.participants(ingest.stored_matches(spark, store)).collect()] == [2]


def test_live_ratings_state_equals_batch(spark, scratch):
    from pitchmetrics.operators import ratings as _ratings
    f = _facts.match_facts(_squads.participants(testdata.matches(spark, SF001)),
                           _metrics.match_metrics(testdata.events(spark, SF001)))
    src = os.path.join(scratch, "facts")
    f.write.partitionBy("match_date").parquet(src)
    stream = (spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 1)
              .parquet(src))
    q = (live.live_ratings(stream).writeStream.outputMode("append").format("memory")
         .queryName("live_ratings_test").trigger(availableNow=True).start())
    q.awaitTermination(600)
    got = {(r.player_id, r.match_id): r.rating for r in spark.table("live_ratings_test").collect()}
    exp = {(r.player_id, r.match_id): r.rating for r in _ratings.rating_history(f).collect()}
    assert got.keys() == exp.keys()
    for k, v in exp.items():
        assert got[k] == pytest.approx(v, abs=1e-12)


def test_bounded_run_then_finalise_equals_batch(spark, scratch):
    """T6: run the stream, stop it, then write the season tables from the store;
    ratings and totals equal the batch plan's."""
    from pitchmetrics.plans import jobs
    from pitchmetrics.plans.season import Season
    os.makedirs(os.path.join(scratch, "in"))
    _write_files(spark, scratch)
    lines = ingest.record_stream(spark, os.path.join(scratch, "in"))
    q = ingest.start_ingest(lines, os.path.join(scratch, "store"), os.path.join(scratch, "ckpt"),
                            available_now=True)
    ingest.run_for(q, 600)
    players, teams = testdata.players(spark, SF001), testdata.teams(spark, SF001)
    s = ingest.season_from_store(spark, os.path.join(scratch, "store"), players, teams)
    jobs.build_season_tables(s, os.path.join(scratch, "tables"))
    got = {(r.player_id, r.match_id): r.rating
           for r in spark.read.parquet(os.path.join(scratch, "tables", "ratings")).collect()}
    b = Season.from_testdata(spark, SF001)
    exp = {(r.player_id, r.match_id): r.rating for r in b.ratings.collect()}
    assert got.keys() == exp.keys()
    for k, v in exp.items():
        assert got[k] == pytest.approx(v, abs=1e-12)
    tot = {r.player_id: (r.number_of_matches, r.number_of_goals, round(r.pass_accuracy, 12))
           for r in spark.read.parquet(os.path.join(scratch, "tables", "player_totals")).collect()}
    assert tot == {r.player_id: (r.number_of_matches, r.number_of_goals, round(r.pass_accuracy, 12))
                   for r in b.player_totals.collect()}
