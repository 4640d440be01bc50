"""Live views of the ingest, the life of a match, and the keyed rating state."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from pitchmetrics.operators import chemistry as _chem
from pitchmetrics.operators import facts as _facts
from pitchmetrics.operators import metrics as _metrics
from pitchmetrics.operators import ratings as _ratings
from pitchmetrics.operators import squads as _squads
from pitchmetrics.plans.season import Season
from pitchmetrics.sources import testdata
from pitchmetrics.streaming import ingest, live
from pitchmetrics.streaming.store import Store
from pitchmetrics.streaming.views import LiveViews

D = dt.date(2024, 1, 1)


def _play(spark, root, files, **settings):
    """Feeds the files (lists of lines), one a micro-batch, and runs until all are taken."""
    os.makedirs(os.path.join(root, "in"), exist_ok=True)
    have = len(os.listdir(os.path.join(root, "in")))
    for k, lines in enumerate(files):
        path = os.path.join(root, "in", f"{have + k:05d}.jsonl")
        with open(path, "w") as f:
            f.write("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + have + k,) * 2)
    lines = ingest.record_stream(spark, os.path.join(root, "in"), max_files_per_trigger=1)
    q = ingest.start_ingest(lines, os.path.join(root, "store"), os.path.join(root, "ckpt"), available_now=True, **settings)
    ingest.run_for(q, 900)
    return LiveViews(spark, os.path.join(root, "store"))


def _record(match, day, squad, arrival=0, date=None):
    """A record with a lineup of players on two sides (even and odd ids)."""
    def side(k):
        return {"formation": {"lineup": [{"playerId": p, "goals": "0"} for p in squad if p % 2 == k], "bench": [], "substitutions": []}}
    return json.dumps({"status": "Played", "wyId": match, "label": f"M{match}", "winner": 0, "arrival": arrival,
                       "dateutc": date or f"{D + dt.timedelta(days=day)} 15:00:00", "teamsData": {"1": side(0), "2": side(1)}})


def _event(match, player, seq, kind=8, tags=(1801,)):
    return json.dumps({"eventId": kind, "subEventId": kind * 10 + 1, "playerId": player, "matchId": match, "seq": seq,
                       "tags": [{"id": t} for t in tags]})


def _rows(df, *keys, digits=9):
    cols = [c for c in df.columns if c not in keys]
    return {tuple(r[k] for k in keys): tuple(round(r[c] + 3e-12, digits) if isinstance(r[c], float) else r[c] for c in cols)
            for r in df.select(*keys, *cols).collect()}


def _same_as_batch(spark, views, season):
    """All views against the batch operators over the season's events and matches."""
    facts = _facts.match_facts(_squads.participants(season.matches), _metrics.match_metrics(season.events))
    cols = ["match_id", "player_id", "minutes_played", "player_performance", "number_of_fouls"]
    assert _rows(views.facts().select(*cols), "match_id", "player_id") == _rows(facts.select(*cols), "match_id", "player_id")
    rated = _ratings.rating_history(facts, carry=("team_pos", "squad"))
    assert _rows(views.ratings().select(*rated.columns), "match_id", "player_id") == _rows(rated, "match_id", "player_id")
    players = season.players
    exact = _metrics.stream_pass_accuracy(season.events)
    assert _rows(views.pass_accuracy(), "player_id") == _rows(exact, "player_id")
    assert _rows(views.totals(players), "player_id") == _rows(_facts.player_totals(players, facts, exact), "player_id")
    assert _rows(views.chemistry(), "player_id_1", "player_id_2", digits=7) == _rows(_chem.player_chemistry(rated), "player_id_1", "player_id_2", digits=7)


def _season_files(spark, days_a_file):
    lines = testdata.stream_lines(spark, SF001).orderBy("day", "part", "ord").collect()
    files = {}
    for r in lines:
        files.setdefault(r.day // days_a_file, []).append(r.value)
    return [files[k] for k in sorted(files)]


def test_views_equal_batch_while_matches_freeze(spark, scratch):
    """Five batches: matches of the first weeks are frozen on the way, small parts merged."""
    from pitchmetrics.streaming import ingest as module
    old, module.COMPACT_PARTS = module.COMPACT_PARTS, 2
    try:
        views = _play(spark, scratch, _season_files(spark, 6), horizon_days=5, freeze_days=3)
    finally:
        module.COMPACT_PARTS = old
    assert views.commit.through is not None and all(len(p) <= 3 for p in views.commit.parts.values())
    _same_as_batch(spark, views, Season.from_testdata(spark, SF001))
    # what a batch carries on are the open matches only
    hot = {r.match_date for r in views.store.hot(views.commit, "records").select("match_date").distinct().collect()}
    assert min(hot) > dt.date.fromisoformat(views.commit.through)
    assert views.metrics().select("match_id").distinct().count() == len(hot)
    kept = sorted(os.listdir(os.path.join(scratch, "store", "hot")))
    assert len(kept) == 3


def test_views_equal_batch_in_any_order(spark, scratch):
    """Lines of the season in random batches, some twice: closed again and again, and late."""
    rng = random.Random(5)
    lines = [line for file in _season_files(spark, 30) for line in file]
    records = [x for x in lines if '"status"' in x]
    rng.shuffle(lines)
    files = [lines[k::3] for k in range(3)] + [rng.sample(records, 20)]
    views = _play(spark, scratch, files, horizon_days=None)
    assert views.commit.through is None and views.waiting().count() == 0
    _same_as_batch(spark, views, Season.from_testdata(spark, SF001))


def test_the_life_of_a_match(spark, scratch):
    """A match without a record, late events before and after freezing, a late record, a
    moved and a malformed date, a player who leaves the squad."""
    squad = [2, 3, 4, 5]
    views = _play(spark, scratch, [
        [_record(1, 0, squad), _event(1, 2, 1), _event(77, 3, 1), "no json"],
        [_event(1, 2, 2, tags=(1802,)), _record(2, 3, squad, date="someday"), _record(3, 3, squad)],
        [_record(3, 3, [2, 3], arrival=1), _record(2, 4, squad)],
    ], horizon_days=10, freeze_days=1)
    facts = {(r.match_id, r.player_id): r.pass_accuracy for r in views.facts().collect()}
    assert facts[("1", "2")] == 0.5                                     # a late event closed the match again
    assert {k for k in facts if k[0] == "3"} == {("3", "2"), ("3", "3")}  # players 4 and 5 are gone
    assert {k for k in facts if k[0] == "2"} == {("2", str(p)) for p in squad}
    assert {r.player_id for r in views.ratings().filter("match_id = '3'").collect()} == {"2", "3"}
    assert [r.match_id for r in views.waiting().collect()] == ["77"] and views.orphans().count() == 0
    assert sorted(r.kind for r in ingest.stored_table(spark, os.path.join(scratch, "store"), "rejects").collect()) == ["corrupt", "undated"]

    views = _play(spark, scratch, [
        [_record(10, 20, squad), _event(10, 2, 1)],                      # freezes all days up to 10
        [_event(1, 2, 3), _event(1, 3, 1), _record(4, 1, squad), _record(1, 0, [2], arrival=9)],
        [_record(11, 40, squad)],
    ], horizon_days=10, freeze_days=1)
    assert views.commit.through == str(D + dt.timedelta(days=30))
    facts = {(r.match_id, r.player_id): r.pass_accuracy for r in views.facts().collect()}
    assert facts[("1", "2")] == 0.5 and ("4", "2") not in facts and ("11", "2") in facts
    assert {(r.match_id, r.arrival) for r in views.late_records().collect()} == {("4", 0), ("1", 9)}
    assert {(r.match_id, r.player_id, r.n_pass_events) for r in views.orphans().collect()} == {("77", "3", 1), ("1", "2", 1), ("1", "3", 1)}
    assert views.waiting().count() == 0 and len(os.listdir(os.path.join(scratch, "store", "hot"))) == 3
    # in full from the archive
    players, teams = testdata.players(spark, SF001), testdata.teams(spark, SF001)
    full = ingest.season_from_store(spark, os.path.join(scratch, "store"), players, teams, include_late=True)
    assert {(r.match_id, r.player_id): round(r.pass_accuracy, 6) for r in full.match_facts.collect()}[("1", "2")] == round(2 / 3, 6)
    assert full.match_facts.filter("match_id = '4'").count() == 4


def test_readers_see_whole_batches(spark, scratch):
    """Without its commit a batch does not exist; a replay of a committed batch does nothing."""
    views = _play(spark, scratch, [[_record(1, 0, [2, 3]), _event(1, 2, 1)], [_record(2, 1, [2, 3])]])
    root = os.path.join(scratch, "store")
    assert views.commit.batch == 1
    before = _rows(views.facts(), "match_id", "player_id")
    run = ingest.handle_batch(root)
    again = spark.createDataFrame([(_record(2, 1, [2, 3, 4, 5], arrival=5),)], "value string")
    run(again, 1)
    assert _rows(LiveViews(spark, root).facts(), "match_id", "player_id") == before
    # a batch that fails before its commit leaves no trace, and can be run again
    publish = Store.publish
    try:
        def fail(self, commit):
            raise OSError("lost")
        Store.publish = fail
        with pytest.raises(OSError):
            run(again, 2)
    finally:
        Store.publish = publish
    assert _rows(LiveViews(spark, root).facts(), "match_id", "player_id") == before
    run(again, 2)
    assert {k[1] for k in _rows(LiveViews(spark, root).facts(), "match_id", "player_id") if k[0] == "2"} == {"2", "3", "4", "5"}
    # another checkpoint must not write into this store
    lines = ingest.record_stream(spark, os.path.join(scratch, "in"))
    q = ingest.start_ingest(lines, root, os.path.join(scratch, "other"), available_now=True)
    with pytest.raises(Exception, match="another query"):
        q.awaitTermination(300)
    fresh = LiveViews(spark, os.path.join(scratch, "none"))
    assert fresh.facts().count() == fresh.metrics().count() == fresh.chemistry().count() == fresh.pass_accuracy().count() == 0


def test_pass_segments_merge_at_any_cut(spark):
    ev = testdata.events(spark, SF001)
    want = _rows(_metrics.stream_pass_sums(ev), "match_id", "player_id")
    for width in (1, 7, 100_000):
        segments = _metrics.pass_segments(ev, width)
        assert _rows(_metrics.stream_pass_sums(ev, width), "match_id", "player_id") == want
    # merging merged segments: halves first, then the two halves
    segments = _metrics.pass_segments(ev, 10).withColumn("half", (F.col("bucket") >= 50).cast("int"))
    halves = _metrics.merge_pass_segments(segments, keys=("match_id", "player_id", "half"))
    once = _metrics.merge_pass_segments(halves, "half")
    assert _rows(once, "match_id", "player_id") == _rows(_metrics.merge_pass_segments(segments), "match_id", "player_id")


def _plain_ratings(facts):
    out, last = {}, {}
    for player, day, match in sorted(facts):
        old = last.get(player, 0.5)
        last[player] = (old + facts[(player, day, match)]) / 2
        out[(player, match)] = (old, last[player])
    return out


def _close(got, want):
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-12)


def test_rating_history_is_corrected():
    """Random facts, again, moved and taken back: always the plain fold."""
    rng = random.Random(9)
    history, truth, seen, text = live.History(), {}, {}, None
    for version in range(300):
        match = f"m{rng.randrange(40)}"
        day = rng.randrange(19_000, 19_200)
        perf = None if rng.random() < 0.15 else rng.uniform(-1, 1)
        for d, m, old, new in history.change([(day, match, perf, version)]):
            seen[m] = (old, new)
        truth.pop(match, None)
        if perf is not None:
            truth[match] = (day, perf)
        plain = _plain_ratings({("p", d, m): v for m, (d, v) in truth.items()})
        _close({m: r for m, r in seen.items() if r[1] is not None}, {k[1]: v for k, v in plain.items()})
        text = history.text()
        history = live.History(text)
    assert history.change([(19_000, "m1", 0.3, -1)] if "m1" in truth else []) == []  # an older version changes nothing
    link_only = live.History(text)
    assert link_only.change([(20_000, "new", 0.1, 999)])[0][:2] == (20_000, "new")


def test_live_ratings_with_late_repeated_and_removed_facts(spark, scratch):
    facts = [("a", 0, "m1", 0.4), ("a", 3, "m2", 0.1), ("b", 3, "m2", 0.7), ("a", 40, "m5", 0.9), ("b", 40, "m5", 0.2)]
    files = [[(*f, 0, False) for f in facts],
             [("a", 20, "m3", 0.6, 1, False)],                                         # late
             [("a", 3, "m2", 0.1, 0, False), ("b", 3, "m2", 0.7, 0, False)],           # again, equal
             [("a", 3, "m2", 0.3, 2, False), ("b", 3, "m2", 0.0, 2, True)],            # closed again: corrected, taken back
             [("a", 3, "m2", 0.8, 1, False)]]                                          # an older version
    src = os.path.join(scratch, "facts")
    schema = "player_id string, day int, match_id string, player_performance double, version long, removed boolean"
    for k, rows in enumerate(files):
        df = spark.createDataFrame(rows, schema).withColumn("match_date", F.date_add(F.lit(D), F.col("day")))
        df.coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).option("maxFilesPerTrigger", 1).parquet(src)
    out = os.path.join(scratch, "out")
    q = (live.live_ratings(stream).writeStream.outputMode("append").foreachBatch(lambda b, i: b.write.parquet(f"{out}/batch_id={i}"))
         .option("checkpointLocation", os.path.join(scratch, "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(600)
    assert q.exception() is None
    got = {(r.player_id, r.match_id): (r.old_rating, r.rating) for r in live.current_ratings(spark.read.parquet(out)).collect()}
    want = {("a", D, "m1"): 0.4, ("a", D + dt.timedelta(days=3), "m2"): 0.3, ("a", D + dt.timedelta(days=20), "m3"): 0.6,
            ("a", D + dt.timedelta(days=40), "m5"): 0.9, ("b", D + dt.timedelta(days=40), "m5"): 0.2}
    _close(got, _plain_ratings(want))
