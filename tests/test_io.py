"""Sources and sinks: CSV dimension files, request documents, nested JSON exports,
and the two-job flow (write derived tables, answer requests from them)."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from pitchmetrics.operators import clustering
from pitchmetrics.plans import jobs
from pitchmetrics.plans.season import Season
from pitchmetrics.sinks import writers
from pitchmetrics.sources import files, requests as reqsrc
from pitchmetrics.streaming import answers


def test_requests_as_a_stream(spark, scratch):
    """Any cut into micro-batches, a restart and a line that comes again give the answers of the table."""
    import json
    s = Season.from_testdata(spark, SF001)
    tables = os.path.join(scratch, "tables")
    jobs.build_season_tables(s, tables)
    lines = ["no request"]
    for r in s.requests.filter("request_id % 10 <> 4 or request_id < 300").collect():
        doc = {"request_id": r.request_id, "name": r.name, "label": r.label, "date": str(r.date) if r.date else None, "team1": r.team1, "team2": r.team2,
               "req_type": {"forecast": 1, "profile": 2, "match": None}[r.request_kind]}
        lines.append(json.dumps({k: v for k, v in doc.items() if v is not None}))
    src, out = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    os.makedirs(src)

    def feed(name, part):
        with open(os.path.join(src, name), "w") as f:
            f.write("\n".join(part) + "\n")
        stream = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(src)
        q = answers.start_answers(stream, tables, s.players, s.teams, out, os.path.join(scratch, "ckpt"), availableNow=True)
        q.awaitTermination(600)
        assert q.exception() is None

    feed("a", lines[::2])
    feed("b", lines[1::2] + lines[:10])
    whole = jobs.answer_requests(jobs.stored_season(spark, tables, s.players, s.teams, reqsrc.requests_from_lines(spark.createDataFrame([(x,) for x in lines], "value string"))))
    for kind in answers.KINDS:
        got = answers.stored_answers(spark, out, kind)
        got, want = ({r.request_id: r for r in df.select(*whole[kind].columns).collect()} for df in (got, whole[kind]))
        assert got.keys() == want.keys()
        for rid, r in want.items():
            assert tuple(got[rid]) == tuple(pytest.approx(v, abs=1e-9) if isinstance(v, float) else v for v in r), kind


def test_players_and_teams_csv(spark, scratch):
    p = os.path.join(scratch, "players.csv")
    with open(p, "w") as f:
        f.write("Id,name,role,foot,birthDate,birthArea,passportArea,height,weight\n")
        f.write("7,Ann,GK,right,1990-05-01,X,Y,180,null\n")
        f.write("8,Bob,DF,left,unknown,X,Y,tall,70\n")
    t = os.path.join(scratch, "teams.csv")
    with open(t, "w") as f:
        f.write("Id,name\n12,Reds\n")
    r, bob = files.read_players_csv(spark, p).collect()
    assert (bob.birth_date, bob.height, bob.weight) == (None, None, 70)
    assert (r.player_id, r.role, str(r.birth_date), r.height, r.weight) == ("7", "GK", "1990-05-01", 180, None)
    assert files.read_teams_csv(spark, t).collect()[0].asDict() == {"team_id": "12", "name": "Reds"}


def test_request_documents_are_routed(spark, scratch):
    p = os.path.join(scratch, "req.jsonl")
    with open(p, "w") as f:
        f.write('{"req_type":1,"date":"2024-02-15","team1":{"name":"A","p1":"x"},"team2":{"name":"B"}}\n')
        f.write('{"req_type":2,"name":"Ann"}\n')
        f.write('{"label":"T1 - T2 #0"}\n')
        f.write('{"req_type":7}\n')
        f.write('not json\n\n  \n[1]\n{"req_type":"x"}\n')
    kinds = sorted(r.request_kind for r in reqsrc.read_requests(spark, p).collect())
    assert kinds == ["forecast", "ignored", "match", "profile", "rejected", "rejected", "rejected"]


def test_equal_lines_bad_dates_and_broken_lines(spark):
    """Each has its stated answer and none changes the answers of the others."""
    s = Season.from_testdata(spark, SF001).cut("match_facts", "ratings", "match_counts", "chemistry", "player_totals", "cluster_centres")
    ok = s.requests.filter("request_id = 0").collect()[0]
    import json
    plain = {"req_type": 1, "date": "2024-02-15", "team1": ok.team1, "team2": ok.team2}
    lines = [json.dumps({**plain, "request_id": 1}), json.dumps(plain), json.dumps(plain), json.dumps({**plain, "request_id": 2, "date": "tomorrow"}),
             json.dumps({"req_type": 2, "name": "nobody", "request_id": 3}), json.dumps({"req_type": 2, "name": "a", "request_id": 3}), "{broken",
             json.dumps({**plain, "request_id": 4, "date": None})]
    reqs = reqsrc.requests_from_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    season = Season(events=None, matches=s.matches, players=s.players, teams=s.teams, requests=reqs)
    for t in ("match_facts", "ratings", "match_counts", "chemistry", "player_totals", "cluster_centres"):
        season.__dict__[t] = getattr(s, t)
    given = jobs.answer_requests(season)
    forecasts = {r.request_id: r for r in given["forecasts"].collect()}
    assert len(forecasts) == 4 and forecasts[2].result == forecasts[4].result == "Invalid"
    again = next(r for i, r in forecasts.items() if i not in (1, 2, 4))
    assert again.result == forecasts[1].result == "ok" and again.chance1 == pytest.approx(forecasts[1].chance1)
    assert [(r.request_id, r.error) for r in given["profiles"].collect()] == [(3, "Invalid")]
    assert [r.error for r in given["rejected"].collect()] == ["Invalid"]
    s.discard()


def test_nested_exports_round_trip(spark, scratch):
    r = spark.createDataFrame([("7", "m1", 0.25)], "player_id string, match_id string, rating double") \
        .withColumn("match_date", F.to_date(F.lit("2024-01-02")))
    writers.write_ratings(r, os.path.join(scratch, "ratings"))
    back = files.read_rating_export(spark, os.path.join(scratch, "ratings")).collect()[0]
    assert (back.player_id, str(back.match_date), back.rating) == ("7", "2024-01-02", 0.25)
    c = spark.createDataFrame([("1", "2", 0.7)], "player_id_1 string, player_id_2 string, chemistry double")
    writers.write_chemistry(c, os.path.join(scratch, "chem"))
    assert files.read_chemistry_export(spark, os.path.join(scratch, "chem")).collect()[0].chemistry == 0.7


def test_two_job_flow_answers_from_stored_tables(spark, scratch):
    s = Season.from_testdata(spark, SF001)
    paths = jobs.build_season_tables(s, os.path.join(scratch, "tables"))
    assert set(paths) == set(jobs.TABLES)
    stored = jobs.stored_season(spark, os.path.join(scratch, "tables"), s.players, s.teams, s.requests)
    given = jobs.answer_requests(stored, group_col="role")
    fresh = Season.from_testdata(spark, SF001)
    assert given["profiles"].count() == fresh.profiles.count()
    a = {r.request_id: r.chance1 for r in given["forecasts"].collect()}
    b = {r.request_id: r.chance1 for r in fresh.forecasts("role").collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert (a[k] is None and b[k] is None) or abs(a[k] - b[k]) < 1e-9
    # clusters come from the stored model, no fit is run
    got = jobs.answer_requests(stored)["forecasts"].collect()
    assert any(r.chance1 is not None for r in got) and {r.request_id for r in got} == set(b)
    assert {r.player_id: r.prediction for r in stored.clusters.collect()} == {
        r.player_id: r.prediction for r in clustering.player_clusters(stored.player_totals).collect()}
    jobs.write_answers(given, os.path.join(scratch, "answers"))
    assert spark.read.json(os.path.join(scratch, "answers", "matches")).count() == given["matches"].count()
