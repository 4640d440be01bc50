"""Hand-computed cases (FIXTURES.md §3): one per metric branch and per decision."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitchmetrics import schemas
from pitchmetrics.operators import chemistry, facts, matches, metrics, ratings, regression, requests, squads
from pitchmetrics.sources import records

D = dt.date(2024, 1, 1)


def ev(spark, rows):
    """rows: (seq, player_id, event_id, sub_event_id, [tag ids]) in match 'm1'."""
    data = [("m1", s, p, e, se, [(t,) for t in tags]) for s, p, e, se, tags in rows]
    return spark.createDataFrame(data, schemas.EVENTS)


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def test_f1_pass_accuracy(spark):
    e = ev(spark, [(1, "7", 8, 81, [302, 1801]), (2, "7", 8, 81, [302, 1802]),
                   (3, "7", 8, 81, [1801]), (4, "7", 8, 81, [1802])])
    assert one(metrics.match_metrics(e)).pass_accuracy == pytest.approx(0.5)


def test_f2_f3_stream_pass_accuracy_depends_on_order(spark):
    e = ev(spark, [(1, "7", 8, 81, [302, 1801]), (2, "7", 8, 81, [302, 1802]),
                   (3, "7", 8, 81, [1801]), (4, "7", 8, 81, [1802])])
    r = one(metrics.stream_pass_accuracy(e))
    assert (r.numerator, r.denominator) == (10, 17)
    e = ev(spark, [(1, "7", 8, 81, [1802]), (2, "7", 8, 81, [1801]),
                   (3, "7", 8, 81, [302, 1802]), (4, "7", 8, 81, [302, 1801])])
    r = one(metrics.stream_pass_accuracy(e))
    assert (r.numerator, r.denominator) == (5, 13)


def test_stream_pass_accuracy_buckets_are_exact(spark):
    # the same passes spread over many seq buckets give the same running sums
    rows = [(i * 1000, "7", 8, 81, [302, 1801] if i % 3 == 0 else ([1802] if i % 2 else [1801]))
            for i in range(1, 60)]
    e = ev(spark, rows)
    a = one(metrics.stream_pass_sums(e, bucket_width=4096))
    b = one(metrics.stream_pass_sums(e, bucket_width=1000))
    n, d, rn, rd = 0, 0, 0, 0
    for _, _, _, _, tags in rows:
        key, acc = 302 in tags, 1801 in tags
        n += 2 if key and acc else (1 if acc else 0)
        d += 2 if key else 1
        rn, rd = rn + n, rd + d
    assert (a.running_numerator, a.running_denominator) == (rn, rd)
    assert (b.running_numerator, b.running_denominator) == (rn, rd)


def test_f4_f5_pass_edge_cases(spark):
    assert one(metrics.match_metrics(ev(spark, [(1, "7", 8, 81, [1801, 1802])]))).pass_accuracy == 1.0
    assert one(metrics.match_metrics(ev(spark, [(1, "7", 8, 81, [302])]))).pass_accuracy == 0.0


def test_f6_duels(spark):
    e = ev(spark, [(1, "7", 1, 11, [703]), (2, "7", 1, 11, [702]), (3, "7", 1, 11, [701])])
    assert one(metrics.match_metrics(e)).duel_effectiveness == pytest.approx(0.5)


def test_f7_f8_free_kicks(spark):
    e = ev(spark, [(1, "7", 3, 31, [1801]), (2, "7", 3, 31, [1802])])
    assert one(metrics.match_metrics(e)).free_kick_effectiveness == pytest.approx(2 / 3)
    r = one(metrics.match_metrics(ev(spark, [(1, "7", 3, 35, [1801, 101])])))
    assert r.free_kick_effectiveness == pytest.approx(2.0)
    assert r.number_of_goals == 1


def test_f9_f10_shots(spark):
    e = ev(spark, [(1, "7", 10, 101, [101, 1801]), (2, "7", 10, 101, [1801]), (3, "7", 10, 101, [1802])])
    r = one(metrics.match_metrics(e))
    assert r.shot_effectiveness == pytest.approx(0.5)
    assert (r.no_of_shots_on_target, r.number_of_goals) == (2, 1)
    assert one(metrics.match_metrics(ev(spark, [(1, "7", 10, 101, [101, 1802])]))).shot_effectiveness == 0.5


def test_f11_f12_f13_fouls_own_goals_system_player(spark):
    r = one(metrics.match_metrics(ev(spark, [(1, "7", 2, 21, []), (2, "7", 8, 81, [])])))
    assert (r.number_of_fouls, r.pass_accuracy) == (1, 0.0)
    assert one(metrics.match_metrics(ev(spark, [(1, "7", 5, 51, [102])]))).number_of_own_goals == 1
    assert metrics.match_metrics(ev(spark, [(1, "0", 1, 11, [703])])).count() == 0


def _facts_for(spark, minutes, pa, de, fk, sot, fouls=0, own=0):
    part = spark.createDataFrame([("m1", D, 0, "t", "7", "lineup", 0, minutes, 0, 0, 0, 0)],
                                 "match_id string, match_date date, team_pos int, team_id string, player_id string, "
                                 "squad string, squad_index int, minutes_played int, goals int, own_goals int, "
                                 "yellow_cards int, red_cards int")
    met = spark.createDataFrame([("m1", "7", pa, de, fk, 0.0, fouls, own, sot, 0)],
                                "match_id string, player_id string, pass_accuracy double, duel_effectiveness double, "
                                "free_kick_effectiveness double, shot_effectiveness double, number_of_fouls bigint, "
                                "number_of_own_goals bigint, no_of_shots_on_target bigint, number_of_goals bigint")
    return one(facts.match_facts(part, met))


def test_f14_f17_contribution_and_performance(spark):
    r = _facts_for(spark, 90, 0.5, 0.5, 0.0, 2)
    assert r.player_contribution == pytest.approx(0.7875)
    r = _facts_for(spark, 90, 0.5, 0.5, 0.0, 2, fouls=2, own=1)
    assert r.player_performance == pytest.approx(0.7365)
    assert _facts_for(spark, 45, 0.5, 0.5, 0.0, 2).player_contribution == pytest.approx(0.375)
    assert _facts_for(spark, 0, 0.5, 0.5, 0.0, 2).player_contribution == 0.0


def _match(spark, lineup1, bench1, subs1, lineup2=(), bench2=(), subs2=()):
    def p(i, goals="0"):
        return (i, goals, "0", "0", "0")
    td = {"1": ((([p(i) for i in lineup1]), [p(i) for i in bench1], list(subs1)),),
          "2": ((([p(i) for i in lineup2]), [p(i) for i in bench2], list(subs2)),)}
    return spark.createDataFrame([("m1", "L", D, "Regular", "0", "V", 1, td)], schemas.MATCHES)


def test_f15_f16_minutes_last_write_wins(spark):
    m = _match(spark, [1, 2, 3], [4, 5, 6], [(4, 2, 60), (5, 1, 90), (6, 3, 93), (8, 4, 80)])
    got = {r.player_id: (r.minutes_played, r.squad) for r in squads.participants(m).collect()}
    # 4 in at 60 then out at 80 -> 80; 1 out at 90 -> 90; 6 in at 93 -> -3; 8 named only in a sub
    assert got["4"] == (80, "bench")
    assert got["1"] == (90, "lineup")
    assert got["6"] == (-3, "bench")
    assert got["2"] == (60, "lineup")
    assert got["8"] == (10, "sub_only")


def test_f18_rating_recurrence(spark):
    f = spark.createDataFrame([("7", D + dt.timedelta(days=i), f"m{i}", p) for i, p in enumerate([0.4, 0.0, 1.2])],
                              "player_id string, match_date date, match_id string, player_performance double")
    got = [r.rating for r in ratings.rating_history(f).orderBy("match_date").collect()]
    assert got == pytest.approx([0.45, 0.225, 0.7125])


def test_rating_scan_spanning_partitions_matches_sequential_fold(spark):
    # a hot player (most rows), whose blocks are spread over the tasks, and small ones
    rows = []
    for i in range(1500):
        rows.append(("hot", D + dt.timedelta(days=i), f"h{i:05d}", ((i * 37) % 100) / 50.0 - 0.5))
    for p in range(30):
        for i in range(7):
            rows.append((f"p{p:02d}", D + dt.timedelta(days=i), f"x{i}", ((p * 7 + i) % 13) / 10.0))
    f = spark.createDataFrame(rows, "player_id string, match_date date, match_id string, player_performance double")
    got = {(r.player_id, r.match_id): (r.old_rating, r.rating)
           for r in ratings.rating_history(f).collect()}
    expected = {}
    by_player = {}
    for r in rows:
        by_player.setdefault(r[0], []).append(r)
    for pid, rs in by_player.items():
        x = 0.5
        for _, d, mid, perf in sorted(rs, key=lambda r: (r[1], r[2])):
            expected[(pid, mid)] = (x, (x + perf) / 2)
            x = (x + perf) / 2
    assert len(got) == len(expected)
    for k, (old, new) in expected.items():
        assert got[k][0] == pytest.approx(old, abs=1e-12)
        assert got[k][1] == pytest.approx(new, abs=1e-12)


def test_f19_chemistry_signs(spark):
    part = spark.createDataFrame(
        [("m1", D, 0, "a", "1", "lineup", 0, 90, 0, 0, 0, 0), ("m1", D, 0, "a", "2", "lineup", 1, 90, 0, 0, 0, 0),
         ("m1", D, 1, "b", "3", "lineup", 0, 90, 0, 0, 0, 0)],
        "match_id string, match_date date, team_pos int, team_id string, player_id string, squad string, "
        "squad_index int, minutes_played int, goals int, own_goals int, yellow_cards int, red_cards int")
    rt = spark.createDataFrame([("1", D, "m1", 0.5, 0.6, 0.1), ("2", D, "m1", 0.5, 0.8, 0.3),
                                ("3", D, "m1", 0.5, 0.8, 0.3)],
                               "player_id string, match_date date, match_id string, old_rating double, "
                               "rating double, change_in_rating double").join(part.select("player_id", "team_pos", "squad"), "player_id")
    c = {(r.player_id_1, r.player_id_2): r.chemistry for r in chemistry.player_chemistry(rt).collect()}
    assert c[("1", "2")] == pytest.approx(0.7)      # team-mates, same sign: +0.2
    assert c[("2", "1")] == pytest.approx(0.7)      # symmetric
    assert c[("1", "3")] == pytest.approx(0.3)      # opponents, same sign: -0.2
    rt2 = rt.withColumn("change_in_rating", F.when(F.col("player_id") == "1", -0.1).otherwise(F.col("change_in_rating")))
    c2 = {(r.player_id_1, r.player_id_2): r.chemistry for r in chemistry.player_chemistry(rt2).collect()}
    assert c2[("1", "2")] == pytest.approx(0.4)     # team-mates, opposite signs: -0.1


def test_f21_f22_regression(spark):
    t = spark.createDataFrame([("g", 1, 1.0), ("g", 2, 4.0), ("g", 3, 9.0), ("h", 5, 0.5)],
                              "k string, age int, rating double")
    fit = {r.k: r for r in regression.fit_quadratic(t, ["k"]).collect()}
    g = fit["g"]
    u = 4 - g.mean_age
    assert g.degree == 2
    assert g.b0 + g.b1 * u + g.b2 * u * u == pytest.approx(16.0)
    assert (fit["h"].degree, fit["h"].b0) == (0, 0.5)
    t2 = spark.createDataFrame([("g", 1, 1.0), ("g", 3, 3.0), ("g", 3, 5.0)], "k string, age int, rating double")
    g2 = one(regression.fit_quadratic(t2, ["k"]))
    assert g2.degree == 1


def test_f23_forecast_legacy_and_repaired(spark):
    req = spark.createDataFrame([(1, "forecast", None, None, D, {"name": "A"}, {"name": "B"})], schemas.REQUESTS)
    roles = spark.createDataFrame([(1, 1, True), (1, 2, True)], "request_id long, side int, request_valid boolean")
    chem = spark.createDataFrame([(1, 1, "s1", "x", 1.0), (1, 2, "s2", "y", 1.0)],
                                 "request_id long, side int, slot string, player_id string, chemistry_coefficient double")
    rat = spark.createDataFrame([(1, 1, "s1", 2.2), (1, 2, "s2", 1.1)],
                                "request_id long, side int, slot string, predicted_rating double")
    r = one(requests.forecasts(req, roles, chem, rat))
    assert (r.chance1, r.chance2) == (pytest.approx(55.0), pytest.approx(45.0))
    r = one(requests.forecasts(req, roles, chem, rat, legacy=True))
    assert (r.chance1, r.chance2) == (pytest.approx(60.0), pytest.approx(40.0))


def test_f24_goal_counts_with_null_text(spark):
    td = {"1": (([(1, "null", "0", "0", "0"), (2, "2", "0", "0", "0"), (3, "0", "0", "0", "0")], [], []),)}
    m = spark.createDataFrame([("m1", "L", D, "Regular", "0", "V", 1, td)], schemas.MATCHES)
    got = {r.player_id: r.goals for r in squads.squad_entries(m).collect()}
    assert got == {"1": 0, "2": 2, "3": 0}


def test_f25_record_routing(spark):
    lines = spark.createDataFrame([('{"status":"Played","wyId":5}',), ('{"eventId":8,"playerId":3,"matchId":5}',),
                                   ('{"foo":1}',), ("not json",)], "value string")
    kinds = sorted(r.kind for r in records.parse_records(lines).collect())
    assert kinds == ["corrupt", "event", "match", "other"]


def test_f26_unknown_profile_and_lineup_validity(spark):
    req = spark.createDataFrame([(1, "profile", "Nobody", None, None, None, None)], schemas.REQUESTS)
    tot = spark.createDataFrame([("9", "Somebody")], "player_id string, name string")
    cols = [F.lit(None).cast("string").alias(c) for c in ("role", "foot", "birth_area", "passport_area")]
    tot = tot.select("player_id", "name", *cols, F.lit(None).cast("date").alias("birth_date"),
                     *[F.lit(0).alias(c) for c in ("height", "weight", "number_of_fouls", "number_of_goals",
                                                   "number_of_own_goals", "number_of_matches",
                                                   "number_of_shots_on_target")],
                     F.lit(0.0).alias("pass_accuracy"))
    assert one(requests.player_profiles(req, tot)).error == "Invalid"


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_ratings_do_not_depend_on_exchange_reuse_or_block_length(spark, reuse):
    rows = [(f"p{i % 7}" if i % 3 else "hot", D + dt.timedelta(days=(i * 11) % 400), f"m{i:04d}", ((i * 37) % 100) / 50.0 - 0.5)
            for i in range(1200)]
    f = spark.createDataFrame(rows, "player_id string, match_date date, match_id string, player_performance double")
    want, last = {}, {}
    for player, day, match, perf in sorted(rows):
        want[(player, match)] = last[player] = (last.get(player, 0.5) + perf) / 2
    old = spark.conf.get("spark.sql.exchange.reuse")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        for days in (1, 16, 1000):
            got = {(r.player_id, r.match_id): r.rating for r in ratings.rating_history(f.repartition(5), block_days=days).collect()}
            assert got == pytest.approx(want, abs=1e-12)
    finally:
        spark.conf.set("spark.sql.exchange.reuse", old)


def test_points_without_an_age_do_not_bend_a_fit(spark):
    points = [("g", x, 0.5 + 0.1 * x) for x in (1, 2, 3, 4)]
    fits = [one(regression.fit_quadratic(spark.createDataFrame(rows, "k string, age int, rating double"), ["k"]))
            for rows in (points, [*points, ("g", None, 9.0), ("g", 3, None)])]
    for fit in fits:
        assert (fit.n_points, fit.degree) == (4, 2)
        assert (fit.b0, fit.b1) == (pytest.approx(0.75), pytest.approx(0.1)) and abs(fit.b2) < 1e-12


def _lineup_case(spark, team2, ratings_):
    """A request of two sides of seven players, all pairs without history."""
    people = [(f"{s}{i}", f"n{s}{i}", role) for s in (1, 2) for i, role in enumerate(["GK", "DF", "DF", "MD", "MD", "FW", "FW"])]
    players = spark.createDataFrame([(*p, *[None] * 6) for p in people], schemas.PLAYERS)
    team1 = {"name": "A"} | {f"p{i}": f"n1{i}" for i in range(7)}
    req = spark.createDataFrame([(1, "forecast", None, None, D, team1, team2)], schemas.REQUESTS)
    lineups = requests.lineup_players(req, players)
    rated = lineups.join(spark.createDataFrame(ratings_, "player_id string, predicted_rating double"), "player_id")
    chem = lineups.filter("player_id is not null").select("request_id", "side", "slot", "player_id", F.lit(0.5).alias("chemistry_coefficient"))
    return req, lineups, chem, rated


@pytest.mark.parametrize("legacy", [False, True])
def test_empty_side_and_unrated_player(spark, legacy):
    full = {"name": "B"} | {f"p{i}": f"n2{i}" for i in range(7)}
    everyone = [(f"{s}{i}", 1.1) for s in (1, 2) for i in range(7)]
    cases = [(full, everyone, "ok"), ({"name": "B"}, everyone, "Invalid" if not legacy else "ok"), (full, everyone[1:], "Unrated"),
             (full | {"p9": "Nobody"}, everyone, "Invalid")]
    for team2, rated, want in cases:
        req, lineups, chem, slots = _lineup_case(spark, team2, rated)
        roles = requests.lineup_roles(req, lineups, legacy=legacy)
        sides = {r.side: (r.gk, r.df, r.md, r.fw, r.unknown) for r in roles.collect()}
        assert sides[1] == (1, 2, 2, 2, 0) and set(sides) == {1, 2}
        if len(team2) == 1:
            assert sides[2] == (0, 0, 0, 0, 0)
        r = one(requests.forecasts(req, roles, chem, slots, legacy=legacy))
        assert r.result == want and (r.chance1 is not None) == (want == "ok")


def test_last_record_of_a_match_counts(spark):
    def squad(goals):
        return {"1": (([(1, goals, "0", "0", "0")], [], []),)}
    rows = [("9", "old", D, "Regular", "0", "V", 1, squad("1"), 0), ("9", "new", D, "Regular", "1", "V", 1, squad("2"), 1)]
    players = spark.createDataFrame([("1", "Ann", "GK", *[None] * 6)], schemas.PLAYERS)
    teams = spark.createDataFrame([("1", "Reds")], schemas.TEAMS)
    for order in (rows, rows[::-1]):
        m = spark.createDataFrame(order, schemas.MATCH_RECORDS)
        d = one(matches.match_details(m, players, teams))
        assert (d.label, d.winner, [(g.player_name, g.number_of_goals) for g in d.goals]) == ("new", "Reds", [("Ann", 2)])
        p = squads.participants(m)
        assert one(p).goals == 2
        assert one(matches.match_summary(p, m, teams)).asDict()["winner"] == "Reds"


def test_fits_from_merged_moments(spark):
    """Any split of the rows, merged, gives numpy's coefficients; ages far from zero and over decades."""
    import numpy as np
    rng = np.random.default_rng(4)
    rows = []
    for k, (lo, hi, n) in {"narrow": (12_000, 12_003, 60), "wide": (6_000, 15_000, 80), "two": (9_000, 9_001, 9), "one": (8_191, 8_191, 4),
                           "negative": (-70, 70, 30), "few": (64, 66, 12)}.items():
        ages = rng.integers(lo, hi, n, endpoint=True)
        rows += [(k, int(a), float(0.4 + 1e-4 * (a - lo) - 1e-7 * (a - lo) ** 2 + 0.01 * rng.standard_normal())) for a in ages]
    df = spark.createDataFrame(rows, "k string, age int, rating double")
    parts = [regression.age_moments(df.filter(F.pmod(F.xxhash64("age", "rating"), F.lit(3)) == i), ["k"]) for i in range(3)]
    merged = regression.merge_moments(parts[0].unionByName(parts[1]).unionByName(parts[2]), ["k"])
    whole = {r.k: r for r in regression.fit_quadratic(df, ["k"]).collect()}
    for r in regression.fit_from_moments(merged, ["k"]).collect():
        x = np.array([a for k, a, _ in rows if k == r.k], float)
        y = np.array([v for k, _, v in rows if k == r.k])
        assert r.degree == min(2, len(set(x)) - 1) == whole[r.k].degree and r.mean_age == pytest.approx(x.mean())
        want = np.polynomial.polynomial.polyfit(x - x.mean(), y, r.degree)
        at = np.array([r.b0, r.b1, r.b2])
        grid = np.linspace(x.min(), x.max(), 7) - x.mean()
        assert np.polynomial.polynomial.polyval(grid, at) == pytest.approx(np.polynomial.polynomial.polyval(grid, want), abs=1e-8)
        assert at == pytest.approx([whole[r.k].b0, whole[r.k].b1, whole[r.k].b2], rel=1e-6, abs=1e-9)


def test_malformed_dates_are_null(spark):
    lines = spark.createDataFrame([('{"status":"Played","wyId":5,"dateutc":"unknown"}',), ('{"status":"Played","wyId":6,"dateutc":"2024-01-02 15:00:00"}',),
                                   ('{"status":"Played","wyId":7}',)], "value string")
    got = {r.match_id: r.match_date for r in records.matches_from_records(records.parse_records(lines)).collect()}
    assert got == {"5": None, "6": dt.date(2024, 1, 2), "7": None}


def test_lloyd_rounds_from_given_centres(spark):
    """Against plain rounds: ties go to the first centre, an empty cluster keeps its centre."""
    from pitchmetrics.operators import clustering
    import random
    rng = random.Random(1)
    points = [(f"p{i}", 1, None, *[float(rng.randrange(6)) for _ in clustering.FEATURES]) for i in range(60)]
    df = spark.createDataFrame(points, "player_id string, number_of_matches int, birth_date date, "
                               + ", ".join(f"{f} double" for f in clustering.FEATURES))
    start = [list(p[3:]) for p in points[:3]] + [[99.0] * 5]
    centres = [list(c) for c in start]

    def near(p):
        return min(range(len(centres)), key=lambda i: (round(sum((a - b) ** 2 for a, b in zip(p, centres[i])), 6), i))
    for _ in range(4):
        owner = [near(p[3:]) for p in points]
        centres = [[sum(v) / len(v) for v in zip(*[p[3:] for p, o in zip(points, owner) if o == i])] if i in owner else c for i, c in enumerate(centres)]
    got = clustering.fit_centres(df, centres=start, rounds=4)
    assert [[r[f] for f in clustering.FEATURES] for r in sorted(got.collect())] == [pytest.approx(c) for c in centres]
    assigned = {r.player_id: r.prediction for r in clustering.assign(df, got).collect()}
    assert assigned == {p[0]: near(p[3:]) for p in points}
    same = clustering.fit_centres(df.repartition(5), k=3)
    assert sorted(map(tuple, same.collect())) == [pytest.approx(t) for t in sorted(map(tuple, clustering.fit_centres(df.coalesce(1), k=3).collect()))]
    one = spark.createDataFrame([points[0]], df.schema)
    assert clustering.fit_centres(one).count() == 1 and clustering.fit_centres(df.limit(0)).count() == 0
    assert clustering.assign(df.limit(0), clustering.fit_centres(df.limit(0))).count() == 0
