"""Adapter from the driver's generated tables to the canonical football tables.

The driver ships TPC-H-like tables plus an ``events`` table; this module derives,
with DataFrame operations only, a football season from them (FIXTURES.md §2):

* ``events``   one event per driver event: match = (day, group of 15 users),
               type and tags from ``props.k``;
* ``matches``  one nested match record per (day, group) with events, squads from the
               group's 15 players, one substitution per team; every fifth match has an
               earlier record too, which the later one replaces;
* ``players``  one player per customer, most of whom never play; some have no birth date;
* ``teams``    two teams per group of customers;
* ``requests`` forecast, profile and match-lookup requests derived from the above, some
               of them twice.

The same rules are written a second time, independently, as DuckDB SQL in
``pitchmetrics.plans.oracle``; the two must agree.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes as C

EPOCH = "2024-01-01"            # day 0 of the season
GROUP_SIZE = 15                 # users per group: one group = two teams
FORECAST_DATE = "2024-02-15"    # date of every generated forecast request
SEASON_DAYS = 100_000           # more days than any season has: match id = group * this + day
NO_BIRTH_DATE = (97, 12)        # customers with this remainder have no birth date; 12 plays at every size
REPEATED = (5, 0)               # matches with this remainder of group + day have an earlier record
# request id = key * REQUEST_KINDS + kind: ids of different kinds cannot meet
REQUEST_KINDS = 10
(FORECAST, FORECAST_NO_FORWARDS, FORECAST_EMPTY_SIDE, FORECAST_UNKNOWN, PROFILE, PROFILE_UNKNOWN, LOOKUP,
 LOOKUP_UNKNOWN, FORECAST_FULL, FORECAST_NO_DATE) = range(10)
SUBSTITUTE = 12                 # the position that a plain forecast leaves out
# positions of the sides of 11 of a full forecast: all of one group; of a group and the next one
FULL_SIDE = (0, 2, 3, 4, 5, 6, 7, 8, 9, 10, 12)
MIXED_SIDE = (1, 11, 13, 14)
MIXED_NEXT = (2, 3, 6, 7, 8, 9, 10)


def _plan_cache(fn):
    """Memoises the *plan* (DataFrame object) per (session, directory, ...): the test
    tables are read-only, so the file listing, schema read and analysis of the
    adapter are paid once per session.  No data is cached; every action re-reads."""
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(spark: SparkSession, *args):
        key = (id(spark), spark.sparkContext.applicationId, *args)
        if key not in cache:
            cache[key] = fn(spark, *args)
        return cache[key]
    return wrapper


@_plan_cache
def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _day(ts: str = "ts") -> Column:
    return F.datediff(F.to_date(ts), F.lit(EPOCH).cast("date"))


def _group(c: str) -> Column:
    return F.floor(F.col(c) / GROUP_SIZE).cast("bigint")


def _match_id(day: Column, group: Column) -> Column:
    return (group.cast("bigint") * SEASON_DAYS + day).cast("string")


def _request_id(key: Column, kind: int) -> Column:
    return (key.cast("bigint") * REQUEST_KINDS + kind).cast("bigint").alias("request_id")


@_plan_cache
def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical events (match_id, seq, player_id, event_id, sub_event_id, tags)."""
    ev = _table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "props")
    k = F.col("k")
    t = F.col("etype")
    tag_ids = F.array(
        F.when((t == C.EVENT_PASS) & (k % 10 == 0), F.lit(C.TAG_KEY_PASS)),
        F.when(((t == C.EVENT_PASS) & (k < 70)) | ((t == C.EVENT_FREE_KICK) & (k < 60))
               | ((t == C.EVENT_SHOT) & (k < 50)), F.lit(C.TAG_ACCURATE)),
        F.when(((t == C.EVENT_PASS) & (k >= 70)) | ((t == C.EVENT_FREE_KICK) & (k >= 60))
               | ((t == C.EVENT_SHOT) & (k >= 50)), F.lit(C.TAG_NOT_ACCURATE)),
        F.when((t == C.EVENT_DUEL) & (k < 33), F.lit(C.TAG_DUEL_LOST)),
        F.when((t == C.EVENT_DUEL) & (k >= 33) & (k <= 65), F.lit(C.TAG_DUEL_NEUTRAL)),
        F.when((t == C.EVENT_DUEL) & (k > 65), F.lit(C.TAG_DUEL_WON)),
        F.when(((t == C.EVENT_SHOT) & (k < 15))
               | ((t == C.EVENT_FREE_KICK) & (k % 5 == 0) & (k < 30)), F.lit(C.TAG_GOAL)),
        F.when(k == 99, F.lit(C.TAG_OWN_GOAL)),
    )
    tags = F.when(k == 98, F.array().cast("array<struct<id:int>>")).otherwise(
        F.transform(F.filter(tag_ids, lambda x: x.isNotNull()),
                    lambda x: F.struct(x.cast("int").alias("id"))))
    return (
        # a generated column: filters on what follows from k do not parse it again
        ev.select("*", F.explode(F.array(_k())).alias("k"))
        .withColumn("etype", F.when(F.col("event_type") == "view", C.EVENT_PASS)
                    .when(F.col("event_type") == "click", C.EVENT_DUEL)
                    .when(F.col("event_type") == "error", C.EVENT_FOUL)
                    .when(F.col("event_type") == "purchase", C.EVENT_FREE_KICK)
                    .when(F.col("event_type") == "signup", C.EVENT_SHOT).cast("int"))
        .select(
            _match_id(_day(), _group("user_id")).alias("match_id"),
            F.col("event_id").alias("seq"),
            F.when(k == 97, F.lit(C.SYSTEM_PLAYER_ID))
             .otherwise((F.col("user_id") + 1).cast("string")).alias("player_id"),
            t.alias("event_id"),
            F.when((t == C.EVENT_FREE_KICK) & (k % 5 == 0), F.lit(C.SUB_EVENT_PENALTY))
             .otherwise(t * 10 + 1).cast("int").alias("sub_event_id"),
            tags.alias("tags"),
        )
    )


@_plan_cache
def _roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All customers, with their group and squad position."""
    cust = _table(spark, sf_dir, "customer")
    return (cust.withColumn("g", _group("c_custkey"))
            .withColumn("pos", (F.col("c_custkey") % GROUP_SIZE).cast("int")))


@_plan_cache
def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical players (player_id, name, role, foot, birth_date, ..., height, weight)."""
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    pos = F.col("pos")
    # the bench player 14, who has no matches of his own, differs by group: so every role
    # has players on the group route, and some groups have two goalkeepers
    bench = F.when(F.col("g") % 4 == 1, "DF").when(F.col("g") % 4 == 2, "GK").otherwise("FW")
    role = (F.when(pos.isin(0, 1), "GK").when(pos.isin(2, 3, 4, 5, 11), "DF")
            .when(pos.isin(6, 7, 8, 12, 13), "MD").when(pos == 14, bench).otherwise("FW"))
    return (
        _roster(spark, sf_dir)
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            (F.col("c_custkey") + 1).cast("string").alias("player_id"),
            F.col("c_name").alias("name"),
            role.alias("role"),
            F.element_at(F.array(F.lit("right"), F.lit("left"), F.lit("both")),
                         (F.col("c_custkey") % 3 + 1).cast("int")).alias("foot"),
            F.when(F.col("c_custkey") % NO_BIRTH_DATE[0] != NO_BIRTH_DATE[1],
                   F.date_add(F.lit("1985-01-01").cast("date"),
                              ((F.col("c_custkey") * 37) % 5000).cast("int"))).alias("birth_date"),
            F.col("n_name").alias("birth_area"),
            F.col("n_name").alias("passport_area"),
            (F.col("c_custkey") % 30 + 165).cast("int").alias("height"),
            (F.col("c_custkey") % 25 + 60).cast("int").alias("weight"),
        )
    )


@_plan_cache
def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two teams per group: id ``2g + side + 1`` (0 stays free for a draw)."""
    tid = (F.col("g") * 2 + F.col("pos") % 2 + 1).cast("string")
    return (_roster(spark, sf_dir).select(tid.alias("team_id")).distinct()
            .select("team_id", F.concat(F.lit("Team "), F.col("team_id")).alias("name")))


@_plan_cache
def _match_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_table(spark, sf_dir, "events")
            .select(_day().alias("dn"), _group("user_id").alias("g")).distinct())


@_plan_cache
def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested match record per (day, group): teams_data map in side order,
    lineup (positions < 11) + bench, one substitution per side, winner by score."""
    days = _match_days(spark, sf_dir)
    roster = _roster(spark, sf_dir).select("c_custkey", "g", "pos")
    uid, dn, pos = F.col("c_custkey"), F.col("dn"), F.col("pos")
    goal = ((uid + dn) % 7 == 0)
    own = ((uid * 3 + dn) % 41 == 0)
    entry = F.struct(
        (uid + 1).cast("bigint").alias("playerId"),
        F.when(goal, "1").when(pos % 2 == 1, "null").otherwise("0").alias("goals"),
        F.when(own, "1").otherwise("0").alias("ownGoals"),
        F.when((uid + 2 * dn) % 11 == 0, "1").otherwise("0").alias("yellowCards"),
        F.when((uid + 5 * dn) % 53 == 0, "1").otherwise("0").alias("redCards"),
    )
    per_side = (
        days.join(roster, "g")
        .withColumn("side", (pos % 2).cast("int"))
        .groupBy("dn", "g", "side")
        .agg(
            F.sort_array(F.collect_list(F.when(pos < 11, F.struct(pos.alias("p"), entry.alias("e"))))).alias("l"),
            F.sort_array(F.collect_list(F.when(pos >= 11, F.struct(pos.alias("p"), entry.alias("e"))))).alias("b"),
            F.max(F.when(pos.isin(11, 12), uid + 1)).alias("sub_in"),
            F.max(F.when(pos.isin(0, 1), uid + 1)).alias("sub_out"),
            F.sum(F.when(goal, 1).otherwise(0)).alias("n_goals"),
            F.sum(F.when(own, 1).otherwise(0)).alias("n_own"),
        )
        .withColumn("team_id", (F.col("g") * 2 + F.col("side") + 1).cast("string"))
        .withColumn("minute", (F.lit(45) + (F.col("dn") * 3) % 50).cast("int"))
        .withColumn("formation", F.struct(
            F.transform("l", lambda x: x["e"]).alias("lineup"),
            F.transform("b", lambda x: x["e"]).alias("bench"),
            F.when(F.col("sub_in").isNotNull() & F.col("sub_out").isNotNull(),
                   F.array(F.struct(F.col("sub_in").cast("bigint").alias("playerIn"),
                                    F.col("sub_out").cast("bigint").alias("playerOut"),
                                    F.col("minute").alias("minute"))))
            .otherwise(F.array().cast("array<struct<playerIn:bigint,playerOut:bigint,minute:int>>"))
            .alias("substitutions"),
        ))
    )
    side = F.col("side")
    per_match = per_side.groupBy("dn", "g").agg(
        F.sort_array(F.collect_list(F.struct("side", "team_id", "formation"))).alias("sides"),
        F.sum(F.when(side == 0, F.col("n_goals"))).alias("g0"),
        F.sum(F.when(side == 1, F.col("n_goals"))).alias("g1"),
        F.sum(F.when(side == 0, F.col("n_own"))).alias("o0"),
        F.sum(F.when(side == 1, F.col("n_own"))).alias("o1"),
    )
    score0 = F.coalesce(F.col("g0"), F.lit(0)) + F.coalesce(F.col("o1"), F.lit(0))
    score1 = F.coalesce(F.col("g1"), F.lit(0)) + F.coalesce(F.col("o0"), F.lit(0))
    g = F.col("g")
    last = per_match.select(
        _match_id(F.col("dn"), g).alias("match_id"),
        F.concat(F.lit("T"), (g * 2 + 1).cast("string"), F.lit(" - T"), (g * 2 + 2).cast("string"),
                 F.lit(" #"), F.col("dn").cast("string")).alias("label"),
        F.date_add(F.lit(EPOCH).cast("date"), F.col("dn").cast("int")).alias("match_date"),
        F.lit("Regular").alias("duration"),
        F.when(score0 > score1, (g * 2 + 1).cast("string"))
         .when(score1 > score0, (g * 2 + 2).cast("string"))
         .otherwise(F.lit(C.DRAW_TEAM_ID)).alias("winner"),
        F.concat(F.lit("V"), g.cast("string")).alias("venue"),
        (F.col("dn") + 1).cast("int").alias("gameweek"),
        F.map_from_entries(F.transform(
            "sides", lambda s: F.struct(s["team_id"].alias("key"),
                                        F.struct(s["formation"].alias("formation")).alias("value"))
        )).alias("teams_data"),
        F.lit(1).cast("bigint").alias("arrival"),
        ((g + F.col("dn")) % REPEATED[0] == REPEATED[1]).alias("repeated"),
    )
    # the record of the first half: other winner, no substitutions yet
    early = last.filter("repeated").select(
        "match_id", F.concat("label", F.lit(" (half time)")).alias("label"), "match_date", "duration",
        F.lit(C.DRAW_TEAM_ID).alias("winner"), "venue", "gameweek",
        F.transform_values("teams_data", lambda _, t: t.withField(
            "formation.substitutions", F.array().cast("array<struct<playerIn:bigint,playerOut:bigint,minute:int>>"))).alias("teams_data"),
        F.lit(0).cast("bigint").alias("arrival"))
    return early.unionByName(last.drop("repeated"))


@_plan_cache
def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests table: per group a forecast with all players but a substitute (sides by
    position parity), one without forwards, one whose second side is empty, one with an
    unknown name, one without a date, and one of sides of 11, the second with players of the
    next group; a profile request per customer name and an unknown one per group; a hit and
    a miss per match label.  Forecasts of even groups and profiles of customers divisible by
    ten come twice."""
    roster = _roster(spark, sf_dir)
    g, pos = F.col("g"), F.col("pos")
    slot = F.struct(F.concat(F.lit("p"), F.lpad(pos.cast("string"), 2, "0")).alias("k"),
                    F.col("c_name").alias("v"))

    def side_map(side: int, only: Column, extra: Column | None = None) -> Column:
        name = F.struct(F.lit("name").alias("k"),
                        F.concat(F.lit("Team "), (g * 2 + side + 1).cast("string")).alias("v"))
        members = F.sort_array(F.collect_list(F.when((pos % 2 == side) & only, slot)))
        return F.map_from_entries(F.concat(F.array(name), members, *([F.array(extra)] if extra is not None else [])))

    nobody = F.struct(F.lit("p99").alias("k"), F.concat(F.lit("Nobody "), g.cast("string")).alias("v"))

    def as_forecasts(sides: DataFrame, kind: int, date: str | None = FORECAST_DATE) -> DataFrame:
        return sides.select(
            _request_id(g, kind),
            F.lit("forecast").alias("request_kind"),
            F.lit(None).cast("string").alias("name"),
            F.lit(None).cast("string").alias("label"),
            F.lit(date).cast("date").alias("date"),
            "team1", "team2")

    def forecast(kind: int, only1: Column, only2: Column, extra: Column | None = None, date: str | None = FORECAST_DATE) -> DataFrame:
        return as_forecasts(roster.groupBy("g").agg(side_map(0, only1, extra).alias("team1"), side_map(1, only2).alias("team2")), kind, date)

    def full() -> DataFrame:
        """Sides of 11; groups that have a next one."""
        both = roster.select("g", "pos", "c_name", F.lit(False).alias("next")).unionByName(
            roster.select((g - 1).alias("g"), "pos", "c_name", F.lit(True).alias("next")))
        key = F.concat(F.when(F.col("next"), "n").otherwise("p"), F.lpad(pos.cast("string"), 2, "0"))

        def side(number: int, members: Column) -> Column:
            name = F.struct(F.lit("name").alias("k"), F.concat(F.lit("Team "), (g * 2 + number).cast("string")).alias("v"))
            chosen = F.sort_array(F.collect_list(F.when(members, F.struct(key.alias("k"), F.col("c_name").alias("v")))))
            return F.map_from_entries(F.concat(F.array(name), chosen))

        sides = both.groupBy("g").agg(
            side(1, ~F.col("next") & pos.isin(*FULL_SIDE)).alias("team1"),
            side(2, (~F.col("next") & pos.isin(*MIXED_SIDE)) | (F.col("next") & pos.isin(*MIXED_NEXT))).alias("team2"),
            F.countDistinct("next").alias("groups"))
        return as_forecasts(sides.filter("groups = 2"), FORECAST_FULL)

    no_map = F.lit(None).cast("map<string,string>")

    def profile(rows: DataFrame, key: Column, kind: int, name: Column) -> DataFrame:
        return rows.select(_request_id(key, kind), F.lit("profile").alias("request_kind"), name.alias("name"),
                           F.lit(None).cast("string").alias("label"), F.lit(None).cast("date").alias("date"),
                           no_map.alias("team1"), no_map.alias("team2"))

    m = matches(spark, sf_dir).filter(F.col("arrival") == 1).select("match_id", "label")
    mid = F.col("match_id").cast("bigint")
    lookups = m.select(
        F.explode(F.array(
            F.struct(_request_id(mid, LOOKUP).alias("rid"), F.col("label").alias("lbl")),
            F.struct(_request_id(mid, LOOKUP_UNKNOWN).alias("rid"),
                     F.concat(F.col("label"), F.lit(" (replay)")).alias("lbl")),
        )).alias("r")
    ).select(
        F.col("r.rid").alias("request_id"),
        F.lit("match").alias("request_kind"),
        F.lit(None).cast("string").alias("name"),
        F.col("r.lbl").alias("label"),
        F.lit(None).cast("date").alias("date"),
        no_map.alias("team1"), no_map.alias("team2"))
    everyone, none = F.lit(True), F.lit(False)
    plain = forecast(FORECAST, pos != SUBSTITUTE, pos != SUBSTITUTE)
    profiles = profile(_table(spark, sf_dir, "customer"), F.col("c_custkey"), PROFILE, F.col("c_name"))
    key = F.floor(F.col("request_id") / REQUEST_KINDS)
    return (plain
            .unionByName(plain.filter(key % 2 == 0))
            .unionByName(full())
            .unionByName(forecast(FORECAST_NO_DATE, everyone, everyone, date=None))
            .unionByName(forecast(FORECAST_NO_FORWARDS, pos < 9, pos < 9))
            .unionByName(forecast(FORECAST_EMPTY_SIDE, everyone, none))
            .unionByName(forecast(FORECAST_UNKNOWN, everyone, everyone, nobody))
            .unionByName(profiles)
            .unionByName(profiles.filter(key % 10 == 0))
            .unionByName(profile(roster.select("g").distinct(), g, PROFILE_UNKNOWN, F.concat(F.lit("Nobody "), g.cast("string"))))
            .unionByName(lookups))


def stream_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The season as stream records: (day, value) JSON lines, the events of a day and
    then the match records of that day (for replaying through the stream source)."""
    ev = events(spark, sf_dir)
    e = ev.select(
        (F.col("match_id").cast("bigint") % SEASON_DAYS).cast("int").alias("day"),
        F.lit(0).alias("part"),
        F.to_json(F.struct(
            F.col("event_id").alias("eventId"), F.col("sub_event_id").alias("subEventId"),
            F.col("player_id").cast("bigint").alias("playerId"), F.col("match_id").cast("bigint").alias("matchId"),
            F.col("seq").alias("seq"), F.col("tags").alias("tags"))).alias("value"),
        F.col("seq").alias("ord"))
    m = matches(spark, sf_dir).select(
        F.datediff("match_date", F.lit(EPOCH).cast("date")).alias("day"),
        F.lit(1).alias("part"),
        F.to_json(F.struct(
            F.lit("Played").alias("status"), F.col("match_id").cast("bigint").alias("wyId"), "label",
            F.concat(F.date_format("match_date", "yyyy-MM-dd"), F.lit(" 15:00:00")).alias("dateutc"),
            "duration", F.col("winner").cast("bigint").alias("winner"), "venue", "gameweek",
            F.col("teams_data").alias("teamsData"), "arrival")).alias("value"),
        (F.col("match_id").cast("bigint") * 2 + F.col("arrival")).alias("ord"))
    return e.unionByName(m)
