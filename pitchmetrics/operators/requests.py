"""Answering batches of requests with joins instead of per-request lookups.

A request table has one row per request: ``request_kind`` is 'forecast'
(req_type 1), 'profile' (req_type 2), 'match' (no req_type), 'ignored'
(any other req_type) or 'rejected' (a line that is no request).  Every answer is a join of the requests with a table, so
the number of Spark jobs does not grow with the number of requests.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import codes as C

PROFILE_FIELDS = (
    "player_id", "name", "role", "foot", "birth_date", "birth_area", "passport_area", "height", "weight",
    "number_of_fouls", "number_of_goals", "number_of_own_goals", "number_of_matches",
    "number_of_shots_on_target", "pass_accuracy")


def route_requests(requests: DataFrame) -> DataFrame:
    """Adds ``request_kind`` to raw request records: req_type 1 -> forecast,
    2 -> profile, absent -> match, anything else -> ignored."""
    t = F.col("req_type")
    kind = (F.when(t.isNull(), "match").when(t == C.REQUEST_FORECAST, "forecast")
            .when(t == C.REQUEST_PROFILE, "profile").otherwise("ignored"))
    return requests.withColumn("request_kind", kind)


def unique_requests(requests: DataFrame) -> DataFrame:
    """One row per ``request_id``; of different rows with one id, the one that is smallest
    as JSON text."""
    rest = [c for c in requests.columns if c != "request_id"]
    return (requests.groupBy("request_id").agg(F.min_by(F.struct(*rest), F.to_json(F.struct(*rest))).alias("q"))
            .select("request_id", "q.*").select(*requests.columns))


def rejected_requests(requests: DataFrame) -> DataFrame:
    """(request_id, error) of the lines that are no requests."""
    return requests.filter(F.col("request_kind") == "rejected").select("request_id", F.lit(C.INVALID).alias("error"))


def first_by_key(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per ``key``: the row with the smallest ``order`` (partial+final
    aggregate; no window over a possibly hot key)."""
    rest = [c for c in df.columns if c != key]
    return (df.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r"))
            .select(key, *[F.col(f"r.{c}").alias(c) for c in rest]))


def player_profiles(requests: DataFrame, totals: DataFrame) -> DataFrame:
    """Profile requests joined with player totals on name; a duplicate name answers
    with the lowest player_id; an unknown name gives ``error = 'Invalid'``."""
    req = requests.filter(F.col("request_kind") == "profile").select("request_id", F.col("name").alias("q"))
    # only the requested names are de-duplicated, not the whole player table
    asked = totals.select(*PROFILE_FIELDS, F.length("player_id").alias("id_length")).join(req.select("q").distinct(), F.col("name") == F.col("q"), "left_semi")
    by_name = first_by_key(asked, "name", ["id_length", "player_id"])
    j = req.join(by_name, F.col("q") == F.col("name"), "left")
    return j.select("request_id", *[c for c in PROFILE_FIELDS],
                    F.when(F.col("player_id").isNull(), F.lit(C.INVALID)).alias("error"))


def match_lookups(requests: DataFrame, details: DataFrame) -> DataFrame:
    """Match requests joined with match details on label; a label used by several
    matches answers with the first by (date, match_id); unknown -> 'Invalid'."""
    req = requests.filter(F.col("request_kind") == "match").select("request_id", F.col("label").alias("q"))
    asked = details.join(req.select("q").distinct(), F.col("label") == F.col("q"), "left_semi")
    by_label = first_by_key(asked, "label", ["date", "match_id"])
    j = req.join(by_label, F.col("q") == F.col("label"), "left")
    cols = [c for c in details.columns]
    return j.select("request_id", *cols, F.when(F.col("match_id").isNull(), F.lit(C.INVALID)).alias("error"))


# --- forecasts ------------------------------------------------------------------------

def lineup_players(requests: DataFrame, players: DataFrame) -> DataFrame:
    """One row per named player of each forecast request side: (request_id, side,
    slot, player_name, player_id, role).  A name shared by several players maps
    to the lowest player_id; an unknown name keeps NULL id and role."""
    fc = requests.filter(F.col("request_kind") == "forecast")
    sides = fc.select("request_id", F.explode(F.array(
        F.struct(F.lit(1).alias("side"), F.col("team1").alias("m")),
        F.struct(F.lit(2).alias("side"), F.col("team2").alias("m")))).alias("s"))
    slots = (sides.select("request_id", F.col("s.side").alias("side"), F.explode(F.col("s.m")).alias("slot", "player_name"))
             .filter(F.col("slot") != "name"))
    asked = players.select("name", "player_id", "role", F.length("player_id").alias("id_length")).join(
        slots.select("player_name").distinct(), F.col("name") == F.col("player_name"), "left_semi")
    by_name = first_by_key(asked, "name", ["id_length", "player_id"])
    return (slots.join(by_name, F.col("player_name") == F.col("name"), "left")
            .select("request_id", "side", "slot", "player_name", "player_id", "role"))


def request_sides(requests: DataFrame) -> DataFrame:
    """(request_id, side): both sides of every forecast request, players or none."""
    fc = requests.filter(F.col("request_kind") == "forecast")
    return fc.select("request_id", F.explode(F.array(F.lit(1), F.lit(2))).alias("side"))


def lineup_roles(requests: DataFrame, lineups: DataFrame, legacy: bool = False) -> DataFrame:
    """Role counts and validity per (request, side); a side without players has zeros.
    A side is valid with exactly one goalkeeper, at least two defenders, two midfielders
    and one forward and no unknown player; a request is valid when both sides are.
    ``legacy=True`` marks a request invalid only when *both* sides break the same rule."""
    role = F.col("role")

    def n(r: str) -> Column:
        return F.sum(F.when(role == r, 1).otherwise(0)).cast("bigint").alias(r.lower())

    counts = lineups.groupBy("request_id", "side").agg(
        *[n(r) for r in C.ROLES],
        F.sum(F.when(F.col("player_id").isNull(), 1).otherwise(0)).cast("bigint").alias("unknown"))
    names = [r.lower() for r in C.ROLES] + ["unknown"]
    counts = (request_sides(requests).join(counts, ["request_id", "side"], "left")
              .na.fill({c: 0 for c in names}))
    rules = {
        "gk_bad": F.col("gk") != C.REQUIRED_GOALKEEPERS, "df_bad": F.col("df") < C.MIN_DEFENDERS,
        "md_bad": F.col("md") < C.MIN_MIDFIELDERS, "fw_bad": F.col("fw") < C.MIN_FORWARDS,
    }
    counts = counts.select("*", *[c.alias(k) for k, c in rules.items()])
    side_ok = ~(F.col("gk_bad") | F.col("df_bad") | F.col("md_bad") | F.col("fw_bad") | (F.col("unknown") > 0))
    counts = counts.withColumn("side_valid", side_ok)
    # two rows per request: a grouped aggregate, then a join back on request_id
    if legacy:
        per_req = counts.groupBy("request_id").agg(
            *[F.min(F.col(k).cast("int")).alias(k) for k in rules], F.max("unknown").alias("u"))
        bad = F.lit(False)
        for k in rules:
            bad = bad | (F.col(k) == 1)
        per_req = per_req.select("request_id", (~bad & (F.col("u") == 0)).alias("request_valid"))
    else:
        per_req = counts.groupBy("request_id").agg(F.min(F.col("side_valid").cast("int")).alias("v")) \
            .select("request_id", (F.col("v") == 1).alias("request_valid"))
    return (counts.join(per_req, "request_id")
            .select("request_id", "side", "gk", "df", "md", "fw", "unknown", "side_valid", "request_valid"))


def lineup_chemistry(lineups: DataFrame, totals: DataFrame, chemistry: DataFrame, groups: DataFrame,
                     group_avg: DataFrame, group_col: str, threshold: int = C.EXPERIENCE_THRESHOLD,
                     initial: float = C.INITIAL_CHEMISTRY) -> DataFrame:
    """Chemistry coefficient of each lineup slot: the mean, over the side's other
    players, of the pair chemistry when both players have at least ``threshold``
    matches or both at most ``threshold`` (a pair never seen counts ``initial``),
    else of the mean chemistry of the first player's group (taken twice, as the
    source does).  A player alone on a side gets NULL.

    Pairs are formed inside a (request, side) lineup only: an equi-join on
    (request_id, side); a lineup is a handful of players."""
    lp = (lineups.filter(F.col("player_id").isNotNull())
          .join(totals.select("player_id", F.col("number_of_matches").alias("nm")), "player_id", "left")
          .join(groups.select("player_id", F.col(group_col).alias("grp")), "player_id", "left")
          .select("request_id", "side", "slot", "player_id", "nm", "grp"))
    a, b = lp.alias("a"), lp.alias("b")
    pairs = a.join(b, (F.col("a.request_id") == F.col("b.request_id")) & (F.col("a.side") == F.col("b.side"))
                   & (F.col("a.player_id") != F.col("b.player_id"))).select(
        F.col("a.request_id").alias("request_id"), F.col("a.side").alias("side"), F.col("a.slot").alias("slot"),
        F.col("a.player_id").alias("p1"), F.col("b.player_id").alias("p2"),
        F.col("a.nm").alias("nm1"), F.col("b.nm").alias("nm2"), F.col("a.grp").alias("grp1"))
    chem = chemistry.select(F.col("player_id_1").alias("p1"), F.col("player_id_2").alias("p2"), "chemistry")
    gavg = group_avg.select(F.col(group_col).alias("grp1"), F.col("avg_chemistry").alias("g1"))
    j = pairs.join(chem, ["p1", "p2"], "left").join(gavg, "grp1", "left")
    nm1 = F.coalesce(F.col("nm1"), F.lit(0))
    nm2 = F.coalesce(F.col("nm2"), F.lit(0))
    direct = ((nm1 >= threshold) & (nm2 >= threshold)) | ((nm1 <= threshold) & (nm2 <= threshold))
    value = F.when(direct, F.coalesce(F.col("chemistry"), F.lit(initial))).otherwise((F.col("g1") + F.col("g1")) / 2)
    coef = j.groupBy("request_id", "side", "slot").agg(F.avg(value).alias("chemistry_coefficient"))
    return (lp.select("request_id", "side", "slot", "player_id")
            .join(coef, ["request_id", "side", "slot"], "left"))


def forecasts(requests: DataFrame, roles: DataFrame, slot_chemistry: DataFrame, slot_ratings: DataFrame,
              legacy: bool = False) -> DataFrame:
    """Win chances per forecast request: side strength = sum(chemistry * predicted
    rating) / 11; chance1 = (0.5 + s1 - (s1 + s2) / 2) * 100, chance2 = 100 - chance1
    (no clamp).  ``legacy=True`` keeps side 2's strength at 0, as the source does.
    An invalid request, or one without a date, gets ``result = 'Invalid'``, a valid one with a player who has no
    predicted rating or no chemistry 'Unrated'; neither has strengths or chances."""
    j = slot_chemistry.join(slot_ratings.select("request_id", "side", "slot", "predicted_rating"),
                            ["request_id", "side", "slot"], "left")
    contrib = F.col("chemistry_coefficient") * F.col("predicted_rating")
    strength = j.groupBy("request_id").agg(
        (F.sum(F.when(F.col("side") == 1, contrib).otherwise(0.0)) / C.STRENGTH_DIVISOR).alias("s1"),
        (F.sum(F.when(F.col("side") == 2, contrib).otherwise(0.0)) / C.STRENGTH_DIVISOR).alias("s2"),
        F.min(contrib.isNotNull().cast("int")).alias("rated"))
    s1 = F.col("s1")
    s2 = F.lit(0.0) if legacy else F.col("s2")
    chance1 = (F.lit(0.5) + s1 - (s1 + s2) / 2) * 100
    valid = roles.groupBy("request_id").agg(F.min(F.col("request_valid").cast("int")).alias("ok"))
    fc = requests.filter(F.col("request_kind") == "forecast").select(
        "request_id", "date", F.col("team1")["name"].alias("team1_name"), F.col("team2")["name"].alias("team2_name"))
    out = fc.join(valid, "request_id", "left").join(strength, "request_id", "left")
    valid_ = F.coalesce(F.col("ok") == 1, F.lit(False)) & F.col("date").isNotNull()
    ok = valid_ & F.coalesce(F.col("rated") == 1, F.lit(False))
    return out.select(
        "request_id", "team1_name", "team2_name",
        F.when(ok, F.lit("ok")).when(valid_, F.lit(C.UNRATED)).otherwise(F.lit(C.INVALID)).alias("result"),
        F.when(ok, s1).alias("strength1"), F.when(ok, s2).alias("strength2"),
        F.when(ok, chance1).alias("chance1"), F.when(ok, F.lit(100.0) - chance1).alias("chance2"))
