"""Bindings of the reference's roles to the driver's test tables.

The test tables are TPC-H-like, so each role is derived from an analogous table with integer
arithmetic only; ``plans/oracle.py`` states the same derivations in SQL. Everything here is lazy and
grows with the input tables.

* fixture   : one ``orders`` row; home = ``o_custkey``, away = ``(o_orderkey*31+7) mod n_customers``
              (rows with home = away dropped); goals, cards, fouls, referee and 12 prices from
              ``o_orderkey`` and ``floor(o_totalprice)``; kickoff = ``o_orderdate``, tiebreak ``id``.
* play event: one ``events`` row; match = ``user_id`` (joined to the fixture with that id, which gives
              the two team names), side by the parity of ``event_id``, type/outcome/location/
              qualifiers from ``event_type``, ``value`` and ``props.k``.
* points    : ``lineitem`` (order-free): x = 2*quantity, y = 1000*discount.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.sources.tables import table

GOAL_VALUE = 150.0  # a purchase event at or above this value is a goal


def _mod(c: Column, m: int) -> Column:
    return F.pmod(c, F.lit(m))


def _odds(base: float, key: Column, p: Column, mult: int, add_p: bool, span: int) -> Column:
    raw = key * mult + (p if add_p else F.lit(0))
    return F.lit(base) + _mod(raw, span).cast("double") / 10


def fixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    n_cust = table(spark, sf_dir, "customer").agg(F.count(F.lit(1)).alias("_n_cust"))
    k = F.col("o_orderkey")
    p = F.floor(F.col("o_totalprice")).cast("long")
    # one-row aggregate: bounded broadcast
    base = orders.crossJoin(F.broadcast(n_cust)).select(
        k.alias("id"),
        F.col("o_orderdate").alias("kickoff"),
        F.col("o_custkey").alias("home_team"),
        F.pmod(k * 31 + 7, F.col("_n_cust")).alias("away_team"),
        _mod(k * 7 + p, 5).alias("fthg"),
        _mod(k * 3 + p, 4).alias("ftag"),
        F.when(_mod(k, 97) == 0, F.lit(None).cast("long")).otherwise(_mod(k, 23)).alias("referee"),
        _mod(k * 11, 5).alias("hy"),
        _mod(k * 13 + 1, 6).alias("ay"),
        (_mod(k * 17, 15) + 5).alias("hf"),
        (_mod(k * 19 + 3, 15) + 5).alias("af"),
        (_mod(k * 23 + p, 20) + 2).alias("hs"),
        (_mod(k * 29 + p, 18) + 1).alias("as_"),
        _mod(k * 7 + p, 8).alias("hst"),
        _mod(k * 5 + p, 7).alias("ast"),
        _mod(k * 17, 11).alias("hc"),
        _mod(k * 19, 10).alias("ac"),
        F.when(_mod(k, 41) == 0, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("hr"),
        F.when(_mod(k, 43) == 0, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("ar"),
        _odds(1.2, k, p, 37, True, 40).alias("b365h"),
        _odds(2.5, k, p, 41, False, 20).alias("b365d"),
        _odds(1.5, k, p, 43, True, 50).alias("b365a"),
        _odds(1.25, k, p, 47, True, 38).alias("bwh"),
        _odds(2.6, k, p, 53, False, 18).alias("bwd"),
        _odds(1.45, k, p, 59, True, 48).alias("bwa"),
    )
    base = base.filter(F.col("home_team") != F.col("away_team"))
    return base.withColumns({
        "maxh": F.greatest("b365h", "bwh") + 0.1,
        "maxd": F.greatest("b365d", "bwd") + 0.1,
        "maxa": F.greatest("b365a", "bwa") + 0.1,
        "avgh": (F.col("b365h") + F.col("bwh")) / 2,
        "avgd": (F.col("b365d") + F.col("bwd")) / 2,
        "avga": (F.col("b365a") + F.col("bwa")) / 2,
        "ftr": F.when(F.col("fthg") > F.col("ftag"), "H").when(F.col("fthg") == F.col("ftag"), "D").otherwise("A"),
        "total_goals": (F.col("fthg") + F.col("ftag")).cast("double"),
        "home_win": (F.col("fthg") > F.col("ftag")).cast("int"),
    })


# Qualifier vocabulary of the event binding: (display name, condition on k and event id).
def _qualifier_items(k: Column, eid: Column, y: Column) -> list[Column]:
    def item(name: str, cond: Column, value: Column | None = None) -> Column:
        v = value if value is not None else F.lit(None).cast("string")
        return F.when(cond, F.struct(F.struct(F.lit(name).alias("displayName")).alias("type"), v.alias("value")))
    return [
        item("BigChance", _mod(k, 5) == 0),
        item("Head", _mod(k, 7) == 1),
        item("RightFoot", (_mod(k, 2) == 0) & (_mod(k, 7) != 1)),
        item("LeftFoot", (_mod(k, 2) == 1) & (_mod(k, 7) != 1)),
        item("Penalty", _mod(k, 23) == 3),
        item("FastBreak", _mod(k, 11) == 2),
        item("FromCorner", _mod(k, 13) == 4),
        item("Volley", _mod(k, 17) == 5),
        item("FirstTouch", _mod(k, 3) == 0),
        item("SmallBoxCentre", _mod(k, 8) == 6),
        item("BoxCentre", _mod(k, 4) == 1),
        item("OutOfBoxCentre", _mod(k, 4) == 3),
        item("Assisted", _mod(eid, 3) == 0),
        item("IntentionalAssist", _mod(eid, 6) == 0),
        item("IndividualPlay", _mod(eid, 3) == 1),
        item("RegularPlay", _mod(eid, 5) != 0),
        item("SetPiece", _mod(eid, 5) == 0),
        item("DirectFreekick", _mod(eid, 10) == 5),
        item("ThrowinSetPiece", _mod(eid, 20) == 0),
        item("Zone", F.lit(True), F.when(_mod(k, 3) == 0, F.lit("Center")).when(_mod(k, 3) == 1, F.lit("Left")).otherwise(F.lit("Right"))),
        item("GoalMouthY", _mod(eid, 2) == 0, y.cast("long").cast("string")),
        item("Angle", _mod(k, 9) == 0, F.lit("")),
    ]


def _events_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object(F.col("props"), "$.k").cast("long")
    return ev.select("event_id", "ts", "user_id", "event_type", "value", k.alias("_k"))


def play_events(spark: SparkSession, sf_dir: str, fixtures_df: DataFrame | None = None) -> DataFrame:
    """The reference's play-by-play schema (FIXTURES A2) over ``events``."""
    fx = fixtures_df if fixtures_df is not None else fixtures(spark, sf_dir)
    ev = _events_base(spark, sf_dir)
    ctx = fx.select(F.col("id").alias("user_id"), "home_team", "away_team")
    j = ev.join(ctx, "user_id", "left")
    eid, k, et, v = F.col("event_id"), F.col("_k"), F.col("event_type"), F.col("value")
    team = F.when(_mod(eid, 2) == 0, F.col("home_team")).otherwise(F.col("away_team"))
    is_shot = et.isin("purchase", "error")
    is_goal = (et == "purchase") & (v >= GOAL_VALUE)
    return j.select(
        eid.alias("id"),
        F.col("user_id").alias("match_id"),
        F.col("ts"),
        F.minute("ts").alias("minute"),
        F.second("ts").alias("second"),
        F.when(et == "click", "Pass").when(et == "view", "BallTouch").when(et == "signup", "Tackle")
         .when(is_goal, "Goal").when(et == "purchase", "SavedShot").otherwise("MissedShots").alias("event_type"),
        F.when(v >= 20, "Successful").otherwise("Unsuccessful").alias("outcome"),
        team.cast("string").alias("team_name"),
        F.when(_mod(eid, 13) == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(team.cast("string"), F.lit("_"), _mod(eid, 7).cast("string"))).alias("player_name"),
        k.cast("double").alias("x"),
        _mod(k * 37 + eid, 101).cast("double").alias("y"),
        F.when((et == "click") & (_mod(k, 3) != 0), F.least((k + _mod(eid, 40)).cast("double"), F.lit(100.0))).alias("end_x"),
        et.isin("click", "view", "purchase", "error").cast("int").alias("is_touch"),
        is_shot.cast("int").alias("is_shot"),
        is_goal.cast("int").alias("is_goal"),
    )


def shot_qualifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The qualifier cache (FIXTURES A3): shots only, a few ids missing (every 19th)."""
    ev = _events_base(spark, sf_dir).filter(F.col("event_type").isin("purchase", "error"))
    ev = ev.filter(_mod(F.col("event_id"), 19) != 0)
    eid, k = F.col("event_id"), F.col("_k")
    y = _mod(k * 37 + eid, 101)
    return ev.select(eid.alias("id"), F.array_compact(F.array(*_qualifier_items(k, eid, y))).alias("qualifiers"))


def match_context(fixtures_df: DataFrame) -> DataFrame:
    return fixtures_df.select("id", "kickoff", F.col("home_team").cast("string").alias("home_team"),
                              F.col("away_team").cast("string").alias("away_team"), "fthg", "ftag")


def pitch_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Point geometry on ``lineitem`` (order-free)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_returnflag",
                     (F.col("l_quantity") * 2).alias("x"), (F.col("l_discount") * 1000).alias("y"))


# Member models of the ensemble binding: (model_id, a, b, c) multipliers of the per-row noise.
MEMBERS = [("m1", 3, 5, 7), ("m2", 11, 13, 17), ("m3", 19, 23, 29), ("m4", 31, 37, 41)]


def member_predictions(fixtures_df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Long member predictions (row_id, model_id, p_home, p_draw, p_away, goals, label): market
    probabilities plus member-specific noise. m2 misses every row with id mod 10 = 3, m3 gives a
    negative draw score when id mod 17 = 0, m4 gives only a label (D) when id mod 13 = 0, m1 has no
    goals when id mod 7 = 0. One scan of the fixtures, ``explode`` of one struct per member."""
    i = F.col("id")

    def member(mid, a, b, c):
        rh = 1 / F.col("b365h") + _mod(i * a, 7).cast("double") / 20
        rd = 1 / F.col("b365d") + _mod(i * b, 5).cast("double") / 20
        if mid == "m3":
            rd = F.when(_mod(i, 17) == 0, F.lit(-0.2)).otherwise(rd)
        ra = 1 / F.col("b365a") + _mod(i * c, 6).cast("double") / 20
        goals = F.lit(2.0) + _mod(i * a, 9).cast("double") / 4
        if mid == "m1":
            goals = F.when(_mod(i, 7) == 0, F.lit(None).cast("double")).otherwise(goals)
        present = F.lit(True) if mid != "m2" else (_mod(i, 10) != 3)
        return F.struct(F.lit(mid).alias("model_id"), rh.alias("rh"), rd.alias("rd"), ra.alias("ra"),
                        goals.alias("goals"), present.alias("present"))

    # ``keep`` columns of the fixture ride along (e.g. the result and the split flag), so consumers need
    # no join back to the fixture table
    ex = fixtures_df.select(i.alias("row_id"), *keep, F.explode(F.array(*[member(*m) for m in MEMBERS])).alias("m"))
    ex = ex.filter(F.col("m.present")).select("row_id", *keep, "m.model_id", "m.rh", "m.rd", "m.ra", "m.goals")
    tot = F.col("rh") + F.col("rd") + F.col("ra")
    label_only = (F.col("model_id") == "m4") & (_mod(F.col("row_id"), 13) == 0)
    ex = ex.withColumns({c: F.when(label_only, F.lit(None).cast("double")).otherwise(F.col(r) / tot)
                         for c, r in (("p_home", "rh"), ("p_draw", "rd"), ("p_away", "ra"))})
    lab = (F.when((F.col("p_home") >= F.col("p_draw")) & (F.col("p_home") >= F.col("p_away")), "H")
            .when(F.col("p_draw") >= F.col("p_away"), "D").otherwise("A"))
    return ex.select("row_id", *keep, "model_id", "p_home", "p_draw", "p_away", "goals",
                     F.when(label_only, F.lit("D")).otherwise(lab).alias("label"))


def with_time_split(fixtures_df: DataFrame, holdout: float = 0.2) -> DataFrame:
    """M1 + W14: the fixtures with ``is_train`` for the first ``max(int(n * (1 - holdout)), 1)`` rows in
    (kickoff, id) order; the cut is one row, found by the distributed index."""
    from touchline.ml.split import holdout_flag
    return holdout_flag(fixtures_df, ["kickoff", "id"], holdout)
