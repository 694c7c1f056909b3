"""Registered queries: future fixtures, composite indices, cleaning scalars, zone and flag summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions import clean, geometry, odds as O, text
from touchline.operators import aggregate as A
from touchline.operators import features
from touchline.operators import scoring as SC
from touchline.plans import bindings
from touchline.plans.eval_queries import MEMBERS_CTE, _XG_CTE, _xg_shots
from touchline.plans.oracle import EVENTS_CTE, FIXTURES_CTE, with_ctes
from touchline.plans.registry import normalise, query
from touchline.sources.tables import table

_SPLIT_CTE = """
split AS (SELECT id, row_number() OVER (ORDER BY kickoff, id) - 1 AS row_idx, count(*) OVER () AS n FROM fixtures),
split2 AS (SELECT id, row_idx, row_idx < greatest(CAST(floor(n * 0.8) AS BIGINT), 1) AS is_train FROM split)"""


@query("future_fixture_features", with_ctes(FIXTURES_CTE, _SPLIT_CTE, """
hist AS (SELECT f.* FROM fixtures f JOIN split2 s ON s.id = f.id WHERE s.is_train),
new AS (SELECT f.* FROM fixtures f JOIN split2 s ON s.id = f.id WHERE NOT s.is_train),
rinc AS (
  SELECT id, kickoff, referee, 0 AS is_new, avg(CAST(hy + ay AS DOUBLE)) OVER w AS y, avg(CAST(hf + af AS DOUBLE)) OVER w AS fo,
         avg(CAST(total_goals AS DOUBLE)) OVER w AS g, avg(CAST(home_win AS DOUBLE)) OVER w AS hw
  FROM hist WHERE referee IS NOT NULL WINDOW w AS (PARTITION BY referee ORDER BY kickoff, id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)
),
ru AS (SELECT * FROM rinc UNION ALL SELECT id, kickoff, referee, 1, NULL, NULL, NULL, NULL FROM new WHERE referee IS NOT NULL),
ra AS (
  SELECT id, is_new, last_value(y IGNORE NULLS) OVER w AS y, last_value(fo IGNORE NULLS) OVER w AS fo, last_value(g IGNORE NULLS) OVER w AS g,
         last_value(hw IGNORE NULLS) OVER w AS hw
  FROM ru WINDOW w AS (PARTITION BY referee ORDER BY kickoff, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
teams AS (SELECT home_team AS team FROM new UNION SELECT away_team FROM new),
hl AS (
  SELECT id, kickoff, home_team AS team, 1 AS is_home, CAST(fthg AS DOUBLE) AS gf, CAST(ftag AS DOUBLE) AS ga,
         CAST(CASE WHEN ftr = 'H' THEN 3 WHEN ftr = 'D' THEN 1 ELSE 0 END AS DOUBLE) AS pts FROM hist
  UNION ALL
  SELECT id, kickoff, away_team, 0, CAST(ftag AS DOUBLE), CAST(fthg AS DOUBLE),
         CAST(CASE WHEN ftr = 'A' THEN 3 WHEN ftr = 'D' THEN 1 ELSE 0 END AS DOUBLE) FROM hist
),
hinc AS (
  SELECT id, kickoff, team, is_home, 0 AS is_new, avg(gf) OVER w AS igf, avg(ga) OVER w AS iga, avg(pts) OVER w AS ipts
  FROM hl WHERE team IN (SELECT team FROM teams)
  WINDOW w AS (PARTITION BY team ORDER BY kickoff, id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
),
nl AS (
  SELECT id, kickoff, home_team AS team, 1 AS is_home, 1 AS is_new, CAST(NULL AS DOUBLE) AS igf, CAST(NULL AS DOUBLE) AS iga, CAST(NULL AS DOUBLE) AS ipts FROM new
  UNION ALL
  SELECT id, kickoff, away_team, 0, 1, NULL, NULL, NULL FROM new
),
u AS (SELECT * FROM hinc UNION ALL SELECT * FROM nl),
a AS (
  SELECT id, is_home, is_new, last_value(igf IGNORE NULLS) OVER w AS gf5, last_value(iga IGNORE NULLS) OVER w AS ga5,
         last_value(ipts IGNORE NULLS) OVER w AS p5
  FROM u WINDOW w AS (PARTITION BY team ORDER BY kickoff, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
wd AS (
  SELECT id, max(CASE WHEN is_home = 1 THEN gf5 END) AS hgf, max(CASE WHEN is_home = 0 THEN gf5 END) AS agf,
         max(CASE WHEN is_home = 1 THEN ga5 END) AS hga, max(CASE WHEN is_home = 0 THEN ga5 END) AS aga,
         max(CASE WHEN is_home = 1 THEN p5 END) AS hp, max(CASE WHEN is_home = 0 THEN p5 END) AS ap
  FROM a WHERE is_new = 1 GROUP BY id
)""") + """
SELECT n.id, round(hgf, 6) AS home_goals_for_last5, round(agf, 6) AS away_goals_for_last5,
       round(hga, 6) AS home_goals_against_last5, round(aga, 6) AS away_goals_against_last5,
       round(hp, 6) AS home_points_last5, round(ap, 6) AS away_points_last5,
       round(hgf - agf, 6) AS goals_for_diff_last5, round(hga - aga, 6) AS goals_against_diff_last5, round(hp - ap, 6) AS points_diff_last5,
       round(ra.y, 6) AS ref_avg_yellows_last10, round(ra.fo, 6) AS ref_avg_fouls_last10, round(ra.g, 6) AS ref_avg_goals_last10,
       round(ra.hw, 6) AS ref_home_win_rate_last10, round(1 / b365h, 6) AS b365_home_prob, round(1 / bwd, 6) AS bw_draw_prob,
       round(b365a - b365h, 6) AS odds_gap_home_away, round(1 / b365h + 1 / b365d + 1 / b365a, 6) AS implied_prob_sum_b365
FROM new n LEFT JOIN wd ON n.id = wd.id LEFT JOIN ra ON n.id = ra.id AND ra.is_new = 1
""")
def future_fixture_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J8 (fixed) + J13 + R4: the holdout fixtures scored as not yet played, from history only."""
    fx = bindings.fixtures(spark, sf_dir)
    both = bindings.with_time_split(fx)
    hist = both.filter("is_train").drop("is_train")
    books = [f"{b}{s}" for b in features.BOOKS for s in features.SIDE_NAMES]
    new = both.filter(~F.col("is_train")).select("id", "kickoff", "home_team", "away_team", "referee", *books)
    res = features.future_fixture_features(hist, new)
    cols = ["goals_for", "goals_against", "points"]
    return normalise(res.select("id", *[f"{s}_{c}_last5" for c in cols for s in ("home", "away")], *[f"{c}_diff_last5" for c in cols],
                                *features.REFEREE_TARGETS.values(), "b365_home_prob", "bw_draw_prob", "odds_gap_home_away", "implied_prob_sum_b365"))


# Composite index weights over z-scored match-stat differences.
INDEX_WEIGHTS = {
    "threat_index": {"sot_diff": 0.70, "shots_diff": 0.30},
    "dominance_index": {"shots_diff": 0.35, "sot_diff": 0.50, "corners_diff": 0.15},
    "efficiency_control_index": {"sot_diff": 0.50, "shots_diff": 0.30, "accuracy_diff": 0.20},
    "territorial_pressure_index": {"corners_diff": 0.45, "shots_diff": 0.35, "sot_diff": 0.20},
    "clean_dominance_index": {"sot_diff": 0.45, "shots_diff": 0.30, "corners_diff": 0.15, "card_diff": -0.05, "foul_diff": -0.05},
}
_RAW = ["shots_diff", "sot_diff", "corners_diff", "accuracy_diff", "card_diff", "foul_diff"]


def _index_raw(fx: DataFrame) -> DataFrame:
    from touchline.operators.shots import safe_div_zero
    d = lambda a, b: F.col(a).cast("double") - F.col(b).cast("double")
    return fx.withColumns({
        "shots_diff": d("hs", "as_"), "sot_diff": d("hst", "ast"), "corners_diff": d("hc", "ac"),
        "accuracy_diff": safe_div_zero(F.col("hst").cast("double"), F.col("hs").cast("double"))
                         - safe_div_zero(F.col("ast").cast("double"), F.col("as_").cast("double")),
        "card_diff": (F.col("hy") + 2 * F.col("hr")).cast("double") - (F.col("ay") + 2 * F.col("ar")).cast("double"),
        "foul_diff": d("hf", "af"),
    })


def _index_sql() -> str:
    zs = ", ".join(f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 OR stddev_pop({c}) IS NULL THEN 1.0 ELSE stddev_pop({c}) END AS s_{c}" for c in _RAW)
    outs = []
    for name, w in INDEX_WEIGHTS.items():
        terms = " + ".join(f"({coef}) * (({c} - m_{c}) / s_{c})" for c, coef in w.items())
        outs.append(f"round(0.0 + {terms}, 6) AS {name}")
    return with_ctes(FIXTURES_CTE, _SPLIT_CTE, f"""
raw AS (
  SELECT f.id, s.is_train, CAST(hs AS DOUBLE) - CAST(as_ AS DOUBLE) AS shots_diff, CAST(hst AS DOUBLE) - CAST(ast AS DOUBLE) AS sot_diff,
         CAST(hc AS DOUBLE) - CAST(ac AS DOUBLE) AS corners_diff,
         (CASE WHEN hs = 0 THEN 0.0 ELSE CAST(hst AS DOUBLE) / CAST(hs AS DOUBLE) END)
           - (CASE WHEN as_ = 0 THEN 0.0 ELSE CAST(ast AS DOUBLE) / CAST(as_ AS DOUBLE) END) AS accuracy_diff,
         CAST(hy + 2 * hr AS DOUBLE) - CAST(ay + 2 * ar AS DOUBLE) AS card_diff, CAST(hf AS DOUBLE) - CAST(af AS DOUBLE) AS foul_diff
  FROM fixtures f JOIN split2 s ON s.id = f.id
),
params AS (SELECT {zs} FROM raw WHERE is_train)""") + f"""
SELECT id, {", ".join(outs)} FROM raw CROSS JOIN params
"""


@query("composite_indices", _index_sql())
def composite_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X15 (fixed): five fixed-weight indices over z-scored stat differences, z parameters (mean,
    population std, zero std -> 1) fitted on the time-ordered training part only."""
    fx = bindings.fixtures(spark, sf_dir)
    raw = _index_raw(bindings.with_time_split(fx))
    params = features.zscore_params(raw.filter("is_train"), _RAW)
    res = features.weighted_indices(raw, params, INDEX_WEIGHTS)
    return normalise(res.select("id", *INDEX_WEIGHTS))


@query("name_keys", """
SELECT p_partkey, trim(coalesce(p_brand, '')) AS canonical_brand,
       trim(regexp_replace(replace(lower('  ' || upper(p_name) || '. ' || p_type), '.', ''), '\\s+', ' ', 'g')) AS lookup_key
FROM part
""")
def name_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 + P2: canonical names (trim + alias map) and case/space/dot-insensitive lookup keys."""
    p = table(spark, sf_dir, "part")
    raw = F.concat(F.lit("  "), F.upper("p_name"), F.lit(". "), F.col("p_type"))
    return normalise(p.select("p_partkey", clean.canonical_name("p_brand").alias("canonical_brand"),
                              clean.lookup_key(raw).alias("lookup_key")))


@query("kickoff_parsing", """
WITH t AS (
  SELECT o_orderkey,
         CASE WHEN o_orderkey % 50 = 0 THEN 'not a date' ELSE strftime(o_orderdate, '%d/%m/%Y') END AS d,
         CASE WHEN o_orderkey % 3 = 0 THEN '19:45' ELSE '15:00' END AS tm,
         CASE WHEN o_orderkey % 40 = 0 THEN 'n/a' ELSE CAST(o_orderkey % 7 AS VARCHAR) END AS g1,
         CAST(o_orderkey % 5 AS VARCHAR) AS g2
  FROM orders
)
SELECT o_orderkey, strftime(try_strptime(d || ' ' || tm, '%d/%m/%Y %H:%M'), '%Y-%m-%d %H:%M') AS kickoff_text,
       TRY_CAST(g1 AS DOUBLE) AS home_goals,
       CASE WHEN TRY_CAST(g1 AS DOUBLE) IS NULL THEN NULL WHEN TRY_CAST(g1 AS DOUBLE) > CAST(g2 AS DOUBLE) THEN 'H'
            WHEN TRY_CAST(g1 AS DOUBLE) = CAST(g2 AS DOUBLE) THEN 'D' ELSE 'A' END AS result
FROM t
""")
def kickoff_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3 + P4 + P10: day-first date/time text to timestamp (bad text -> null), lenient numbers, result from the score."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    t = o.select("o_orderkey",
                 F.when(F.pmod(k, F.lit(50)) == 0, F.lit("not a date")).otherwise(F.date_format("o_orderdate", "dd/MM/yyyy")).alias("d"),
                 F.when(F.pmod(k, F.lit(3)) == 0, F.lit("19:45")).otherwise(F.lit("15:00")).alias("tm"),
                 F.when(F.pmod(k, F.lit(40)) == 0, F.lit("n/a")).otherwise(F.pmod(k, F.lit(7)).cast("string")).alias("g1"),
                 F.pmod(k, F.lit(5)).cast("string").alias("g2"))
    ko = clean.kickoff("d", "tm")
    g1 = clean.lenient_number("g1")
    return normalise(t.select("o_orderkey", F.date_format(ko, "yyyy-MM-dd HH:mm").alias("kickoff_text"), g1.alias("home_goals"),
                              clean.result_from_score(g1, clean.lenient_number("g2")).alias("result")))


_QUAL_NAMES_CTE = """
, qn AS (
  SELECT event_id AS id, [CASE WHEN k % 5 = 0 THEN 'BigChance' END, CASE WHEN k % 7 = 1 THEN 'Head' END,
      CASE WHEN k % 2 = 0 AND k % 7 <> 1 THEN 'RightFoot' END, CASE WHEN k % 2 = 1 AND k % 7 <> 1 THEN 'LeftFoot' END,
      CASE WHEN k % 23 = 3 THEN 'Penalty' END, CASE WHEN k % 11 = 2 THEN 'FastBreak' END, CASE WHEN k % 13 = 4 THEN 'FromCorner' END,
      CASE WHEN k % 17 = 5 THEN 'Volley' END, CASE WHEN k % 3 = 0 THEN 'FirstTouch' END, CASE WHEN k % 8 = 6 THEN 'SmallBoxCentre' END,
      CASE WHEN k % 4 = 1 THEN 'BoxCentre' END, CASE WHEN k % 4 = 3 THEN 'OutOfBoxCentre' END, CASE WHEN event_id % 3 = 0 THEN 'Assisted' END,
      CASE WHEN event_id % 6 = 0 THEN 'IntentionalAssist' END, CASE WHEN event_id % 3 = 1 THEN 'IndividualPlay' END,
      CASE WHEN event_id % 5 <> 0 THEN 'RegularPlay' END, CASE WHEN event_id % 5 = 0 THEN 'SetPiece' END,
      CASE WHEN event_id % 10 = 5 THEN 'DirectFreekick' END, CASE WHEN event_id % 20 = 0 THEN 'ThrowinSetPiece' END, 'Zone',
      CASE WHEN event_id % 2 = 0 THEN 'GoalMouthY' END, CASE WHEN k % 9 = 0 THEN 'Angle' END] AS names
  FROM ev0 WHERE et IN ('purchase', 'error') AND event_id % 19 <> 0
)"""


@query("qualifier_name_frequency", with_ctes(FIXTURES_CTE, EVENTS_CTE) + _QUAL_NAMES_CTE + """
SELECT item, CAST(count(*) AS BIGINT) AS count FROM (SELECT unnest(names) AS item FROM qn) WHERE item IS NOT NULL GROUP BY item
""")
def qualifier_name_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F3 + R5 + A14: display names of the qualifier lists, exploded, counted without per-row dedupe."""
    q = bindings.shot_qualifiers(spark, sf_dir).select(text.qualifier_names("qualifiers").alias("names"))
    return normalise(A.exploded_frequency(q, "names"))


@query("zone_summary", with_ctes(FIXTURES_CTE, EVENTS_CTE) + _XG_CTE + """
, z AS (SELECT x.xg, x.is_goal, CASE WHEN s.x >= 94.5 AND s.y BETWEEN 36.8 AND 63.2 THEN 'small_box'
                                    WHEN s.x >= 83.5 AND s.y BETWEEN 21.1 AND 78.9 THEN 'penalty_box' ELSE 'outside_box' END AS zone
        FROM xg x JOIN sh s ON s.id = x.id),
grid AS (SELECT * FROM (VALUES (0, 'small_box'), (1, 'penalty_box'), (2, 'outside_box')) t(pos, zone)),
g AS (SELECT zone, count(*) AS n, sum(is_goal) AS goals, avg(xg) AS p FROM z GROUP BY zone),
r AS (SELECT grid.pos, grid.zone, coalesce(n, 0) AS shots, coalesce(goals, 0) AS goals, coalesce(p, 0.0) AS mean_xg,
             CASE WHEN coalesce(n, 0) > 0 THEN goals / n ELSE 0.0 END AS conversion,
             coalesce(n, 0) / (SELECT count(*) FROM z) AS share
      FROM grid LEFT JOIN g ON grid.zone = g.zone)
SELECT CAST(pos AS BIGINT) AS pos, zone, CAST(shots AS BIGINT) AS shots, CAST(goals AS BIGINT) AS goals, round(mean_xg, 6) AS mean_xg,
       round(conversion, 6) AS conversion, round(share, 6) AS share,
       CAST(CASE WHEN row_number() OVER (ORDER BY conversion DESC, pos) = 1 THEN 1 ELSE 0 END AS BIGINT) AS best_zone
FROM r
""")
def zone_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A22 + X5 + X16: fixed zone list with shots, goals, mean xG, conversion, share and best zone."""
    s = _xg_shots(spark, sf_dir).withColumn("zone", geometry.zone_key("x", "y"))
    return normalise(A.zone_summary(s, "zone", ["small_box", "penalty_box", "outside_box"], "is_goal", "xg"))


@query("dominant_zone", with_ctes(FIXTURES_CTE, EVENTS_CTE) + """
, z AS (SELECT CASE WHEN x >= 94 AND abs(y - 50) <= 10 THEN 'Área chica' WHEN x >= 84 AND abs(y - 50) <= 20 THEN 'Zona de penal'
                    WHEN x >= 76 AND abs(y - 50) <= 28 THEN 'Frontal del área' ELSE 'Media distancia' END AS value
        FROM play_events WHERE is_shot = 1)
SELECT value, CAST(count(*) AS BIGINT) AS count FROM z GROUP BY value ORDER BY count DESC, value LIMIT 1
""")
def dominant_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A24 + X5 (four-level zone): the most frequent zone of all shots."""
    shots = bindings.play_events(spark, sf_dir).filter(F.col("is_shot") == 1).withColumn("z", geometry.global_zone("x", "y"))
    return normalise(A.dominant_value(shots, "z"))


@query("big_chance_rates", with_ctes(FIXTURES_CTE, EVENTS_CTE) + """
, s AS (SELECT p.is_goal, CASE WHEN strpos(coalesce(q.qualifier_text, ''), 'bigchance') > 0 THEN 1 ELSE 0 END AS is_big_chance
        FROM play_events p LEFT JOIN qual q ON p.id = q.id WHERE p.is_shot = 1)
SELECT CAST(is_big_chance AS BIGINT) AS is_big_chance, CAST(count(*) AS BIGINT) AS shots, CAST(sum(is_goal) AS BIGINT) AS goals,
       round(sum(is_goal) / count(*), 6) AS rate
FROM s GROUP BY is_big_chance
""")
def big_chance_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A37 + F5: goal rate from summed parts by the big-chance flag."""
    s = _xg_shots(spark, sf_dir)
    return normalise(A.rate_from_parts(s, "is_big_chance", "is_goal"))


@query("compact_text_flags", """
WITH c AS (SELECT page_id, regexp_replace(lower(coalesce(html, '')), '[^a-z0-9]+', '', 'g') AS t FROM pages)
SELECT page_id, length(t) AS compact_length,
       CAST(CASE WHEN regexp_matches(t, 'script|style') THEN 1 ELSE 0 END AS BIGINT) AS has_code,
       CAST(CASE WHEN regexp_matches(t, 'nav|footer|header') THEN 1 ELSE 0 END AS BIGINT) AS has_layout,
       CAST(CASE WHEN regexp_matches(t, 'href') THEN 1 ELSE 0 END AS BIGINT) AS has_link
FROM c
""")
def compact_text_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 + F6: whole page texts compacted (lower, a-z0-9 only); regex-alternation flags over them."""
    p = table(spark, sf_dir, "pages").select("page_id", text.compact_text("html").alias("t"))
    flags = text.regex_flags("t", {"has_code": "script|style", "has_layout": "nav|footer|header", "has_link": "href"})
    return normalise(p.select("page_id", F.length("t").alias("compact_length"), *[c.alias(n) for n, c in flags.items()]))


@query("shot_validity_counts", with_ctes(FIXTURES_CTE, EVENTS_CTE) + """
SELECT CAST(sum(CASE WHEN x BETWEEN 0 AND 100 THEN 0 ELSE 1 END) AS BIGINT) AS x_range,
       CAST(sum(CASE WHEN y BETWEEN 0 AND 100 THEN 0 ELSE 1 END) AS BIGINT) AS y_range,
       CAST(sum(CASE WHEN is_goal IN (0, 1) THEN 0 ELSE 1 END) AS BIGINT) AS goal_flag,
       CAST(sum(CASE WHEN end_x IS NULL OR end_x >= x THEN 0 ELSE 1 END) AS BIGINT) AS forward_end
FROM play_events
""")
def shot_validity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P21 + P22: constraint table over all events, failures counted per constraint in one aggregate."""
    ev = bindings.play_events(spark, sf_dir)
    checks = {"x_range": F.col("x").between(0, 100), "y_range": F.col("y").between(0, 100),
              "goal_flag": F.col("is_goal").isin(0, 1), "forward_end": F.col("end_x").isNull() | (F.col("end_x") >= F.col("x"))}
    return normalise(SC.violation_counts(SC.validity(ev, checks), list(checks)))


@query("market_fallback_probabilities", with_ctes(FIXTURES_CTE) + """
, r AS (SELECT id, CASE WHEN id % 11 = 0 THEN NULL ELSE b365h END AS h, b365d AS d, CASE WHEN id % 13 = 0 THEN 0.0 ELSE b365a END AS a FROM fixtures),
i AS (SELECT id, 1 / greatest(coalesce(h, 2.4), 0.001) AS ih, 1 / greatest(coalesce(d, 3.4), 0.001) AS id_, 1 / greatest(coalesce(a, 3.0), 0.001) AS ia FROM r)
SELECT id, round(ih / (ih + id_ + ia), 6) AS mk_home, round(id_ / (ih + id_ + ia), 6) AS mk_draw, round(ia / (ih + id_ + ia), 6) AS mk_away,
       CASE WHEN ih / (ih + id_ + ia) >= id_ / (ih + id_ + ia) AND ih / (ih + id_ + ia) >= ia / (ih + id_ + ia) THEN 'H'
            WHEN id_ / (ih + id_ + ia) >= ia / (ih + id_ + ia) THEN 'D' ELSE 'A' END AS predicted_result
FROM i
""")
def market_fallback_probabilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E23 + E30: normalised inverse prices with default prices for missing ones and a 0.001 floor."""
    fx = bindings.fixtures(spark, sf_dir).select(
        "id", F.when(F.pmod("id", F.lit(11)) == 0, F.lit(None).cast("double")).otherwise(F.col("b365h")).alias("b365h"), "b365d",
        F.when(F.pmod("id", F.lit(13)) == 0, F.lit(0.0)).otherwise(F.col("b365a")).alias("b365a"))
    m = SC.market_probabilities(fx)
    return normalise(m.select("id", "mk_home", "mk_draw", "mk_away",
                              O.argmax_label("mk_home", "mk_draw", "mk_away").alias("predicted_result")))
