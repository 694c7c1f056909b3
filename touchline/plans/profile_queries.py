"""Registered queries for aggregations, conversion tables, profiles and scalar families."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions import geometry, odds as O, text
from touchline.operators import aggregate as A
from touchline.operators import features, profile, reshape, windows
from touchline.plans import bindings
from touchline.plans.oracle import EVENTS_CTE, FIXTURES_CTE, POINTS_CTE, with_ctes
from touchline.plans.registry import normalise, query
from touchline.sources.tables import table

_STOP = ", ".join(f"'{t}'" for t in text.IGNORED_TOKENS)


def _labelled_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "inner")


# --- W1/W2 on orders -------------------------------------------------------------------------

@query("trailing_mean_last5", """
SELECT o_orderkey, o_custkey,
       round(avg(o_totalprice) OVER w, 6) AS o_totalprice_last5,
       round(sum(o_totalprice) OVER w, 6) AS o_totalprice_sum_last5
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
""")
def trailing_mean_last5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1 + W2: trailing mean and sum of the previous 5 orders of a customer."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    hot = windows.hot_key_rows(o, ["o_custkey"])[("o_custkey",)]
    o = windows.trailing(o, "o_custkey", ["o_orderdate", "o_orderkey"], ["o_totalprice"], 5, hot_rows=hot)
    o = windows.trailing(o, "o_custkey", ["o_orderdate", "o_orderkey"], ["o_totalprice"], 5, how="sum", out="{c}_sum_last{n}", hot_rows=hot)
    return normalise(o.select("o_orderkey", "o_custkey", "o_totalprice_last5", "o_totalprice_sum_last5"))


@query("moving_average_complete", """
SELECT o_orderkey, o_custkey,
       round(CASE WHEN count(*) OVER w >= 3 THEN avg(o_totalprice) OVER w END, 6) AS ma3,
       CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS order_number,
       CAST(date_diff('day', lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), o_orderdate) AS BIGINT) AS days_since_prev
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
""")
def moving_average_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W12 (inclusive moving average, null until 3 rows) + W3 ordinal + W5-style gap in days."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    hot = windows.hot_key_rows(o, ["o_custkey"])[("o_custkey",)]
    order = ["o_orderdate", "o_orderkey"]
    o = windows.moving_average_complete(o, "o_custkey", order, "o_totalprice", 3, out="ma3", hot_rows=hot)
    o = windows.ordinal(o, "o_custkey", order, "order_number", hot_rows=hot)

    def gap_days(w):
        prev = F.lag("o_orderdate").over(w)
        return {"days_since_prev": F.when(prev.isNotNull(), F.datediff(F.to_date("o_orderdate"), F.to_date(prev)))}
    o = windows.apply_window(o, "o_custkey", order, windows.WindowJob(gap_days, lookback=1), hot_rows=hot)
    return normalise(o.select("o_orderkey", "o_custkey", "ma3", "order_number", "days_since_prev"))


@query("notebook_form_features", with_ctes(FIXTURES_CTE, """
tl AS (
  SELECT id, kickoff, home_team AS team, 1 AS is_home, CAST(fthg AS DOUBLE) AS gf, CAST(ftag AS DOUBLE) AS ga,
         CAST(CASE WHEN ftr = 'H' THEN 3 WHEN ftr = 'D' THEN 1 ELSE 0 END AS DOUBLE) AS pts FROM fixtures
  UNION ALL
  SELECT id, kickoff, away_team, 0, CAST(ftag AS DOUBLE), CAST(fthg AS DOUBLE),
         CAST(CASE WHEN ftr = 'A' THEN 3 WHEN ftr = 'D' THEN 1 ELSE 0 END AS DOUBLE) FROM fixtures
),
h AS (
  SELECT id, is_home, avg(gf) OVER w AS gf5, avg(ga) OVER w AS ga5, sum(pts) OVER w AS p5,
         avg(CASE WHEN pts = 3 THEN 1.0 ELSE 0.0 END) OVER w AS wr5
  FROM tl WINDOW w AS (PARTITION BY team ORDER BY kickoff, id ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
),
wd AS (
  SELECT id, max(CASE WHEN is_home = 1 THEN gf5 END) AS hg, max(CASE WHEN is_home = 0 THEN gf5 END) AS ag,
         max(CASE WHEN is_home = 1 THEN ga5 END) AS hga, max(CASE WHEN is_home = 0 THEN ga5 END) AS aga,
         max(CASE WHEN is_home = 1 THEN p5 END) AS hp, max(CASE WHEN is_home = 0 THEN p5 END) AS ap,
         max(CASE WHEN is_home = 1 THEN wr5 END) AS hw, max(CASE WHEN is_home = 0 THEN wr5 END) AS aw
  FROM h GROUP BY id
)""") + """
SELECT f.id, f.ftr, round(hg, 6) AS home_gf_avg_last5, round(ag, 6) AS away_gf_avg_last5,
       round(hp, 6) AS home_points_sum_last5, round(ap, 6) AS away_points_sum_last5,
       round(hw, 6) AS home_win_rate_last5, round(aw, 6) AS away_win_rate_last5,
       round(hg - ag, 6) AS gf_avg_last5_diff, round(hga - aga, 6) AS ga_avg_last5_diff,
       round(hp - ap, 6) AS points_sum_last5_diff, round(hw - aw, 6) AS win_rate_last5_diff
FROM fixtures f LEFT JOIN wd ON f.id = wd.id
""")
def notebook_form_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form pack with trailing points sum and win rate, home-away differences."""
    res = features.notebook_form_features(bindings.fixtures(spark, sf_dir))
    return normalise(res.select("id", "ftr", "home_gf_avg_last5", "away_gf_avg_last5", "home_points_sum_last5",
                                "away_points_sum_last5", "home_win_rate_last5", "away_win_rate_last5",
                                "gf_avg_last5_diff", "ga_avg_last5_diff", "points_sum_last5_diff", "win_rate_last5_diff"))


# --- conversion tables on documents x labels --------------------------------------------------

_BINS_SQL = """
WITH d AS (SELECT CAST(n_chars AS DOUBLE) AS v, quality AS o FROM documents JOIN labels USING (doc_id)),
r AS (SELECT min(v) AS lo, max(v) AS hi FROM d),
b AS (
  SELECT v, o, lo, hi,
         CASE WHEN hi = lo THEN 4 ELSE greatest(1, least(8, CAST(ceil((v - lo) / ((hi - lo) / 8)) AS INTEGER))) END AS bin
  FROM d CROSS JOIN r
),
g AS (SELECT bin, avg(v) AS mean_value, count(*) AS shots, sum(o) AS goals, avg(o) AS conversion_rate,
             min(lo) AS lo, min(hi) AS hi FROM b GROUP BY bin)
SELECT CAST(bin AS BIGINT) AS bin, round(mean_value, 6) AS mean_value, CAST(shots AS BIGINT) AS shots,
       CAST(goals AS BIGINT) AS goals, round(conversion_rate, 6) AS conversion_rate,
       round(CASE WHEN bin = 1 THEN lo - (hi - lo) * 0.001 ELSE lo + (bin - 1) * ((hi - lo) / 8) END, 6) AS bin_left,
       round(lo + bin * ((hi - lo) / 8), 6) AS bin_right
FROM g
"""


@query("conversion_by_bins", _BINS_SQL)
def conversion_by_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9 + X6: quality rate by 8 equal-width bins of document length."""
    res = A.conversion_by_bins(_labelled_docs(spark, sf_dir), "n_chars", "quality", 8)
    return normalise(res.select("bin", "mean_value", "shots", "goals", "conversion_rate", "bin_left", "bin_right"))


_TOKENS_CTE = f"""
WITH d AS (SELECT doc_id, quality, unnest(list_distinct(regexp_extract_all(lower(text), '[a-z][a-z0-9_]{{2,}}'))) AS qualifier
           FROM documents JOIN labels USING (doc_id)),
t AS (SELECT * FROM d WHERE qualifier NOT IN ({_STOP})),
g AS (SELECT qualifier, count(*) AS shots, sum(quality) AS goals, avg(quality) AS conversion_rate FROM t GROUP BY qualifier)
"""


@query("token_conversion_top15", _TOKENS_CTE + """
SELECT qualifier, CAST(shots AS BIGINT) AS shots, CAST(goals AS BIGINT) AS goals, round(conversion_rate, 6) AS conversion_rate
FROM g WHERE shots >= 20 ORDER BY conversion_rate DESC, shots DESC, qualifier LIMIT 15
""")
def token_conversion_top15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F9 + A13: tokens of whole document texts, quality rate, support >= 20, top 15 by rate."""
    return normalise(A.token_stats(_labelled_docs(spark, sf_dir), "doc_id", "text", "quality", 20, 15, "rate", unique_ids=True))


@query("token_frequency_top15", _TOKENS_CTE.replace("JOIN labels USING (doc_id)", "").replace("SELECT doc_id, quality,", "SELECT doc_id, 0 AS quality,") + """
SELECT qualifier, CAST(shots AS BIGINT) AS shots FROM g ORDER BY shots DESC, qualifier LIMIT 15
""")
def token_frequency_top15(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A13 frequency table: documents per token over all documents, top 15."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.lit(0).alias("none"))
    return normalise(A.token_stats(docs, "doc_id", "text", "none", 0, 15, "rows", unique_ids=True))


@query("conversion_by_category", """
SELECT coalesce(source, 'Unknown') AS label, CAST(count(*) AS BIGINT) AS shots, CAST(sum(toxic) AS BIGINT) AS goals,
       round(avg(toxic), 6) AS conversion_rate
FROM documents JOIN labels USING (doc_id) GROUP BY 1 ORDER BY shots DESC, conversion_rate DESC, label LIMIT 10
""")
def conversion_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxic rate by source, top 10 by rows then rate."""
    return normalise(A.conversion_by_category(_labelled_docs(spark, sf_dir), "source", "toxic", 10))


@query("conversion_by_flag", """
SELECT CAST(toxic AS BIGINT) AS value, CAST(count(*) AS BIGINT) AS shots, CAST(sum(quality) AS BIGINT) AS goals,
       round(avg(quality), 6) AS conversion_rate, CASE toxic WHEN 0 THEN 'clean' WHEN 1 THEN 'toxic' ELSE CAST(toxic AS VARCHAR) END AS label
FROM documents JOIN labels USING (doc_id) GROUP BY toxic
""")
def conversion_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rate by the toxic flag, labelled."""
    return normalise(A.conversion_by_flag(_labelled_docs(spark, sf_dir), "toxic", "quality", {0: "clean", 1: "toxic"}))


@query("conversion_min_support", """
SELECT lang, CAST(count(*) AS BIGINT) AS shots, CAST(sum(coalesce(quality, 0)) AS BIGINT) AS goals,
       round(avg(coalesce(quality, 0)), 6) AS conversion_rate
FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang HAVING count(*) >= 50
""")
def conversion_min_support(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rate by language over all documents (unlabelled count as 0), support >= 50."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return normalise(A.conversion_table(docs, "lang", "quality", 50))


@query("linspace_profile", """
WITH d AS (SELECT CAST(n_chars AS DOUBLE) AS v, quality AS o FROM documents JOIN labels USING (doc_id)),
m AS (SELECT max(v) AS hi FROM d),
b AS (SELECT o, greatest(1, least(5, CAST(ceil(v / (hi / 5)) AS INTEGER))) AS bin FROM d CROSS JOIN m WHERE v >= 0 AND v <= hi)
SELECT CAST(bin AS BIGINT) AS bin, CAST(count(*) AS BIGINT) AS shots, CAST(sum(o) AS BIGINT) AS goals, round(avg(o), 6) AS conversion_rate
FROM b GROUP BY bin
""")
def linspace_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: quality rate over linspace(0, max, 6) edges of document length."""
    return normalise(A.profile_linspace(_labelled_docs(spark, sf_dir), "n_chars", "quality", 6))


# --- fixture-level profiles ---------------------------------------------------------------------

_PICK = "CASE WHEN b365h <= b365d AND b365h <= b365a THEN 'H' WHEN b365d <= b365a THEN 'D' ELSE 'A' END"


@query("market_confusion", with_ctes(FIXTURES_CTE) + f"""
, p AS (SELECT {_PICK} AS predicted, ftr AS actual FROM fixtures),
grid AS (SELECT a.l AS predicted, b.l AS actual FROM (VALUES ('H'), ('D'), ('A')) a(l), (VALUES ('H'), ('D'), ('A')) b(l))
SELECT g.predicted, g.actual, CAST(count(p.predicted) AS BIGINT) AS matches
FROM grid g LEFT JOIN p ON g.predicted = p.predicted AND g.actual = p.actual GROUP BY g.predicted, g.actual
""")
def market_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X11 + A12: shortest-price pick against the result on the zero-filled 3x3 grid."""
    fx = bindings.fixtures(spark, sf_dir).withColumn("pick", O.shortest_price_pick("b365h", "b365d", "b365a"))
    return normalise(A.crosstab_grid(fx, "pick", "ftr"))


@query("market_accuracy", with_ctes(FIXTURES_CTE) + f"""
SELECT round(avg(CASE WHEN {_PICK} = ftr THEN 1.0 ELSE 0.0 END), 6) AS accuracy, CAST(count(*) AS BIGINT) AS rows,
       round(avg(CASE WHEN (CASE WHEN 1 / bwh >= 1 / bwd AND 1 / bwh >= 1 / bwa THEN 'H' WHEN 1 / bwd >= 1 / bwa THEN 'D' ELSE 'A' END) = ftr
                 THEN 1.0 ELSE 0.0 END), 6) AS largest_prob_accuracy
FROM fixtures
""")
def market_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A32 + X12: accuracy of the shortest-price pick, and of the largest-probability pick of a second book."""
    fx = bindings.fixtures(spark, sf_dir)
    res = fx.agg(F.avg((O.shortest_price_pick("b365h", "b365d", "b365a") == F.col("ftr")).cast("double")).alias("accuracy"),
                 F.count(F.lit(1)).alias("rows"),
                 F.avg((O.largest_probability_pick("bwh", "bwd", "bwa") == F.col("ftr")).cast("double")).alias("largest_prob_accuracy"))
    return normalise(res)


@query("result_shares", with_ctes(FIXTURES_CTE) + """
, grid AS (SELECT * FROM (VALUES (0, 'H', 'Local'), (1, 'D', 'Empate'), (2, 'A', 'Visitante')) t(pos, key, label)),
c AS (SELECT ftr AS key, count(*) AS n FROM fixtures GROUP BY ftr),
t AS (SELECT count(*) AS total FROM fixtures)
SELECT CAST(g.pos AS BIGINT) AS pos, g.key, CAST(coalesce(c.n, 0) AS BIGINT) AS value,
       round(coalesce(c.n, 0) / t.total, 6) AS share, g.label
FROM grid g LEFT JOIN c ON g.key = c.key CROSS JOIN t
""")
def result_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11 + A36: result counts and shares in the fixed H, D, A order with labels."""
    fx = bindings.fixtures(spark, sf_dir)
    return normalise(A.counts_in_order(fx, "ftr", ["H", "D", "A"], {"H": "Local", "D": "Empate", "A": "Visitante"}))


@query("over_under_shares", with_ctes(FIXTURES_CTE) + """
, ou AS (SELECT CASE WHEN total_goals > 2.5 THEN 'Over 2.5' ELSE 'Under 2.5' END AS k FROM fixtures),
grid AS (SELECT * FROM (VALUES (0, 'Over 2.5'), (1, 'Under 2.5')) t(pos, key))
SELECT CAST(g.pos AS BIGINT) AS pos, g.key, CAST(count(ou.k) AS BIGINT) AS value,
       round(count(ou.k) / (SELECT count(*) FROM fixtures), 6) AS share, g.key AS label
FROM grid g LEFT JOIN ou ON g.key = ou.k GROUP BY g.pos, g.key
""")
def over_under_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X13 + A36: over/under 2.5 shares."""
    fx = bindings.fixtures(spark, sf_dir).withColumn("ou", O.over_under("total_goals"))
    return normalise(A.counts_in_order(fx, "ou", ["Over 2.5", "Under 2.5"]))


@query("actual_price_describe", with_ctes(FIXTURES_CTE) + """
, a AS (SELECT ftr, CASE ftr WHEN 'H' THEN b365h WHEN 'D' THEN b365d WHEN 'A' THEN b365a END AS p FROM fixtures)
SELECT ftr, CAST(count(p) AS BIGINT) AS count, round(avg(p), 6) AS mean, round(stddev_samp(p), 6) AS std,
       round(min(p), 6) AS min, round(quantile_cont(p, 0.25), 6) AS q25, round(quantile_cont(p, 0.5), 6) AS q50,
       round(quantile_cont(p, 0.75), 6) AS q75, round(max(p), 6) AS max
FROM a GROUP BY ftr
""")
def actual_price_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X14 + A19/A29: describe of the price of the outcome that happened, per result class."""
    fx = bindings.fixtures(spark, sf_dir).withColumn("p", O.actual_price("ftr", "b365h", "b365d", "b365a"))
    return normalise(profile.describe_by(fx, "ftr", "p"))


@query("class_signal", with_ctes(FIXTURES_CTE) + """
SELECT ftr, round(avg(1 / b365h), 6) AS mean_b365_home_prob, round(avg(1 / b365a), 6) AS mean_b365_away_prob,
       round(avg(CAST(hy + ay AS DOUBLE)), 6) AS mean_cards
FROM fixtures GROUP BY ftr
""")
def class_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature means per result class."""
    fx = bindings.fixtures(spark, sf_dir).withColumns({
        "b365_home_prob": O.implied_prob("b365h"), "b365_away_prob": O.implied_prob("b365a"),
        "cards": (F.col("hy") + F.col("ay")).cast("double")})
    return normalise(profile.class_means(fx, "ftr", ["b365_home_prob", "b365_away_prob", "cards"]))


@query("eda_summary", with_ctes(FIXTURES_CTE, EVENTS_CTE) + f"""
SELECT CAST(count(*) AS BIGINT) AS fixtures,
       round(avg(CASE WHEN ftr = 'H' THEN 1.0 ELSE 0.0 END), 6) AS home_win_rate,
       round(avg(CASE WHEN ftr = 'D' THEN 1.0 ELSE 0.0 END), 6) AS draw_rate,
       round(avg(CASE WHEN ftr = 'A' THEN 1.0 ELSE 0.0 END), 6) AS away_win_rate,
       round(avg(CASE WHEN {_PICK} = ftr THEN 1.0 ELSE 0.0 END), 6) AS market_accuracy,
       round(avg(total_goals), 6) AS avg_goals,
       (SELECT CAST(count(*) AS BIGINT) FROM play_events WHERE is_shot = 1) AS shots,
       (SELECT CAST(sum(is_goal) AS BIGINT) FROM play_events WHERE is_shot = 1) AS goals,
       (SELECT round(avg(CAST(is_goal AS DOUBLE)), 6) FROM play_events WHERE is_shot = 1) AS shot_conversion_rate
FROM fixtures
""")
def eda_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-row summary of fixtures and shots."""
    fx = bindings.fixtures(spark, sf_dir)
    shots = bindings.play_events(spark, sf_dir, fx).filter(F.col("is_shot") == 1)
    return normalise(profile.eda_summary(fx, shots))


# --- geometry on lineitem points ------------------------------------------------------------------

_GEO_SQL = with_ctes(POINTS_CTE, """
g1 AS (SELECT *, CASE WHEN x < 50 THEN 100 - x ELSE x END AS xn, CASE WHEN x < 50 THEN 100 - y ELSE y END AS yn FROM points),
g2 AS (SELECT *, (100 - xn) / 100 * 105.0 AS lon, (yn - 50) / 100 * 68.0 AS slat FROM g1),
g3 AS (SELECT *, sqrt(lon * lon + abs(slat) * abs(slat)) AS dm, sqrt(lon * lon + (slat - 3.66) * (slat - 3.66)) AS lp,
              sqrt(lon * lon + (slat + 3.66) * (slat + 3.66)) AS rp FROM g2)""") + """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, round(xn, 6) AS x, round(yn, 6) AS y,
       round(sqrt((100 - xn) * (100 - xn) + (50 - yn) * (50 - yn)), 6) AS distance_to_goal,
       round(abs(atan2(50 - yn, 100 - xn)), 6) AS angle_to_goal,
       round(dm, 6) AS distance_to_goal_m, round(degrees(abs(atan2(abs(slat), lon))), 6) AS angle_degrees,
       round(acos(greatest(least(CASE WHEN 2 * lp * rp > 0 THEN (lp * lp + rp * rp - 7.32 * 7.32) / (2 * lp * rp) ELSE 1.0 END, 1.0), -1.0)), 6) AS goal_frame_angle,
       round(1 - abs(yn - 50) / 50, 6) AS centrality_to_goal,
       CASE WHEN xn >= 94.5 AND yn BETWEEN 36.8 AND 63.2 THEN 'small_box' WHEN xn >= 83.5 AND yn BETWEEN 21.1 AND 78.9 THEN 'penalty_box'
            ELSE 'outside_box' END AS zone_key,
       CASE WHEN x >= 94 AND abs(y - 50) <= 10 THEN 'Área chica' WHEN x >= 84 AND abs(y - 50) <= 20 THEN 'Zona de penal'
            WHEN x >= 76 AND abs(y - 50) <= 28 THEN 'Frontal del área' ELSE 'Media distancia' END AS global_zone
FROM g3
"""


@query("shot_geometry", _GEO_SQL)
def shot_geometry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Direction normalisation, distances, angles, goal-frame angle and zones of every point."""
    pts = bindings.pitch_points(spark, sf_dir)
    g = pts.withColumn("global_zone", geometry.global_zone("x", "y")).withColumns(geometry.shot_geometry("x", "y"))
    g = g.withColumn("zone_key", geometry.zone_key("x", "y"))
    return normalise(g.select("l_orderkey", "l_linenumber", "x", "y", "distance_to_goal", "angle_to_goal", "distance_to_goal_m",
                              "angle_degrees", "goal_frame_angle", "centrality_to_goal", "zone_key", "global_zone"))


@query("density_grid", with_ctes(POINTS_CTE) + """
, c AS (SELECT least(CAST(floor(x / (100.0 / 18)) AS INTEGER), 17) AS xbin, least(CAST(floor(y / (100.0 / 12)) AS INTEGER), 11) AS ybin
        FROM points WHERE x >= 0 AND x <= 100 AND y >= 0 AND y <= 100)
SELECT CAST(xbin AS BIGINT) AS xbin, CAST(ybin AS BIGINT) AS ybin, CAST(count(*) AS BIGINT) AS count,
       round(count(*) / (SELECT count(*) FROM c), 6) AS share
FROM c GROUP BY xbin, ybin
""")
def density_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """18 x 12 density grid over 0-100 with each cell's share."""
    return normalise(profile.density2d(bindings.pitch_points(spark, sf_dir), "x", "y", 18, 12))


@query("histogram_by_flag", with_ctes(POINTS_CTE) + """
, c AS (SELECT l_returnflag, least(CAST(floor(x / (100.0 / 10)) AS INTEGER), 9) AS bin FROM points WHERE x >= 0 AND x <= 100),
t AS (SELECT l_returnflag, count(*) AS n FROM c GROUP BY l_returnflag)
SELECT CAST(bin AS BIGINT) AS bin, c.l_returnflag, CAST(count(*) AS BIGINT) AS count,
       round(bin * (100.0 / 10), 6) AS bin_left, round((bin + 1) * (100.0 / 10), 6) AS bin_right,
       round(count(*) / (min(t.n) * (100.0 / 10)), 6) AS density
FROM c JOIN t USING (l_returnflag) GROUP BY bin, c.l_returnflag
""")
def histogram_by_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixed-edge histogram of x per return flag with densities."""
    return normalise(profile.histogram(bindings.pitch_points(spark, sf_dir), "x", 0.0, 100.0, 10, by="l_returnflag", density=True))




@query("hexbin_points", with_ctes(POINTS_CTE) + """
, e AS (SELECT min(x) AS a, max(x) AS b, min(y) AS c, max(y) AS d FROM points),
g AS (SELECT a - 1e-9::DOUBLE * (b - a) AS x0, ((b + 1e-9::DOUBLE * (b - a)) - (a - 1e-9::DOUBLE * (b - a))) / 18 AS sx, c - 1e-9::DOUBLE * (d - c) AS y0,
             ((d + 1e-9::DOUBLE * (d - c)) - (c - 1e-9::DOUBLE * (d - c))) / 10 AS sy FROM e),
v AS (SELECT (x - x0) / sx AS xv, (y - y0) / sy AS yv, g.* FROM points CROSS JOIN g WHERE x IS NOT NULL AND y IS NOT NULL),
c AS (SELECT *, round_even(xv, 0) AS i1, round_even(yv, 0) AS j1, floor(xv) + 0.5 AS i2, floor(yv) + 0.5 AS j2 FROM v),
d AS (SELECT *, (xv - i1) * (xv - i1) + 3 * (yv - j1) * (yv - j1) < (xv - i2) * (xv - i2) + 3 * (yv - j2) * (yv - j2) AS near FROM c)
SELECT CAST(CASE WHEN near THEN 1 ELSE 2 END AS BIGINT) AS hex_lattice, round(CASE WHEN near THEN i1 ELSE i2 END * sx + x0, 6) AS hex_cx,
       round(CASE WHEN near THEN j1 ELSE j2 END * sy + y0, 6) AS hex_cy, CAST(count(*) AS BIGINT) AS count
FROM d GROUP BY 1, 2, 3 HAVING count(*) >= 1
""")
def hexbin_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hexagonal bins of all points (gridsize 18, mincnt 1); also checked against a brute-force
    nearest-centre search in tests."""
    return normalise(profile.hexbin(bindings.pitch_points(spark, sf_dir), "x", "y", 18, 1))


@query("correlation_pairs", """
SELECT * FROM (VALUES
  ('l_quantity', 'l_extendedprice', (SELECT round(corr(l_quantity, l_extendedprice), 6) FROM lineitem)),
  ('l_quantity', 'l_discount', (SELECT round(corr(l_quantity, l_discount), 6) FROM lineitem)),
  ('l_quantity', 'l_tax', (SELECT round(corr(l_quantity, l_tax), 6) FROM lineitem)),
  ('l_extendedprice', 'l_discount', (SELECT round(corr(l_extendedprice, l_discount), 6) FROM lineitem)),
  ('l_extendedprice', 'l_tax', (SELECT round(corr(l_extendedprice, l_tax), 6) FROM lineitem)),
  ('l_discount', 'l_tax', (SELECT round(corr(l_discount, l_tax), 6) FROM lineitem))
) t(feature_a, feature_b, corr)
""")
def correlation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X19 + R6: upper-triangle Pearson correlations in one aggregation pass."""
    li = table(spark, sf_dir, "lineitem")
    return normalise(reshape.correlation_pairs(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))


@query("target_correlation", """
SELECT * FROM (VALUES
  ('l_quantity', (SELECT round(corr(l_quantity, o_totalprice), 6) FROM lineitem JOIN orders ON l_orderkey = o_orderkey)),
  ('l_discount', (SELECT round(corr(l_discount, o_totalprice), 6) FROM lineitem JOIN orders ON l_orderkey = o_orderkey)),
  ('l_tax', (SELECT round(corr(l_tax, o_totalprice), 6) FROM lineitem JOIN orders ON l_orderkey = o_orderkey))
) t(feature, corr) CROSS JOIN (SELECT 1) u
""".replace("SELECT * FROM (VALUES", "SELECT feature, corr, abs(corr) AS abs_corr FROM (VALUES"))
def target_correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlation of line features with the order total (join on the order key)."""
    li = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    res = reshape.correlation_with_target(li, ["l_quantity", "l_discount", "l_tax"], "o_totalprice")
    return normalise(res.select("feature", "corr", "abs_corr"))


@query("redundant_pairs", """
SELECT * FROM (
  SELECT 'l_quantity' AS feature_a, 'l_extendedprice' AS feature_b, round(corr(l_quantity, l_extendedprice), 6) AS corr FROM lineitem
  UNION ALL SELECT 'l_quantity', 'qty2', round(corr(l_quantity, l_quantity * 2 + l_tax), 6) FROM lineitem
  UNION ALL SELECT 'l_extendedprice', 'qty2', round(corr(l_extendedprice, l_quantity * 2 + l_tax), 6) FROM lineitem
) WHERE abs(corr) >= 0.85
""")
def redundant_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs with |corr| >= 0.85."""
    li = table(spark, sf_dir, "lineitem").withColumn("qty2", F.col("l_quantity") * 2 + F.col("l_tax"))
    return normalise(reshape.redundant_pairs(li, ["l_quantity", "l_extendedprice", "qty2"], 0.85))


@query("two_sided_balances", """
WITH c AS (SELECT c_nationkey AS nation, count(*) AS customers, sum(c_acctbal) AS customer_balance FROM customer GROUP BY 1),
s AS (SELECT s_nationkey AS nation, count(*) AS suppliers, sum(s_acctbal) AS supplier_balance FROM supplier GROUP BY 1)
SELECT CAST(coalesce(c.nation, s.nation) AS BIGINT) AS nation, CAST(coalesce(customers, 0) AS BIGINT) AS customers,
       round(coalesce(customer_balance, 0), 6) AS customer_balance, CAST(coalesce(suppliers, 0) AS BIGINT) AS suppliers,
       round(coalesce(supplier_balance, 0), 6) AS supplier_balance
FROM c FULL OUTER JOIN s ON c.nation = s.nation
""")
def two_sided_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A21 + J9: per-nation aggregates of customers and suppliers, full outer join, nulls to 0."""
    cust = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "nation")
    supp = table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "nation")
    res = A.two_sided_totals(cust, supp, "nation",
                             {"customers": F.count(F.lit(1)), "customer_balance": F.sum("c_acctbal")},
                             {"suppliers": F.count(F.lit(1)), "supplier_balance": F.sum("s_acctbal")})
    return normalise(res)


@query("quality_summary", """
SELECT 'orders' AS "table", CAST(count(*) AS BIGINT) AS rows, CAST(6 AS BIGINT) AS columns,
       CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM orders)) AS BIGINT) AS duplicate_rows,
       CAST(sum((o_orderkey IS NULL)::INT + (o_custkey IS NULL)::INT + (o_orderstatus IS NULL)::INT + (o_totalprice IS NULL)::INT
            + (o_orderdate IS NULL)::INT + (o_orderpriority IS NULL)::INT) AS BIGINT) AS missing_cells,
       round(sum((o_orderkey IS NULL)::INT + (o_custkey IS NULL)::INT + (o_orderstatus IS NULL)::INT + (o_totalprice IS NULL)::INT
            + (o_orderdate IS NULL)::INT + (o_orderpriority IS NULL)::INT) * 100.0 / (count(*) * 6), 6) AS missing_pct,
       CAST(0 AS BIGINT) AS invalid_dates
FROM orders
""")
def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Data-quality summary of orders (duplicates by grouping on all columns)."""
    return normalise(profile.quality_summary(table(spark, sf_dir, "orders"), "orders", ["o_orderdate"]))


@query("null_counts_top10", """
WITH j AS (SELECT * FROM documents d LEFT JOIN labels l USING (doc_id)),
c AS (
  SELECT * FROM (VALUES
   ('doc_id', (SELECT count(*) - count(doc_id) FROM j)), ('text', (SELECT count(*) - count(text) FROM j)),
   ('lang', (SELECT count(*) - count(lang) FROM j)), ('source', (SELECT count(*) - count(source) FROM j)),
   ('n_chars', (SELECT count(*) - count(n_chars) FROM j)), ('quality', (SELECT count(*) - count(quality) FROM j)),
   ('toxic', (SELECT count(*) - count(toxic) FROM j))) t("column", nulls))
SELECT "column", CAST(nulls AS BIGINT) AS nulls FROM c ORDER BY nulls DESC, "column" LIMIT 10
""")
def null_counts_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null counts per column of documents left-joined to labels."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return normalise(profile.null_counts(docs, 10))


@query("table_overview", """
SELECT 'lineitem' AS "table", CAST(count(*) AS BIGINT) AS rows, CAST(11 AS BIGINT) AS columns,
       'l_orderkey:bigint, l_partkey:bigint, l_suppkey:bigint, l_linenumber:int, l_quantity:double, l_extendedprice:double, l_discount:double, l_tax:double, l_returnflag:string, l_linestatus:string, l_shipdate:timestamp_ntz' AS dtypes
FROM lineitem
""")
def table_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, column count, types."""
    return normalise(profile.overview(table(spark, sf_dir, "lineitem"), "lineitem"))
