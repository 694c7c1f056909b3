"""Registered queries of library functions that the other plans do not reach."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions import clean, odds as O, text
from touchline.ml import logistic_grid as L
from touchline.ml import models as M
from touchline.ml.split import holdout_flag
from touchline.operators import aggregate as A
from touchline.operators import ensemble as EN
from touchline.operators import features, reshape
from touchline.operators import profile as P
from touchline.operators import scoring as SC
from touchline.operators import shots as S
from touchline.plans import bindings
from touchline.plans.oracle import FIXTURES_CTE, TEAM_LONG_CTE, with_ctes
from touchline.plans.registry import normalise, query
from touchline.session import shared_folder
from touchline.sources import io as IO
from touchline.sources.tables import table

_SPLIT_CTE = """
numbered AS (SELECT *, row_number() OVER (ORDER BY kickoff, id) - 1 AS i, count(*) OVER () AS rows FROM fixtures),
held AS (SELECT *, i < greatest(CAST(floor(rows * 0.8) AS BIGINT), 1) AS is_train FROM numbered)"""


@query("frame_repairs", """
SELECT c_custkey AS k, round(coalesce(CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 END, 0), 6) AS bal,
       coalesce(CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END, 'none') AS seg, CAST(0 AS BIGINT) AS goals, 'D' AS ftr,
       (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY c_custkey) AS new_id
FROM customer WHERE c_custkey % 5 = 0
""")
def frame_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J10 + P8 + P5 + R7: a balance from the local table or the joined one, placeholders for absent columns and nulls,
    the numeric check, and ids after the largest."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").cast("double").alias("b"), F.col("c_mktsegment").alias("seg"))
    left = c.select("k", F.when(F.col("k") % 4 != 0, F.col("b")).alias("bal"))
    right = c.filter(F.col("k") % 3 == 0).select("k", (F.col("b") + 1).alias("bal"), "seg")
    merged = S.coalescing_merge(left, right, "k", ["bal", "seg"])
    filled = clean.strict_numeric(clean.fill_placeholders(merged, {"seg": "none", "bal": 0.0, "goals": 0, "ftr": "D"}), ["bal", "goals"])
    out = reshape.assign_new_ids(c, filled.filter(F.col("k") % 5 == 0), "k", ["k"], "new_id")
    return normalise(out.select("k", "bal", "seg", F.col("goals").cast("long"), "ftr", "new_id"))


@query("score_scalars", with_ctes(FIXTURES_CTE) + """
, p AS (SELECT id, kickoff, b365h * f AS h, b365d * f AS d, (b365a - 4) * f AS a, id % 4 AS kind, CASE WHEN id % 7 = 0 THEN hs / 10.0 END AS e, CASE WHEN id % 3 <> 0 THEN hst / 10.0 END AS ca,
               CASE WHEN id % 5 <> 0 THEN ast / 10.0 END AS cf, CASE WHEN id % 11 > 4 THEN hy / 10.0 END AS ta, ay / 10.0 AS tf
        FROM (SELECT *, CASE WHEN id % 2 = 0 THEN 0.1 ELSE 30.0 END AS f FROM fixtures)),
s AS (SELECT *, CASE WHEN greatest(h, d, a) <= 1 THEN 100.0 ELSE 1.0 END AS m FROM p)
SELECT id, strftime(kickoff, '%Y-%m-%d') AS day, round(greatest(least(h * m, 100), 0), 6) AS h, round(greatest(least(d * m, 100), 0), 6) AS d, round(greatest(least(a * m, 100), 0), 6) AS a,
       CASE kind WHEN 0 THEN 'H' WHEN 1 THEN 'D' WHEN 2 THEN 'A' ELSE 'H' END AS label,
       round(coalesce(e, (ca + cf + ta + tf) / 4, ta, tf, ca, cf), 6) AS score
FROM s
""")
def score_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P23 + E38 + E15 + F10: percentages of fractions and of percentages, cleaned labels, a run's score, days."""
    i = F.col("id")
    f = F.when(i % 2 == 0, 0.1).otherwise(30.0)
    tenth = lambda c: F.col(c) / 10.0
    fx = bindings.fixtures(spark, sf_dir).select(
        "id", "kickoff", (F.col("b365h") * f).alias("h"), (F.col("b365d") * f).alias("d"), ((F.col("b365a") - 4) * f).alias("a"),
        F.when(i % 4 == 0, "h").when(i % 4 == 1, "D").when(i % 4 == 2, "a").when(i % 8 == 3, "x").alias("label"), F.when(i % 7 == 0, tenth("hs")).alias("e"),
        F.when(i % 3 != 0, tenth("hst")).alias("ca"), F.when(i % 5 != 0, tenth("ast")).alias("cf"), F.when(i % 11 > 4, tenth("hy")).alias("ta"), tenth("ay").alias("tf"))
    h, d, a = O.percent_scale("h", "d", "a")
    out = SC.clean_labels(fx, "label").select("id", text.date_text("kickoff").alias("day"), h.alias("h"), d.alias("d"), a.alias("a"), "label",
                                              EN.model_score(["e"], "ca", "cf", "ta", "tf").alias("score"))
    return normalise(out)


@query("report_shots", """
WITH s AS (SELECT l_orderkey AS k, l_linenumber AS n, l_quantity * 2 AS x FROM lineitem)
SELECT k, n, CASE WHEN n = 1 THEN 'penalty' WHEN k % 2 = 0 THEN 'header' WHEN n = 3 OR n = 4 THEN 'foot' ELSE 'other' END AS shot_type_key,
       CASE WHEN n = 2 OR n = 6 THEN 'Jugador no identificado' ELSE 'p' || k END AS player_name, round(CASE WHEN n = 5 THEN 0.0 ELSE x / 100 END, 6) AS xg,
       round(x, 6) AS distance_to_goal_m
FROM s WHERE n <> 7
""")
def report_shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shots made ready for a report: rows without a place go, labels are filled, the shot type is inferred,
    stored distances stay."""
    n, k = F.col("l_linenumber"), F.col("l_orderkey")
    x = F.col("l_quantity").cast("double") * 2
    flag = lambda c: c.cast("int")
    shots = table(spark, sf_dir, "lineitem").select(
        k.alias("k"), n.alias("n"), F.when(n != 7, x).alias("x"), F.lit(50.0).alias("y"), x.alias("distance_to_goal_m"), flag(n == 1).alias("is_penalty"), flag(k % 2 == 0).alias("is_header"),
        flag(n == 3).alias("is_left_foot"), flag(n == 4).alias("is_right_foot"), F.when(n != 2, F.when(n == 6, "").otherwise(F.concat(F.lit("p"), k))).alias("player_name"),
        F.when(n == 5, float("nan")).otherwise(x / 100).alias("xg"))
    return normalise(S.normalise_for_report(shots).select("k", "n", "shot_type_key", "player_name", "xg", "distance_to_goal_m"))


@query("facets_and_medians", """
WITH h AS (SELECT median(CAST(c_acctbal AS DOUBLE)) AS m FROM customer WHERE c_custkey % 2 = 0),
f AS (SELECT DISTINCT c_mktsegment AS v FROM customer WHERE c_nationkey = 3)
SELECT c_custkey AS k, round(CASE WHEN c_custkey % 3 = 0 THEN (SELECT m FROM h) ELSE c_acctbal END, 6) AS bal, CAST(c_mktsegment IN (SELECT v FROM f) AS BIGINT) AS offered FROM customer
""")
def facets_and_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5 + A35: missing balances take the median of the history; segments that a filtered facet offers."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").cast("double").alias("bal"), "c_mktsegment", "c_nationkey")
    asked = c.withColumn("bal", F.when(F.col("k") % 3 != 0, F.col("bal")))
    filled = features.fill_with_history_medians(asked, c.filter(F.col("k") % 2 == 0), ["bal"], exact=True)
    facet = A.facet_values(c, "c_mktsegment", F.col("c_nationkey") == 3).withColumn("offered", F.lit(1))
    return normalise(filled.join(facet, "c_mktsegment", "left").select("k", "bal", F.coalesce("offered", F.lit(0)).alias("offered")))


@query("fallback_preview", with_ctes(FIXTURES_CTE) + """
, f AS (SELECT id, kickoff, CASE WHEN id % 5 = 0 THEN 2.4 ELSE b365h END AS h, b365d AS d, CASE WHEN id % 6 = 0 THEN 3.0 ELSE b365a END AS a FROM fixtures),
p AS (SELECT id, kickoff, 1 / h / (1 / h + 1 / d + 1 / a) AS h, 1 / d / (1 / h + 1 / d + 1 / a) AS d, 1 / a / (1 / h + 1 / d + 1 / a) AS a FROM f)
SELECT id, round(h, 6) AS p_home, round(d, 6) AS p_draw, round(a, 6) AS p_away, CASE WHEN h >= d AND h >= a THEN 'H' WHEN d >= a THEN 'D' ELSE 'A' END AS predicted_result,
       2.7 AS predicted_total_goals, 'no model' AS fallback_reason FROM p ORDER BY kickoff, id LIMIT 200
""")
def fallback_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E30 + S14: fixtures that no model could score take the market's probabilities; the first 200 in time order."""
    i = F.col("id")
    fx = bindings.fixtures(spark, sf_dir).select("id", "kickoff", F.when(i % 5 != 0, F.col("b365h")).alias("b365h"), "b365d", F.when(i % 6 != 0, F.col("b365a")).alias("b365a"))
    out = SC.preview(SC.fallback_rows(fx, "no model"), ["kickoff", "id"], 200)
    return normalise(out.select("id", "p_home", "p_draw", "p_away", "predicted_result", "predicted_total_goals", "fallback_reason"))


@query("completed_features", with_ctes(FIXTURES_CTE, TEAM_LONG_CTE, _SPLIT_CTE) + """
, l AS (SELECT t.team, avg(goals_for) AS gf, avg(points) AS pt FROM (SELECT team_long.* FROM team_long JOIN held USING (id) WHERE held.is_train
        QUALIFY row_number() OVER (PARTITION BY team ORDER BY team_long.kickoff DESC, id DESC) <= 5) t GROUP BY t.team)
SELECT n.id, round(h.gf, 6) AS home_goals_for_last5, round(a.pt, 6) AS away_points_last5, round(h.gf - a.gf, 6) AS goals_for_diff_last5, round(1 / n.b365h, 6) AS b365_home_prob,
       n.id % 9 AS extra FROM held n LEFT JOIN l h ON h.team = n.home_team LEFT JOIN l a ON a.team = n.away_team WHERE NOT n.is_train
""")
def completed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frame of new fixtures without the required features gets them from history and keeps its own columns."""
    both = bindings.with_time_split(bindings.fixtures(spark, sf_dir))
    books = [f"{b}{s}" for b in features.BOOKS for s in features.SIDE_NAMES]
    frame = both.filter(~F.col("is_train")).select("id", "kickoff", "home_team", "away_team", "referee", *books, (F.col("id") % 9).alias("extra"))
    wanted = ["home_goals_for_last5", "away_points_last5", "goals_for_diff_last5", "b365_home_prob"]
    return normalise(features.complete_features(frame, wanted, both.filter("is_train").drop("is_train")).select("id", *wanted, "extra"))


@query("in_sample_fit", with_ctes(FIXTURES_CTE) + """
, t AS (SELECT id, CAST(hst AS DOUBLE) AS x, total_goals + hst / 3.0 AS y FROM fixtures),
m AS (SELECT regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM t)
SELECT id, round(a + b * x, 6) AS prediction, CAST(1 AS BIGINT) AS in_sample, round(abs(b), 6) AS importance FROM t CROSS JOIN m
""")
def in_sample_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M34 + M32 + M11: a linear model refitted on every row scores every row, marked as in sample; its coefficient."""
    data = bindings.fixtures(spark, sf_dir).select("id", F.col("hst").cast("double").alias("x"), (F.col("total_goals") + F.col("hst") / 3.0).alias("label")).checkpoint(eager=True)
    scored = M.score_all_rows(data, ["x"], M.estimator("linear", "regressor"))
    plain = M.build_pipeline(["x"], M.estimator("linear", "regressor"), impute=None, scale=False).fit(data)
    (_, weight), = M.coefficient_importance(plain, ["x"])
    return normalise(scored.select("id", "prediction", "in_sample", F.lit(weight).alias("importance")))


@query("residual_histogram", with_ctes(FIXTURES_CTE) + """
, r AS (SELECT total_goals - hst * 0.7 AS v FROM fixtures), b AS (SELECT min(v) AS lo, max(v) AS hi FROM r)
SELECT CAST(least(floor((v - lo) / ((hi - lo) / 24)), 23) AS BIGINT) AS bin, count(*) AS count,
       round(lo + CAST(least(floor((v - lo) / ((hi - lo) / 24)), 23) AS BIGINT) * (hi - lo) / 24, 6) AS bin_left FROM r CROSS JOIN b GROUP BY 1, 3
""")
def residual_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The residuals of a goals estimate in 24 equal bins over their range."""
    fx = bindings.fixtures(spark, sf_dir).select("total_goals", (F.col("hst") * F.lit(0.7)).alias("predicted"))
    return normalise(P.residual_summary(fx, "total_goals", "predicted")[1].select("bin", "count", "bin_left"))


@query("csv_round_trip", """
SELECT c_custkey AS k, c_name || chr(10) || '"' || c_mktsegment || '", ' || c_custkey AS note, round(c_acctbal, 6) AS bal,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_custkey % 17 END AS n, CAST(NULL AS VARCHAR) AS absent, (SELECT count(*) FROM customer) AS written FROM customer
""")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10 + S1 + S4: customers written as CSV with quoted line breaks, quotes and commas, and read back in splits by column
    name; bad numbers and absent columns are null."""
    k = F.col("c_custkey")
    out = table(spark, sf_dir, "customer").select(
        F.concat("c_name", F.lit('\n"'), "c_mktsegment", F.lit('", '), k).alias(" Note "), F.when(k % 4 == 0, "n/a").otherwise((k % 17).cast("string")).alias("N"), k.alias("k"),
        F.col("c_acctbal").alias("BAL"), F.lit("left out").alias("extra"))
    path = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    out.write.option("header", True).option("escape", '"').csv(path)
    written = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path).count()
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("note", T.StringType()), T.StructField("bal", T.DoubleType()), T.StructField("n", T.LongType()),
                           T.StructField("absent", T.StringType())])
    return normalise(IO.read_csv(spark, path, schema).withColumn("written", F.lit(written)))


_SUBSETS = {"odds": ["b365h", "b365d", "b365a"], "history": ["hst", "ast", "hy"], "both": ["b365h", "b365d", "b365a", "hst", "ast", "hy"]}


@query("ablation_optimum", with_ctes(FIXTURES_CTE, _SPLIT_CTE) + """
, c AS (SELECT sum(CASE WHEN is_train THEN 1 ELSE 0 END) AS trained, sum(CASE WHEN is_train THEN 0 ELSE 1 END) AS scored FROM held)
SELECT system, CAST(trained AS BIGINT) AS trained, CAST(scored AS BIGINT) AS scored, CAST(1 AS BIGINT) AS optimal FROM c CROSS JOIN (VALUES ('odds'), ('history'), ('both')) t(system)
""")
def ablation_optimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10 + E9: the multinomial model with C = 10 on the odds, on other columns and on both: rows trained on and scored, and
    whether the fit meets the conditions of its optimum, computed anew from the rows."""
    fx = holdout_flag(bindings.fixtures(spark, sf_dir), ["kickoff", "id"])
    data = fx.select(F.col("result_code").cast("int").alias("label") if "result_code" in fx.columns else M.label_code("ftr").cast("int").alias("label"),
                     F.when(F.col("is_train"), -1).otherwise(0).alias("fold"), *[F.col(c).cast("double").alias(c) for c in _SUBSETS["both"]]).checkpoint(eager=True)
    out = []
    for system, columns in _SUBSETS.items():
        tensor, _ = L.fit_grid(data, columns, "label", "fold", [(10.0, 0.0)])
        slope = tensor.sums(L.selected(data, columns, "label", "fold"), tensor.w, tensor.w[..., 0, 0] < float("inf"))[1]
        scored = L.confusion(data, columns, "label", "fold", tensor).agg(F.sum("n")).first()[0]
        out.append((system, int(tensor.n[0]), int(scored), bool(tensor.violation(slope).max() < 1e-6)))
    return normalise(spark.createDataFrame(out, "system string, trained long, scored long, optimal boolean"))
