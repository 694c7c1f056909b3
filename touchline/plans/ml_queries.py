"""Registered Spark ML queries.

What a fit must satisfy whatever its quality is stated in SQL: rows trained on and scored, class weights,
probabilities that sum to 1, planned runs, folds and ranks. Fits with a closed form (one feature), scaling,
polynomials, imputation and softmax are checked by their formulas, exact kNN by brute force. Quality figures
stay out of the hashed rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.ml import knn as K
from touchline.ml import models as M
from touchline.ml import search as S
from touchline.ml.split import fold_of, holdout_flag, holdout_split
from touchline.operators import aggregate as A
from touchline.operators import evaluate as EV
from touchline.operators import features
from touchline.functions.odds import softmax
from touchline.plans import bindings
from touchline.plans.event_queries import enriched_shots
from touchline.plans.oracle import EVENTS_CTE, FIXTURES_CTE, with_ctes
from touchline.plans.registry import normalise, query
from touchline.session import stored
from touchline.sources.tables import table

MATCH_FEATURES = ["home_goals_for_last5", "away_goals_for_last5", "home_goals_against_last5", "away_goals_against_last5",
                  "home_points_last5", "away_points_last5", "goals_for_diff_last5", "points_diff_last5",
                  "ref_avg_goals_last10", "b365_home_prob", "b365_draw_prob", "b365_away_prob", "market_entropy_b365",
                  "home_odds_dispersion", "away_odds_dispersion"]
XG_FEATURES = ["distance_to_goal_m", "goal_frame_angle", "angle_degrees", "centrality_to_goal", "distance_squared",
               "shot_angle_distance_interaction", "is_big_chance", "is_header", "is_penalty", "is_right_foot", "is_left_foot",
               "is_counter_attack", "from_corner", "is_volley", "first_touch", "is_assisted", "score_diff_before_shot"]


def match_table(spark: SparkSession, sf_dir: str, keep: Sequence[str] = (), indexed: bool = False) -> DataFrame:
    """The fixtures with the features of ``MATCH_FEATURES``, the label and the time-ordered holdout. Only the columns that
    a fit or a benchmark reads (and ``keep``) pass the windows, the join and the written table. ``indexed``: with
    ``row_idx`` for folds, which sorts the rows themselves."""
    columns = ["id", "kickoff", "is_train", "total_goals", "b365h", "b365d", "b365a", *MATCH_FEATURES, "label", *keep]
    fx = holdout_split(bindings.fixtures(spark, sf_dir), ["kickoff", "id"], idx_col="row_idx" if indexed else None)
    feats = features.fixture_features(fx, None, 5, ["goals_for", "goals_against", "points"])
    data = feats.withColumn("label", F.col("result_code").cast("double")).select(*columns, *(["row_idx"] if indexed else []))
    # cut the window/join lineage once before the iterative fits (written to spark.checkpoint.dir)
    return stored(data.fillna(0.0, subset=MATCH_FEATURES), "matches")


_TRAIN_CTE = """
split AS (SELECT *, row_number() OVER (ORDER BY kickoff, id) - 1 AS row_idx, count(*) OVER () AS n FROM fixtures),
data AS (SELECT *, row_idx < greatest(CAST(floor(n * 0.8) AS BIGINT), 1) AS is_train FROM split)"""


def _probability_checks(pred: DataFrame, names) -> list:
    """Aggregates: scored rows, and those whose probabilities lie in [0, 1] and sum to 1."""
    total = sum(F.col(c) for c in names)
    ok = (F.abs(total - 1) < 1e-9)
    for c in names:
        ok = ok & F.col(c).between(0, 1)
    return [F.count(F.lit(1)).alias("scored"), F.sum(ok.cast("long")).alias("valid")]


@query("xg_logistic_model", with_ctes(FIXTURES_CTE, EVENTS_CTE) + """
, o AS (SELECT p.is_goal, row_number() OVER (ORDER BY f.kickoff, p.match_id, p.minute, p.second, p.id) - 1 AS i, count(*) OVER () AS n
        FROM play_events p JOIN fixtures f ON p.match_id = f.id WHERE p.is_shot = 1),
t AS (SELECT *, i < greatest(CAST(floor(n * 0.8) AS BIGINT), 1) AS is_train FROM o),
c AS (SELECT is_goal, count(*) AS rows, sum(CASE WHEN is_train THEN 1 ELSE 0 END) AS tr, sum(CASE WHEN is_train THEN 0 ELSE 1 END) AS te FROM t GROUP BY is_goal)
SELECT CAST(is_goal AS DOUBLE) AS label, CAST(tr AS BIGINT) AS trained, round(sum(rows) OVER () / (count(*) OVER () * rows), 6) AS weight,
       CAST(te AS BIGINT) AS scored, CAST(te AS BIGINT) AS valid FROM c
""")
def xg_logistic_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M9 + M8 + M1: class-weighted logistic xG on 17 shot features, time-ordered 80/20 holdout: per class
    its balanced weight, the rows trained on and scored, and those with valid probabilities."""
    shots = enriched_shots(spark, sf_dir)
    shots = shots.withColumns({c: F.col(c).cast("double") for c in XG_FEATURES}).withColumn("label", F.col("is_goal").cast("double"))
    data = M.class_weights(holdout_flag(shots, ["kickoff", "match_id", "minute", "second", "id"]), "label").select(
        "id", "label", "weight", "is_train", *XG_FEATURES).checkpoint(eager=True)
    model = M.build_pipeline(XG_FEATURES, M.estimator("logistic", "classifier", weight="weight")).fit(data.filter("is_train"))
    pred = M.probabilities(model.transform(data.filter(~F.col("is_train"))), names=("p0", "p1"))
    per = pred.groupBy("label").agg(*_probability_checks(pred, ["p0", "p1"]))
    trained = data.groupBy("label").agg(F.sum(F.col("is_train").cast("long")).alias("trained"), F.max("weight").alias("weight"))
    return normalise(trained.join(per, "label", "left").select("label", "trained", "weight", "scored", "valid"))


CLASSIFIERS = [("multinomial", {"regParam": 0.01}), ("elasticnet_logistic", {"regParam": 0.01, "elasticNetParam": 0.5}),
               ("random_forest", {"numTrees": 100, "maxDepth": 7}), ("gbt", {"maxIter": 20, "maxDepth": 3}),
               ("mlp", {"layers": [len(MATCH_FEATURES), 64, 32, 3], "maxIter": 100})]
REGRESSORS = [("linear", {}), ("ridge", {"regParam": 0.001}), ("elasticnet", {"regParam": 0.01, "elasticNetParam": 0.5}),
              ("random_forest", {"numTrees": 100, "maxDepth": 7}), ("gbt", {"maxIter": 20, "maxDepth": 3})]


@query("match_model_comparison", with_ctes(FIXTURES_CTE, _TRAIN_CTE) + """
, sys AS (SELECT * FROM (VALUES ('multinomial'), ('elasticnet_logistic'), ('random_forest'), ('gbt'), ('mlp'), ('ridge_classifier'), ('market')) t(system)),
mk AS (SELECT avg(CASE WHEN (CASE WHEN b365h <= b365d AND b365h <= b365a THEN 'H' WHEN b365d <= b365a THEN 'D' ELSE 'A' END) = ftr THEN 1.0 ELSE 0.0 END) AS acc
       FROM data WHERE NOT is_train)
SELECT system, CAST((SELECT count(*) FROM data WHERE NOT is_train) AS BIGINT) AS n, CAST((SELECT count(*) FROM data WHERE NOT is_train) AS BIGINT) AS valid,
       round(CASE WHEN system = 'market' THEN (SELECT acc FROM mk) END, 6) AS benchmark_accuracy FROM sys
""")
def match_model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10, M13, M15, M17, M18, M19 + E21: H/D/A classifiers on the fixture features, same time-ordered
    holdout: rows scored per model, rows with a class of the list, and the market benchmark's accuracy."""
    data = match_table(spark, sf_dir)
    train, test = data.filter("is_train"), data.filter(~F.col("is_train"))
    preds = []
    for name, params in CLASSIFIERS:
        est_name = "multinomial" if name == "elasticnet_logistic" else name
        m = M.build_pipeline(MATCH_FEATURES, M.estimator(est_name, "classifier", **params), impute=None).fit(train)
        preds.append(m.transform(test).select(F.lit(name).alias("system"), "label", "prediction"))
    ridge = M.ridge_classifier(train, MATCH_FEATURES, "label", impute=None)
    preds.append(ridge(test).select(F.lit("ridge_classifier").alias("system"), "label", "prediction"))
    preds.append(test.select(
        F.lit("market").alias("system"), "label",
        F.when((F.col("b365h") <= F.col("b365d")) & (F.col("b365h") <= F.col("b365a")), 0.0)
         .when(F.col("b365d") <= F.col("b365a"), 1.0).otherwise(2.0).alias("prediction")))
    allp = preds[0]
    for p in preds[1:]:
        allp = allp.unionByName(p)
    code = lambda c: F.element_at(F.array(*[F.lit(x) for x in M.CODE_LABELS]), F.col(c).cast("int") + 1)
    counts = EV.outcome_counts(allp.withColumns({"l": code("label"), "p": code("prediction")}), "l", "p", by=["system"]).checkpoint(eager=True)
    known = counts.groupBy("system").agg(F.sum(F.when(F.col("predicted") != EV.OTHER, F.col("count"))).alias("valid"))
    met = EV.summary_metrics(counts, by=["system"]).join(known, "system")
    return normalise(met.select("system", "n", "valid", F.when(F.col("system") == "market", F.col("accuracy")).alias("benchmark_accuracy")))


@query("goals_regression_models", with_ctes(FIXTURES_CTE, _TRAIN_CTE) + """
SELECT model, CAST((SELECT count(*) FROM data WHERE NOT is_train) AS BIGINT) AS n, CAST(1 AS BIGINT) AS mae_at_most_rmse, CAST(1 AS BIGINT) AS r2_at_most_one
FROM (VALUES ('linear'), ('ridge'), ('elasticnet'), ('random_forest'), ('gbt')) t(model)
""")
def goals_regression_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M11, M12, M14, M17, M18 + E3: total-goals regressors on the same holdout: rows scored and the
    relations that hold between their error measures."""
    data = match_table(spark, sf_dir).withColumn("goals", F.col("total_goals"))
    train, test = data.filter("is_train"), data.filter(~F.col("is_train"))
    out = None
    for name, params in REGRESSORS:
        m = M.build_pipeline(MATCH_FEATURES, M.estimator(name, "regressor", label="goals", **params), impute=None).fit(train)
        scored = m.transform(test).select(F.lit(name).alias("model"), "goals", "prediction")
        out = scored if out is None else out.unionByName(scored)
    r = EV.regression_metrics(out, "goals", "prediction", by=["model"])
    return normalise(r.select("model", "n", (F.col("mae") <= F.col("rmse")).alias("mae_at_most_rmse"), (F.col("r2") <= 1).alias("r2_at_most_one")))


@query("one_feature_fits", with_ctes(FIXTURES_CTE, _TRAIN_CTE) + """
, t AS (SELECT 1 / b365h AS x, total_goals AS y FROM data WHERE is_train)
SELECT 'linear' AS model, round(regr_slope(y, x), 6) AS slope, round(regr_intercept(y, x), 6) AS intercept FROM t
UNION ALL SELECT 'ridge', round(covar_pop(y, x) / (var_pop(x) + 50.0 / count(*)), 6), round(avg(y) - covar_pop(y, x) / (var_pop(x) + 50.0 / count(*)) * avg(x), 6) FROM t
""")
def one_feature_fits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M11 + M12: linear and ridge (strength 50) regression of the goals on one implied probability, whose
    solutions have a closed form."""
    data = holdout_flag(bindings.fixtures(spark, sf_dir), ["kickoff", "id"]).filter("is_train").select(
        (1 / F.col("b365h")).alias("x"), F.col("total_goals").alias("label")).checkpoint(eager=True)
    rows = []
    for name, reg in (("linear", 0.0), ("ridge", M.ridge_reg_param(data, "label", 50.0))):
        last = M.build_pipeline(["x"], M.estimator(name, "regressor", regParam=reg), impute=None, scale=False).fit(data).stages[-1]
        rows.append((name, float(last.coefficients[0]), float(last.intercept)))
    return normalise(spark.createDataFrame(rows, "model string, slope double, intercept double"))


@query("one_feature_ridge_classifier", with_ctes(FIXTURES_CTE, _TRAIN_CTE) + """
, d AS (SELECT id, is_train, 1 / b365h AS x, ftr FROM data),
m AS (SELECT avg(x) AS mx, stddev_samp(x) AS sx, count(*) AS n FROM d WHERE is_train),
t AS (SELECT (x - mx) / sx AS z, ftr, n FROM d CROSS JOIN m WHERE is_train),
f AS (SELECT c, covar_pop(CASE WHEN ftr = c THEN 1.0 ELSE -1.0 END, z) / (var_pop(z) + 1.0 / max(n)) AS w, avg(CASE WHEN ftr = c THEN 1.0 ELSE -1.0 END) AS b
      FROM t CROSS JOIN (VALUES ('H'), ('D'), ('A')) v(c) GROUP BY c),
s AS (SELECT d.id, (SELECT w * (x - mx) / sx + b FROM f WHERE c = 'H') AS h, (SELECT w * (x - mx) / sx + b FROM f WHERE c = 'D') AS dr,
             (SELECT w * (x - mx) / sx + b FROM f WHERE c = 'A') AS a FROM d CROSS JOIN m WHERE NOT is_train)
SELECT id, round(exp(h) / (exp(h) + exp(dr) + exp(a)), 6) AS p_home, round(exp(dr) / (exp(h) + exp(dr) + exp(a)), 6) AS p_draw,
       CASE WHEN h >= dr AND h >= a THEN 'H' WHEN dr >= a THEN 'D' ELSE 'A' END AS predicted FROM s
""")
def one_feature_ridge_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M13 + M30: the +1/-1 ridge classifier on one scaled feature, probabilities by softmax."""
    data = holdout_flag(bindings.fixtures(spark, sf_dir), ["kickoff", "id"]).select(
        "id", "is_train", (1 / F.col("b365h")).alias("x"), M.label_code("ftr").alias("label")).checkpoint(eager=True)
    out = M.ridge_classifier(data.filter("is_train"), ["x"], "label")(data.filter(~F.col("is_train")))
    names = F.array(*[F.lit(c) for c in M.CODE_LABELS])
    return normalise(out.select("id", F.col("p0").alias("p_home"), F.col("p1").alias("p_draw"),
                                F.element_at(names, F.col("prediction").cast("int") + 1).alias("predicted")))


@query("pipeline_transforms", with_ctes(FIXTURES_CTE) + """
, g AS (SELECT id, CASE WHEN id % 10 = 4 THEN NULL ELSE CAST(hs AS DOUBLE) END AS a, CAST(hst AS DOUBLE) AS b, b365h, b365d, b365a, total_goals FROM fixtures),
m AS (SELECT quantile_disc(a, 0.5) AS med, avg(b) AS mb, stddev_pop(b) AS sb FROM g)
SELECT id, round(coalesce(a, med), 6) AS imputed, round((b - mb) / sb, 6) AS scaled, round(b * b, 6) AS poly_bb, round(coalesce(a, med) * b, 6) AS poly_ab,
       round(exp(b365h) / (exp(b365h) + exp(b365d) + exp(b365a)), 6) AS soft_home,
       round(100 * exp(b365h) / (exp(b365h) + exp(b365d) + exp(b365a)), 2) AS p_home_pct, round(total_goals, 6) AS total_goals
FROM g CROSS JOIN m
""")
def pipeline_transforms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 + M4 + M5 + M30 + M35: median imputation (every tenth home shot count missing), population scaling,
    second-degree terms, softmax and the exported percentages."""
    from pyspark.ml.feature import Imputer, PolynomialExpansion, VectorAssembler
    from pyspark.ml.functions import vector_to_array
    fx = bindings.fixtures(spark, sf_dir).select(
        "id", F.when(F.pmod("id", F.lit(10)) != 4, F.col("hs").cast("double")).alias("a"), F.col("hst").cast("double").alias("b"),
        "b365h", "b365d", "b365a", "total_goals")
    imputed = Imputer(inputCols=["a"], outputCols=["a__imp"], strategy="median", relativeError=M.MEDIAN_ERROR).fit(fx).transform(fx)
    scaled = M.population_scale(imputed, M.population_scaler_stats(fx, ["b"]), ["b"], "_scaled")
    both = PolynomialExpansion(degree=2, inputCol="v", outputCol="p").transform(VectorAssembler(inputCols=["a__imp", "b"], outputCol="v").transform(scaled))
    terms = vector_to_array("p")  # a, a*a, b, a*b, b*b
    soft = both.withColumns({"_t": terms, "p_home": softmax(F.array("b365h", "b365d", "b365a"))[0]})
    out = M.prediction_export(soft, keep=("id", "a__imp", "b_scaled", "_t", "p_home"), probs=("p_home",))
    return normalise(out.select("id", F.col("a__imp").alias("imputed"), F.col("b_scaled").alias("scaled"), F.col("_t")[4].alias("poly_bb"),
                                F.col("_t")[3].alias("poly_ab"), F.col("p_home").alias("soft_home"), "p_home_pct", "total_goals"))


@query("embedding_knn", """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label, row_number() OVER (ORDER BY vec_id) - 1 AS i, count(*) OVER () AS n FROM embeddings),
s AS (SELECT *, i < greatest(CAST(floor(n * 0.8) AS BIGINT), 1) AS tr FROM e),
p AS (SELECT q.vec_id AS qid, q.label AS ql, r.label AS rl, list_distance(q.v, r.v) AS d,
             row_number() OVER (PARTITION BY q.vec_id ORDER BY list_distance(q.v, r.v), r.vec_id) AS k FROM s q JOIN s r ON NOT q.tr AND r.tr),
nn AS (SELECT *, max(CASE WHEN d = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY qid) AS z FROM p WHERE k <= 5),
v AS (SELECT qid, ql, rl, count(*) AS u, sum(CASE WHEN z = 1 THEN CASE WHEN d = 0 THEN 1.0 ELSE 0.0 END ELSE 1 / d END) AS w FROM nn GROUP BY qid, ql, rl),
b AS (SELECT qid, ql, rl, row_number() OVER (PARTITION BY qid ORDER BY u DESC, rl) AS ku, row_number() OVER (PARTITION BY qid ORDER BY w DESC, rl) AS kw FROM v)
SELECT round(avg(CASE WHEN rl = ql THEN 1.0 ELSE 0.0 END), 6) AS accuracy, CAST(count(*) AS BIGINT) AS n, 'uniform' AS weights FROM b WHERE ku = 1
UNION ALL SELECT round(avg(CASE WHEN rl = ql THEN 1.0 ELSE 0.0 END), 6), CAST(count(*) AS BIGINT), 'distance' FROM b WHERE kw = 1
""")
def embedding_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact kNN classifier (k = 5, uniform and distance weights) on the embeddings; the last
    20% by vec_id are the queries; accuracy per weighting."""
    emb = table(spark, sf_dir, "embeddings")
    emb = holdout_flag(emb, ["vec_id"])
    ref, qry = emb.filter("is_train"), emb.filter(~F.col("is_train"))
    out = None
    for w in ("uniform", "distance"):
        pred = K.knn_predict(qry, ref, "vec_id", "embedding", "label", 5, weights=w)
        acc = (pred.join(qry.select(F.col("vec_id").alias("qid"), "label"), "qid")
                   .agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"), F.count(F.lit(1)).alias("n"))
                   .withColumn("weights", F.lit(w)))
        out = acc if out is None else out.unionByName(acc)
    return normalise(out)


@query("embedding_neighbours", """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label, row_number() OVER (ORDER BY vec_id) - 1 AS i, count(*) OVER () AS n FROM embeddings),
s AS (SELECT *, i < greatest(CAST(floor(n * 0.8) AS BIGINT), 1) AS tr FROM e),
p AS (SELECT m AS metric, q.vec_id AS qid, r.vec_id AS rid, r.label AS rlabel,
             CASE WHEN m = 'l2' THEN list_distance(q.v, r.v) ELSE list_sum(list_transform(range(1, len(q.v) + 1), lambda x: abs(q.v[x] - r.v[x]))) END AS d
      FROM s q JOIN s r ON NOT q.tr AND r.tr CROSS JOIN (VALUES ('l1'), ('l2')) t(m))
SELECT metric, qid, rid, round(d, 6) AS dist, CAST(rlabel AS DOUBLE) AS rlabel, row_number() OVER (PARTITION BY metric, qid ORDER BY d, rid) AS rank
FROM p QUALIFY rank <= 5
""")
def embedding_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest training vectors of every holdout vector under both metrics, by pivot cells."""
    emb = holdout_flag(table(spark, sf_dir, "embeddings"), ["vec_id"])
    ref, qry = emb.filter("is_train"), emb.filter(~F.col("is_train"))
    found = [K.knn_neighbours(qry, ref, "vec_id", "embedding", "label", 5, metric).withColumn("metric", F.lit(metric)) for metric in ("l1", "l2")]
    return normalise(found[0].unionByName(found[1]).select("metric", "qid", "rid", "dist", "rlabel", "rank"))


@query("knn_grid_folds", """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label, row_number() OVER (ORDER BY vec_id) - 1 AS i, count(*) OVER () AS n FROM embeddings),
s AS (SELECT *, greatest(-1, CAST(floor((i - (n - 5 * (n // 6))) / (n // 6)) AS BIGINT)) AS fold FROM e),
p AS (SELECT m, q.fold, q.vec_id AS qid, q.label AS ql, r.label AS rl, r.vec_id AS rid,
             CASE WHEN m = 'l2' THEN list_distance(q.v, r.v) ELSE list_sum(list_transform(range(1, len(q.v) + 1), lambda x: abs(q.v[x] - r.v[x]))) END AS d
      FROM s q JOIN s r ON r.fold < q.fold CROSS JOIN (VALUES ('l1'), ('l2')) t(m)),
nn AS (SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY m, qid ORDER BY d, rid) <= 15),
g AS (SELECT nn.*, k, row_number() OVER (PARTITION BY m, k, qid ORDER BY d, rid) AS pos FROM nn CROSS JOIN (VALUES (3), (5), (7), (11), (15)) t(k)),
z AS (SELECT *, max(CASE WHEN d = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY m, k, qid) AS zero FROM g WHERE pos <= k),
w AS (SELECT z.*, weights, CASE WHEN weights = 'uniform' THEN 1.0 WHEN zero = 1 THEN CASE WHEN d = 0 THEN 1.0 ELSE 0.0 END ELSE 1 / d END AS wt
      FROM z CROSS JOIN (VALUES ('uniform'), ('distance')) t(weights)),
v AS (SELECT m, k, weights, fold, qid, any_value(ql) AS ql, rl, sum(wt) AS votes FROM w GROUP BY m, k, weights, fold, qid, rl),
c AS (SELECT m, k, weights, fold, qid, avg(CASE WHEN rl = ql THEN 1.0 ELSE 0.0 END) AS hit FROM
       (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY m, k, weights, qid ORDER BY round(votes, 9) DESC, rl) = 1) GROUP BY ALL),
r AS (SELECT m, k, weights, fold, qid, any_value(ql) AS ql, sum(wt * rl) / sum(wt) AS mean FROM w GROUP BY m, k, weights, fold, qid)
SELECT r.m AS metric, CAST(r.k AS BIGINT) AS k, r.weights, CAST(r.fold AS BIGINT) AS fold, count(*) AS n, round(avg(hit), 6) AS accuracy,
       round(avg(abs(mean - ql)), 6) AS mae, round(sqrt(avg((mean - ql) ** 2)), 6) AS rmse
FROM r JOIN c USING (m, k, weights, fold, qid) GROUP BY r.m, r.k, r.weights, r.fold
""")
def knn_grid_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M16 + M2 + M21: all 20 points of the kNN grid (k, weights, metric) as classifier and as regressor on 5
    expanding folds: rows, accuracy, MAE and RMSE of every point and fold. Two neighbour searches serve them all."""
    emb = fold_of(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), ["vec_id"]).checkpoint(eager=True)
    asked, truth = emb.filter("fold >= 0"), emb.select(F.col("vec_id").alias("qid"), "fold", "label")
    both = K.knn_grid(asked, emb, "vec_id", "embedding", "label", before_col="fold", tasks=("classifier", "regressor")).join(truth, "qid")
    gap = F.col("regressor") - F.col("label")
    return normalise(both.groupBy("metric", "k", "weights", "fold").agg(
        F.count(F.lit(1)).alias("n"), F.avg((F.col("classifier") == F.col("label")).cast("double")).alias("accuracy"),
        F.avg(F.abs(gap)).alias("mae"), F.sqrt(F.avg(gap * gap)).alias("rmse")))


@query("smote_class_counts", """
SELECT CAST(label AS DOUBLE) AS label, CAST(max(count(*)) OVER () AS BIGINT) AS rows, CAST(max(count(*)) OVER () - count(*) AS BIGINT) AS synthetic
FROM embeddings GROUP BY label
""")
def smote_class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7: SMOTE (k = 1) on the embeddings: every class reaches the majority count."""
    emb = table(spark, sf_dir, "embeddings")
    res = K.smote(emb, "vec_id", "embedding", "label")
    return normalise(res.groupBy("label").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("synthetic").cast("int")).alias("synthetic")))


@query("team_clusters", with_ctes(FIXTURES_CTE) + """
, t AS (SELECT home_team AS team FROM fixtures UNION SELECT away_team FROM fixtures)
SELECT CAST(3 AS BIGINT) AS clusters, CAST(count(*) AS BIGINT) AS teams, CAST(9 AS BIGINT) AS examples, CAST(1 AS BIGINT) AS silhouette_in_range FROM t
""")
def team_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M28 + A34: K-means (k = 3, best of 20 seeds) on scaled per-team averages; the cluster profile covers
    every team, names three per cluster, and its silhouette lies between -1 and 1."""
    long = features.team_long(bindings.fixtures(spark, sf_dir))
    teams = long.groupBy("team").agg(F.avg("goals_for").alias("attack"), F.avg("goals_against").alias("defence"),
                                     F.avg("points").alias("points")).checkpoint(eager=True)
    clustered, sil, _ = M.kmeans_clusters(teams, ["attack", "defence", "points"], 3)
    prof = A.cluster_profile(clustered.select("team", "attack", "defence", "points", "cluster"), "cluster",
                             ["attack", "defence", "points"], "team", "points", 3)
    return normalise(prof.agg(F.count(F.lit(1)).alias("clusters"), F.sum("size").alias("teams"), F.sum(F.size("examples")).alias("examples"),
                              F.lit(-1 <= sil <= 1).alias("silhouette_in_range")))


# Regularisation strengths of the ridge search.
RIDGE_ALPHAS = [0.01, 0.1, 1.0, 5.0, 10.0, 25.0, 50.0, 100.0]


@query("grid_search_trials", """
SELECT 'ridge' AS model, CAST(count(*) AS BIGINT) AS points, CAST(5 AS BIGINT) AS folds, CAST(1 AS BIGINT) AS best_is_first
FROM (VALUES (0.01), (0.1), (1.0), (5.0), (10.0), (25.0), (50.0), (100.0)) t(alpha)
""")
def grid_search_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 + M12 + M21 + M22: ridge regression of the goals over the whole grid of strengths on 5 expanding
    folds; every point has five fold scores and the best mean comes first."""
    data = match_table(spark, sf_dir, indexed=True).filter("is_train").withColumn("goals", F.col("total_goals")).checkpoint(eager=True)
    grid = {"regParam": [M.ridge_reg_param(data, "goals", a) for a in RIDGE_ALPHAS]}
    trials = S.search(data, "row_idx", MATCH_FEATURES, "goals", "ridge", "regressor", grid, impute=None)
    best = S.best_trial(trials).checkpoint(eager=True)
    first = best.orderBy(F.desc("mean_score"), "params").limit(1).select(F.col("mean_score").alias("_first"))
    return normalise(best.crossJoin(first).agg(F.lit("ridge").alias("model"), F.count(F.lit(1)).alias("points"), F.min("folds").alias("folds"),
                                               (F.max("_first") == F.max("mean_score")).alias("best_is_first")))


@query("two_stage_match_model", with_ctes(FIXTURES_CTE, _TRAIN_CTE) + """
SELECT 'stage1_pred_total_goals' AS generated, CAST(count(*) AS BIGINT) AS scored, CAST(count(*) AS BIGINT) AS valid FROM data WHERE NOT is_train
""")
def two_stage_match_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M24 + M29: goals regressor feeding the H/D/A classifier: every holdout row gets the generated column
    and valid class probabilities."""
    data = match_table(spark, sf_dir)
    pred = S.two_stage(data.filter("is_train"), data.filter(~F.col("is_train")), MATCH_FEATURES, "total_goals", "label")
    probs = M.probabilities(pred.filter(F.col("stage1_pred_total_goals").isNotNull()))
    return normalise(probs.agg(F.lit("stage1_pred_total_goals").alias("generated"), *_probability_checks(probs, ["p_home", "p_draw", "p_away"])))


GENERATORS = [("linear", {}), ("random_forest", {"numTrees": 50, "maxDepth": 5})]


#: Columns of a fixture that the composite indices are made of.
INDEX_SOURCES = ["hs", "as_", "hst", "ast", "hc", "ac", "hy", "ay", "hr", "ar", "hf", "af"]


def _indexed_matches(spark: SparkSession, sf_dir: str, indexed: bool = False) -> DataFrame:
    from touchline.plans.feature_queries import INDEX_WEIGHTS, _RAW, _index_raw
    raw = _index_raw(match_table(spark, sf_dir, INDEX_SOURCES, indexed))
    params = features.zscore_params(raw.filter("is_train"), _RAW)
    out = features.weighted_indices(raw, params, INDEX_WEIGHTS)
    return stored(out.select("id", *(["row_idx"] if indexed else []), "is_train", "label", *MATCH_FEATURES, *INDEX_WEIGHTS), "indices")


@query("index_generators", """
SELECT target, CAST(2 AS BIGINT) AS runs, CAST(1 AS BIGINT) AS best_is_maximum
FROM (VALUES ('threat_index'), ('dominance_index'), ('efficiency_control_index'), ('territorial_pressure_index'), ('clean_dominance_index')) t(target)
""")
def index_generators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M25 + M33 + E12 + E13: stage-1 regressors for each of the five composite indices (X15 targets,
    observed after the match) from pre-match features; runs ranked by 0.5 fold-mean R2 + 0.5 holdout R2:
    runs per target, and whether the best per target has the largest score."""
    from touchline.operators import ensemble as EN
    data = _indexed_matches(spark, sf_dir, indexed=True)
    runs = S.multi_target_fits(data.filter("is_train"), data.filter(~F.col("is_train")), MATCH_FEATURES, features.INDEX_COLUMNS, GENERATORS,
                               idx_col="row_idx").checkpoint(eager=True)
    ranked = EN.rank_regressors(runs)
    best = EN.best_per_group(ranked, "target").select("target", F.col("rank_score").alias("_best"))
    return normalise(ranked.groupBy("target").agg(F.count(F.lit(1)).alias("runs"), F.max("rank_score").alias("_max")).join(best, "target")
                     .select("target", "runs", (F.col("_best") == F.col("_max")).alias("best_is_maximum")))


@query("advanced_stage2_runs", with_ctes(FIXTURES_CTE, _TRAIN_CTE) + """
, gen AS (SELECT * FROM (VALUES ('threat_index'), ('dominance_index'), ('efficiency_control_index'), ('territorial_pressure_index'), ('clean_dominance_index')) t(target)),
plan AS (SELECT target AS run, 16 AS features FROM gen UNION ALL SELECT 'all', 20)
SELECT run, CAST(features AS BIGINT) AS features, CAST((SELECT count(*) FROM data WHERE NOT is_train) AS BIGINT) AS scored,
       CAST((SELECT count(*) FROM data WHERE NOT is_train) AS BIGINT) AS valid FROM plan
""")
def advanced_stage2_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M26 + M29: one stage-2 classifier per generator over the base features plus ``approx_<index>``, and the
    include-all run over every generator; each applies all the generators it was planned with."""
    data = _indexed_matches(spark, sf_dir)
    return normalise(S.advanced_stage2(data.filter("is_train"), data.filter(~F.col("is_train")), MATCH_FEATURES, features.INDEX_COLUMNS, "label",
                                       checks=lambda pred: _probability_checks(pred, ["p_home", "p_draw", "p_away"])))


ODDS_FEATURES = ["b365_home_prob", "b365_draw_prob", "b365_away_prob"]


@query("feature_ablation", with_ctes(FIXTURES_CTE, _TRAIN_CTE) + """
SELECT system, CAST(features AS BIGINT) AS features, CAST((SELECT count(*) FROM data WHERE NOT is_train) AS BIGINT) AS scored,
       CAST((SELECT count(*) FROM data WHERE NOT is_train) AS BIGINT) AS valid
FROM (VALUES ('odds', 3), ('history', 9), ('both', 12)) t(system, features)
""")
def feature_ablation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M10 + E9: the same multinomial model on the odds, on the history and on both."""
    data = match_table(spark, sf_dir)
    history = [c for c in MATCH_FEATURES if "_last" in c]
    out = None
    for system, cols in (("odds", ODDS_FEATURES), ("history", history), ("both", ODDS_FEATURES + history)):
        model = M.build_pipeline(cols, M.estimator("multinomial", "classifier"), impute=None).fit(data.filter("is_train"))
        pred = M.probabilities(model.transform(data.filter(~F.col("is_train"))))
        row = pred.agg(F.lit(system).alias("system"), F.lit(len(cols)).alias("features"), *_probability_checks(pred, ["p_home", "p_draw", "p_away"]))
        out = row if out is None else out.unionByName(row)
    return normalise(out)


@query("pipeline_modes", with_ctes(FIXTURES_CTE, _TRAIN_CTE) + """
, c AS (SELECT ftr, count(*) AS n FROM data WHERE is_train GROUP BY ftr)
SELECT mode, CAST((SELECT 3 * max(n) FROM c) AS BIGINT) AS fitted_rows, CAST((SELECT count(*) FROM data WHERE NOT is_train) AS BIGINT) AS scored,
       CAST((SELECT count(*) FROM data WHERE NOT is_train) AS BIGINT) AS valid
FROM (VALUES ('normal'), ('lasso_selected'), ('poly2_lasso')) t(mode)
""")
def pipeline_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M6 + M7 + M23: the pipeline modes with SMOTE on the training rows: balanced rows fitted, and every holdout
    row scored with valid probabilities."""
    data = match_table(spark, sf_dir)
    cols = ODDS_FEATURES + ["home_points_last5", "away_points_last5"]
    out = None
    for mode in ("normal", "lasso_selected", "poly2_lasso"):
        fitted, score = S.fit_mode(data.filter("is_train"), "id", cols, "label", "multinomial", "classifier", mode, smote=True)
        pred = M.probabilities(score(data.filter(~F.col("is_train"))))
        row = pred.agg(F.lit(mode).alias("mode"), F.lit(fitted).alias("fitted_rows"), *_probability_checks(pred, ["p_home", "p_draw", "p_away"]))
        out = row if out is None else out.unionByName(row)
    return normalise(out)
