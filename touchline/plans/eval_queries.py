"""Registered queries for evaluation, run ranking, ensembles and batch scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions import odds as O
from touchline.operators import ensemble as EN
from touchline.operators import evaluate as EV
from touchline.operators import scoring as SC
from touchline.plans import bindings
from touchline.plans.oracle import EVENTS_CTE, FIXTURES_CTE, with_ctes
from touchline.plans.registry import normalise, query

MEMBERS_CTE = """
members AS (SELECT * FROM (VALUES ('m1', 3, 5, 7), ('m2', 11, 13, 17), ('m3', 19, 23, 29), ('m4', 31, 37, 41)) t(model_id, a, b, c)),
mp0 AS (
  SELECT f.id AS row_id, m.model_id,
         1 / f.b365h + CAST((f.id * m.a) % 7 AS DOUBLE) / 20 AS rh,
         CASE WHEN m.model_id = 'm3' AND f.id % 17 = 0 THEN -0.2 ELSE 1 / f.b365d + CAST((f.id * m.b) % 5 AS DOUBLE) / 20 END AS rd,
         1 / f.b365a + CAST((f.id * m.c) % 6 AS DOUBLE) / 20 AS ra,
         CASE WHEN m.model_id = 'm1' AND f.id % 7 = 0 THEN NULL ELSE 2.0 + CAST((f.id * m.a) % 9 AS DOUBLE) / 4 END AS goals
  FROM fixtures f CROSS JOIN members m
  WHERE NOT (m.model_id = 'm2' AND f.id % 10 = 3)
),
mp1 AS (
  SELECT row_id, model_id, goals,
         CASE WHEN model_id = 'm4' AND row_id % 13 = 0 THEN NULL ELSE rh / (rh + rd + ra) END AS p_home,
         CASE WHEN model_id = 'm4' AND row_id % 13 = 0 THEN NULL ELSE rd / (rh + rd + ra) END AS p_draw,
         CASE WHEN model_id = 'm4' AND row_id % 13 = 0 THEN NULL ELSE ra / (rh + rd + ra) END AS p_away,
         (model_id = 'm4' AND row_id % 13 = 0) AS label_only
  FROM mp0
),
member_preds AS (
  SELECT row_id, model_id, goals, p_home, p_draw, p_away,
         CASE WHEN label_only THEN 'D' WHEN p_home >= p_draw AND p_home >= p_away THEN 'H' WHEN p_draw >= p_away THEN 'D' ELSE 'A' END AS label
  FROM mp1
),
split AS (
  SELECT id, row_number() OVER (ORDER BY kickoff, id) - 1 AS row_idx, count(*) OVER () AS n FROM fixtures
),
split2 AS (SELECT id, row_idx, row_idx < greatest(CAST(floor(n * 0.8) AS BIGINT), 1) AS is_train FROM split),
scores AS (
  SELECT p.model_id, avg(CASE WHEN p.label = f.ftr THEN 1.0 ELSE 0.0 END) AS score
  FROM member_preds p JOIN fixtures f ON p.row_id = f.id JOIN split2 s ON s.id = f.id WHERE s.is_train GROUP BY p.model_id
),
weights AS (
  SELECT model_id, score,
         CASE WHEN min(CASE WHEN score IS NOT NULL AND score > 0 THEN 1 ELSE 0 END) OVER () = 1 AND sum(score) OVER () > 0
              THEN score / sum(score) OVER () ELSE 1.0 / count(*) OVER () END AS weight
  FROM scores
),
q0 AS (
  SELECT p.*, greatest(coalesce(p_home, 0.0), 0.0) AS ch, greatest(coalesce(p_draw, 0.0), 0.0) AS cd, greatest(coalesce(p_away, 0.0), 0.0) AS ca
  FROM member_preds p
),
q1 AS (
  SELECT row_id, model_id, goals,
         CASE WHEN ch + cd + ca > 0 THEN ch ELSE CASE WHEN upper(coalesce(label, '')) = 'H' THEN 1.0 ELSE 0.0 END END AS h,
         CASE WHEN ch + cd + ca > 0 THEN cd ELSE CASE WHEN upper(coalesce(label, '')) = 'D' THEN 1.0 ELSE 0.0 END END AS d,
         CASE WHEN ch + cd + ca > 0 THEN ca ELSE CASE WHEN upper(coalesce(label, '')) = 'A' THEN 1.0 ELSE 0.0 END END AS a
  FROM q0
),
q AS (
  SELECT q1.row_id, q1.model_id, q1.goals, h / (h + d + a) AS qh, d / (h + d + a) AS qd, a / (h + d + a) AS qa,
         greatest(w.weight, 0.0) AS weight
  FROM q1 JOIN weights w ON q1.model_id = w.model_id WHERE h + d + a > 0
),
vote0 AS (
  SELECT row_id, sum(weight) AS w, count(*) AS ensemble_size, sum(weight * qh) AS sh, sum(weight * qd) AS sd, sum(weight * qa) AS sa,
         sum(CASE WHEN goals IS NOT NULL THEN weight * goals END) AS gs, sum(CASE WHEN goals IS NOT NULL THEN weight END) AS gw
  FROM q GROUP BY row_id
),
vote1 AS (
  SELECT row_id, ensemble_size, gs, gw, CASE WHEN w <= 0 THEN NULL ELSE sh / w END AS ph, sd / w AS pd, sa / w AS pa FROM vote0
),
vote AS (
  SELECT row_id, ensemble_size, ph / (ph + pd + pa) AS p_home, pd / (ph + pd + pa) AS p_draw, pa / (ph + pd + pa) AS p_away,
         CASE WHEN gw > 0 THEN gs / gw END AS predicted_total_goals
  FROM vote1
),
ens AS (
  SELECT *, CASE WHEN p_home >= p_draw AND p_home >= p_away THEN 'H' WHEN p_draw >= p_away THEN 'D' ELSE 'A' END AS predicted_result
  FROM vote
)"""

_ALL = with_ctes(FIXTURES_CTE, MEMBERS_CTE)


_CARRY = ("ftr", "is_train", "total_goals")
_VOTE_COLS = ["row_id", "p_home", "p_draw", "p_away", "predicted_result", "predicted_total_goals", "ensemble_size"]


def _split_fixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bindings.with_time_split(bindings.fixtures(spark, sf_dir))


def _outcome_cells(fxs: DataFrame) -> DataFrame:
    """(system, is_train, actual, predicted, count) of every member and of the market, in one pass over
    the fixtures. Member scores, weights, confusion grids and the run table all come from these few rows."""
    members = bindings.member_predictions(fxs, keep=_CARRY).select(F.col("model_id").alias("system"), "is_train", "ftr", "label")
    market = fxs.select(F.lit("market").alias("system"), "is_train", "ftr", O.shortest_price_pick("b365h", "b365d", "b365a").alias("label"))
    return EV.outcome_counts(members.unionByName(market), "ftr", "label", by=["system", "is_train"]).checkpoint(eager=True)


def _members(cells: DataFrame) -> DataFrame:
    right = F.when(F.col("actual") == F.col("predicted"), F.col("count")).otherwise(F.lit(0))
    scores = (cells.filter(F.col("is_train") & (F.col("system") != "market")).groupBy(F.col("system").alias("model_id"))
                   .agg((F.sum(right) / F.sum("count")).alias("score")))
    return EN.assign_weights(scores)


def _vote(fxs: DataFrame, members: DataFrame, keep: tuple[str, ...] = _CARRY) -> DataFrame:
    return EN.soft_vote(bindings.member_predictions(fxs, keep=keep), members, carry=keep)


@query("weighted_soft_vote", _ALL + """
SELECT row_id, round(p_home, 6) AS p_home, round(p_draw, 6) AS p_draw, round(p_away, 6) AS p_away, predicted_result,
       round(predicted_total_goals, 6) AS predicted_total_goals, CAST(ensemble_size AS BIGINT) AS ensemble_size
FROM ens
""")
def weighted_soft_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E15-E19 + M1: member scores on the time-ordered training part, proportional weights,
    per-row renormalisation over present members, clamped/one-hot member probabilities, argmax."""
    fxs = _split_fixtures(spark, sf_dir)
    return normalise(_vote(fxs, _members(_outcome_cells(fxs))).select(*_VOTE_COLS))


@query("member_weights", _ALL + """
SELECT model_id, round(score, 6) AS score, round(weight, 6) AS weight FROM weights
""")
def member_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ensemble member weights from training accuracy."""
    members = _members(_outcome_cells(_split_fixtures(spark, sf_dir)))
    return normalise(members.select("model_id", "score", "weight"))


_TEST_SYSTEMS = """
, test AS (SELECT f.id, f.ftr, f.total_goals, f.b365h, f.b365d, f.b365a FROM fixtures f JOIN split2 s ON s.id = f.id WHERE NOT s.is_train),
sys AS (
  SELECT 'ensemble' AS system, t.id, t.ftr AS label, e.predicted_result AS pred FROM test t JOIN ens e ON e.row_id = t.id
  UNION ALL
  SELECT 'market', id, ftr, CASE WHEN b365h <= b365d AND b365h <= b365a THEN 'H' WHEN b365d <= b365a THEN 'D' ELSE 'A' END FROM test
  UNION ALL
  SELECT p.model_id, t.id, t.ftr, p.label FROM test t JOIN member_preds p ON p.row_id = t.id
),
grid AS (SELECT a.l AS actual, b.l AS predicted FROM (VALUES ('H'), ('D'), ('A')) a(l), (VALUES ('H'), ('D'), ('A')) b(l)),
conf AS (
  SELECT g.system, g.actual, g.predicted, count(s.id) AS cnt
  FROM (SELECT DISTINCT system FROM sys) sy CROSS JOIN grid g0
       JOIN (SELECT sy2.system, gg.actual, gg.predicted FROM (SELECT DISTINCT system FROM sys) sy2 CROSS JOIN grid gg) g
         ON g.system = sy.system AND g.actual = g0.actual AND g.predicted = g0.predicted
       LEFT JOIN sys s ON s.system = g.system AND s.label = g.actual AND s.pred = g.predicted
  GROUP BY g.system, g.actual, g.predicted
),
cm AS (
  SELECT c.system, c.actual AS cls, sum(CASE WHEN c.actual = c.predicted THEN cnt ELSE 0 END) AS tp, sum(cnt) AS support,
         (SELECT sum(c2.cnt) FROM conf c2 WHERE c2.system = c.system AND c2.predicted = c.actual) AS predicted_n
  FROM conf c GROUP BY c.system, c.actual
),
cm2 AS (
  SELECT *, CASE WHEN predicted_n > 0 THEN tp / predicted_n ELSE 0.0 END AS prec, CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rec FROM cm
),
cm3 AS (SELECT *, CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END AS f1 FROM cm2)"""


@query("ensemble_confusion", _ALL + _TEST_SYSTEMS + """
SELECT system, actual, predicted, CAST(cnt AS BIGINT) AS count FROM conf
""")
def ensemble_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 + E21: zero-filled 3x3 confusion per system (ensemble, market, each member) on the holdout."""
    return normalise(EV.zero_filled(_system_counts(spark, sf_dir), by=["system"]))


def _system_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome counts of ensemble, market and members on the holdout: two passes over the fixtures."""
    fxs = _split_fixtures(spark, sf_dir)
    cells = _outcome_cells(fxs)
    vote = _vote(fxs.filter(~F.col("is_train")), _members(cells), keep=("ftr",))
    ens = EV.outcome_counts(vote.withColumn("system", F.lit("ensemble")), "ftr", "predicted_result", by=["system"])
    return ens.unionByName(cells.filter(~F.col("is_train")).drop("is_train"))


@query("system_metrics", _ALL + _TEST_SYSTEMS + """
SELECT system, round(sum(tp) / sum(support), 6) AS accuracy, round(avg(prec), 6) AS precision_macro,
       round(avg(rec), 6) AS recall_macro, round(avg(f1), 6) AS f1_macro,
       round(sum(prec * support) / sum(support), 6) AS precision_weighted, round(sum(rec * support) / sum(support), 6) AS recall_weighted,
       round(sum(f1 * support) / sum(support), 6) AS f1_weighted, CAST(sum(support) AS BIGINT) AS n
FROM cm3 GROUP BY system
""")
def system_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E2 + E21: accuracy, macro and weighted precision/recall/F1 per system on the holdout."""
    return normalise(EV.summary_metrics(_system_counts(spark, sf_dir), by=["system"]))


@query("goals_regression_metrics", _ALL + """
, test AS (SELECT f.id, f.total_goals FROM fixtures f JOIN split2 s ON s.id = f.id WHERE NOT s.is_train),
r AS (SELECT t.total_goals AS y, e.predicted_total_goals AS p FROM test t JOIN ens e ON e.row_id = t.id WHERE e.predicted_total_goals IS NOT NULL),
m AS (SELECT avg(y) AS mu FROM r)
SELECT round(avg(abs(y - p)), 6) AS mae, round(sqrt(avg((y - p) ^ 2)), 6) AS rmse,
       round(1 - sum((y - p) ^ 2) / sum((y - mu) ^ 2), 6) AS r2, CAST(count(*) AS BIGINT) AS n
FROM r CROSS JOIN m
""")
def goals_regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MAE, RMSE, R2 of the ensemble's goal estimate on the holdout."""
    return normalise(EV.regression_metrics(_holdout_vote(spark, sf_dir), "total_goals", "predicted_total_goals"))


def _holdout_vote(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = _CARRY) -> DataFrame:
    fxs = _split_fixtures(spark, sf_dir)
    return _vote(fxs.filter(~F.col("is_train")), _members(_outcome_cells(fxs)), keep=keep)


@query("market_cv_folds", _ALL + """
, blocks AS (SELECT s.row_idx, count(*) OVER () AS n, f.ftr, CASE WHEN b365h <= b365d AND b365h <= b365a THEN 'H' WHEN b365d <= b365a THEN 'D' ELSE 'A' END AS pick
             FROM fixtures f JOIN split2 s ON s.id = f.id),
folds AS (SELECT *, CASE WHEN row_idx >= n - 5 * (n // 6) THEN (row_idx - (n - 5 * (n // 6))) // (n // 6) ELSE -1 END AS fold FROM blocks),
per_fold AS (SELECT fold, avg(CASE WHEN pick = ftr THEN 1.0 ELSE 0.0 END) AS accuracy FROM folds WHERE fold BETWEEN 0 AND 4 GROUP BY fold)
SELECT round(avg(accuracy), 6) AS cv_accuracy_mean, round(stddev_pop(accuracy), 6) AS cv_accuracy_std, CAST(count(*) AS BIGINT) AS folds
FROM per_fold
""")
def market_cv_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 + E7 + E8: expanding-window folds (k = 5, test block n // 6 rows each) over the time index;
    market accuracy per fold, then mean and population std."""
    from touchline.ml.split import fold_of
    folds = fold_of(bindings.fixtures(spark, sf_dir), ["kickoff", "id"], 5).filter("fold >= 0")
    per_fold = folds.groupBy("fold").agg(
        F.avg((O.shortest_price_pick("b365h", "b365d", "b365a") == F.col("ftr")).cast("double")).alias("accuracy"))
    return normalise(EV.fold_summary(per_fold, "accuracy"))


_XG_CTE = """
, sh AS (
  SELECT p.id, p.is_goal, p.x, p.y, coalesce(q.qualifier_text, '') AS t FROM play_events p LEFT JOIN qual q ON p.id = q.id WHERE p.is_shot = 1
),
sh2 AS (
  SELECT id, is_goal, x, y, sqrt((100 - x) ^ 2 + (50 - y) ^ 2) AS dist, atan2(abs(50 - y), greatest(100 - x, 0.001)) AS ang,
         CASE WHEN strpos(t, 'bigchance') > 0 THEN 1.0 ELSE 0.0 END AS bc, CASE WHEN strpos(t, 'penalty') > 0 THEN 1.0 ELSE 0.0 END AS pen,
         CASE WHEN strpos(t, 'head') > 0 THEN 1.0 ELSE 0.0 END AS hd, CASE WHEN strpos(t, 'firsttouch') > 0 THEN 1.0 ELSE 0.0 END AS ft,
         CASE WHEN strpos(t, 'volley') > 0 THEN 1.0 ELSE 0.0 END AS vo, CASE WHEN strpos(t, 'fastbreak') > 0 THEN 1.0 ELSE 0.0 END AS fb,
         CASE WHEN strpos(t, 'fromcorner') > 0 THEN 1.0 ELSE 0.0 END AS fc
  FROM sh
),
xg AS (
  SELECT id, is_goal, greatest(least(1 / (1 + exp(-(-2.70 + -0.055 * dist + 1.10 * (1 - least(ang / (pi() / 2), 1.0)) + 1.35 * bc + 2.25 * pen
             + -0.25 * hd + 0.15 * ft + 0.12 * vo + 0.10 * fb + 0.04 * fc))), 0.999), 0.001) AS xg
  FROM sh2
)"""


def _xg_shots(spark: SparkSession, sf_dir: str) -> DataFrame:
    fx = bindings.fixtures(spark, sf_dir)
    ev = bindings.play_events(spark, sf_dir, fx).filter(F.col("is_shot") == 1)
    from touchline.functions.text import keyword_flags, qualifiers_to_text
    q = bindings.shot_qualifiers(spark, sf_dir).select("id", qualifiers_to_text("qualifiers").alias("qualifier_text"))
    s = ev.join(q, "id", "left").withColumn("qualifier_text", F.coalesce("qualifier_text", F.lit("")))
    s = s.withColumns(keyword_flags("qualifier_text"))
    return s.withColumn("xg", O.heuristic_xg("x", "y", "is_big_chance", "is_penalty", "is_header", "first_touch", "is_volley",
                                             "is_counter_attack", "from_corner"))


@query("xg_auc", with_ctes(FIXTURES_CTE, EVENTS_CTE) + _XG_CTE + """
, g AS (SELECT xg AS score, sum(is_goal) AS pos, sum(1 - is_goal) AS neg FROM xg GROUP BY 1),
c AS (SELECT score, sum(pos) OVER w / sum(pos) OVER () AS tpr, sum(neg) OVER w / sum(neg) OVER () AS fpr
      FROM g WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
d AS (SELECT tpr, fpr, coalesce(lag(fpr) OVER (ORDER BY score DESC), 0.0) AS pf, coalesce(lag(tpr) OVER (ORDER BY score DESC), 0.0) AS pt FROM c)
SELECT round(sum((fpr - pf) * (tpr + pt) / 2), 6) AS auc FROM d
""")
def xg_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E4 + X16: AUC of the heuristic xG from the raw scores."""
    return normalise(EV.auc(_xg_shots(spark, sf_dir), "is_goal", "xg"))


@query("xg_roc_curve", with_ctes(FIXTURES_CTE, EVENTS_CTE) + _XG_CTE + """
, m AS (SELECT 'all' AS grp, xg, is_goal FROM xg UNION ALL SELECT CASE WHEN bc = 1.0 THEN 'big chance' ELSE 'other' END, xg, is_goal
        FROM xg JOIN sh2 USING (id, is_goal)),
g AS (SELECT grp, xg AS score, sum(is_goal) AS pos, sum(1 - is_goal) AS neg FROM m GROUP BY grp, xg),
c AS (SELECT grp, score, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY grp) AS p, sum(neg) OVER (PARTITION BY grp) AS n
      FROM g WINDOW w AS (PARTITION BY grp ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT grp, round(score, 6) AS score, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(CASE WHEN p > 0 THEN tp / p END, 6) AS tpr,
       round(CASE WHEN n > 0 THEN fp / n END, 6) AS fpr FROM c
""")
def xg_roc_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every point of the ROC curve of the heuristic xG, over all shots and by big chance."""
    s = _xg_shots(spark, sf_dir)
    groups = F.array(F.lit("all"), F.when(F.col("is_big_chance") == 1, "big chance").otherwise("other"))
    pts = EV.roc_points(s.withColumn("grp", F.explode(groups)), "is_goal", "xg", by=["grp"])
    return normalise(pts.select("grp", "score", "tp", "fp", "tpr", "fpr"))


@query("xg_threshold_sweep", with_ctes(FIXTURES_CTE, EVENTS_CTE) + _XG_CTE + """
, t AS (SELECT CAST(threshold AS DOUBLE) AS threshold FROM (VALUES (0.3), (0.5), (0.7)) v(threshold)),
j AS (SELECT threshold, is_goal AS y, CASE WHEN xg >= threshold THEN 1 ELSE 0 END AS p FROM xg CROSS JOIN t),
g AS (SELECT threshold, avg(CASE WHEN p = y THEN 1.0 ELSE 0.0 END) AS accuracy, sum(p * y) AS tp, sum(p) AS pp, sum(y) AS pos FROM j GROUP BY threshold),
g2 AS (SELECT *, CASE WHEN pp > 0 THEN tp / pp ELSE 0.0 END AS prec, CASE WHEN pos > 0 THEN tp / pos ELSE 0.0 END AS rec FROM g)
SELECT round(threshold, 6) AS threshold, round(accuracy, 6) AS accuracy, CAST(tp AS BIGINT) AS tp, CAST(pp AS BIGINT) AS pred_pos,
       CAST(pos AS BIGINT) AS pos, round(prec, 6) AS precision, round(rec, 6) AS recall,
       round(CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END, 6) AS f1
FROM g2
""")
def xg_threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E5: accuracy, precision, recall, F1 of the heuristic xG at thresholds 0.3, 0.5, 0.7."""
    return normalise(EV.threshold_sweep(_xg_shots(spark, sf_dir), "is_goal", "xg"))


@query("xg_naive_baseline", with_ctes(FIXTURES_CTE, EVENTS_CTE) + """
SELECT round(1 - avg(CAST(is_goal AS DOUBLE)), 6) AS naive_accuracy, CAST(count(*) AS BIGINT) AS n FROM play_events WHERE is_shot = 1
""")
def xg_naive_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy of always predicting no goal."""
    shots = bindings.play_events(spark, sf_dir).filter(F.col("is_shot") == 1)
    return normalise(EV.naive_baseline(shots, "is_goal"))


@query("calibration_bins", with_ctes(FIXTURES_CTE, EVENTS_CTE) + _XG_CTE + """
, b AS (SELECT least(CAST(floor(xg * 8) AS INTEGER), 7) AS bin, xg, is_goal FROM xg WHERE xg >= 0 AND xg <= 1)
SELECT CAST(bin AS BIGINT) AS bin, round(avg(xg), 6) AS predicted, round(avg(CAST(is_goal AS DOUBLE)), 6) AS observed,
       CAST(count(*) AS BIGINT) AS count,
       CAST(CAST(round(bin * 100.0 / 8) AS BIGINT) AS VARCHAR) || '-' || CAST(CAST(round((bin + 1) * 100.0 / 8) AS BIGINT) AS VARCHAR) || '%' AS label
FROM b GROUP BY bin
""")
def calibration_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A25 + X16: calibration of the heuristic xG in 8 equal-width buckets."""
    from touchline.operators.profile import calibration_bins as cal
    return normalise(cal(_xg_shots(spark, sf_dir), "xg", "is_goal", 8))


@query("xg_batch_summary", with_ctes(FIXTURES_CTE, EVENTS_CTE) + _XG_CTE + """
SELECT CAST(count(*) AS BIGINT) AS rows, round(avg(xg), 6) AS mean_xg, round(max(xg), 6) AS max_xg,
       CAST(sum(CASE WHEN xg >= 0.35 THEN 1 ELSE 0 END) AS BIGINT) AS high_quality
FROM xg
""")
def xg_batch_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E27 (xg task) + X18 + A33: score a batch of shots, summarise."""
    s = _xg_shots(spark, sf_dir).select("x", "y", "is_big_chance", "is_penalty", "is_header", "first_touch", "is_volley",
                                        F.col("is_counter_attack").alias("is_counter"), "from_corner")
    return normalise(SC.batch_summary_xg(SC.score_xg_batch(s)))


@query("run_ranking", _ALL + """
, part AS (SELECT p.model_id, s.is_train, p.label, f.ftr FROM member_preds p JOIN fixtures f ON p.row_id = f.id JOIN split2 s ON s.id = f.id),
grid AS (SELECT a.l AS actual, b.l AS predicted FROM (VALUES ('H'), ('D'), ('A')) a(l), (VALUES ('H'), ('D'), ('A')) b(l)),
keys AS (SELECT DISTINCT model_id, is_train FROM part),
conf AS (SELECT k.model_id, k.is_train, g.actual, g.predicted,
                (SELECT count(*) FROM part p WHERE p.model_id = k.model_id AND p.is_train = k.is_train AND p.ftr = g.actual AND p.label = g.predicted) AS cnt
         FROM keys k CROSS JOIN grid g),
cm AS (SELECT c.model_id, c.is_train, c.actual AS cls, sum(CASE WHEN actual = predicted THEN cnt ELSE 0 END) AS tp, sum(cnt) AS support,
              (SELECT sum(c2.cnt) FROM conf c2 WHERE c2.model_id = c.model_id AND c2.is_train = c.is_train AND c2.predicted = c.actual) AS pn
       FROM conf c GROUP BY c.model_id, c.is_train, c.actual),
cm2 AS (SELECT *, CASE WHEN pn > 0 THEN tp / pn ELSE 0.0 END AS prec, CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rec FROM cm),
cm3 AS (SELECT *, CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END AS f1 FROM cm2),
met AS (SELECT model_id, is_train, sum(tp) / sum(support) AS acc, sum(f1 * support) / sum(support) AS f1w FROM cm3 GROUP BY model_id, is_train),
runs AS (SELECT model_id AS run_name,
                max(CASE WHEN is_train THEN acc END) AS cv_accuracy, max(CASE WHEN is_train THEN f1w END) AS cv_f1_weighted,
                max(CASE WHEN NOT is_train THEN acc END) AS test_accuracy, max(CASE WHEN NOT is_train THEN f1w END) AS test_f1_weighted
         FROM met GROUP BY model_id),
ranked AS (SELECT *, 0.25 * cv_accuracy + 0.25 * cv_f1_weighted + 0.25 * test_accuracy + 0.25 * test_f1_weighted AS rank_score FROM runs)
SELECT run_name, round(cv_accuracy, 6) AS cv_accuracy, round(cv_f1_weighted, 6) AS cv_f1_weighted, round(test_accuracy, 6) AS test_accuracy,
       round(test_f1_weighted, 6) AS test_f1_weighted, round(rank_score, 6) AS rank_score,
       CAST(row_number() OVER (ORDER BY rank_score DESC, test_accuracy DESC, test_f1_weighted DESC, cv_accuracy DESC, cv_f1_weighted DESC, run_name) AS BIGINT) AS rank,
       CASE WHEN test_accuracy < 0.5 THEN 'delete' ELSE 'keep' END AS action
FROM ranked
""")
def run_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E11 + T5 + E14 + E2: run table (train = "cv", holdout = "test" metrics per member), weighted
    ranking score, 1-based rank, retention action at accuracy 0.5."""
    cells = _outcome_cells(_split_fixtures(spark, sf_dir)).filter(F.col("system") != "market")
    met = EV.summary_metrics(cells, by=["system", "is_train"])
    runs = met.groupBy(F.col("system").alias("run_name")).agg(
        F.max(F.when(F.col("is_train"), F.col("accuracy"))).alias("cv_accuracy"),
        F.max(F.when(F.col("is_train"), F.col("f1_weighted"))).alias("cv_f1_weighted"),
        F.max(F.when(~F.col("is_train"), F.col("accuracy"))).alias("test_accuracy"),
        F.max(F.when(~F.col("is_train"), F.col("f1_weighted"))).alias("test_f1_weighted"))
    ranked = EN.rank_runs(runs)
    ranked = EN.retention_report(ranked, "test_accuracy", 0.5)
    return normalise(ranked.select("run_name", "cv_accuracy", "cv_f1_weighted", "test_accuracy", "test_f1_weighted", "rank_score",
                                   "rank", "action"))


@query("scoring_cascade", _ALL + """
, req AS (SELECT f.id AS row_id, f.home_team, f.away_team, f.b365h, f.b365d, f.b365a FROM fixtures f JOIN split2 s ON s.id = f.id WHERE NOT s.is_train),
lg0 AS (SELECT avg(CASE WHEN ftr = 'H' THEN 1.0 ELSE 0.0 END) AS h, avg(CASE WHEN ftr = 'D' THEN 1.0 ELSE 0.0 END) AS d,
               avg(CASE WHEN ftr = 'A' THEN 1.0 ELSE 0.0 END) AS a FROM fixtures f JOIN split2 s ON s.id = f.id WHERE s.is_train),
lg AS (SELECT h / (h + d + a) AS lh, d / (h + d + a) AS ld, a / (h + d + a) AS la FROM lg0),
src_e AS (SELECT row_id, p_home, p_draw, p_away, predicted_total_goals AS goals FROM ens WHERE row_id % 4 <> 0),
src_m AS (SELECT row_id, p_home, p_draw, p_away, goals FROM member_preds WHERE model_id = 'm1' AND row_id % 3 <> 0),
src_k AS (SELECT row_id, (1 / greatest(b365h, 0.001)) / (1 / greatest(b365h, 0.001) + 1 / greatest(b365d, 0.001) + 1 / greatest(b365a, 0.001)) AS p_home,
                 (1 / greatest(b365d, 0.001)) / (1 / greatest(b365h, 0.001) + 1 / greatest(b365d, 0.001) + 1 / greatest(b365a, 0.001)) AS p_draw,
                 (1 / greatest(b365a, 0.001)) / (1 / greatest(b365h, 0.001) + 1 / greatest(b365d, 0.001) + 1 / greatest(b365a, 0.001)) AS p_away,
                 CAST(NULL AS DOUBLE) AS goals
          FROM req WHERE row_id % 5 <> 0),
j AS (
  SELECT r.row_id,
    CASE WHEN e.p_home IS NOT NULL AND e.p_draw IS NOT NULL AND e.p_away IS NOT NULL AND e.p_home + e.p_draw + e.p_away > 0 THEN 'ensemble'
         WHEN m.p_home IS NOT NULL AND m.p_draw IS NOT NULL AND m.p_away IS NOT NULL AND m.p_home + m.p_draw + m.p_away > 0 THEN 'model'
         WHEN k.p_home IS NOT NULL AND k.p_draw IS NOT NULL AND k.p_away IS NOT NULL AND k.p_home + k.p_draw + k.p_away > 0 THEN 'market'
         ELSE 'league_average_fallback' END AS source,
    e.p_home AS eh, e.p_draw AS ed, e.p_away AS ea, e.goals AS eg, m.p_home AS mh, m.p_draw AS md, m.p_away AS ma, m.goals AS mg,
    k.p_home AS kh, k.p_draw AS kd, k.p_away AS ka, lg.lh, lg.ld, lg.la
  FROM req r LEFT JOIN src_e e ON r.row_id = e.row_id LEFT JOIN src_m m ON r.row_id = m.row_id LEFT JOIN src_k k ON r.row_id = k.row_id CROSS JOIN lg
),
p AS (
  SELECT row_id, source,
    CASE source WHEN 'ensemble' THEN eh WHEN 'model' THEN mh WHEN 'market' THEN kh ELSE lh END AS ph,
    CASE source WHEN 'ensemble' THEN ed WHEN 'model' THEN md WHEN 'market' THEN kd ELSE ld END AS pd,
    CASE source WHEN 'ensemble' THEN ea WHEN 'model' THEN ma WHEN 'market' THEN ka ELSE la END AS pa,
    greatest(CASE source WHEN 'ensemble' THEN coalesce(eg, 2.7) WHEN 'model' THEN coalesce(mg, 2.7) ELSE 2.7 END, 0.0) AS expected_goals
  FROM j
),
c AS (SELECT row_id, source, expected_goals, greatest(least(ph, 0.999), 0.001) AS ch, greatest(least(pd, 0.999), 0.001) AS cd,
             greatest(least(pa, 0.999), 0.001) AS ca FROM p),
n AS (SELECT row_id, source, expected_goals, ch / (ch + cd + ca) AS h, cd / (ch + cd + ca) AS d, ca / (ch + cd + ca) AS a FROM c)
SELECT row_id, source, round(h, 6) AS home_win_probability, round(d, 6) AS draw_probability, round(a, 6) AS away_win_probability,
       round(expected_goals, 6) AS expected_goals,
       CASE WHEN source = 'ensemble' THEN 'ensemble' WHEN source = 'model' THEN 'model' ELSE 'fallback' END AS mode,
       CASE WHEN h >= d AND h >= a THEN 'H' WHEN d >= a THEN 'D' ELSE 'A' END AS predicted_result
FROM n
""")
def scoring_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E22-E26 + E35: per-row cascade ensemble -> model -> market -> league average for the holdout
    fixtures; probabilities clipped and renormalised."""
    fxs = _split_fixtures(spark, sf_dir)
    held = fxs.filter(~F.col("is_train"))
    vote = _vote(held, _members(_outcome_cells(fxs)), keep=())
    preds = bindings.member_predictions(held)
    req = fxs.filter(~F.col("is_train")).select(F.col("id").alias("row_id"), "home_team", "away_team", "b365h", "b365d", "b365a")
    train_fx = fxs.filter("is_train")
    ens = vote.filter(F.pmod("row_id", F.lit(4)) != 0).select("row_id", "p_home", "p_draw", "p_away",
                                                                F.col("predicted_total_goals").alias("goals"))
    model = preds.filter((F.col("model_id") == "m1") & (F.pmod("row_id", F.lit(3)) != 0)).select("row_id", "p_home", "p_draw", "p_away", "goals")
    mk = SC.market_probabilities(req.filter(F.pmod("row_id", F.lit(5)) != 0)).select(
        "row_id", F.col("mk_home").alias("p_home"), F.col("mk_draw").alias("p_draw"), F.col("mk_away").alias("p_away"),
        F.lit(None).cast("double").alias("goals"))
    scored = SC.cascade(req.select("row_id"), {"ensemble": ens, "model": model, "market": mk}, SC.league_average(train_fx))
    return normalise(scored.select("row_id", "source", "home_win_probability", "draw_probability", "away_win_probability",
                                   "expected_goals", "mode", "predicted_result"))


@query("latest_pair_rows", with_ctes(FIXTURES_CTE) + """
, k AS (SELECT *, trim(regexp_replace(replace(lower(CAST(home_team AS VARCHAR)), '.', ''), '\\s+', ' ', 'g')) AS hk,
                  trim(regexp_replace(replace(lower(CAST(away_team AS VARCHAR)), '.', ''), '\\s+', ' ', 'g')) AS ak FROM fixtures),
r AS (SELECT *, row_number() OVER (PARTITION BY hk, ak ORDER BY kickoff DESC, id DESC) AS rn FROM k)
SELECT hk, ak, id, ftr, round(total_goals, 6) AS total_goals FROM r WHERE rn = 1
""")
def latest_pair_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J12 + T3 + P2: latest fixture per normalised (home, away) pair via ``max_by``."""
    res = SC.latest_pair_rows(bindings.fixtures(spark, sf_dir))
    return normalise(res.select("_hk", "_ak", "id", "ftr", "total_goals").withColumnRenamed("_hk", "hk").withColumnRenamed("_ak", "ak"))


@query("goals_residual_summary", _ALL + """
, test AS (SELECT f.id, f.total_goals FROM fixtures f JOIN split2 s ON s.id = f.id WHERE NOT s.is_train),
r AS (SELECT t.total_goals - e.predicted_total_goals AS residual FROM test t JOIN ens e ON e.row_id = t.id)
SELECT round(avg(residual), 6) AS mean_residual, round(sqrt(avg(residual * residual)), 6) AS rmse, CAST(count(*) AS BIGINT) AS n,
       round(quantile_cont(residual, 0.5), 6) AS median
FROM r
""")
def goals_residual_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E10 + A31 + A30: residuals of the ensemble goal estimate on the holdout: mean, RMSE, median."""
    from touchline.operators import profile as P
    res = EV.residuals(_holdout_vote(spark, sf_dir), "total_goals", "predicted_total_goals").checkpoint(eager=True)
    summary, _ = P.residual_summary(res, "actual", "predicted")
    med = P.mean_median(res, "residual").select("median")
    return normalise(summary.crossJoin(med))


@query("featured_matches", _ALL + """
, j AS (SELECT f.id, f.kickoff, f.home_team, f.away_team, e.predicted_result, greatest(e.p_home, e.p_draw, e.p_away) AS confidence
        FROM fixtures f JOIN ens e ON e.row_id = f.id)
SELECT id, CAST(home_team AS BIGINT) AS home_team, CAST(away_team AS BIGINT) AS away_team, predicted_result, round(confidence, 6) AS confidence
FROM j ORDER BY kickoff DESC, id DESC LIMIT 12
""")
def featured_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J11 + T4: predictions joined to fixtures, confidence = largest probability, latest 12 by date
    (a top-12 report)."""
    fxs = _split_fixtures(spark, sf_dir)
    vote = _vote(fxs, _members(_outcome_cells(fxs)), keep=("kickoff", "home_team", "away_team"))
    j = vote.withColumnRenamed("row_id", "id").withColumn("confidence", F.greatest("p_home", "p_draw", "p_away"))
    return normalise(j.orderBy(F.col("kickoff").desc(), F.col("id").desc()).limit(12)
                      .select("id", "home_team", "away_team", "predicted_result", "confidence"))


@query("member_discovery", _ALL + """
, c AS (SELECT model_id AS name, score, model_id <> 'm3' AS has_artifact FROM weights),
s AS (SELECT *, CASE WHEN NOT has_artifact THEN 'missing artifact' WHEN score IS NOT NULL AND score < 0.3 THEN 'score below minimum' END AS r FROM c),
ok AS (SELECT *, row_number() OVER (ORDER BY score IS NOT NULL DESC, score DESC NULLS LAST, name DESC) AS pos FROM s WHERE r IS NULL)
SELECT name, round(score, 6) AS score, CASE WHEN pos > 2 THEN 'beyond top-k' END AS skip_reason, CAST(pos <= 2 AS BIGINT) AS selected FROM ok
UNION ALL SELECT name, round(score, 6), r, CAST(0 AS BIGINT) FROM s WHERE r IS NOT NULL
""")
def member_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates need an artifact (m3 has none here) and a minimum score; ordered by (has
    score, score, name) descending; top 2 selected; skip reasons recorded."""
    members = _members(_outcome_cells(_split_fixtures(spark, sf_dir)))
    cands = members.select(F.col("model_id").alias("name"), "score", (F.col("model_id") != "m3").alias("has_artifact"))
    out = EN.discover(cands, top_k=2, min_score=0.3)
    return normalise(out.select("name", "score", "skip_reason", F.col("selected").cast("boolean").alias("selected")))


@query("shot_view_filters", with_ctes(FIXTURES_CTE, EVENTS_CTE) + _XG_CTE + """
, s AS (SELECT x.*, p.team_name FROM xg x JOIN play_events p ON p.id = x.id)
SELECT 'goals' AS mode, CAST(count(*) AS BIGINT) AS shots, round(avg(xg), 6) AS mean_xg FROM s WHERE is_goal = 1
UNION ALL SELECT 'misses', CAST(count(*) AS BIGINT), round(avg(xg), 6) FROM s WHERE is_goal = 0
UNION ALL SELECT 'high_xg', CAST(count(*) AS BIGINT), round(avg(xg), 6) FROM s WHERE xg >= 0.30
UNION ALL SELECT 'all', CAST(count(*) AS BIGINT), round(avg(xg), 6) FROM s
UNION ALL SELECT 'team_filter', CAST(count(*) AS BIGINT), round(avg(xg), 6) FROM s
          WHERE team_name = (SELECT min(team_name) FROM s) AND is_goal = 1
""")
def shot_view_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P13 + P14 + A23: view-mode filters (goals, misses, xG >= 0.30, all) and a faceted team filter."""
    s = _xg_shots(spark, sf_dir)
    first_team = s.agg(F.min("team_name").alias("_t"))
    goal = F.col("is_goal") == 1
    views = {"goals": goal, "misses": ~goal, "high_xg": F.col("xg") >= 0.30, "all": F.lit(True),
             "team_filter": goal & (F.col("team_name") == F.col("_t"))}
    per = [F.struct(F.lit(name).alias("mode"), F.count(F.when(cond, 1)).alias("shots"), F.avg(F.when(cond, F.col("xg"))).alias("mean_xg"))
           for name, cond in views.items()]
    # all views in one aggregate over the shots
    one = s.crossJoin(F.broadcast(first_team)).agg(F.array(*per).alias("_v"))
    return normalise(one.select(F.explode("_v").alias("_v")).select("_v.*"))


@query("system_gaps", _ALL + _TEST_SYSTEMS + """
, m AS (SELECT system, sum(tp) / sum(support) AS accuracy, sum(f1 * support) / sum(support) AS f1_weighted FROM cm3 GROUP BY system),
b AS (SELECT accuracy AS ba, f1_weighted AS bf FROM m WHERE system = 'market')
SELECT system, round(accuracy, 6) AS accuracy, round(f1_weighted, 6) AS f1_weighted,
       round(accuracy - ba, 6) AS accuracy_gap, round(f1_weighted - bf, 6) AS f1_weighted_gap
FROM m CROSS JOIN b
""")
def system_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E9 + E21: each system's holdout accuracy and weighted F1 minus the market benchmark's."""
    met = EV.summary_metrics(_system_counts(spark, sf_dir), by=["system"]).select("system", "accuracy", "f1_weighted")
    return normalise(EV.compare(met, "system", ["accuracy", "f1_weighted"], "market"))


@query("ensemble_info", _ALL + """
, sk AS (SELECT model_id, CASE WHEN model_id = 'm3' THEN 'missing artifact' WHEN score < 0.3 THEN 'score below minimum' END AS r FROM weights)
SELECT CAST(count(*) AS BIGINT) AS loaded, round(min(score), 6) AS min_score, round(max(score), 6) AS max_score,
       round(avg(score), 6) AS avg_score, arg_max(model_id, weight) AS top_model,
       coalesce((SELECT string_agg(model_id || ': ' || r, ', ' ORDER BY model_id) FROM sk WHERE r IS NOT NULL), '') AS ignored
FROM weights
""")
def ensemble_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members loaded, score range and mean, the heaviest member, and who was ignored and why."""
    members = _members(_outcome_cells(_split_fixtures(spark, sf_dir)))
    found = EN.discover(members.select(F.col("model_id").alias("name"), "score", (F.col("model_id") != "m3").alias("has_artifact")), top_k=None, min_score=0.3)
    info = EN.ensemble_info(members, discovered=found).withColumn("top_model", F.col("top_models")[0])
    ignored = F.array_join(F.transform("ignored", lambda x: F.concat_ws(": ", x["name"], x["skip_reason"])), ", ").alias("ignored")
    return normalise(info.select("loaded", "min_score", "max_score", "avg_score", "top_model", ignored))


@query("zero_weight_vote", _ALL + """
, zw AS (SELECT * FROM (VALUES ('m1', 0.0), ('m2', 0.0), ('m3', 0.0), ('m4', 0.7)) t(model_id, weight)),
zp AS (SELECT q1.row_id, q1.goals, h / (h + d + a) AS qh, d / (h + d + a) AS qd, a / (h + d + a) AS qa, zw.weight
       FROM q1 JOIN zw ON q1.model_id = zw.model_id WHERE h + d + a > 0 AND NOT (q1.model_id = 'm4' AND q1.row_id % 3 = 0)),
zr AS (SELECT *, CASE WHEN sum(weight) OVER (PARTITION BY row_id) > 0 THEN weight ELSE 1.0 END AS w FROM zp),
zs AS (SELECT row_id, sum(w * qh) / sum(w) AS ph, sum(w * qd) / sum(w) AS pd, sum(w * qa) / sum(w) AS pa,
              sum(CASE WHEN goals IS NOT NULL THEN w * goals END) AS gs, sum(CASE WHEN goals IS NOT NULL THEN w END) AS gw, count(*) AS n FROM zr GROUP BY row_id)
SELECT row_id, round(ph / (ph + pd + pa), 6) AS p_home, round(pd / (ph + pd + pa), 6) AS p_draw, round(pa / (ph + pd + pa), 6) AS p_away,
       round(CASE WHEN gw > 0 THEN gs / gw END, 6) AS predicted_total_goals, CAST(n AS BIGINT) AS ensemble_size FROM zs
""")
def zero_weight_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of weight zero; rows that only such members predicted fall back to equal weights."""
    preds = bindings.member_predictions(bindings.fixtures(spark, sf_dir))
    preds = preds.filter(~((F.col("model_id") == "m4") & (F.pmod("row_id", F.lit(3)) == 0)))
    weights = spark.createDataFrame([("m1", 0.0), ("m2", 0.0), ("m3", 0.0), ("m4", 0.7)], "model_id string, weight double")
    vote = EN.soft_vote(preds, weights)
    return normalise(vote.select("row_id", "p_home", "p_draw", "p_away", "predicted_total_goals", "ensemble_size"))


@query("ensemble_sizes", _ALL + """
, rk AS (SELECT model_id, score, row_number() OVER (ORDER BY score DESC NULLS LAST, model_id DESC) AS r FROM scores),
sz AS (SELECT v.size, rk.model_id, rk.score / sum(rk.score) OVER (PARTITION BY v.size) AS weight FROM rk JOIN (VALUES (1), (2), (4)) v(size) ON rk.r <= v.size),
qs AS (SELECT q1.row_id, sz.size, h / (h + d + a) AS qh, d / (h + d + a) AS qd, a / (h + d + a) AS qa, sz.weight
       FROM q1 JOIN sz ON q1.model_id = sz.model_id JOIN split2 s ON s.id = q1.row_id WHERE h + d + a > 0 AND NOT s.is_train),
vs AS (SELECT row_id, size, sum(weight * qh) AS ph, sum(weight * qd) AS pd, sum(weight * qa) AS pa FROM qs GROUP BY row_id, size)
SELECT CAST(size AS BIGINT) AS size, CAST(count(*) AS BIGINT) AS n,
       round(avg(CASE WHEN (CASE WHEN ph >= pd AND ph >= pa THEN 'H' WHEN pd >= pa THEN 'D' ELSE 'A' END) = ftr THEN 1.0 ELSE 0.0 END), 6) AS accuracy
FROM vs JOIN fixtures f ON f.id = vs.row_id GROUP BY size
""")
def ensemble_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ensembles of the best 1, 2 and 4 members on the holdout, voted in one pass."""
    fxs = _split_fixtures(spark, sf_dir)
    ensembles = EN.sized_ensembles(_members(_outcome_cells(fxs)).drop("weight"), (1, 2, 4))
    preds = bindings.member_predictions(fxs.filter(~F.col("is_train")), keep=("ftr",))
    vote = EN.soft_vote(preds, ensembles, carry=("ftr",), by=("size",))
    met = EV.summary_metrics(EV.outcome_counts(vote, "ftr", "predicted_result", by=["size"]), by=["size"])
    return normalise(met.select("size", "n", "accuracy"))
