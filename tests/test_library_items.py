"""Library-only inventory items (no registered query): runs, feature sets, reports, helpers."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from touchline.functions import odds as O
from touchline.ml import models as M
from touchline.operators import aggregate as A
from touchline.operators import ensemble as EN
from touchline.operators import evaluate as EV
from touchline.operators import features
from touchline.operators import scoring as SC
from touchline.operators import shots as S
from touchline.sources import io as IO


def _write_runs(root):
    runs = [
        {"run_name": "r1", "model_id": "m1", "stage": "stage2", "model": "logistic", "feature_mode": "normal", "target": "ftr",
         "has_artifact": True, "score": None, "params": {"C": "1"}, "cv_metrics": {"accuracy": 0.5, "f1_weighted": 0.4},
         "test_metrics": {"accuracy": 0.6, "f1_weighted": 0.5}},
        {"run_name": "r2", "model_id": "m2", "stage": "stage2", "model": "rf", "feature_mode": "extra", "target": "ftr",
         "has_artifact": False, "score": 0.7, "params": {}, "cv_metrics": {"accuracy": 0.7}, "test_metrics": {"accuracy": 0.4}},
    ]
    for i, r in enumerate(runs):
        d = os.path.join(root, f"run{i}", "nested")
        os.makedirs(d)
        with open(os.path.join(d, "run_summary.json"), "w") as f:
            json.dump(r, f, indent=2)


def test_runs_flatten_cards_rank(spark):
    root = tempfile.mkdtemp(prefix="tl-runs-", dir="/tmp")
    _write_runs(root)
    runs = IO.read_runs(spark, root)
    assert runs.count() == 2 and runs.filter(F.col("source_file").contains("run_summary.json")).count() == 2
    flat = IO.flatten_runs(runs)
    r1 = flat.filter("run_name = 'r1'").first()
    assert r1.cv_accuracy == 0.5 and r1.test_f1_weighted == 0.5 and json.loads(r1.params_json) == {"C": "1"}
    cards = EN.model_cards(runs)
    assert set(cards.columns) >= {"model_id", "name", "test_accuracy"}
    ranked = EN.rank_runs(flat.fillna({"cv_f1_weighted": 0.0, "test_f1_weighted": 0.0}))
    assert [r.run_name for r in ranked.orderBy("rank").collect()] == ["r1", "r2"]


def test_feature_sets(spark):
    df = spark.createDataFrame([(1, 2.0, 1.0, 3.0, 0.5, 0.1, "H", 2)],
                               "id long, home_goals_for_last5 double, ref_avg_goals_last10 double, fthg double, b365_home_prob double, threat_index double, ftr string, result_code int")
    allnum = features.available_numeric_features(df)
    assert allnum == ["home_goals_for_last5", "ref_avg_goals_last10", "b365_home_prob"]   # ids, observed, target, indices out
    assert features.historical_features(df) == ["home_goals_for_last5", "ref_avg_goals_last10"]
    assert features.resolve_features(df, ["b365_home_prob", "missing"]) == ["b365_home_prob"]
    hist = spark.createDataFrame([(1.0,), (3.0,), (10.0,)], "home_goals_for_last5 double")
    filled = features.fill_with_history_medians(spark.createDataFrame([(None,)], "home_goals_for_last5 double"), hist,
                                                ["home_goals_for_last5"])
    assert filled.first().home_goals_for_last5 == 3.0


def test_compare_info_labels(spark):
    m = spark.createDataFrame([("market", 0.5), ("model", 0.55)], "system string, accuracy double")
    gaps = {r.system: r.accuracy_gap for r in EV.compare(m, "system", ["accuracy"], "market").collect()}
    assert abs(gaps["model"] - 0.05) < 1e-12 and gaps["market"] == 0.0
    members = EN.assign_weights(spark.createDataFrame([("a", 0.6), ("b", 0.4)], "model_id string, score double"))
    info = EN.ensemble_info(members, found=3).first()
    assert info.loaded == 2 and info.found == 3 and info.top_models == ["a", "b"]
    labs = [r.l for r in SC.clean_labels(spark.createDataFrame([("a",), ("d",), ("x",), (None,)], "l string"), "l").collect()]
    assert labs == ["A", "D", "H", "H"]


def test_report_helpers(spark):
    shots = spark.createDataFrame([(95.0, 50.0, None, 1, 0, 0, 0, None), (float("nan"), 1.0, 3.0, 0, 0, 0, 0, "p")],
                                  "x double, y double, distance_to_goal_m double, is_penalty int, is_header int, is_left_foot int, is_right_foot int, player_name string")
    out = S.normalise_for_report(shots).collect()
    assert len(out) == 1 and out[0].shot_type_key == "penalty" and out[0].zone_key == "small_box" and out[0].distance_to_goal_m > 0
    r = spark.createDataFrame([(0.5, 0.3, 0.2), (50.0, 30.0, 120.0)], "h double, d double, a double").select(
        *[c.alias(n) for n, c in zip("hda", O.percent_scale("h", "d", "a"))]).collect()
    assert (r[0].h, r[1].a) == (50.0, 100.0)
    facets = [x.team for x in A.facet_values(spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "team string"), "team").collect()]
    assert facets == ["a", "b"]
    assert spark.range(1).select(O.simple_xg(F.lit(10.0), F.lit(30.0)).alias("v")).first().v < 0.5
    norm = features.normalised_market_probs(spark.createDataFrame([(2.0, 4.0, 4.0)], "b365h double, b365d double, b365a double")).first()
    assert abs(norm.b365_home_prob_norm - 0.5) < 1e-12


def test_l1_selection_poly_and_in_sample(spark):
    df = spark.range(0, 200).select((F.col("id") % 10).cast("double").alias("a"), ((F.col("id") * 7) % 13).cast("double").alias("b"),
                                    (F.col("id") % 3).cast("double").alias("c"))
    df = df.withColumn("y", 3 * F.col("a") + 0.01 * F.col("b"))
    slots = M.select_by_l1(df, ["a", "b", "c"], "y")
    assert 0 in slots
    poly = M.build_pipeline(["a", "b"], M.estimator("linear", "regressor", label="y"), poly=True).fit(df)
    assert poly.transform(df).count() == 200
    scored = M.score_all_rows(df, ["a", "b"], M.estimator("linear", "regressor", label="y"))
    assert scored.filter(~F.col("in_sample")).count() == 0


def test_complete_features_uses_frame_or_rebuilds(spark):
    hist = spark.createDataFrame([(1, "2024-01-01", "A", "B", 2, 0, "H")],
                                 "id long, kickoff string, home_team string, away_team string, fthg long, ftag long, ftr string"
                                 ).withColumn("kickoff", F.to_timestamp("kickoff"))
    frame = spark.createDataFrame([(5, "2024-02-01", "A", "B")], "id long, kickoff string, home_team string, away_team string"
                                  ).withColumn("kickoff", F.to_timestamp("kickoff"))
    done = features.complete_features(frame, ["id"], hist)
    assert done.columns == frame.columns
    rebuilt = features.complete_features(frame, ["home_goals_for_last5"], hist).first()
    assert rebuilt.home_goals_for_last5 == 2.0 and rebuilt.away_goals_against_last5 == 2.0


def test_complete_features_names_what_it_cannot_build(spark):
    import pytest
    from touchline.schemas import SchemaError
    hist = spark.createDataFrame([(1, "A", "B", 2, 0, "H")], "id long, home_team string, away_team string, fthg long, ftag long, ftr string"
                                 ).withColumn("kickoff", F.lit("2024-01-01").cast("timestamp"))
    frame = spark.createDataFrame([(5, "A", "B")], "id long, home_team string, away_team string").withColumn("kickoff", F.lit("2024-02-01").cast("timestamp"))
    with pytest.raises(SchemaError, match="ref_avg_goals_last10"):
        features.complete_features(frame, ["home_goals_for_last5", "ref_avg_goals_last10"], hist)


def test_presets_and_modes(spark):
    df = spark.range(1).select("id", F.lit(1.0).alias("b365h"), F.lit(1.0).alias("points_diff_last5"), F.lit(1.0).alias("ref_avg_goals_last10"),
                               F.lit(1.0).alias("threat_index"), F.lit(1.0).alias("approx_hs"), F.lit(1).alias("fthg"))
    assert features.resolve_features(df, "goals_compact", "regression") == ["b365h", "points_diff_last5"]
    assert features.resolve_features(df, "winner_default") == ["b365h", "points_diff_last5"]
    assert features.resolve_features(df, "candidate_indices") == ["threat_index"]
    assert features.mode_features(df, "winner_default", "classification", "normal", ["approx_hs"]) == ["b365h", "points_diff_last5", "approx_hs"]
    assert "threat_index" not in features.mode_features(df, "winner_default", "classification", "extra")
    assert len(features.GOALS_PRESETS["goals_default"]) == 37 and len(features.WINNER_PRESETS["winner_default"]) == 15


def test_xg_batch_rules(spark):
    import pytest
    from touchline.operators import scoring as SC
    from touchline.schemas import SchemaError
    rows = [("90", "50", "1", None), ("101", "50", "0", None), ("90", "50", "2", None), ("abc", "50", "0", None), ("90", "50", "0", "30"), ("90", "50", None, "-1")]
    out = SC.score_xg_batch(spark.createDataFrame(rows, "x string, y string, is_penalty string, shot_distance string")).collect()
    assert [r.source for r in out] == ["heuristic_fallback", "fallback", "fallback", "fallback", "heuristic_fallback", "fallback"]
    assert out[4].xg_prediction < out[0].xg_prediction and out[1].xg_prediction == 0.0
    with pytest.raises(SchemaError):
        SC.score_xg_batch(spark.createDataFrame([(None, "50")], "x string, y string"))


def test_market_prefers_supplied_probabilities_and_own_goals(spark):
    from touchline.operators import scoring as SC
    df = spark.createDataFrame([(0.2, 0.2, 0.4, 3.5)], "b365_home_prob_norm double, b365_draw_prob_norm double, b365_away_prob_norm double, total_goals double")
    m = SC.market_probabilities(df).first()
    assert abs(m.mk_away - 0.5) < 1e-12 and m.mk_goals == 3.5


def test_stored_predictions_by_pair_last_duplicate_wins(spark):
    from touchline.operators import scoring as SC
    stored = spark.createDataFrame([("F.C. A", "B", 50.0, 30.0, 20.0, 2.0, 1), ("fc a", " b ", 10.0, 20.0, 70.0, None, 2)],
                                   "home string, away string, prob_home double, prob_draw double, prob_away double, est_goals double, position int")
    asked = spark.createDataFrame([(1, "FC A", "B"), (2, "B", "FC A")], "row_id long, home_team string, away_team string")
    out = SC.stored_predictions(asked, stored).collect()
    assert len(out) == 1 and out[0].row_id == 1 and abs(out[0].p_away - 0.7) < 1e-12 and out[0].goals == 2.7
