"""Stored runs, their flat report, and the catalogs."""

import json
import os
import tempfile

from touchline.sources import io as IO
from touchline.sources import run_store as RS

MODEL = {"name": "ridge", "best_cv_score": 0.25, "best_params": {"alpha": "1.0"}}
CLASSIFIER = {"name": "knn", "best_cv_score": 0.5, "best_params": {"k": "5"}}
ERRORS = {"train": {"mae": 1.0, "rmse": 1.5, "r2": 0.3}, "test": {"mae": 1.1, "rmse": 1.6, "r2": 0.2}}
SCORES = {"train": {"accuracy": 0.6, "f1_weighted": 0.55}, "test": {"accuracy": 0.5, "f1_weighted": 0.45}}
RUNS = [{"run_name": "two", "feature_mode": "normal", "smote": False, "regressor": MODEL, "classifier": CLASSIFIER, "regression_metrics": ERRORS, "classifier_metrics": SCORES},
        {"run_name": "one", "target_metric": "threat_index", "regressor": MODEL, "regression_metrics": ERRORS},
        {"run_name": "adv", "target_metric": "threat_index", "feature_mode": "extra", "smote": True, "classifier": CLASSIFIER, "classifier_metrics": SCORES,
         "generator_model": {"run_name": "one", "name": "ridge", "cv_r2": 0.25, "test_r2": 0.2}}]


def files(runs):
    folder = tempfile.mkdtemp(prefix="tl-runs-", dir="/tmp")
    for r in runs:
        os.makedirs(f"{folder}/{r['run_name']}")
        with open(f"{folder}/{r['run_name']}/run_summary.json", "w") as f:
            json.dump(r, f, indent=2)
    return folder


def test_forms_flatten_to_one_wide_row_each(spark):
    rows = {r.run_name: r for r in RS.report(RS.read_run_files(spark, files(RUNS))).collect()}
    assert {n: r.form for n, r in rows.items()} == {"two": "two_stage", "one": "stage1", "adv": "advanced"}
    two, one, adv = rows["two"], rows["one"], rows["adv"]
    assert (two.regressor_name, two.classifier_cv_score, two.regression_test_rmse, two.winner_train_accuracy, two.smote) == ("ridge", 0.5, 1.6, 0.6, False)
    assert json.loads(two.regressor_params) == {"alpha": "1.0"} and json.loads(adv.classifier_params) == {"k": "5"}
    assert (one.target_metric, one.regression_train_r2, one.classifier_name, one.winner_test_accuracy) == ("threat_index", 0.3, None, None)
    assert (adv.plan_type, adv.generator_run_name, adv.generator_test_r2, adv.regressor_name, adv.winner_test_f1_weighted) == ("single_metric", "one", 0.2, None, 0.45)


def test_a_trial_written_twice_counts_once(spark):
    path = tempfile.mkdtemp(prefix="tl-store-", dir="/tmp") + "/store"
    runs = RS.read_run_files(spark, files(RUNS))
    RS.append_runs(runs.filter("run_name <> 'adv'"), path)
    RS.append_runs(runs.filter("run_name = 'adv'"), path)
    RS.append_runs(runs.filter("run_name = 'one'"), path)  # a retry
    better = files([{**RUNS[0], "classifier": {**CLASSIFIER, "best_cv_score": 0.75}}])
    RS.append_runs(RS.read_run_files(spark, better).unionByName(RS.read_run_files(spark, better)), path)
    kept = {r.run_name: r for r in RS.report(RS.stored_runs(spark, path)).collect()}
    assert RS.stored_runs(spark, path).count() == 3 and kept["two"].classifier_cv_score == 0.75 and kept["one"].regressor_cv_score == 0.25


def test_catalogs_list_every_feature(spark):
    rows = IO.feature_catalog(spark).collect()
    assert len(rows) == 37 == len({(r.dataset, r.name) for r in rows}) and {r.ex_ante for r in rows if r.family == "geometria"} == {False}
    assert {r.name for r in rows if r.dataset == "shots_enriched" and r.ex_ante} == {"player_conversion_last20", "player_big_chance_rate_last20", "team_conversion_last40",
                                                                                   "team_big_chance_rate_last40"}
    assert all(r.ex_ante for r in rows if r.dataset == "match_features") and not any(r.ex_ante for r in rows if r.dataset == "event_match_features")
    leak = IO.leakage_table(spark).collect()
    assert len(leak) == 7 and sum(r["class"] == "post-partido leakage" for r in leak) == 4
