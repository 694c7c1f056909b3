"""Hot-key splitting must not change results: whole pipelines run with a tiny rows-per-task limit
(every entity is hot and split into many segments) and must equal the default run."""

from pyspark.sql import functions as F

from conftest import SF001, rows
from touchline.operators import features, windows
from touchline.operators.shots import enrich_shots
from touchline.plans import bindings


def _with_limit(spark, limit, fn):
    old = spark.conf.get(windows.ROWS_PER_TASK_CONF, None)
    spark.conf.set(windows.ROWS_PER_TASK_CONF, str(limit))
    try:
        return fn()
    finally:
        if old is None:
            spark.conf.unset(windows.ROWS_PER_TASK_CONF)
        else:
            spark.conf.set(windows.ROWS_PER_TASK_CONF, old)


def test_shot_pipeline_split_equals_plain(spark):
    def run():
        fx = bindings.fixtures(spark, SF001)
        s = enrich_shots(bindings.play_events(spark, SF001, fx), bindings.match_context(fx), bindings.shot_qualifiers(spark, SF001))
        return rows(s.select("id", "shot_number_in_match", "time_since_prev_match_shot_s", "home_goals_before_shot",
                             "team_shot_number_in_match", "player_shot_number_in_match", "player_shots_before",
                             "player_goals_last20", "team_avg_distance_last40"))
    plain = run()
    split = _with_limit(spark, 8, run)   # the busiest players/teams have tens of shots: split into several segments
    assert plain == split


def test_future_features_split_equals_plain(spark):
    def run():
        fx = bindings.fixtures(spark, SF001)
        both = bindings.with_time_split(fx)
        hist = both.filter("is_train").drop("is_train")
        new = both.filter(~F.col("is_train")).select("id", "kickoff", "home_team", "away_team")
        return rows(features.future_fixture_features(hist, new).select("id", "home_goals_for_last5", "away_points_last5"))
    assert run() == _with_limit(spark, 4, run)


def test_future_rows_do_not_see_each_other(spark):
    hist = spark.createDataFrame(
        [(1, "2024-01-01", "A", "B", 3, 0, "H"), (2, "2024-01-08", "A", "C", 1, 1, "D")],
        "id long, kickoff string, home_team string, away_team string, fthg long, ftag long, ftr string"
    ).withColumn("kickoff", F.to_timestamp("kickoff"))
    new = spark.createDataFrame([(10, "2024-02-01", "A", "D"), (11, "2024-02-08", "A", "E")],
                                "id long, kickoff string, home_team string, away_team string").withColumn("kickoff", F.to_timestamp("kickoff"))
    out = {r.id: r for r in features.future_fixture_features(hist, new).collect()}
    # both future fixtures of A see the same two played fixtures: (3 + 1) / 2 goals, (3 + 1) / 2 points
    assert out[10].home_goals_for_last5 == 2.0 and out[11].home_goals_for_last5 == 2.0
    assert out[10].home_points_last5 == 2.0 and out[11].home_points_last5 == 2.0
    assert out[10].away_goals_for_last5 is None


def test_fixture_hot_rows_equal_generic_detection(spark):
    def run():
        fx = bindings.fixtures(spark, SF001)
        long = features.team_long(fx)
        return (features.fixture_hot_rows(fx),
                (windows.hot_key_rows(long, ["team"])[("team",)], windows.hot_key_rows(fx, ["referee"])[("referee",)]))
    one_pass, generic = _with_limit(spark, 15, run)
    assert one_pass == generic and one_pass[0] > 0 and one_pass[1] > 0


def test_fixture_features_split_equals_plain(spark):
    def run():
        res = features.fixture_features(bindings.fixtures(spark, SF001), None, 5, ["goals_for", "points"])
        return rows(res.select("id", "home_goals_for_last5", "away_points_last5", "ref_avg_goals_last10"))
    assert run() == _with_limit(spark, 15, run)
