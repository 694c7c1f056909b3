"""Form states: updates equal rebuilds, and requests equal the feature row built from history."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF001
from touchline.operators import features, form_state as FS
from touchline.plans import bindings


def states(df, key):
    return {r[key]: [(x.kickoff, x.id, *x.form) for x in r["last"]] for r in df.collect()}


def rows(spark, n=300, hot=0.5):
    start = dt.datetime(2024, 1, 1)
    data = [("hot" if i % 10 < hot * 10 else f"t{i % 7}", start + dt.timedelta(days=(i * 37) % 90), i, None if i % 11 == 0 else float(i % 5)) for i in range(n)] + [(None, start, 9999, 1.0)]
    return spark.createDataFrame(data, "team string, kickoff timestamp, id long, goals double")


def plain(data, window):
    out = {}
    for r in sorted((r for r in data if r.team is not None), key=lambda r: (r.kickoff, r.id)):
        out.setdefault(r.team, []).append((r.kickoff, r.id, r.goals))
    return {k: v[-window:] for k, v in out.items()}


def test_updates_in_any_split_equal_a_rebuild(spark):
    frame = rows(spark)
    want = plain(frame.collect(), 4)
    assert states(FS.build(frame, "team", ["goals"], 4), "team") == want
    state = None
    for part in (F.col("id") % 3 == 1, F.col("id") % 3 == 0, F.col("id") % 3 == 2, F.col("id") < 50):  # the last one again: a retry
        new = FS.build(frame.filter(part), "team", ["goals"], 4)
        state = new if state is None else FS.merge(state, new, "team", 4)
    assert states(state, "team") == want
    mean = {r.team: r.goals for r in state.select("team", *FS.means(state, ["goals"])).collect()}
    for team, last in want.items():
        known = [g for _, _, g in last if g is not None]
        assert mean[team] == (sum(known) / len(known) if known else None)


def test_a_task_sends_on_no_more_than_the_window_of_a_key(spark):
    plan = FS.build(rows(spark), "team", ["goals"], 4)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 1


def test_requests_equal_the_feature_row_from_history(spark):
    fx = bindings.fixtures(spark, SF001)
    both = bindings.with_time_split(fx)
    hist = both.filter("is_train").drop("is_train")
    books = [f"{b}{s}" for b in features.BOOKS for s in features.SIDE_NAMES]
    new = both.filter("not is_train").select("id", "kickoff", "home_team", "away_team", "referee", *books)
    want = features.future_fixture_features(hist, new)
    got = FS.request_features(new, FS.team_state(hist), FS.referee_state(hist))
    cols = sorted(set(want.columns) & set(got.columns))
    assert set(want.columns) == set(got.columns)

    def table(df):
        return {r.id: [round(v, 9) if isinstance(v, float) else v for v in (r[c] for c in cols)] for r in df.collect()}

    assert table(got) == table(want)
