"""The README's user path: CSV sources with the reference's schemas -> prepared matches -> shots ->
team-match stats -> fixture features -> time split -> a fitted model."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF001
from touchline.ml import models, split
from touchline.operators import features, shots
from touchline.plans import bindings
from touchline.schemas import EVENTS, MATCHES, SHOT_QUALIFIERS
from touchline.sources import io


def test_csv_user_path(spark):
    d = tempfile.mkdtemp(prefix="tl-user-", dir="/tmp")
    fx = bindings.fixtures(spark, SF001)
    raw = fx.select(
        "id", F.date_format("kickoff", "dd/MM/yyyy").alias("date"), F.lit("15:00").alias("time"),
        F.concat(F.lit("Team "), F.col("home_team").cast("string")).alias("home_team"),
        F.concat(F.lit("Team "), F.col("away_team").cast("string")).alias("away_team"),
        F.col("referee").cast("string").alias("referee"), "ftr", "fthg", "ftag", "hs", "as_", "hst", "ast", "hf", "af",
        "hc", "ac", "hy", "ay", "hr", "ar", *[c for c in MATCHES.fieldNames() if c.endswith(("h", "d", "a")) and c[:-1] in ("b365", "bw", "max", "avg")],
        F.lit("ignored").alias("extra_column"))
    raw.write.mode("overwrite").option("header", True).csv(os.path.join(d, "matches"))
    ev = bindings.play_events(spark, SF001, fx).withColumn("team_name", F.concat(F.lit("Team "), F.col("team_name")))
    ev.select(*[c for c in EVENTS.fieldNames() if c in ev.columns]).write.mode("overwrite").option("header", True).csv(os.path.join(d, "events"))
    bindings.shot_qualifiers(spark, SF001).write.mode("overwrite").json(os.path.join(d, "quals"))

    matches = features.prepare_matches(io.read_csv(spark, os.path.join(d, "matches"), MATCHES))
    events = io.read_csv(spark, os.path.join(d, "events"), EVENTS)
    quals = spark.read.schema(SHOT_QUALIFIERS).json(os.path.join(d, "quals"))
    shot_table = shots.enrich_shots(events, matches, quals)
    stats = shots.team_match_stats(events, shot_table, matches)
    feats = features.fixture_features(matches, stats)
    assert feats.count() == fx.count()
    assert {"home_shots_last5", "away_conversion_rate_last5", "pass_accuracy_diff_last5", "ref_avg_goals_last10"} <= set(feats.columns)
    # event stats reached the windows: some fixture has a non-null shot history
    assert feats.filter(F.col("home_shots_last5").isNotNull()).count() > 0
    data = split.holdout_split(feats, ["kickoff", "id"]).withColumn("label", F.col("result_code").cast("double"))
    cols = features.resolve_features(data, "history_only")
    assert cols and all("_last" in c for c in cols)
    model = models.build_pipeline(cols, models.estimator("multinomial", "classifier")).fit(data.filter("is_train"))
    assert model.transform(data.filter(~F.col("is_train"))).count() == data.filter(~F.col("is_train")).count()
