"""The table that the match models are fitted on, and the stages that its fits share."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from touchline.functions import odds as O
from touchline.ml import models as M
from touchline.ml import search as S
from touchline.ml.split import holdout_split
from touchline.plans import ml_queries as Q


def split_counts(df):
    return sorted(map(tuple, df.groupBy("t", "id", "is_train").count().collect()), key=repr)


def test_holdout_without_an_index_equals_the_indexed_one(spark):
    plain = [(i * 7 % 103, i) for i in range(103)] + [(None, 200)]
    tied = [(5, 1)] * 10 + [(6, 2)] * 30  # the cut lies among rows that share their keys
    edge = [(i, i) for i in range(8)] + [(8, 8)] * 2  # it lies before them
    nulls = [(None, None)] * 9 + [(1, 1)]
    for rows in (plain, tied, edge, nulls, [(1, 1)], []):
        df = spark.createDataFrame(rows, "t long, id long")
        got = holdout_split(df, ["t", "id"], idx_col=None)
        assert got.columns == ["t", "id", "is_train"]
        assert split_counts(got) == split_counts(holdout_split(df, ["t", "id"]))


def test_row_std_stays_small_enough_to_compile(spark):
    assert str(O.row_std(["a", "b", "c", "d"])).count("/") <= 2  # the mean is written once
    df = spark.createDataFrame([(1.0, 2.0, 4.0), (1.0, None, None), (float("inf"), 1.0, 2.0), (3.0, 3.0, None)], "a double, b double, c double")
    got = [r[0] for r in df.select(O.row_std(["a", "b", "c"])).collect()]
    assert got[0] == pytest.approx(np.std([1, 2, 4], ddof=1)) and got[1] is None and np.isnan(got[2]) and got[3] == 0


def test_match_table_holds_only_what_the_fits_read(spark):
    data = Q.match_table(spark, SF001)
    assert len(data.columns) < 30 and set(Q.MATCH_FEATURES) <= set(data.columns)
    more = Q.match_table(spark, SF001, ["hs"], indexed=True)
    assert {*more.columns} - {*data.columns} == {"hs", "row_idx"}
    n = more.count()
    assert more.filter("is_train").count() == data.filter("is_train").count() == int(n * 0.8)
    assert more.agg(F.countDistinct("row_idx")).first()[0] == n


def stage_rows(spark, missing=False):
    rng = np.random.default_rng(5)
    rows = [(i, float(a), float(b) if not missing or i % 9 else None, float(2 * a - b), float(a + rng.normal()), float(i % 3)) for i, (a, b) in enumerate(rng.normal(size=(120, 2)))]
    return spark.createDataFrame(rows, "i long, a double, b double, y double, z double, cls double").checkpoint()


def test_all_generators_come_from_one_scan(spark, monkeypatch):
    df = stage_rows(spark)
    train, test = df.filter("i < 90"), df.filter("i >= 90")
    kinds, seen = [], []
    plain = M.estimator
    monkeypatch.setattr(M, "estimator", lambda name, kind, **p: kinds.append(kind) or plain(name, kind, **p))

    def checks(pred):
        seen.append(pred)
        return [F.count(F.lit(1)).alias("scored")]
    runs = {r["run"]: (r["features"], r["scored"]) for r in S.advanced_stage2(train, test, ["a", "b"], ["y", "z"], "cls", checks=checks).collect()}
    assert runs == {"y": (3, 30), "z": (3, 30), "all": (4, 30)}
    assert kinds == ["classifier"] * 3  # no fit a generator
    monkeypatch.undo()
    fit = M.build_pipeline(["a", "b"], M.estimator("linear", "regressor", label="z"), impute=None).fit(train)
    want = [r["prediction"] for r in fit.transform(test).orderBy("a").collect()]
    assert [r["approx_z"] for r in seen[-1].orderBy("a").collect()] == pytest.approx(want, abs=1e-7)


def test_medians_are_found_only_where_values_are_missing(spark, monkeypatch):
    built = []
    plain = M.build_pipeline
    monkeypatch.setattr(M, "build_pipeline", lambda *a, **k: built.append(k.get("impute", "median")) or plain(*a, **k))
    for missing, want in ((False, None), (True, "median")):
        df = stage_rows(spark, missing)
        built.clear()
        assert S.two_stage(df.filter("i < 90"), df.filter("i >= 90"), ["a", "b"], "y", "cls").count() == 30
        assert built == [want] * 2
