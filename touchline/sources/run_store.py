"""Stored training runs: idempotent appends and the flat report over all forms of run.

A run is written under its own name, so that writing it again (a retry, a repeated trial) replaces it and no other.
Three forms of run exist: a two-stage run, a stage-1 run for one target, and an advanced stage-2 run on a
generator's output. Each has its own flat columns; the report is their union by name, in which the columns of other forms
are null but typed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_ERRORS = "struct<mae:double,rmse:double,r2:double>"
_SCORES = "struct<accuracy:double,f1_weighted:double>"
_MODEL = "struct<name:string,best_cv_score:double,best_params:map<string,string>>"
#: Everything a run of any form may hold.
RUN_FORM = ("run_name string, feature_mode string, smote boolean, target_metric string, plan_type string, "
            f"regressor {_MODEL}, classifier {_MODEL}, generator_model struct<run_name:string,name:string,cv_r2:double,test_r2:double>, "
            f"regression_metrics struct<train:{_ERRORS},test:{_ERRORS}>, classifier_metrics struct<train:{_SCORES},test:{_SCORES}>")
FORMS = ("two_stage", "stage1", "advanced")


def read_run_files(spark: SparkSession, path: str) -> DataFrame:
    """Run summaries, one JSON document a file."""
    return spark.read.schema(RUN_FORM).option("multiLine", True).option("recursiveFileLookup", True).json(path)


def append_runs(runs: DataFrame, path: str) -> None:
    """Store runs (``RUN_FORM``) by name: a name that is stored already is replaced, all others stay. Of rows that
    repeat a name within one append one is kept."""
    rows = runs.filter(F.col("run_name").isNotNull()).dropDuplicates(["run_name"]).withColumn("run", F.col("run_name"))
    rows.repartition("run").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)


def stored_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_FORM).option("basePath", path).parquet(path)


def form_of() -> Column:
    return F.when(F.col("generator_model.run_name").isNotNull(), "advanced").when(F.col("classifier.name").isNull(), "stage1").otherwise("two_stage")


def _sides(prefix: str, metrics: str, names: tuple[str, ...]) -> dict[str, Column]:
    return {f"{prefix}_{side}_{name}": F.col(f"{metrics}.{side}.{name}") for name in names for side in ("train", "test")}


def flatten(runs: DataFrame, form: str) -> DataFrame:
    """The flat columns of one form."""
    regressor = {"regressor_name": F.col("regressor.name"), "regressor_cv_score": F.col("regressor.best_cv_score"),
                 **_sides("regression", "regression_metrics", ("mae", "rmse", "r2")), "regressor_params": F.to_json("regressor.best_params")}
    classifier = {"classifier_name": F.col("classifier.name"), "classifier_cv_score": F.col("classifier.best_cv_score"),
                  **_sides("winner", "classifier_metrics", ("accuracy", "f1_weighted")), "classifier_params": F.to_json("classifier.best_params")}
    mode = {"feature_mode": F.col("feature_mode"), "smote": F.col("smote")}
    columns = {"two_stage": {**mode, **regressor, **classifier}, "stage1": {"target_metric": F.col("target_metric"), **regressor},
               "advanced": {"target_metric": F.col("target_metric"), "plan_type": F.coalesce("plan_type", F.lit("single_metric")), **mode,
                            "generator_run_name": F.col("generator_model.run_name"), "generator_name": F.col("generator_model.name"),
                            "generator_cv_r2": F.col("generator_model.cv_r2"), "generator_test_r2": F.col("generator_model.test_r2"), **classifier}}[form]
    return runs.filter(form_of() == form).select(F.lit(form).alias("form"), "run_name", *[c.alias(n) for n, c in columns.items()])


def report(runs: DataFrame) -> DataFrame:
    """One flat row a run of any form."""
    out = flatten(runs, FORMS[0])
    for form in FORMS[1:]:
        out = out.unionByName(flatten(runs, form), allowMissingColumns=True)
    return out

