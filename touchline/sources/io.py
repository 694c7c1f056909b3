"""Readers, writers, manifests and catalogs.

All readers take explicit schemas (no inference). Writers produce Parquet by default; JSON and CSV
on request. Nothing is collected to the driver except the manifest's per-artifact row counts, read
back from the written files.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.schemas import RUN, SchemaError
from touchline.sources import csv_split


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, encoding: str = "UTF-8",
             corrupt_col: str | None = None, keep_extra: bool = False, split: bool = True) -> DataFrame:
    """Header CSV mapped onto ``schema`` by column *name* (headers trimmed and lower-cased),
    not by position: columns are read as text, each schema field is cast leniently (bad text ->
    null, P4), schema fields absent from the file are null, extra file columns are dropped unless
    ``keep_extra``. Quoted line breaks stay inside their field. All files of one call have the same header;
    a file whose header differs raises instead of being read by position. ``corrupt_col`` keeps malformed
    lines (too few or too many fields) whole in that column (S5). Files are read in splits also where fields
    hold line breaks (``csv_split``); ``split=False``, or an encoding that cannot be split, makes a file one task."""
    paths = [path] if isinstance(path, str) else list(path)
    options = {"header": True, "encoding": encoding, "mode": "PERMISSIVE", "multiLine": True, "escape": '"'}
    header = spark.read.options(**options).csv(paths).columns  # reads the first record only
    text = T.StructType([T.StructField(c, T.StringType()) for c in header])
    reader = spark.read.options(**options).option("enforceSchema", False)
    if corrupt_col:
        text = T.StructType(text.fields + [T.StructField(corrupt_col, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt_col)
    if split and encoding.lower() in csv_split.SPLITTABLE:
        raw = normalise_headers(csv_split.read_records(spark, paths, header, text, corrupt_col=corrupt_col))
    else:
        raw = normalise_headers(reader.schema(text).csv(paths))
    cols = []
    for f in schema.fields:
        if f.name in raw.columns:
            c = F.col(f"`{f.name}`")
            cols.append((c if isinstance(f.dataType, T.StringType) else F.trim(c).try_cast(f.dataType)).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    known = {f.name for f in schema.fields}
    if keep_extra:
        cols += [F.col(f"`{c}`") for c in raw.columns if c not in known and c != (corrupt_col or "").lower()]
    if corrupt_col:
        cols.append(F.col(f"`{corrupt_col.strip().lower()}`").alias(corrupt_col))
    return raw.select(*cols)


def read_json_records(spark: SparkSession, path: str, schema: T.StructType, root_key: str = "data") -> DataFrame:
    """Multi-line JSON that is either a bare list of records or an object wrapping the list under
    ``root_key``; which of the two a file is shows in the file itself."""
    both = T.StructType([*schema.fields, *([] if root_key in schema.fieldNames() else [T.StructField(root_key, T.ArrayType(schema))])])
    raw = spark.read.schema(both).option("multiLine", True).json(path)
    if root_key in schema.fieldNames():
        return raw
    own = F.array(F.struct(*[F.col(f"`{c}`") for c in schema.fieldNames()]))
    return raw.select(F.explode(F.coalesce(F.col(f"`{root_key}`"), own)).alias("_r")).select("_r.*")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether any Hadoop-readable location (local path or URI) exists; Spark's own path check decides."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def first_existing(spark: SparkSession, paths: Sequence[str]) -> str:
    """The first location that exists."""
    for p in paths:
        if p and exists(spark, p):
            return p
    raise FileNotFoundError(f"none of the candidate paths exist: {list(paths)}")


def read_with_raw_copy(spark: SparkSession, paths: Sequence[str], schema: T.StructType, raw_path: str) -> DataFrame:
    """The first existing CSV location, copied to the raw layer as Parquet and read from there."""
    read_csv(spark, first_existing(spark, paths), schema).write.mode("overwrite").parquet(raw_path)
    return spark.read.schema(schema).parquet(raw_path)


def column_cascade(spark: SparkSession, cached_path: str, inline: DataFrame | None, schema: T.StructType) -> DataFrame:
    """An auxiliary table from its cached file, else from the columns of ``inline``, else empty."""
    if exists(spark, cached_path):
        return spark.read.schema(schema).parquet(cached_path)
    if inline is not None and set(schema.fieldNames()) <= set(inline.columns):
        return inline.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    return spark.createDataFrame([], schema)


def normalise_headers(df: DataFrame) -> DataFrame:
    """Lower-cased, trimmed column names."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A table that does not exist becomes an empty table of the schema, with a warning. Any other
    failure is raised."""
    if exists(spark, path):
        return spark.read.schema(schema).format(fmt).option("header", True).load(path)
    warnings.warn(f"table at {path} not found; using an empty table")
    return spark.createDataFrame([], schema)


def require_non_empty(df: DataFrame, what: str = "input") -> DataFrame:
    """An empty batch is an error (one ``isEmpty`` probe, reads at most one row)."""
    if df.isEmpty():
        raise SchemaError(f"{what} is empty")
    return df


def read_runs(spark: SparkSession, root: str, recursive: bool = True) -> DataFrame:
    """Every run summary (multi-line JSON) below ``root`` with its source file."""
    reader = spark.read.schema(RUN).option("multiLine", True)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.json(root).withColumn("source_file", F.input_file_name())


def labelled_rows(df: DataFrame, label: str = "ftr") -> DataFrame:
    """Keep rows whose label is one of H, D, A."""
    return df.filter(F.col(label).isin("H", "D", "A"))


def read_labelled(spark: SparkSession, paths: Sequence[str], schema: T.StructType, label: str = "ftr") -> DataFrame:
    """The labelled rows of the first location that exists."""
    return labelled_rows(read_csv(spark, first_existing(spark, paths), schema), label)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), mode: str = "overwrite") -> int:
    """Write an artifact and return its row count, read back from the written files
    (Parquet answers from footer metadata). ``Observation`` metrics are not used: in this Spark
    version an observed write leaves session state that breaks later jobs."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)
    reader = df.sparkSession.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    return int(reader.load(path).count())


def write_json_document(df: DataFrame, path: str) -> None:
    """A nested payload as JSON (one file; non-ASCII kept as is)."""
    df.coalesce(1).write.mode("overwrite").json(path)


def manifest(spark: SparkSession, artifacts: dict[str, tuple[str, DataFrame, int]], inputs: Sequence[str]) -> DataFrame:
    """One row per artifact (name, path, rows, columns) plus input lineage and a UTC timestamp.
    ``artifacts`` maps name to (path, frame, rows from ``write_table``)."""
    now = datetime.now(timezone.utc).isoformat()
    rows = [(n, p, int(r), list(df.columns), list(inputs), now) for n, (p, df, r) in artifacts.items()]
    return spark.createDataFrame(rows, "artifact string, path string, rows long, columns array<string>, inputs array<string>, created_utc string")


# The feature catalog (dataset: name, family, scope, known before kickoff), with a line on each.
CATALOG = {
    "shots_enriched": [
        ("distance_to_goal_m", "geometria", "tiro", False, "metres from the shot to the centre of the goal"),
        ("goal_frame_angle", "geometria", "tiro", False, "angle between the posts as seen from the shot"),
        ("centrality_to_goal", "geometria", "tiro", False, "how central the shot is, from 0 to 1"),
        ("shot_angle_distance_interaction", "geometria", "tiro", False, "angle and distance in one number"),
        ("is_assisted", "contexto_del_tiro", "tiro", False, "a team mate set the shot up"),
        ("is_individual_play", "contexto_del_tiro", "tiro", False, "the shooter made the chance alone"),
        ("is_regular_play", "contexto_del_tiro", "tiro", False, "open play"),
        ("is_set_piece", "contexto_del_tiro", "tiro", False, "after a set piece"),
        ("score_diff_before_shot", "estado_del_partido", "tiro", False, "goals of the shooter's team less the other's before the shot"),
        ("leading_before_shot", "estado_del_partido", "tiro", False, "the shooter's team leads"),
        ("trailing_before_shot", "estado_del_partido", "tiro", False, "the shooter's team trails"),
        ("shot_number_in_match", "secuencia", "tiro", False, "ordinal among the shots of the match"),
        ("team_shot_number_in_match", "secuencia", "tiro", False, "ordinal among the team's shots in the match"),
        ("time_since_prev_team_shot_s", "secuencia", "tiro", False, "seconds since the team's last shot"),
        ("player_conversion_last20", "historial_rodante", "tiro", True, "goals a shot over the player's 20 shots before"),
        ("player_big_chance_rate_last20", "historial_rodante", "tiro", True, "share of big chances in the player's 20 shots before"),
        ("team_conversion_last40", "historial_rodante", "tiro", True, "goals a shot over the team's 40 shots before"),
        ("team_big_chance_rate_last40", "historial_rodante", "tiro", True, "share of big chances in the team's 40 shots before"),
    ],
    "event_match_features": [
        ("progressive_pass_rate", "estilo_de_equipo", "equipo_partido", False, "share of passes that gain 15 units or more"),
        ("shot_accuracy", "ataque_de_equipo", "equipo_partido", False, "shots on target a shot"),
        ("conversion_rate", "ataque_de_equipo", "equipo_partido", False, "goals a shot"),
        ("big_chance_rate", "ataque_de_equipo", "equipo_partido", False, "big chances a shot"),
        ("assisted_shot_rate", "ataque_de_equipo", "equipo_partido", False, "assisted shots a shot"),
        ("touches_per_shot", "ataque_de_equipo", "equipo_partido", False, "touches a shot"),
        ("avg_score_diff_before_shot", "contexto_de_equipo", "equipo_partido", False, "mean score difference at the team's shots"),
    ],
    "match_features": [
        ("points_diff_last5", "forma_prepartido", "partido", True, "home less away mean points of the last five"),
        ("shot_accuracy_diff_last5", "forma_prepartido", "partido", True, "home less away shot accuracy of the last five"),
        ("conversion_rate_diff_last5", "forma_prepartido", "partido", True, "home less away conversion of the last five"),
        ("big_chance_rate_diff_last5", "forma_prepartido", "partido", True, "home less away big-chance share of the last five"),
        ("assisted_shot_rate_diff_last5", "forma_prepartido", "partido", True, "home less away assisted share of the last five"),
        ("avg_shot_angle_diff_last5", "calidad_de_ocasiones", "partido", True, "home less away mean shot angle of the last five"),
        ("avg_score_diff_before_shot_diff_last5", "estado_prepartido", "partido", True, "home less away mean score state at shots of the last five"),
        ("market_favorite_strength", "senal_de_mercado", "partido", True, "largest normalised implied probability"),
        ("market_entropy_b365", "senal_de_mercado", "partido", True, "entropy of the implied probabilities"),
        ("home_odds_dispersion", "senal_de_mercado", "partido", True, "spread of the home price over the bookmakers"),
        ("ref_avg_yellows_last10", "contexto_arbitral", "partido", True, "mean yellow cards in the referee's ten matches before"),
        ("ref_home_win_rate_last10", "contexto_arbitral", "partido", True, "share of home wins in the referee's ten matches before"),
    ],
}
# The leakage table (feature group, class), with the reason.
LEAKAGE = [
    ("Odds pre-partido (B365H, B365D, B365A)", "pre-partido valida", "prices are set before kickoff"),
    ("Equipo local, equipo visitante y arbitro", "pre-partido valida", "known before kickoff"),
    ("Rolling goals, points y win rate last5", "pre-partido valida", "earlier matches only"),
    ("Shots y shots on target del partido actual", "post-partido leakage", "observed in the match to be predicted"),
    ("Corners del partido actual", "post-partido leakage", "observed in the match to be predicted"),
    ("Fouls, yellow cards y red cards del partido actual", "post-partido leakage", "observed in the match to be predicted"),
    ("FTHG, FTAG, total_goals y goal_diff", "post-partido leakage", "the targets themselves"),
]


def feature_catalog(spark: SparkSession) -> DataFrame:
    rows = [(dataset, *row) for dataset, own in CATALOG.items() for row in own]
    return spark.createDataFrame(rows, "dataset string, name string, family string, scope string, ex_ante boolean, description string")


def leakage_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEAKAGE, "feature string, class string, reason string")


def flatten_runs(runs: DataFrame) -> DataFrame:
    """Nested run summaries to one wide row each; params as JSON text."""
    return runs.select(
        "run_name", "model_id", "stage", "model", "feature_mode", "target", "has_artifact", "score",
        F.to_json("params").alias("params_json"),
        F.col("cv_metrics")["accuracy"].alias("cv_accuracy"), F.col("cv_metrics")["f1_weighted"].alias("cv_f1_weighted"),
        F.col("cv_metrics")["r2"].alias("cv_r2"),
        F.col("test_metrics")["accuracy"].alias("test_accuracy"), F.col("test_metrics")["f1_weighted"].alias("test_f1_weighted"),
        F.col("test_metrics")["r2"].alias("test_r2"))


def export_columns(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """Only the listed columns that exist, in the listed order."""
    return df.select(*[c for c in wanted if c in df.columns])
