"""Fixed schemas of the reference's sources and schema checks.

No inference: readers pass these ``StructType``s. Checks read ``df.columns`` / ``df.schema`` only, so
they run no job.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_L, _D, _S, _I = T.LongType(), T.DoubleType(), T.StringType(), T.IntegerType()


def _struct(fields: Iterable[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


ODDS_COLUMNS = [f"{book}{side}" for book in ("b365", "bw", "max", "avg") for side in ("h", "d", "a")]

MATCHES = _struct(
    [("id", _L), ("date", _S), ("time", _S), ("home_team", _S), ("away_team", _S), ("referee", _S),
     ("ftr", _S), ("htr", _S)]
    + [(c, _L) for c in ("fthg", "ftag", "hthg", "htag", "hs", "as_", "hst", "ast", "hf", "af", "hc", "ac",
                         "hy", "ay", "hr", "ar")]
    + [(c, _D) for c in ODDS_COLUMNS]
)

EVENTS = _struct(
    [("id", _L), ("match_id", _L), ("minute", _I), ("second", _I), ("period", _S), ("event_type", _S),
     ("outcome", _S), ("team_name", _S), ("player_name", _S), ("player_id", _L)]
    + [(c, _D) for c in ("x", "y", "end_x", "end_y", "goal_mouth_y", "goal_mouth_z")]
    + [(c, _I) for c in ("is_touch", "is_shot", "is_goal")]
)

QUALIFIER = T.StructType([
    T.StructField("type", T.StructType([T.StructField("displayName", _S, True)]), True),
    T.StructField("value", _S, True),
])
QUALIFIERS = T.ArrayType(QUALIFIER)
SHOT_QUALIFIERS = T.StructType([T.StructField("id", _L, True), T.StructField("qualifiers", QUALIFIERS, True)])

PLAYERS = _struct([("id", _L), ("team", _S), ("name", _S)])

TEAMS = _struct(
    [("id", _L), ("name", _S), ("short_name", _S)]
    + [(c, _L) for c in ("strength", "strength_overall_home", "strength_overall_away", "strength_attack_home",
                         "strength_attack_away", "strength_defence_home", "strength_defence_away", "position",
                         "squad_size", "total_goals", "total_assists")]
)

REFEREES = _struct([("referee", _S), ("matches", _L), ("avg_yellows", _D), ("avg_fouls", _D), ("avg_goals", _D),
                    ("home_win_pct", _D)])

# One trained run as written by the training job.
RUN = T.StructType([
    T.StructField("run_name", _S, True),
    T.StructField("model_id", _S, True),
    T.StructField("stage", _S, True),
    T.StructField("model", _S, True),
    T.StructField("feature_mode", _S, True),
    T.StructField("target", _S, True),
    T.StructField("has_artifact", T.BooleanType(), True),
    T.StructField("score", _D, True),
    T.StructField("params", T.MapType(_S, _S), True),
    T.StructField("cv_metrics", T.MapType(_S, _D), True),
    T.StructField("test_metrics", T.MapType(_S, _D), True),
])

FUTURE_FIXTURE = _struct([("date", _S), ("time", _S), ("home_team", _S), ("away_team", _S), ("referee", _S)]
                         + [(c, _D) for c in ODDS_COLUMNS])


class SchemaError(ValueError):
    """A required column is missing or has the wrong kind of values."""


def require_columns(df: DataFrame, columns: Iterable[str], what: str = "frame") -> None:
    """Raise naming every missing column (P5, E27). Metadata only: no job."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise SchemaError(f"{what}: missing required columns: {', '.join(missing)}")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
