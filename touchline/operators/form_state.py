"""Form as a state that new fixtures update.

The state of a key (a team, a referee) is its last ``window`` rows in the order of kickoff and id, with the values that
form averages. States merge: the last rows of two are the last rows of both together, so a state is updated with new
rows instead of being built from history again, and updates may come in any split. A key that holds a third of all rows
needs no special care: every task keeps at most ``window`` rows of a key before anything is shuffled.

Requests read the state of their teams and referee. They lie after all rows of the state and never see each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.operators import features, reshape
from touchline.operators.features import DIFF_BASES, ORDER, REFEREE_TARGETS, TEAM_FORM_COLUMNS


def last_rows(rows: DataFrame, key: str, window: int) -> DataFrame:
    """(key, last): the last ``window`` of (kickoff, id, form) rows of every key, oldest first. The row limit is applied
    in each task first."""
    newest = Window.partitionBy(key).orderBy(*[F.col(c).desc() for c in ORDER])
    kept = rows.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= window)
    return kept.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*ORDER, "form"))).alias("last"))  # at most ``window`` rows a key


def build(rows: DataFrame, key: str, columns: Sequence[str], window: int) -> DataFrame:
    """The state of rows (key, kickoff, id, columns). Rows without a key belong to no state."""
    form = F.struct(*[F.col(c).cast("double").alias(c) for c in columns])
    return last_rows(rows.filter(F.col(key).isNotNull()).select(key, *ORDER, form.alias("form")), key, window)


def merge(left: DataFrame, right: DataFrame, key: str, window: int) -> DataFrame:
    """The state of the rows of both; a row in both (a retried update) counts once."""
    rows = left.unionByName(right).select(key, F.explode("last").alias("r")).select(key, "r.*")
    return last_rows(rows.dropDuplicates([key, *ORDER]), key, window)


def means(state: DataFrame, columns: Sequence[str], out: str = "{c}") -> list:
    """Mean of every column over the state's rows, nulls left out."""
    def mean(c: str):
        values = F.filter(F.transform("last", lambda r: r["form"][c]), lambda v: v.isNotNull())
        total = F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
        return F.try_divide(total, F.size(values).cast("double")).alias(out.format(c=c))
    return [mean(c) for c in columns]


def team_rows(fixtures: DataFrame, event_stats: DataFrame | None = None) -> tuple[DataFrame, list[str]]:
    """Two rows a fixture with the form columns that fixtures and event statistics give."""
    long = features.team_long(fixtures)
    if event_stats is not None:
        stats = event_stats.drop("kickoff", "home_team", "away_team", "opponent", "is_home").withColumnRenamed("team_name", "team")
        long = long.join(stats, on=["match_id", "team"], how="left")
    return long.withColumnRenamed("match_id", "id"), [c for c in TEAM_FORM_COLUMNS if c in long.columns]


def team_state(fixtures: DataFrame, event_stats: DataFrame | None = None, window: int = 5) -> DataFrame:
    rows, columns = team_rows(fixtures, event_stats)
    return build(rows, "team", columns, window)


def referee_state(fixtures: DataFrame, window: int = 10) -> DataFrame:
    return build(features.referee_totals(fixtures), "referee", list(REFEREE_TARGETS), window)


def request_features(new_rows: DataFrame, teams: DataFrame, referees: DataFrame | None = None, window: int = 5) -> DataFrame:
    """The feature row of fixtures not yet played, from the states: form of both sides, differences, referee
    history (with ``referees``) and market features (when ``new_rows`` has prices)."""
    columns = teams.schema["last"].dataType.elementType["form"].dataType.fieldNames()
    form = teams.select("team", *means(teams, columns, f"{{c}}_last{window}"))
    res = new_rows
    for side in ("home", "away"):
        own = form.select(F.col("team").alias(f"{side}_team"), *[F.col(f"{c}_last{window}").alias(f"{side}_{c}_last{window}") for c in columns])
        res = res.join(own, f"{side}_team", "left")
    res = reshape.side_differences(res, [b for b in DIFF_BASES if b in columns], f"_last{window}")
    if referees is not None:
        own = referees.select("referee", *means(referees, list(REFEREE_TARGETS), "_ref_{c}"))
        res = res.join(own, "referee", "left").withColumnsRenamed({f"_ref_{c}": t for c, t in REFEREE_TARGETS.items()})
    if all(f"{b}{s}" in new_rows.columns for b in features.BOOKS for s in features.SIDE_NAMES):
        res = features.market_features(res)
    return res
