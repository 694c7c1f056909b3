"""Cleaning scalars.

Spark 4 runs with ANSI mode on: a plain ``cast`` of bad text and a division by zero raise. Lenient
paths here use ``try_cast`` / ``try_to_timestamp`` and guarded division.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Canonical team names (alias -> canonical), applied after trimming.
TEAM_ALIASES = {
    "Arsenal FC": "Arsenal",
    "Aston Villa FC": "Aston Villa",
    "Manchester City": "Man City",
    "Manchester United": "Man United",
    "Man Utd": "Man United",
    "Man Utd.": "Man United",
    "Nottm Forest": "Nottingham Forest",
    "Nott'm Forest": "Nottingham Forest",
    "Tottenham Hotspur": "Tottenham",
    "Spurs": "Tottenham",
    "Wolverhampton Wanderers": "Wolves",
    "Wolverhampton": "Wolves",
}

# The placeholder player name for shots without one.
UNKNOWN_PLAYER = "Jugador no identificado"

# Date formats tried in order when parsing fixture kick-off (day first).
KICKOFF_FORMATS = ["dd/MM/yyyy HH:mm", "dd/MM/yy HH:mm", "d/M/yyyy H:mm", "dd/MM/yyyy"]


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def canonical_name(c: str | Column, aliases: dict[str, str] | None = None) -> Column:
    """P1 (fixed form): trim, then map through the alias table, else keep. Null becomes the empty
    string (the reference turns NaN into the text "nan")."""
    trimmed = F.trim(F.coalesce(_c(c).cast("string"), F.lit("")))
    table = aliases if aliases is not None else TEAM_ALIASES
    if not table:
        return trimmed
    pairs = []
    for k, v in table.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.coalesce(F.create_map(*pairs)[trimmed], trimmed)


def canonical_name_by_join(df: DataFrame, column: str, aliases: DataFrame, alias_col: str = "alias",
                           canon_col: str = "canonical") -> DataFrame:
    """P1 for a large alias table: left join on the trimmed name (AQE broadcasts the alias side when
    its measured size is small) instead of a literal map."""
    key = "_tl_name_key"
    lhs = df.withColumn(key, F.trim(F.coalesce(F.col(column).cast("string"), F.lit(""))))
    rhs = aliases.select(F.col(alias_col).alias(key), F.col(canon_col).alias("_tl_canon"))
    return (lhs.join(rhs, key, "left")
               .withColumn(column, F.coalesce(F.col("_tl_canon"), F.col(key)))
               .drop(key, "_tl_canon"))


def lookup_key(c: str | Column) -> Column:
    """Trim, lower, drop dots, collapse whitespace."""
    s = F.lower(F.coalesce(_c(c).cast("string"), F.lit("")))
    return F.trim(F.regexp_replace(F.replace(s, F.lit("."), F.lit("")), r"\s+", " "))


def kickoff(date: str | Column, time: str | Column | None = None, formats: list[str] | None = None) -> Column:
    """Day-first date (+ time) text to timestamp, trying formats in order; invalid gives null."""
    text = _c(date).cast("string") if time is None else F.concat_ws(" ", _c(date).cast("string"), _c(time).cast("string"))
    attempts = [F.try_to_timestamp(text, F.lit(f)) for f in (formats or KICKOFF_FORMATS)]
    return F.coalesce(*attempts)


def lenient_number(c: str | Column, kind: str = "double") -> Column:
    """Bad text becomes null instead of raising."""
    col = _c(c)
    return F.trim(col.cast("string")).try_cast(kind)


def default_name(c: str | Column, default: str = UNKNOWN_PLAYER) -> Column:
    """Null or empty text becomes ``default``."""
    return F.coalesce(F.nullif(_c(c), F.lit("")), F.lit(default))


def coalesce_numeric(c: str | Column, fallback: Column) -> Column:
    """Supplied value when it parses, else the computed fallback."""
    return F.coalesce(lenient_number(c), fallback)


def result_from_score(home: str | Column, away: str | Column) -> Column:
    """P10: H/D/A from the score."""
    h, a = _c(home), _c(away)
    return F.when(h.isNull() | a.isNull(), F.lit(None).cast("string")).when(h > a, "H").when(h == a, "D").otherwise("A")


def round_half_even(c: str | Column, digits: int = 4) -> Column:
    """Python's ``round`` is half-to-even; Spark's ``bround`` matches on exact ties (``round`` does
    not). ``bround`` rounds the shortest decimal form of the double, Python the exact binary value, so
    values that only look like ties (0.00125 -> 4 digits) can differ in the last digit."""
    return F.bround(_c(c), digits)


def round_doubles(df: DataFrame, digits: int = 4) -> DataFrame:
    """P16 over a whole schema: every double field (nested structs and arrays included)."""
    def fix(col: Column, dt: T.DataType) -> Column:
        if isinstance(dt, (T.DoubleType, T.FloatType)):
            return F.bround(col, digits)
        if isinstance(dt, T.StructType):
            return F.struct(*[fix(col[f.name], f.dataType).alias(f.name) for f in dt.fields])
        if isinstance(dt, T.ArrayType):
            return F.transform(col, lambda x: fix(x, dt.elementType))
        return col
    return df.select(*[fix(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])


def finite_or(c: str | Column, default=None) -> Column:
    """NaN and +/-inf become ``default`` (null by default)."""
    col = _c(c)
    bad = F.isnan(col) | (F.abs(col) == float("inf"))
    fill = F.lit(default).cast("double") if default is not None else F.lit(None).cast("double")
    return F.when(col.isNotNull() & bad, fill).when(col.isNull(), fill).otherwise(col)


def nan_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """§1.2: NaN -> null at ingest, so ``avg`` skips it like pandas does."""
    cols = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in cols})


def strict_numeric(df: DataFrame, columns: list[str], what: str = "frame") -> DataFrame:
    """P5: every listed column must exist and hold numbers in every row; the error names the
    offending columns. One aggregate counts bad cells for all columns."""
    from touchline.schemas import SchemaError, require_columns
    require_columns(df, columns, what)
    bad = df.agg(*[F.sum((F.col(f"`{c}`").isNull() | lenient_number(c).isNull()).cast("long")).alias(c) for c in columns]).first()
    wrong = [c for c in columns if bad[c]]
    if wrong:
        raise SchemaError(f"{what}: non-numeric or missing values in columns: {', '.join(wrong)}")
    return df.withColumns({c: lenient_number(c) for c in columns})


def valid_location(x: str | Column, y: str | Column) -> Column:
    """X and y present and not the (0, 0) placeholder."""
    xv, yv = _c(x), _c(y)
    return xv.isNotNull() & yv.isNotNull() & ~((xv == 0) & (yv == 0))


def fill_placeholders(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Absent columns are added with their default; nulls in present ones are filled."""
    missing = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    out = df.withColumns(missing) if missing else df
    present = {c: v for c, v in defaults.items() if c in df.columns and v is not None}
    return out.fillna(present) if present else out


def ready_rows(df: DataFrame, required: list[str]) -> DataFrame:
    """Rows complete in the required feature set."""
    return df.dropna(subset=list(required))
