"""Pitch geometry, zones, clock and binning scalars.

Coordinates are in pitch units 0-100 with the attacked goal at x = 100, y = 50.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pitch size in metres, goal width in metres.
PITCH_LENGTH_M = 105.0
PITCH_WIDTH_M = 68.0
GOAL_WIDTH_M = 7.32

# Rectangular zone bounds (inclusive) for the pipeline's three zones.
SMALL_BOX_X, SMALL_BOX_Y = 94.5, (36.8, 63.2)
PENALTY_BOX_X, PENALTY_BOX_Y = 83.5, (21.1, 78.9)
ZONE_NAMES = {"small_box": "Area chica", "penalty_box": "Area grande", "outside_box": "Fuera del area"}

# The dashboard's four-level zone (x lower bound, max |y - 50|, label), checked in order.
GLOBAL_ZONES = [(94.0, 10.0, "Área chica"), (84.0, 20.0, "Zona de penal"), (76.0, 28.0, "Frontal del área")]
GLOBAL_ZONE_DEFAULT = "Media distancia"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def shot_geometry(x: str | Column, y: str | Column) -> dict[str, Column]:
    """Attack-direction normalisation and the geometry columns of a shot, as one projection.

    Returns ordered ``{name: Column}`` for ``withColumns``; expressions reference only the inputs, so
    the whole set is one codegen'd projection.
    """
    x0, y0 = _c(x).cast("double"), _c(y).cast("double")
    flip = x0 < 50
    xn = F.when(flip, 100 - x0).otherwise(x0)
    yn = F.when(flip, 100 - y0).otherwise(y0)
    lon = (100 - xn) / 100 * PITCH_LENGTH_M
    signed_lat = (yn - 50) / 100 * PITCH_WIDTH_M
    lat = F.abs(signed_lat)
    dist_m = F.sqrt(lon * lon + lat * lat)
    half = GOAL_WIDTH_M / 2
    left = F.sqrt(lon * lon + (signed_lat - half) * (signed_lat - half))
    right = F.sqrt(lon * lon + (signed_lat + half) * (signed_lat + half))
    den = 2 * left * right
    cos_v = F.when(den > 0, (left * left + right * right - GOAL_WIDTH_M ** 2) / den).otherwise(F.lit(1.0))
    frame_angle = F.acos(F.greatest(F.least(cos_v, F.lit(1.0)), F.lit(-1.0)))
    return {
        "original_x": x0,
        "original_y": y0,
        "was_normalized": flip,
        "x": xn,
        "y": yn,
        "distance_to_goal": F.sqrt((100 - xn) * (100 - xn) + (50 - yn) * (50 - yn)),
        "angle_to_goal": F.abs(F.atan2(50 - yn, 100 - xn)),
        "distance_to_goal_m": dist_m,
        "signed_lateral_distance_m": signed_lat,
        "lateral_distance_m": lat,
        "angle_degrees": F.degrees(F.abs(F.atan2(lat, lon))),
        "goal_frame_angle": frame_angle,
        "goal_frame_angle_degrees": F.degrees(frame_angle),
        "distance_squared": dist_m * dist_m,
        "centrality_to_goal": 1 - F.abs(yn - 50) / 50,
        "shot_angle_distance_interaction": frame_angle / F.greatest(dist_m, F.lit(1e-6)),
    }


def zone_key(x: str | Column, y: str | Column) -> Column:
    """small_box / penalty_box / outside_box with inclusive bounds."""
    xv, yv = _c(x), _c(y)
    return (F.when((xv >= SMALL_BOX_X) & yv.between(*SMALL_BOX_Y), F.lit("small_box"))
             .when((xv >= PENALTY_BOX_X) & yv.between(*PENALTY_BOX_Y), F.lit("penalty_box"))
             .otherwise(F.lit("outside_box")))


def zone_name(key: str | Column) -> Column:
    k = _c(key)
    expr = F.lit(ZONE_NAMES["outside_box"])
    for name in ("penalty_box", "small_box"):
        expr = F.when(k == name, F.lit(ZONE_NAMES[name])).otherwise(expr)
    return expr


def global_zone(x: str | Column, y: str | Column) -> Column:
    """X5 variant: four-level zone from x and |y - 50| (nulls count as 0)."""
    xv = F.coalesce(_c(x).cast("double"), F.lit(0.0))
    cy = F.abs(F.coalesce(_c(y).cast("double"), F.lit(0.0)) - 50)
    expr = None
    for lo, half, label in GLOBAL_ZONES:
        cond = (xv >= lo) & (cy <= half)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(GLOBAL_ZONE_DEFAULT))


def game_clock(minute: str | Column, second: str | Column) -> dict[str, Column]:
    """Lenient minute/second (bad or null -> 0), clock in seconds, minute/95 clipped to [0, 1.25]."""
    m = F.coalesce(_c(minute).try_cast("int"), F.lit(0))
    s = F.coalesce(_c(second).try_cast("int"), F.lit(0))
    return {
        "minute": m,
        "second": s,
        "game_clock_s": m * 60 + s,
        "game_minute_normalized": F.greatest(F.least(m / 95.0, F.lit(1.25)), F.lit(0.0)),
    }


def cut_bin(value: str | Column, lo: str | Column, hi: str | Column, bins: int) -> Column:
    """``pd.cut(v, bins=n)`` bin index 1..n for equal-width bins over [lo, hi]: right-closed,
    lowest value included. ``lo``/``hi`` are the column's min and max (from a one-row aggregate).

    A degenerate range (lo == hi) is widened by 0.1% on each side as pandas does, so every value falls
    in the middle bin.
    """
    v, lo_c, hi_c = _c(value), _c(lo), _c(hi)
    width = (hi_c - lo_c) / bins
    regular = F.greatest(F.lit(1), F.least(F.lit(bins), F.ceil((v - lo_c) / width).cast("int")))
    pad = F.when(lo_c != 0, F.abs(lo_c) * 0.001).otherwise(F.lit(0.001))
    dlo = lo_c - pad
    dwidth = (2 * pad) / bins
    degenerate = F.greatest(F.lit(1), F.least(F.lit(bins), F.ceil((v - dlo) / dwidth).cast("int")))
    return F.when(v.isNull(), F.lit(None).cast("int")).when(hi_c == lo_c, degenerate).otherwise(regular)


def cut_edges(lo: str | Column, hi: str | Column, bins: int, index: str | Column) -> tuple[Column, Column]:
    """Left/right edge of ``pd.cut`` bin ``index`` (1-based). The first left edge is lowered by 0.1%
    of the range, as pandas labels it."""
    lo_c, hi_c, i = _c(lo), _c(hi), _c(index)
    rng = hi_c - lo_c
    pad = F.when(lo_c != 0, F.abs(lo_c) * 0.001).otherwise(F.lit(0.001))
    width = F.when(rng > 0, rng / bins).otherwise(2 * pad / bins)
    base = F.when(rng > 0, lo_c).otherwise(lo_c - pad)
    left = base + (i - 1) * width
    right = base + i * width
    left = F.when((i == 1) & (rng > 0), lo_c - rng * 0.001).otherwise(left)
    return left, right


def linspace_bin(value: str | Column, hi: str | Column, k: int) -> Column:
    """A10: bin over ``linspace(0, max, k)`` edges (k-1 right-closed bins, first edge inclusive)."""
    v, hi_c = _c(value), F.greatest(_c(hi), F.lit(0.001))  # the edges never collapse
    n = k - 1
    idx = F.ceil(v / (hi_c / n)).cast("int")
    return F.when(v.isNull() | (v < 0) | (v > hi_c), F.lit(None).cast("int")).otherwise(
        F.greatest(F.lit(1), F.least(F.lit(n), idx)))


def probability_bucket(p: str | Column, n: int) -> Column:
    """Equal-width bucket of a probability in [0, 1]; the last bucket is closed."""
    v = _c(p)
    return F.when(v.isNull() | F.isnan(v) | (v < 0) | (v > 1), F.lit(None).cast("int")).otherwise(
        F.least(F.floor(v * n).cast("int"), F.lit(n - 1)))


def grid_cell(v: str | Column, lo: float, hi: float, n: int) -> Column:
    """Fixed-edge histogram cell 0..n-1 over [lo, hi], last edge closed; null outside."""
    c = _c(v)
    width = (hi - lo) / n
    return F.when(c.isNull() | (c < lo) | (c > hi), F.lit(None).cast("int")).otherwise(
        F.least(F.floor((c - lo) / width).cast("int"), F.lit(n - 1)))


def hex_cell(x: str | Column, y: str | Column, x_range: tuple[Column, Column], y_range: tuple[Column, Column],
             gridsize: int = 18) -> dict[str, Column]:
    """Hexagonal binning as two offset rectangular lattices over the data's extent, ``gridsize`` cells
    wide and ``gridsize / sqrt(3)`` (rounded down) high.

    Lattice 1 has centres at whole multiples of the cell size, lattice 2 half a cell off; the nearer centre wins,
    a tie goes to lattice 2, and halves round to even. Returns the lattice and the centre.
    """
    pad = lambda lo, hi: (lo - 1e-9 * (hi - lo), hi + 1e-9 * (hi - lo))
    (x0, x1), (y0, y1) = pad(*x_range), pad(*y_range)
    sx, sy = (x1 - x0) / gridsize, (y1 - y0) / int(gridsize / math.sqrt(3))
    xv = F.coalesce(F.try_divide(_c(x) - x0, sx), F.lit(0.0))
    yv = F.coalesce(F.try_divide(_c(y) - y0, sy), F.lit(0.0))
    i1, j1 = F.rint(xv), F.rint(yv)
    i2, j2 = F.floor(xv) + 0.5, F.floor(yv) + 0.5
    first = (xv - i1) * (xv - i1) + 3 * (yv - j1) * (yv - j1) < (xv - i2) * (xv - i2) + 3 * (yv - j2) * (yv - j2)
    return {
        "hex_lattice": F.when(first, F.lit(1)).otherwise(F.lit(2)),
        "hex_cx": F.when(first, i1).otherwise(i2) * sx + x0,
        "hex_cy": F.when(first, j1).otherwise(j2) * sy + y0,
    }
