"""Bookmaker-odds and probability scalars.

All functions map Columns to Columns and stay inside whole-stage codegen.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SIDES = ("H", "D", "A")


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def implied_prob(odds: str | Column) -> Column:
    """1/odds; null for odds <= 0 or null (a plain division by zero raises under ANSI)."""
    o = _c(odds)
    return F.when(o > 0, F.lit(1.0) / o)


def inverse_or_zero(odds: str | Column) -> Column:
    """X12 helper: 1/odds, invalid odds count as 0."""
    o = _c(odds)
    return F.when(o > 0, F.lit(1.0) / o).otherwise(F.lit(0.0))


def normalised(probs: Sequence[str | Column], floor: float = 1e-9) -> list[Column]:
    """Probabilities over their sum (nulls skipped in the sum), sum floored at ``floor``."""
    ps = [_c(p) for p in probs]
    total = F.greatest(sum(F.coalesce(p, F.lit(0.0)) for p in ps), F.lit(floor))
    return [p / total for p in ps]


def overround(probs: Sequence[str | Column]) -> Column:
    """Sum of implied probabilities."""
    ps = [_c(p) for p in probs]
    return ps[0] + ps[1] + ps[2]


def entropy(norm_probs: Sequence[str | Column], floor: float = 1e-9) -> Column:
    """Natural-log entropy with probabilities clipped to [floor, 1] inside the log."""
    return -sum(_c(p) * F.log(F.least(F.greatest(_c(p), F.lit(floor)), F.lit(1.0))) for p in norm_probs)


def row_std(values: Sequence[str | Column]) -> Column:
    """Row-wise sample standard deviation (ddof 1) over non-null values; null when fewer than 2."""
    vs = [_c(v) for v in values]
    n = sum(F.when(v.isNotNull(), F.lit(1)).otherwise(F.lit(0)) for v in vs)
    s = sum(F.coalesce(v, F.lit(0.0)) for v in vs)

    def squares(mean: Column) -> Column:
        return sum(F.when(v.isNotNull(), (v - mean) * (v - mean)).otherwise(F.lit(0.0)) for v in vs)
    # the mean is bound once: written out inside every square it makes an expression too large to compile
    return F.when(n >= 2, F.sqrt(F.transform(F.array(s / n), squares)[0] / (n - 1)))


def shortest_price_pick(h: str | Column, d: str | Column, a: str | Column) -> Column:
    """X11: argmin over the three prices, first of H, D, A wins ties. Null when any price is null."""
    h, d, a = _c(h), _c(d), _c(a)
    return (F.when(h.isNull() | d.isNull() | a.isNull(), F.lit(None).cast("string"))
             .when((h <= d) & (h <= a), F.lit("H"))
             .when(d <= a, F.lit("D"))
             .otherwise(F.lit("A")))


def argmax_label(ph: str | Column, pd_: str | Column, pa: str | Column) -> Column:
    """Largest probability, first of H, D, A wins ties."""
    ph, pd_, pa = _c(ph), _c(pd_), _c(pa)
    return (F.when((ph >= pd_) & (ph >= pa), F.lit("H"))
             .when(pd_ >= pa, F.lit("D"))
             .otherwise(F.lit("A")))


def largest_probability_pick(h: str | Column, d: str | Column, a: str | Column) -> Column:
    """Pick by the largest inverse price, invalid prices as 0."""
    return argmax_label(inverse_or_zero(h), inverse_or_zero(d), inverse_or_zero(a))


def over_under(total: str | Column, line: float = 2.5) -> Column:
    """X13: "Over 2.5" when total > line, else "Under 2.5" (a null total is "Under", as in the reference)."""
    t = _c(total)
    return F.when(t > line, F.lit(f"Over {line}")).otherwise(F.lit(f"Under {line}"))


def actual_price(result: str | Column, h: str | Column, d: str | Column, a: str | Column) -> Column:
    """The price of the outcome that happened."""
    r = _c(result)
    return F.when(r == "H", _c(h)).when(r == "D", _c(d)).when(r == "A", _c(a))


def clean_label(label: str | Column) -> Column:
    """Upper-case; anything outside H/D/A counts as H."""
    u = F.upper(_c(label))
    return F.when(u.isin(*SIDES), u).otherwise(F.lit("H"))


def clip_renormalise(ph: str | Column, pd_: str | Column, pa: str | Column,
                     lo: float = 0.001, hi: float = 0.999) -> list[Column]:
    """Clip each probability to [lo, hi] (non-finite or null as 0 before the clip), renormalise."""
    def clip(p):
        p = _c(p)
        safe = F.when(p.isNull() | F.isnan(p) | (F.abs(p) == float("inf")), F.lit(0.0)).otherwise(p)
        return F.greatest(F.least(safe, F.lit(hi)), F.lit(lo))
    cs = [clip(p) for p in (ph, pd_, pa)]
    total = cs[0] + cs[1] + cs[2]
    return [c / total for c in cs]


def percent_scale(ph: str | Column, pd_: str | Column, pa: str | Column) -> list[Column]:
    """Fractions become percentages when the largest is <= 1; clamp to [0, 100]."""
    ps = [_c(p) for p in (ph, pd_, pa)]
    factor = F.when(F.greatest(*ps) <= 1, F.lit(100.0)).otherwise(F.lit(1.0))
    return [F.greatest(F.least(p * factor, F.lit(100.0)), F.lit(0.0)) for p in ps]


def softmax(scores: str | Column) -> Column:
    """Softmax of an array of decision scores, max-shifted for stability."""
    s = _c(scores)
    m = F.array_max(s)
    ex = F.transform(s, lambda x: F.exp(x - m))
    total = F.aggregate(ex, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(ex, lambda x: x / total)


# The heuristic xG fallback's logistic coefficients and defaults.
XG_INTERCEPT = -2.70
XG_COEF_DISTANCE = -0.055
XG_COEF_CENTRALITY = 1.10
XG_COEF_BIG_CHANCE = 1.35
XG_COEF_PENALTY = 2.25
XG_COEF_HEADER = -0.25
XG_COEF_FIRST_TOUCH = 0.15
XG_COEF_VOLLEY = 0.12
XG_COEF_COUNTER = 0.10
XG_COEF_CORNER = 0.04
XG_DEFAULT_X, XG_DEFAULT_Y, XG_DEFAULT_DISTANCE, XG_DEFAULT_ANGLE = 88.0, 50.0, 12.0, 0.2


def _finite_or(c: Column, default: float) -> Column:
    return F.when(c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")), F.lit(default)).otherwise(c)


def heuristic_xg(x: str | Column, y: str | Column, big_chance: str | Column, penalty: str | Column,
                 header: str | Column, first_touch: str | Column | None = None, volley: str | Column | None = None,
                 counter: str | Column | None = None, corner: str | Column | None = None,
                 distance: str | Column | None = None, angle: str | Column | None = None) -> Column:
    """Logistic xG from fixed coefficients, clipped to [0.001, 0.999]. Missing x/y, distance or angle
    use the reference's defaults; absent flags count as 0."""
    def flag(c):
        return F.lit(0.0) if c is None else F.coalesce(_c(c).cast("double"), F.lit(0.0))
    xv = _finite_or(_c(x).cast("double"), XG_DEFAULT_X)
    yv = _finite_or(_c(y).cast("double"), XG_DEFAULT_Y)
    dist = F.sqrt(F.pow(100 - xv, 2) + F.pow(50 - yv, 2))
    if distance is not None:
        dist = F.coalesce(_c(distance).cast("double"), dist)
    dist = _finite_or(dist, XG_DEFAULT_DISTANCE)
    ang = F.atan2(F.abs(50 - yv), F.greatest(100 - xv, F.lit(0.001)))
    if angle is not None:
        ang = F.coalesce(_c(angle).cast("double"), ang)
    ang = _finite_or(ang, XG_DEFAULT_ANGLE)
    centrality = 1 - F.least(ang / (math.pi / 2), F.lit(1.0))
    logit = (F.lit(XG_INTERCEPT) + XG_COEF_DISTANCE * dist + XG_COEF_CENTRALITY * centrality
             + XG_COEF_BIG_CHANCE * flag(big_chance) + XG_COEF_PENALTY * flag(penalty)
             + XG_COEF_HEADER * flag(header) + XG_COEF_FIRST_TOUCH * flag(first_touch)
             + XG_COEF_VOLLEY * flag(volley) + XG_COEF_COUNTER * flag(counter) + XG_COEF_CORNER * flag(corner))
    return F.greatest(F.least(1 / (1 + F.exp(-logit)), F.lit(0.999)), F.lit(0.001))


# The two-variable xG fallback's coefficients.
SIMPLE_XG_B0, SIMPLE_XG_DISTANCE, SIMPLE_XG_ANGLE = -1.5, -0.08, 0.04


def simple_xg(distance: str | Column, angle: str | Column) -> Column:
    """Two-variable logistic fallback over distance and angle."""
    z = F.lit(SIMPLE_XG_B0) + SIMPLE_XG_DISTANCE * _c(distance) + SIMPLE_XG_ANGLE * _c(angle)
    return 1 / (1 + F.exp(-z))


def shot_quality_label(xg: str | Column) -> Column:
    """Alta >= 0.35, media >= 0.15, else baja."""
    v = _c(xg)
    return F.when(v >= 0.35, F.lit("alta")).when(v >= 0.15, F.lit("media")).otherwise(F.lit("baja"))
