"""Scalar column expressions: blending, clamping, rounding, class maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from reelrank.functions.hashing import unit_hash


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clamp_score(x: Column | str, lo: float = 0.0, hi: float = 5.0) -> Column:
    """min(max(x, lo), hi)."""
    return F.least(F.greatest(_col(x), F.lit(float(lo))), F.lit(float(hi)))


def blend_rating(rating: Column | str, sentiment: Column | str,
                 weight: float = 0.5, clamp: bool = False) -> Column:
    """weight * rating + (1 - weight) * sentiment; each side clamped to
    [0, 5] first when ``clamp``. ``weight=1`` switches sentiment off."""
    r, s = _col(rating), _col(sentiment)
    if clamp:
        r, s = clamp_score(r), clamp_score(s)
    if weight == 1.0:
        return r
    return r * F.lit(float(weight)) + s * F.lit(1.0 - float(weight))


def round_score(x: Column | str, digits: int = 2) -> Column:
    """Round HALF_UP on the decimal value (as BigDecimal.setScale)."""
    return F.round(_col(x), digits)


def round_ratio_half_up(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    """round(num / den, digits) HALF_UP for integers num >= 0, den > 0,
    computed in exact integer arithmetic: floor((2*s*num + den) / (2*den)) / s."""
    scale = 10 ** digits
    n, d = _col(num).cast("long"), _col(den).cast("long")
    top = n * (2 * scale) + d
    steps = (top - F.pmod(top, d * 2)) / (d * 2)  # exact: numerator divisible
    return steps / F.lit(float(scale))


def dot_literal(a: Column | str, vec: Sequence[float]) -> Column:
    """Dot product of an array column with a short driver-side vector."""
    a = _col(a)
    expr = F.lit(0.0)
    for k, v in enumerate(vec):
        expr = expr + a[k] * F.lit(float(v))
    return expr


# Sentiment class -> score (1-5), default for other classes.
CLASS_SCORES = {0: 1.0, 1: 2.0, 2: 3.0, 3: 4.0, 4: 5.0}
DEFAULT_CLASS_SCORE = 3.0


def class_to_score(c: Column | str, default: float = DEFAULT_CLASS_SCORE) -> Column:
    c = _col(c)
    out = F.when(c == 0, F.lit(CLASS_SCORES[0]))
    for k in (1, 2, 3, 4):
        out = out.when(c == k, F.lit(CLASS_SCORES[k]))
    return out.otherwise(F.lit(float(default)))


def class_to_label(c: Column | str) -> Column:
    """0,1 NEGATIVE; 2 NEUTRAL; 3,4 POSITIVE; other classes null."""
    c = _col(c)
    return (F.when(c.isin(0, 1), F.lit("NEGATIVE"))
            .when(c == 2, F.lit("NEUTRAL"))
            .when(c.isin(3, 4), F.lit("POSITIVE")))


# Label -> start of its score band; other labels score 2.5.
LABEL_BANDS = {"positive": 4.0, "neutral": 2.0, "negative": 0.0}
OTHER_LABEL_SCORE = 2.5


def label_to_score(label: Column | str, keys: Sequence[Column | str], seed: int = 42) -> Column:
    """Band start plus a seeded hash fraction in [0, 1), HALF_UP 2 digits.
    Repeatable: the fraction comes from the row's keys, not rand()."""
    lab = F.lower(_col(label))
    frac = unit_hash(list(keys), seed)
    out = F.lit(OTHER_LABEL_SCORE)
    for name, start in LABEL_BANDS.items():
        out = F.when(lab == name, F.lit(start) + frac).otherwise(out)
    return F.round(out, 2)
