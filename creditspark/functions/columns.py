"""Column expressions (PR1, PR8-PR12, PR14, EV12, SC1).

All are built-in Spark expressions, so they stay inside whole-stage codegen.
NULL semantics follow the reference: ``ifelse`` propagates NULL (so every
conditional here has an explicit NULL branch), ``which``-style filters drop
NULL rows, caps leave NULL untouched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def null_safe_if(cond: Column, when_true, when_false, probe: str | Column | None = None) -> Column:
    """``ifelse``: NULL test (or NULL ``probe``) gives NULL, not the else-branch."""
    test_null = cond.isNull() if probe is None else _c(probe).isNull() | cond.isNull()
    return (F.when(test_null, F.lit(None))
             .when(cond, when_true if isinstance(when_true, Column) else F.lit(when_true))
             .otherwise(when_false if isinstance(when_false, Column) else F.lit(when_false)))


def reverse_tag(col: str | Column) -> Column:
    """1 = good: tag 0 -> 1, tag 1 -> 0, NULL stays NULL."""
    x = _c(col)
    return null_safe_if(x == 0, 1, 0)


def cap(col: str | Column, upper: float | None = None, lower: float | None = None) -> Column:
    """Winsor cap/floor at constants; NULL untouched (``least`` would turn NULL into the cap)."""
    x = _c(col)
    out = x
    if upper is not None:
        out = F.when(x > F.lit(upper), F.lit(upper)).otherwise(out)
    if lower is not None:
        out = F.when(x < F.lit(lower), F.lit(lower)).otherwise(out)
    return out


def cut_index(col: str | Column, breaks: list[float], include_lowest: bool = True) -> Column:
    """R ``cut(right=TRUE)``: 1-based interval index for (b[i-1], b[i]]; outside -> NULL.

    With ``include_lowest`` the first interval is closed on the left.
    ``Bucketizer`` is left-closed, so it cannot express this.
    """
    x = _c(col).cast("double")
    expr = F.lit(None).cast("int")
    for i in range(len(breaks) - 1, 0, -1):
        lo, hi = float(breaks[i - 1]), float(breaks[i])
        inside = (x <= F.lit(hi)) & ((x > F.lit(lo)) | ((x == F.lit(lo)) if (include_lowest and i == 1) else F.lit(False)))
        expr = F.when(inside, F.lit(i)).otherwise(expr)
    return expr


def cut_labels(breaks: list[float], include_lowest: bool = True, fmt=lambda v: f"{v:g}") -> list[str]:
    labels = []
    for i in range(1, len(breaks)):
        left = "[" if (include_lowest and i == 1) else "("
        labels.append(f"{left}{fmt(breaks[i - 1])},{fmt(breaks[i])}]")
    return labels


def cut_label(col: str | Column, breaks: list[float], include_lowest: bool = True) -> Column:
    idx = cut_index(col, breaks, include_lowest)
    labels = cut_labels(breaks, include_lowest)
    arr = F.array(*[F.lit(s) for s in labels])
    return F.when(idx.isNull(), F.lit(None)).otherwise(F.element_at(arr, idx))


def range_recode(col: str | Column, rules: list[tuple[float, float, float]], null_value: float,
                 below_value: float) -> Column:
    """Loop recode of the reference (PR10) as one CASE.

    NULL -> ``null_value``; for each (lo, hi, value): lo <= x <= hi -> value;
    x >= the largest rule's lo with hi = inf handled by the rule itself;
    x below every rule -> ``below_value``; anything else (gaps between
    rules, e.g. non-integers in (3, 4)) is left unchanged.
    """
    x = _c(col).cast("double")
    expr = F.when(x.isNull(), F.lit(float(null_value)))
    for lo, hi, val in rules:
        cond = x >= F.lit(float(lo))
        if not math.isinf(hi):
            cond = cond & (x <= F.lit(float(hi)))
        expr = expr.when(cond, F.lit(float(val)))
    first_lo = min(r[0] for r in rules)
    return expr.when(x < F.lit(float(first_lo)), F.lit(float(below_value))).otherwise(x)


def log_odds_good(p: str | Column, eps: float = 0.0) -> Column:
    """ln((1 - p) / p); p optionally clamped to (eps, 1 - eps); p in {0, 1} gives NULL."""
    x = _c(p).cast("double")
    if eps > 0:
        x = F.least(F.greatest(x, F.lit(eps)), F.lit(1.0 - eps))
    ratio = F.try_divide(F.lit(1.0) - x, x)
    return F.when(ratio > 0, F.ln(ratio))


def points_slope(pdo: float = 20.0) -> float:
    """Points per doubling of the odds: pdo / (ln 20 - ln 10)."""
    return pdo / (math.log(20) - math.log(10))


def points(p: str | Column, base_points: float = 400.0, base_odds: float = 10.0, pdo: float = 20.0) -> Column:
    """Scorecard points: base + slope * (ln(odds good) - ln(base_odds))."""
    return F.lit(base_points) + F.lit(points_slope(pdo)) * (log_odds_good(p) - F.lit(math.log(base_odds)))


def points_scalar(p: float, base_points: float = 400.0, base_odds: float = 10.0, pdo: float = 20.0) -> float:
    """Score equivalent of a probability cutoff (SC2): 0.46 -> 338.1879."""
    return base_points + points_slope(pdo) * (math.log((1 - p) / p) - math.log(base_odds))


def predict_at(p: str | Column, cutoff: float) -> Column:
    """Class 1 iff p >= cutoff; NULL p stays NULL (EV12)."""
    x = _c(p)
    return F.when(x.isNull(), F.lit(None).cast("int")).when(x >= F.lit(cutoff), F.lit(1)).otherwise(F.lit(0))
