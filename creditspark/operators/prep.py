"""Preparation operators with fitted state (PR12 caps, PR13 z-scores) and table plumbing.

Fitting is one aggregate pass whose result (two numbers per column) is the
model; applying it is a projection, so it runs unchanged on a streaming
DataFrame.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditspark.functions.columns import cap


@dataclass
class StandardizerModel:
    stats: dict[str, tuple[float | None, float | None]]  # col -> (mean, sample sd)

    @property
    def constant(self) -> list[str]:
        """Columns without variance, which no model can use."""
        return [c for c, (_, sd) in self.stats.items() if not sd]

    def transform(self, df: DataFrame, prefix: str = "") -> DataFrame:
        cols = {}
        for c, (mu, sd) in self.stats.items():
            if mu is None or sd is None or sd == 0:
                cols[f"{prefix}{c}"] = F.lit(None).cast("double")
            else:
                cols[f"{prefix}{c}"] = (F.col(c).cast("double") - F.lit(mu)) / F.lit(sd)
        return df.withColumns(cols)


class Standardizer:
    """PR13: (x - mean) / sd with the sample sd (R ``scale``); zero variance -> NULL."""

    def __init__(self, cols: list[str]):
        self.cols = cols

    def fit(self, df: DataFrame) -> StandardizerModel:
        aggs = []
        for c in self.cols:
            aggs += [F.avg(F.col(c).cast("double")).alias(f"m_{c}"),
                     F.stddev_samp(F.col(c).cast("double")).alias(f"s_{c}")]
        row = df.agg(*aggs).first()
        return StandardizerModel({c: (row[f"m_{c}"], row[f"s_{c}"]) for c in self.cols})


@dataclass
class CapperModel:
    caps: dict[str, tuple[float | None, float | None]]  # col -> (lower, upper)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: cap(c, upper=hi, lower=lo).cast(df.schema[c].dataType)
                               for c, (lo, hi) in self.caps.items()})


class WinsorCapper:
    """PR12: cap/floor at fixed constants, or at learned type-7 percentiles (AG5 -> PR12)."""

    def __init__(self, upper: dict[str, float] | None = None, lower: dict[str, float] | None = None,
                 upper_pct: float | None = None, lower_pct: float | None = None, cols: list[str] | None = None):
        self.upper, self.lower = upper or {}, lower or {}
        self.upper_pct, self.lower_pct = upper_pct, lower_pct
        self.cols = cols or sorted(set(self.upper) | set(self.lower))

    def fit(self, df: DataFrame) -> CapperModel:
        caps = {c: (self.lower.get(c), self.upper.get(c)) for c in self.cols}
        probs = [p for p in (self.lower_pct, self.upper_pct) if p is not None]
        if probs:
            from creditspark.operators.quantiles import column_quantiles
            qs = column_quantiles(df, self.cols, probs)
            for c in self.cols:
                q = list(qs[c])
                lo = q.pop(0) if self.lower_pct is not None else caps[c][0]
                hi = q.pop(0) if self.upper_pct is not None else caps[c][1]
                caps[c] = (lo, hi)
        return CapperModel(caps)


def union_populations(labelled: DataFrame, unlabelled: DataFrame, flag: str = "is_reject") -> DataFrame:
    """ST1/ST3/FL3: union by name, carrying a flag instead of positional row ranges."""
    return (labelled.withColumn(flag, F.lit(False))
            .unionByName(unlabelled.withColumn(flag, F.lit(True)), allowMissingColumns=True))
