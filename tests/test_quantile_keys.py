"""Quantiles of any doubles: keys keep the order, and every part ends."""

import math
import random
import struct

import numpy as np
import pytest

from creditspark.operators.quantiles import grouped_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def values(kind, n=400):
    r = random.Random(kind)
    if kind == 0:
        return [math.inf] + [r.gauss(0, 1) for _ in range(n)]
    if kind == 1:
        return [math.nan, -math.inf, math.inf, -0.0, 0.0, 5e-324, -5e-324] * 20 + [r.uniform(-1e308, 1e308) for _ in range(n)]
    if kind == 2:
        return [5e-324 * r.randint(-40, 40) for _ in range(n)]
    if kind == 3:
        return [x for x in (struct.unpack("<d", r.randbytes(8))[0] for _ in range(n))]
    return [1.0] * n + [math.nextafter(1.0, 2.0)] * 3


def plain(v, p):
    """Type 7 over Spark's order (NaN last)."""
    s = sorted(v, key=lambda x: (math.isnan(x), x))
    at = (len(s) - 1) * p
    lo, hi = math.floor(at), math.ceil(at)
    if lo == hi or s[lo] == s[hi] or math.isnan(s[lo]) and math.isnan(s[hi]):
        return s[lo]
    return (hi - at) * s[lo] + (at - lo) * s[hi]


@pytest.mark.parametrize("per_bucket", [50, 100_000])
def test_any_doubles(spark, per_bucket):
    data = {k: values(k) for k in range(5)}
    df = spark.createDataFrame([(k, x) for k, v in data.items() for x in [*v, None]], "g int, v double").repartition(3)
    got = {r["g"]: r["q"] for r in grouped_quantiles(df, ["g"], "v", PROBS, rows_per_bucket=per_bucket).collect()}
    for k, v in data.items():
        assert np.allclose(got[k], [plain(v, p) for p in PROBS], rtol=1e-12, atol=0, equal_nan=True), k
