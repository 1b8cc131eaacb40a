"""Pearson correlations of every pair of many columns, from one pass over the rows.

Each task turns its Arrow batches into matrix products: the mask of present values gives, for every pair, the count, the
means, the squared deviations and the product of deviations over the rows where both are present.  Batches are merged by
the pairwise update of means and deviations, so nothing cancels, whatever the offset of a column.  A task's pairs leave it as binary
blocks, one per stripe of at most CELLS pairs; FAN blocks of a stripe are added at a time, then the sums.  No group
holds more than FAN blocks, or one per FAN tasks, and the plan has the same size for 10 and for 1000 columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELLS = 2048    # pairs of a block
FAN = 256       # blocks that are added at a time
PARTS = 7       # n, mean_x, mean_y, dev_xx, dev_yy, dev_xy, not finite
BLOCKS = "stripe int, block binary"


def _of_batch(x: np.ndarray, present: np.ndarray) -> np.ndarray:
    """(PARTS, k, k) of one batch; ``x`` is 0 where a value is missing."""
    finite = np.isfinite(x)
    odd = (~finite).astype(float)
    x = np.where(finite, x, 0.0)
    shift = np.array([np.median(c[p]) if p.any() else 0.0 for c, p in zip(x.T, present.T)])
    x, m = np.where(present, x - shift, 0.0), present.astype(float)
    n, sx, raw = m.T @ m, x.T @ m, (x * x).T @ m
    share = sx / np.maximum(n, 1.0)
    dev = raw - sx * share
    dev = np.where(dev <= 1e-13 * raw, 0.0, dev)
    mean = shift[:, None] + share
    strange = odd.T @ m
    return np.stack([n, mean, mean.T, dev, dev.T, x.T @ x - sx * share.T, strange + strange.T])


def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    n = a[0] + b[0]
    share = b[0] / np.maximum(n, 1.0)
    dx, dy = b[1] - a[1], b[2] - a[2]
    w = a[0] * share
    return np.stack([n, a[1] + dx * share, a[2] + dy * share, a[3] + b[3] + dx * dx * w, a[4] + b[4] + dy * dy * w,
                     a[5] + b[5] + dx * dy * w, a[6] + b[6]])


def _task(k: int, width: int):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((PARTS, k, k))
        for batch in batches:
            if batch.num_rows:
                present = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns])
                x = np.column_stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in batch.columns])
                total = _merged(total, _of_batch(x, present))
        if total[0].any():
            starts = range(0, k, width)
            yield pa.record_batch({"stripe": pa.array(range(len(starts)), pa.int32()),
                                   "block": pa.array([total[:, i:i + width].tobytes() for i in starts], pa.binary())})
    return fn


def _sum(blocks: pd.Series) -> np.ndarray:
    total = None
    for b in blocks:
        v = np.frombuffer(b).reshape(PARTS, -1)
        total = v if total is None else _merged(total, v)
    return total


def _added(pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"stripe": pdf["stripe"].iloc[:1], "block": [_sum(pdf["block"]).tobytes()]})


def _correlations(cols: list[str], width: int):
    k = len(cols)

    def fn(pdf: pd.DataFrame) -> pd.DataFrame:
        n, mx, my, xx, yy, xy, odd = _sum(pdf["block"])
        flat = (xx <= 1e-28 * n * mx * mx) | (yy <= 1e-28 * n * my * my)
        with np.errstate(all="ignore"):
            r = np.clip(xy / np.sqrt(xx) / np.sqrt(yy), -1.0, 1.0)
        first = int(pdf["stripe"].iloc[0]) * width
        at = [(p, first + p // k, p % k) for p in range(len(n)) if first + p // k < p % k]
        known = [n[p] > 1 and (odd[p] > 0 or not flat[p]) for p, _, _ in at]
        return pd.DataFrame({"i": [i for _, i, _ in at], "j": [j for _, _, j in at], "known": known, "odd": [odd[p] > 0 for p, _, _ in at],
                             "corr": [float(r[p]) for p, _, _ in at]})
    return fn


def correlations(df: DataFrame, cols: list[str]) -> DataFrame:
    """(var_x, var_y, corr) for every pair, ``var_x`` before ``var_y`` in ``cols``; rows where either is NULL do not count.

    NULL where fewer than two rows hold both or one of the two is constant over them; NaN where an infinity or a NaN
    takes part.  No rows at all: NULL for every pair."""
    k = len(cols)
    width = max(1, CELLS // max(k, 1))
    x = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    blocks = x.mapInArrow(_task(k, width), BLOCKS).withColumn("part", F.floor(F.spark_partition_id() / F.lit(FAN)))
    sums = blocks.groupBy("stripe", "part").applyInPandas(_added, BLOCKS)
    found = sums.groupBy("stripe").applyInPandas(_correlations(cols, width), "i int, j int, known boolean, odd boolean, corr double")
    names = F.array(*[F.lit(c) for c in cols])
    index = df.sparkSession.range(k)
    after = F.explode(F.sequence(F.col("id").cast("int") + 1, F.lit(k))).alias("j")
    pairs = index.select(F.col("id").cast("int").alias("i"), after).filter(F.col("j") < k)
    return pairs.join(found.filter("known").drop("known"), ["i", "j"], "left").orderBy("i", "j").select(
        F.get(names, F.col("i")).alias("var_x"), F.get(names, F.col("j")).alias("var_y"),
        F.when(F.col("odd"), F.lit(float("nan"))).otherwise(F.col("corr")).alias("corr"))
