"""Sampling (SA1-SA3).

SA1 stratified split, deterministic and partition-independent:
    rank key = md5(cast(key as string) || '|' || seed); within each class the
    first round_half_even(ratio * n_class) rows in (rank key, key) order go to
    the training side.
  Scalable form: a histogram over the first ``prefix_hex`` hex digits of the
  rank key (at most 16^prefix_hex rows per class, independent of n) locates
  each class's boundary bucket; rows outside that bucket are decided by a
  broadcast lookup without any shuffle, and only rows inside the boundary
  bucket (about n / 16^prefix_hex per class, i.e. n / 1M by default) are ranked.

SA3 class balancing (ROSE-style smoothed bootstrap): each class is resampled
  to about N/2 rows by a replication count of N / (2 n_c) on average per row
  (Poisson by the inverse CDF of a hash-derived uniform, so results do not depend on
  partitioning; large counts draw only their fraction), rows are replicated with ``explode(sequence)``, and numeric
  features get Gaussian kernel noise h_j,c * z with
  h_j,c = (4 / ((d + 2) n_c)) ^ (1 / (d + 4)) * sd_j,c (Menardi & Torelli).
  Everything stays distributed; only per-class statistics reach the driver.
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from creditspark.operators.cache import persist, small

SEP = "|"
WHOLE_ABOVE = 16.0
COPIES_PER_TASK = 100_000


def rank_key(key: str, seed, row: list[str] | None = None) -> Column:
    """md5 of key and seed; a NULL key is ranked by a hash of its row's columns, so that such rows spread."""
    s = F.col(seed).cast("string") if isinstance(seed, str) else F.lit(str(seed))
    k = F.col(key).cast("string")
    if row:
        k = F.coalesce(k, F.concat(F.lit("NULL "), F.xxhash64(*row).cast("string")))
    return F.md5(F.concat(k, F.lit(SEP), s))


def stratified_split(df: DataFrame, key: str, label: str, ratio: float, seed: int | list[int],
                     prefix_hex: int = 5, flag: str = "is_train", targets: dict | None = None) -> DataFrame:
    """SA1: add boolean ``flag`` (True = sampled/training side) to labelled rows of ``df``.

    With a list of seeds, every row appears once per seed with a ``seed``
    column; all seeds share one scan, one histogram and one assignment pass.
    ``targets`` ({class: count}) replaces round(ratio * n_class) by explicit counts.
    """
    multi = isinstance(seed, (list, tuple))
    lab = persist(df.filter(F.col(label).isNotNull()))
    if multi:
        lab = lab.withColumn("seed", F.explode(F.array(*[F.lit(int(s)) for s in seed])))
    grp = [label, "seed"] if multi else [label]
    h = rank_key(key, "seed" if multi else seed, df.columns)
    with_h = lab.withColumn("__h", h).withColumn(
        "__b", F.conv(F.substring("__h", 1, prefix_hex), 16, 10).cast("long"))
    hist = with_h.groupBy(*grp, "__b").agg(F.count(F.lit(1)).alias("__cnt"))
    w_cls = Window.partitionBy(*grp)
    w_cum = Window.partitionBy(*grp).orderBy("__b").rowsBetween(Window.unboundedPreceding, 0)
    target = F.bround(F.lit(Decimal(repr(ratio))) * F.sum("__cnt").over(w_cls), 0).cast("long")
    if targets:
        explicit = None
        for cls, t in targets.items():
            cond = F.col(label) == F.lit(cls)
            explicit = F.when(cond, F.lit(int(t))) if explicit is None else explicit.when(cond, F.lit(int(t)))
        target = F.least(explicit.otherwise(F.lit(0)).cast("long"), F.sum("__cnt").over(w_cls))
    hist = (hist.withColumn("__target", target)
                .withColumn("__cum", F.sum("__cnt").over(w_cum))
                .withColumn("__before", F.col("__cum") - F.col("__cnt")))
    # boundary bucket: the one where the running count first reaches the target
    bounds = (hist.filter((F.col("__before") < F.col("__target")) & (F.col("__cum") >= F.col("__target")))
                  .select(*grp, F.col("__b").alias("__bstar"), (F.col("__target") - F.col("__before"))
                          .alias("__need")))
    # one row per (class, seed).  A class whose target is 0 has no boundary bucket: nothing of it is sampled.
    j = with_h.join(small(bounds), grp, "left")
    bstar = F.coalesce(F.col("__bstar"), F.lit(-1))
    outside = j.filter(F.col("__b") != bstar).withColumn(flag, F.col("__b") < bstar)
    inside = j.filter(F.col("__b") == bstar)
    w_in = Window.partitionBy(*grp).orderBy("__h", key)
    inside = inside.withColumn(flag, F.row_number().over(w_in) <= F.col("__need"))
    cols = [*df.columns, *(["seed"] if multi else []), flag]
    return outside.select(*cols).unionByName(inside.select(*cols))


def stratified_sample(df: DataFrame, key: str, label: str, ratio: float, seed: int) -> DataFrame:
    """SA2: the sampled side of SA1 only."""
    return stratified_split(df, key, label, ratio, seed, flag="__s").filter("__s").drop("__s")


def md5_uniform(key: str, salt: str) -> Column:
    """Deterministic U(0, 1] from the first 52 bits of md5(key|salt); any SQL engine can repeat it."""
    digest = F.md5(F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(SEP + salt)))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return (bits + F.lit(1.0)) / F.lit(float(2 ** 52))


def md5_normal(salt: str, *cols: str) -> Column:
    """Deterministic N(0, 1) of the columns and the salt: two uniforms from the first and the second 52 bits of one md5,
    turned by Box and Muller; any SQL engine can repeat it."""
    digest = F.md5(F.concat(*[F.concat(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(SEP)) for c in cols], F.lit(salt)))
    u1, u2 = [(F.conv(F.substring(digest, at, 13), 16, 10).cast("double") + F.lit(1.0)) / F.lit(float(2 ** 52)) for at in (1, 14)]
    return F.sqrt(F.lit(-2.0) * F.ln(u1)) * F.cos(F.lit(2 * math.pi) * u2)


def _poisson_cdf(lam: float, tail: float = 1e-12) -> list[float]:
    """P(X <= k) for k = 0, 1, ... until 1 - tail; ``lam`` is at most WHOLE_ABOVE."""
    cdf, p, k, acc = [], math.exp(-lam), 0, 0.0
    while acc < 1.0 - tail:
        acc += p
        cdf.append(min(acc, 1.0))
        k += 1
        p *= lam / k
    return cdf


def replication_count(u: Column, lam: float) -> Column:
    """Copies of a row, ``lam`` on average: Poisson by the inverse CDF, the number of CDF values below u (a short
    literal array, JVM-side).  Above WHOLE_ABOVE the whole part is fixed and only the fraction is drawn."""
    whole = math.floor(lam) if lam > WHOLE_ABOVE else 0
    cdf = F.array(*[F.lit(c) for c in _poisson_cdf(lam - whole)])
    return F.lit(whole).cast("long") + F.size(F.filter(cdf, lambda c: c < u))


def replicate(df: DataFrame, n: str, copy: str) -> DataFrame:
    """Each row ``n`` times, numbered from 1 in ``copy``.  Rows with more than COPIES_PER_TASK copies are cut into as
    many pieces, which are spread before they are written out."""
    last = F.floor((F.col(n) - 1) / F.lit(COPIES_PER_TASK)).cast("long")
    cut = df.filter(F.col(n) > 0).withColumn("__piece", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    if df.filter(F.col(n) > COPIES_PER_TASK).limit(1).count():
        cut = cut.repartition("__piece", *[F.col(c) for c in df.columns[:1]])
    first = F.col("__piece") * COPIES_PER_TASK
    return cut.withColumn(copy, F.explode(F.sequence(first + 1, F.least(first + COPIES_PER_TASK, F.col(n))))).drop("__piece")


def rose_balance(df: DataFrame, key: str, label: str, features: list[str], seed: int = 1,
                 shrink: float = 1.0, exact_total: bool = False) -> DataFrame:
    """SA3: smoothed-bootstrap balancing; returns (key, copy, label, features...) rows.

    ``exact_total``: replicate with a slightly raised rate (target + 6 sd in
    expectation) and keep exactly N/2 rows per class (floor / ceil for odd N)
    by the hash rank of (key, copy), ranking only one boundary bucket per class.
    """
    lab = persist(df.filter(F.col(label).isNotNull()).select(key, label, *features))
    stats = lab.groupBy(label).agg(F.count(F.lit(1)).alias("n"),
                                   *[F.stddev_samp(F.col(c).cast("double")).alias(f"sd_{c}") for c in features]
                                   ).collect()
    N = sum(r["n"] for r in stats)
    d = len(features)
    classes = sorted(r[label] for r in stats)
    targets = {c: (N // len(classes)) + (1 if i < N % len(classes) else 0) for i, c in enumerate(classes)}
    count_expr, h_expr = None, {c: None for c in features}
    for r in stats:
        cls, n_c = r[label], r["n"]
        lam = targets[cls] / float(n_c)
        if exact_total:
            lam *= 1.0 + 6.0 / math.sqrt(max(targets[cls], 1))
        u = md5_uniform(key, f"{seed}|copies")
        k = replication_count(u, lam)
        cond = F.col(label) == F.lit(cls)
        count_expr = F.when(cond, k) if count_expr is None else count_expr.when(cond, k)
        hfac = shrink * (4.0 / ((d + 2) * n_c)) ** (1.0 / (d + 4))
        for c in features:
            hv = F.lit(hfac * (r[f"sd_{c}"] or 0.0))
            h_expr[c] = F.when(cond, hv) if h_expr[c] is None else h_expr[c].when(cond, hv)
    rep = replicate(lab.withColumn("__k", count_expr.otherwise(F.lit(0).cast("long"))), "__k", "copy")
    out = []
    for i, c in enumerate(features):
        z = md5_normal(f"{seed}|noise{i}", key, "copy")
        out.append((F.col(c).cast("double") + h_expr[c].otherwise(F.lit(0.0)) * z).alias(c))
    res = rep.select(key, "copy", label, *out)
    if exact_total:
        res = res.withColumn("__rk", F.concat_ws("#", F.col(key).cast("string"), F.col("copy").cast("string")))
        res = stratified_split(res, "__rk", label, 0.5, seed, flag="__keep", targets=targets) \
            .filter("__keep").drop("__keep", "__rk")
    return res
