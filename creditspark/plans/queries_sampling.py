"""SA keys: exact stratified split, 5 % stratified sample, class balancing."""

from __future__ import annotations

from pyspark.sql import functions as F

from creditspark.operators import sampling as S
from creditspark.plans.catalog import register
from creditspark.plans.modelling import build_design
from creditspark.plans.oracle_base import with_fixture
from creditspark.sources import fixtures as fx

SEED = 100


def _split_sql(ratio, seed, sampled_only):
    where = "where is_train" if sampled_only else ""
    cols = "application_id, tag" if sampled_only else "application_id, tag, is_train"
    return with_fixture(
        f"""select {cols} from (
              select application_id, tag,
                     row_number() over (partition by tag order by md5(cast(application_id as varchar) || '|{seed}'),
                                                                  application_id)
                       <= round_even({ratio} * count(*) over (partition by tag), 0) is_train
              from lab) s {where}""")


@register("stratified_split", _split_sql(0.7, SEED, False))
def stratified_split(spark, d):
    """SA1: 70/30 split preserving the class ratio: per class the first round(0.7 n) rows by md5 rank."""
    mt = fx.modelling_table(spark, d)
    return S.stratified_split(mt, "application_id", "tag", 0.7, SEED).select("application_id", "tag", "is_train")


@register("stratified_sample_5pct", _split_sql(0.05, SEED, True))
def stratified_sample_5pct(spark, d):
    """SA2: 5 % stratified subsample (the reference's SVM cost limiter)."""
    mt = fx.modelling_table(spark, d)
    return S.stratified_sample(mt, "application_id", "tag", 0.05, SEED).select("application_id", "tag")


@register("rose_balance")
def rose_balance(spark, d):
    """SA3: smoothed-bootstrap balancing of the training side to about 50/50 (rows only).  The features are
    those of the encoded design, where a NULL has a bin, so no row is left out."""
    return build_design(fx.modelling_table(spark, d)).balanced


def _copies_sql():
    """Copies per training row: Poisson by the inverse CDF of md5's first 52 bits; the class's rate is N / (2 n)."""
    cdf = "list_count(list_transform(range(0, 60), lambda k: case when u > cdf_at(lam, k) then 1 end))"
    return with_fixture(
        f"""select application_id, tag, {cdf.replace('cdf_at(lam, k)', 'list_sum(list_transform(range(0, k + 1), lambda j: exp(-lam + j * ln(lam) - lgamma(j + 1))))')}::bigint as copies
            from (select application_id, tag,
                         (('0x' || substr(md5(cast(application_id as varchar) || '|1|copies'), 1, 13))::bigint::double + 1) / 4503599627370496 as u,
                         count(*) over () / (2.0 * count(*) over (partition by tag)) as lam from lab) s""")


@register("rose_copies", _copies_sql())
def rose_copies(spark, d):
    """SA3: how often balancing takes each labelled row (no kernel noise)."""
    lab = fx.modelling_table(spark, d).filter(F.col("tag").isNotNull()).select("application_id", "tag")
    got = S.rose_balance(lab, "application_id", "tag", [], seed=1).groupBy("application_id").agg(F.count(F.lit(1)).alias("copies"))
    return lab.join(got, "application_id", "left").select("application_id", "tag", F.coalesce("copies", F.lit(0).cast("long")).alias("copies"))


NOISY = ["tenure_days", "util", "n_trades"]


def _noise_sql():
    """Copies as in ``rose_copies``; their noise from md5's first and second 52 bits by Box and Muller."""
    cdf = "list_sum(list_transform(range(0, k + 1), lambda j: exp(-lam + j * ln(lam) - lgamma(j + 1))))"
    bits = "(('0x' || substr({m}, {at}, 13))::bigint::double + 1) / 4503599627370496"
    d = len(NOISY)
    values = []
    for i, c in enumerate(NOISY):
        m = f"md5(application_id::varchar || '|' || copy::varchar || '|1|noise{i}')"
        values.append(f"round({c}::double + pow(4.0 / ({d + 2} * n_c), 1.0 / {d + 4}) * sd_{c} * sqrt(-2 * ln({bits.format(m=m, at=1)}))"
                      f" * cos(2 * pi() * {bits.format(m=m, at=14)}), 6) as {c}")
    return with_fixture(
        f"select application_id, copy, tag, {', '.join(values)} from taken",
        f"""of_class AS (select tag, count(*) n_c, sum(count(*)) over () as n_all,
                        {', '.join(f'stddev_samp({c}::double) as sd_{c}' for c in NOISY)} from lab group by tag)""",
        """drawn AS (select lab.*, n_c, sd_tenure_days, sd_util, sd_n_trades,
                            (n_all // 2 + case when lab.tag < n_all % 2 then 1 else 0 end)::double / n_c as lam,
                            (('0x' || substr(md5(cast(application_id as varchar) || '|1|copies'), 1, 13))::bigint::double + 1) / 4503599627370496 as u
                     from lab join of_class on of_class.tag = lab.tag)""",
        f"""taken AS (select *, unnest(range(1, 1 + list_count(list_transform(range(0, 60), lambda k: case when u > {cdf} then 1 end)))) as copy
                     from drawn)""")


@register("rose_noise", _noise_sql())
def rose_noise(spark, d):
    """SA3: the copies that balancing makes of all labelled rows, with their kernel noise."""
    lab = fx.modelling_table(spark, d).filter(F.col("tag").isNotNull())
    got = S.rose_balance(lab, "application_id", "tag", NOISY, seed=1)
    return got.select("application_id", "copy", "tag", *[F.round(c, 6).alias(c) for c in NOISY])
