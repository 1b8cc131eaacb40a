"""Session helpers: scratch paths live under the checkpoint folder; partition sizing."""

from creditspark.session import checkpoint_dir, scratch_path, tune_for_input


def test_scratch_under_checkpoint_dir(spark):
    base = checkpoint_dir(spark)
    p1, p2 = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert p1.startswith(base.rstrip("/") + "/scratch/x-") and p1 != p2
    assert checkpoint_dir(spark) == base  # stable once set


def test_tune_for_input(spark):
    keys = ["spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    old = {k: spark.conf.get(k) for k in keys}
    try:
        assert tune_for_input(spark, 10 * (1 << 30)) == 40
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
        assert tune_for_input(spark, 100 * (1 << 40)) == 409_600
        assert tune_for_input(spark, 1) == 1
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_clear_cache(spark):
    from creditspark.operators.cache import clear, persist
    df = persist(spark.range(10))
    df.count()
    assert df.is_cached
    clear(spark)
    assert not spark.range(10).is_cached
