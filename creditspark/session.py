"""Session construction and shared-storage helpers.

On a cluster the shared folder comes from ``spark.checkpoint.dir``; we only
create a local one when the session has none (tests, laptops).
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app_name: str = "creditspark",
              shuffle_partitions: int | None = None, **extra_conf) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    AQE is on so joins are re-planned at runtime (broadcast only when the
    measured side is under ``autoBroadcastJoinThreshold``) and skewed
    shuffle partitions are split.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder
        .master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    for k, v in extra_conf.items():
        builder = builder.config(k.replace("__", "."), v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tune_for_input(spark: SparkSession, input_bytes: int, target_partition_bytes: int = 256 << 20) -> int:
    """Size shuffle and scan partitions from the input size (runtime SQL settings).

    Shuffle partitions ~ input / 256 MB (AQE coalesces small ones afterwards),
    scan splits of 256 MB, advisory post-shuffle size 256 MB.  Returns the
    shuffle partition count.
    """
    n = max(1, -(-int(input_bytes) // target_partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(target_partition_bytes))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_partition_bytes))
    return n


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's reliable checkpoint folder.

    Uses the folder already set on the context, else ``spark.checkpoint.dir``
    from the configuration, else (local masters only) a fresh temporary folder.
    Raises where executors would not see such a folder.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share; "
                             f"master {sc.master} has executors on other machines")
        configured = tempfile.mkdtemp(prefix="creditspark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder.  It is the session's own: ``clear_scratch``
    or the end of the driver's Python deletes it."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/scratch"
    if not _scratch:
        atexit.register(clear_scratch, spark)
    _scratch.add(base)
    return f"{base}/{name}-{uuid.uuid4().hex}"


_scratch: set[str] = set()


def clear_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables that this session wrote (whatever still reads them is lost)."""
    jvm = spark.sparkContext._jvm
    try:
        for base in _scratch:
            path = jvm.org.apache.hadoop.fs.Path(base)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    except Exception:  # noqa: BLE001 - the session has ended: its checkpoint folder is for the cluster to clean
        return
    _scratch.clear()
