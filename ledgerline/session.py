"""Spark session helpers.

The library never builds its own session inside a job: every operator takes
a ``SparkSession`` or a ``DataFrame``. These helpers are for entry points,
tests and the benchmark.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. Timestamps are interpreted in UTC (the
# reference converts market times to UTC); AQE re-plans joins and coalesces
# shuffle partitions from runtime statistics.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app_name: str = "ledgerline",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and local runs."""
    return build_session(
        master=f"local[{cores}]",
        shuffle_partitions=shuffle_partitions,
        extra_conf={"spark.driver.memory": "8g"},
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be configured (a shared file system); only a
    local-mode session without one gets a fresh temporary folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder before running jobs"
        )
    path = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()
