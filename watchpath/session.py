"""Session helpers: local sessions for tests/bench, checkpoint directory."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_session(cpus: int | None = None, app: str = "watchpath") -> SparkSession:
    """A local session sized for ``cpus`` threads (tests and bench only).

    Settings a cluster already carries are not overridden: ``getOrCreate``
    returns an active session unchanged.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    n = int(cpus or os.environ.get("BENCH_CPUS") or 8)
    spark = (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must be present (a folder every executor can
    reach). Only a local-mode session without it (tests, bench) gets a fresh
    folder under /tmp.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="watchpath-ckpt-"))
    return sc.getCheckpointDir()


def materialize(df, name: str = "table", count: bool = False):
    """Write ``df`` once as Parquet under the checkpoint folder and read it back.

    Cuts lineage (the files survive executor loss) and gives the optimizer
    exact sizes for the read-back table. One write job; with ``count=True``
    the row count is observed during that job and returned as well.
    """
    import uuid

    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not count:
        df.write.parquet(path)
        return df.sparkSession.read.parquet(path)
    seen = Observation(name)
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return df.sparkSession.read.parquet(path), int(seen.get["rows"])
