"""Spark session helpers.

Everything in the library takes a ``SparkSession`` from the caller; these helpers only
build one for tests / the bench, and resolve the shared checkpoint folder.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


# Settings for a large cluster (≈100 TB of pixels, ~1000 executors); the library never sets these
# itself — pass them to the session builder / spark-submit.  AQE sizes shuffles at run time.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.shuffle.partitions": "20000",                 # initial; AQE coalesces
    "spark.sql.files.maxPartitionBytes": str(256 << 20),
    "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),    # region sides are size-checked explicitly
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "4096",  # 64-band rows per Arrow batch for pandas UDFs
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "pixelframe") -> SparkSession:
    """Local session for tests and the bench (UI off, UTC, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PIXELFRAME_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` (or a folder already set on the context) wins.  Where neither is set, a
    ``local`` master (tests) takes a fresh scratch folder; a cluster raises, since its executors would
    each write to a disk of their own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="pixelframe-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for intermediate tables (never machine-local)."""
    import uuid
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/pixelframe-scratch/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df):
    """Cut lineage of a small, reused table (regions, grids) with ``checkpoint()`` into the shared folder.

    Geometry columns are nested higher-order expressions; without this, optimizer rewrites may inline
    them into every filter that reads a derived column.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
