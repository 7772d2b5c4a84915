"""Session helpers: a local session for tests and the shared folder for staged data."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings of the local sessions used by tests and the bench. On a cluster the session's own
# configuration rules (see README, "Running at scale"); the library sets none of these.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lakepact") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Scratch data (materialized inputs that cut lineage, derived deliveries, stream
    checkpoints) goes here, never to a machine-local folder; staged table versions live next
    to their table under the lake root. Only a local session that names no folder (tests)
    gets one of its own; on a cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d and sc._jsc.sc().getCheckpointDir().isDefined():
        d = sc._jsc.sc().getCheckpointDir().get()
    if not d:
        _local_only(spark, "spark.checkpoint.dir")
        d = tempfile.mkdtemp(prefix="lakepact-ckpt-")
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def _local_only(spark: SparkSession, setting: str) -> None:
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError(f"{setting} must name a folder that all executors share")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared folder."""
    return "/".join([shared_dir(spark), "lakepact", *parts, uuid.uuid4().hex[:12]])


def lake_root(spark: SparkSession) -> str:
    """Root folder for table versions created by this library.

    ``lakepact.lake.root`` when set; a local session may fall back to its warehouse folder.
    """
    root = spark.conf.get("lakepact.lake.root", None)
    if not root:
        _local_only(spark, "lakepact.lake.root")
        root = spark.conf.get("spark.sql.warehouse.dir")
    return root.rstrip("/") if root != "/" else root


def materialize(df, *parts: str):
    """Cut lineage: write ``df`` once as Parquet under the shared folder and read it back.

    One job computes and writes the rows (executor loss only retries tasks); later plans
    start from a plain scan instead of re-deriving the rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "materialized", *parts)
    df.write.parquet(path)
    return spark.read.parquet(path)
