"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "gatehold") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="gatehold-warehouse-"))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`.

    Only a local session may fall back to a temporary folder; on a cluster an
    unset folder is an error, since executors do not share a local disk.
    """
    context = spark.sparkContext
    configured = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise PySparkException("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="gatehold-scratch-")
        context.setCheckpointDir(_local_roots[app])
    return _local_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the scratch folder; never reused."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and return the written rows.

    For intermediates that several jobs read: they are computed once, later
    executor losses re-read files instead of recomputing, and Catalyst plans the
    next joins on the true file size.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
