"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCAL_DIRS: dict[str, str] = {}


def build_session(app_name: str = "scriptorium", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC; sizes are left to the launcher."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by the session. Only a local session may fall back to a temporary one."""
    configured = spark.conf.get(CHECKPOINT_KEY, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_DIRS:
        _LOCAL_DIRS[application] = tempfile.mkdtemp(prefix="scriptorium-")
    return _LOCAL_DIRS[application]


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def through_table(df: DataFrame, name: str, drop_shuffles: bool = False) -> DataFrame:
    """Write `df` as a Parquet table in the shared folder and read it back.

    Ends the lineage: what is read again survives the loss of any executor. With `drop_shuffles` the
    shuffle files of the write go when it ends; else they stay until the driver collects its garbage.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    as_set = spark.conf.get(CLEANUP_KEY, "false")
    spark.conf.set(CLEANUP_KEY, "true" if drop_shuffles else as_set)
    try:
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP_KEY, as_set)
    return spark.read.schema(df.schema).parquet(path)
