"""SparkSession factory with the settings every job in this package assumes."""

from __future__ import annotations

import os
import tempfile
import threading

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tallybook") -> SparkSession:
    """Build (or reuse) a session.

    UTC session time zone is load-bearing: ``to_date(ts)`` must be the UTC
    calendar date.  AQE is on so join strategy, partition coalescing and
    skew splitting are decided at runtime from real sizes.  The UI is off:
    no server is started.
    """
    master = master or os.environ.get("SPARK_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("SHUFFLE_PARTITIONS", "8"))
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Runtime broadcast only below a measured size; above it, sort-merge.
        .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
        # Partition sizing: AQE coalesces shuffle output to ~128 MB partitions and
        # scans split at 128 MB, so tasks stay executor-sized at any scale; on a
        # cluster set SHUFFLE_PARTITIONS high (e.g. 4000) and let AQE coalesce.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(128 * 1024 * 1024))
        .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Runtime SQL settings the library relies on, applied to any session it is
# handed (the caller may have built its own).  UTC is load-bearing: every
# `to_date(ts)` is a UTC calendar date.
RUNTIME_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles methods of more than 8,000 bytes of bytecode.  Stages whose row loop is larger
    # (parsing, posting) then run by operator, in small compiled methods, instead of interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def apply_runtime_defaults(spark: SparkSession) -> None:
    for k, v in RUNTIME_DEFAULTS.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


#: Shuffle partitions per GB of input files; AQE joins small ones again.
PARTITIONS_PER_GB = 128
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_FITTED: dict[str, tuple[str, str | None]] = {}


def fit_partitions(spark: SparkSession, paths: list[str]) -> None:
    """Let shuffles begin with partitions in proportion to the input, so that a task's share stays the same at every size.

    Small inputs keep the session's setting; a caller's larger number of initial partitions stands.
    """
    total = 0
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        total += fs.getContentSummary(p).getLength() if fs.exists(p) else 0
    app, now = spark.sparkContext.applicationId, spark.conf.get(_INITIAL, None)
    put, given = _FITTED.get(app, (None, None))
    if now is None or now != put:
        given = now   # the caller's own
    wanted = -(-total * PARTITIONS_PER_GB // 10**9)
    if wanted > int(given or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(_INITIAL, str(wanted))
        _FITTED[app] = (str(wanted), given)
    elif now != given:
        spark.conf.unset(_INITIAL) if given is None else spark.conf.set(_INITIAL, given)
        _FITTED.pop(app, None)


#: Whether the shuffle files of a query are removed when it ends, and not with the driver's next full collection.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_STORING: dict[SparkSession, tuple[int, str]] = {}   # tables being written, and the caller's setting
_STORING_GUARD = threading.Lock()


def store(df: DataFrame, path: str, by: str | None = None) -> None:
    """Write a stored table, leaving nothing on disk but its files, compressed well: what is stored shares the disk
    with what is shuffled for the next table."""
    spark = df.sparkSession
    with _STORING_GUARD:
        now, given = _STORING.get(spark) or (0, spark.conf.get(_CLEAN, "false"))
        _STORING[spark] = now + 1, given
        spark.conf.set(_CLEAN, "true")
    try:
        (df.write.partitionBy(by) if by else df.write).mode("overwrite").option("compression", "zstd").parquet(path)
    finally:
        with _STORING_GUARD:
            now, given = _STORING.pop(spark)
            if now > 1:
                _STORING[spark] = now - 1, given
            else:
                spark.conf.set(_CLEAN, given)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names a folder that the driver and all executors
    share; it is used as it is.  Only a session in one process (``local[...]``)
    may go without it and then gets a scratch folder; on a cluster a missing
    setting is an error, as a machine's own folder would hold partial tables.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tallybook-ckpt-", dir="/tmp"))
    return sc._jsc.sc().getCheckpointDir().get()
