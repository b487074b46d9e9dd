"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
SCAN_CONF = "lakeops.scan.partitions"
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "lakeops", cores: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """Local session for tests and benchmarks; on a cluster pass the existing session instead."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if cores != "*":
        builder = builder.config(SCAN_CONF, str(cores))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's checkpoint folder. Only where one machine does it all is one made."""
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
    fallback = tempfile.mkdtemp(prefix="lakeops-")
    spark.conf.set(CHECKPOINT_CONF, fallback)
    return fallback


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never reused, so a retry cannot read half-written data."""
    root = f"{shared_dir(spark)}/lakeops-{uuid.uuid4().hex}"
    _SCRATCH.append(root)
    return f"{root}/{name}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables this process wrote; call it when no result that reads them is needed."""
    while _SCRATCH:
        path = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = (), small: bool = False) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage and survives executor loss. ``small`` as in ``write``."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    write(df, path, partition_by, small=small)
    return spark.read.schema(df.schema).parquet(path)


def write(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "error", small: bool = False) -> None:
    """Write a table, with ``small`` compressed for size rather than speed.

    The shuffles that made it leave the executors' disks with the end of the write, not when the driver
    happens to collect its garbage.
    """
    spark, writer = df.sparkSession, df.write.mode(mode)
    if small:
        writer = writer.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    before = spark.conf.get(CLEANUP_CONF, None)
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        writer.parquet(path)
    finally:
        spark.conf.unset(CLEANUP_CONF) if before is None else spark.conf.set(CLEANUP_CONF, before)


def discard(table: DataFrame) -> None:
    """Delete a table that ``materialize`` wrote and that no result still reads."""
    for file in table.inputFiles():
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, False)


def tasks_for(spark: SparkSession, rows: int, rows_per_task: int) -> int:
    """Tasks for a shuffle of ``rows``: the session's number, more where a task would get over ``rows_per_task``."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_per_task))


def spread(scan: DataFrame) -> DataFrame:
    """Deal a scan out to as many tasks as the setting ``lakeops.scan.partitions`` names; without it the scan stays as it is.

    For small files of one row group before heavy work per row, as in tests and benchmarks.
    """
    wanted = scan.sparkSession.conf.get(SCAN_CONF, None)
    return scan.repartition(int(wanted)) if wanted else scan
