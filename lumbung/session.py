"""Session helpers: the shared folder for tables that cut lineage, and the test session."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: dict[str, str] = {}
_STAGED: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`; a local temporary one only where a local session leaves it unset."""
    given = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if given:
        return given.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN:
        folder = tempfile.mkdtemp(prefix="lumbung-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _OWN[app] = "file://" + folder
    return _OWN[app]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once as Parquet in the shared folder and read it back: cuts lineage, survives the loss of executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_freed(df: DataFrame, name: str) -> DataFrame:
    """stage(), which also deletes the shuffle files of the write at its end rather than when the driver collects garbage."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        # the setting counts for frames that are made under it
        return stage(df.select("*"), name)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def unstage(staged: DataFrame) -> None:
    """Delete a table that stage() wrote, once nothing reads it any more."""
    spark = staged.sparkSession
    name = os.path.basename(os.path.dirname(staged.inputFiles()[0]))
    paths = _STAGED.get(spark.sparkContext.applicationId, [])
    for path in [p for p in paths if p.endswith(f"/{name}")]:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        paths.remove(path)


def drop_staged(spark: SparkSession) -> int:
    """Delete all tables that stage() wrote in this session, once nothing that reads them is needed; their number."""
    paths = _STAGED.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return len(paths)


def local_session(cpus: str = "8", partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lumbung")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A Parquet table of a data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows of a plain scan over all cores before costly work on each, if it has fewer splits than there are cores.

    Large tables have more splits than cores and stay as they are. Only for scans: their splits are known unplanned.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
