"""Session helpers: where shared intermediate data goes and tuned defaults."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCAL_DIRS: dict[str, str] = {}
_STAGES: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Only a local-mode session without the setting falls back to a temporary
    folder, because there the driver and the executors share one machine.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by the cluster")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="faultline-")
    return _LOCAL_DIRS[app]


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, spent: Iterable[DataFrame] = ()) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    A lost executor then costs no replay, and the planner sees the true size. The
    shuffle files of the write go as soon as it has ended, and so do the tables of
    ``spent``, earlier results of this function that nothing reads any more.
    """
    spark = df.sparkSession
    path = work_dir(spark, "stage")
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF)
    spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP_CONF, before)
    out = spark.read.schema(df.schema).parquet(path)
    _STAGES[out] = path
    remove_stages(*spent)
    return out


def remove_stages(*tables: DataFrame) -> None:
    """Delete the tables of ``cut_lineage`` given; other DataFrames are left alone."""
    for table in tables:
        path = _STAGES.pop(table, None)
        if path:
            context = table.sparkSession.sparkContext
            folder = context._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def local_session(cores: int | str = 8, memory: str = "16g") -> SparkSession:
    """Local session used by the tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("faultline")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
