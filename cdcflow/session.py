"""Session helpers: a tuned local session and the folder shared by all executors."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SHARED_DIR_KEY = "spark.checkpoint.dir"
#: Shuffle files of a write go when it ends; without this they stay until the driver's JVM happens to collect its plan.
RELEASED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
_LOCAL_DIRS: dict[str, str] = {}
_SCRATCH: dict[str, list[str]] = {}


def local_session(cores: str = "*", app: str = "cdcflow", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches; on a cluster the submitter supplies the session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CDCFLOW_DRIVER_MEMORY", "8g"))
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Only a ``local[...]`` master may fall back to a machine-local folder, which goes with the process.
    """
    named = spark.conf.get(SHARED_DIR_KEY, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SHARED_DIR_KEY} to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="cdcflow-")
        atexit.register(shutil.rmtree, _LOCAL_DIRS[app], ignore_errors=True)
    return _LOCAL_DIRS[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete what this application stored under the shared folder; returns how many paths there were.

    For the end of a job: frames that were made from stored tables cannot be read afterwards.
    """
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    return len(paths)


@contextmanager
def settings(spark: SparkSession, wanted: Mapping[str, str] = RELEASED) -> Iterator[None]:
    """Session settings for what runs inside; those from before are put back."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
