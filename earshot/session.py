"""Session settings the library relies on, and the shared scratch folder."""

from __future__ import annotations

import atexit
import functools
import re
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Runtime settings; each can be changed on a live session.
#  - every instant is read and written in UTC
#  - nanosecond Parquet timestamps are read as bigint (Spark refuses them otherwise)
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}

# Settings for sessions this library builds itself. AQE sizes shuffle partitions
# from real bytes and splits skewed joins and rebalanced writes; the starting
# partition count is only an upper bound it coalesces from.
BUILD_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str = "earshot", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**BUILD_CONF, **RUNTIME_CONF}
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def share_code(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, for functions that run in Python there."""
    context = spark.sparkContext
    if getattr(context, "_earshot_shared", False):
        return spark
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="earshot-code-")) / "earshot.zip"
    atexit.register(shutil.rmtree, archive.parent, ignore_errors=True)
    with zipfile.ZipFile(archive, "w") as content:
        for source in sorted(package.rglob("*.py")):
            content.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._earshot_shared = True
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`, also set as Spark's checkpoint folder.

    A cluster session without the setting is an error, because executors could
    not see each other's files. A local session is one machine; where it names
    no folder it gets one for its lifetime.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_folder()
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


@functools.cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="earshot-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as that system takes it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder; it is removed when the session's JVM ends."""
    context = spark.sparkContext
    root = getattr(context, "_earshot_scratch", None)
    if root is None:
        root = context._earshot_scratch = f"{checkpoint_folder(spark)}/earshot-{uuid.uuid4().hex}"
        files, target = file_system(spark, root)
        files.mkdirs(target)
        files.deleteOnExit(target)
    return f"{root}/{name}-{uuid.uuid4().hex}"
