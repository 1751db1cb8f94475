"""Session settings the library relies on."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Needed for right results whatever session is handed in: timestamps are UTC
# instants, and nanosecond Parquet timestamps are read as longs (see recordings).
_RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.legacy.parquet.nanosAsLong": "true",
}

# Good defaults for a session this library starts itself.
_SPEED_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Call-site capture doubles the round trips of building a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "wearlake", **settings: str) -> SparkSession:
    """A session with the settings above; ``settings`` win (dots as ``__``)."""
    builder = SparkSession.builder.appName(app_name)
    merged = {**_SPEED_SETTINGS, **_RESULT_SETTINGS}
    merged.update({name.replace("__", "."): value for name, value in settings.items()})
    for name, value in merged.items():
        builder = builder.config(name, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Put the settings that results depend on into an existing session."""
    for name, value in _RESULT_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings for the jobs that run meanwhile."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def scratch_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables.

    On a cluster this is the shared folder named in ``spark.checkpoint.dir``; without it
    a cluster is refused, as executors would each write to a disk of their own. Where
    everything runs in one process (tests) a temporary folder is made, and removed when
    Python ends.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="wearlake-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, kind: str) -> str:
    """A new path in the scratch folder; what is written there goes with the session."""
    path = f"{scratch_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path
