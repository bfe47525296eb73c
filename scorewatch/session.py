"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from py4j.protocol import Py4JError, Py4JNetworkError
from pyspark.sql import DataFrame, SparkSession

_roots: dict[str, str] = {}


def build_session(app: str = "scorewatch", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC time and no UI port; ``conf`` overrides."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    } | conf
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _scratch_root(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``; it goes when Python ends.

    Only a local session without that setting falls back to a temporary folder, since
    executors on other machines could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    key = f"{app} {root}"
    if key not in _roots:
        if not root:
            master = spark.sparkContext.master
            if master != "local" and not master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
            root = tempfile.mkdtemp(prefix="scorewatch-")
        _roots[key] = f"{root.rstrip('/')}/scorewatch-{app}"
        path = spark._jvm.org.apache.hadoop.fs.Path(_roots[key])
        atexit.register(_remove, path.getFileSystem(spark._jsc.hadoopConfiguration()), path)
    return _roots[key]


def _remove(files, path) -> None:
    try:
        files.delete(path, True)
    except (Py4JError, Py4JNetworkError, OSError):
        pass  # the JVM has gone already


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of this application."""
    return f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, which cuts its lineage."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
