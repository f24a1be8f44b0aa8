"""Session settings and the shared work folder."""

from __future__ import annotations

import functools
import os
import pathlib
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a running session can take.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    # Cleansing 39 features makes one generated method of more than 8000 bytes of bytecode, which the JVM
    # never compiles. Above this limit Spark generates one method per expression instead, which
    # is ten times faster here.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
_DEFAULTS = {
    **RUNTIME,
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Recording the Python line of every column call takes half the time of planning a batch.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app: str = "flowwarden", **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Give a session made elsewhere the runtime settings."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


@functools.cache
def _local_root(app_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"flowwarden-{app_id}-")


def shared_root(spark: SparkSession) -> str:
    """The folder for tables that several jobs share.

    It is the cluster's ``spark.checkpoint.dir``. Only a local session without that setting gets
    a folder of its own: executors on other hosts could not read it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_root(context.applicationId)


def work_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; each run gets its own."""
    return f"{shared_root(spark)}/flowwarden/{name}-{uuid.uuid4().hex}"


@functools.cache
def _archive() -> str:
    package = pathlib.Path(__file__).resolve().parent
    target = f"{tempfile.mkdtemp(prefix='flowwarden-package-')}/{package.name}"
    return shutil.make_archive(target, "zip", package.parent, package.name)


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package, for objects of its classes in tasks."""
    archive = _archive()
    if os.path.basename(archive) not in {os.path.basename(f) for f in spark.sparkContext.listFiles}:
        spark.sparkContext.addPyFile(archive)


def materialise(df, name: str):
    """Write ``df`` to the shared folder and read it back: computed once, lineage cut, and safe
    when an executor is lost."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
