"""Session settings shared by the plans, the tests and the benchmark."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Folder for stored tables inside the shared one.
STORED = "surveyloom-stored"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "surveyloom", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    On a cluster leave ``master`` out; shuffle parallelism then comes from the
    cluster's own configuration and AQE coalesces it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a single-machine session may leave the setting out; it then gets a
    temporary folder. On a cluster such a folder would be another one for each
    executor, so there the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="surveyloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def checkpoint(df):
    """Cut lineage through reliable storage, so a lost executor costs no recomputation."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


# The tables stored inside each open ``freeing`` block, the innermost last.
_inside: list[list[str]] = []


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back.

    Like :func:`checkpoint`, but columnar and compressed. The tables stay until
    the :func:`freeing` block around ends or until :func:`drop_stored`, since
    results that read them may be used later.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{STORED}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    if _inside:
        _inside[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(context._jsc.hadoopConfiguration()).delete(found, True)


@contextmanager
def freeing(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end of the block, every table that was stored in it.

    What the block computes has to be written or collected inside it.
    """
    _inside.append([])
    try:
        yield
    finally:
        for path in _inside.pop():
            _delete(spark, path)


def drop_stored(spark: SparkSession) -> None:
    """Delete every table this application has stored; results that still read them end with it."""
    _delete(spark, f"{shared_folder(spark).rstrip('/')}/{STORED}/{spark.sparkContext.applicationId}")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each Spark context."""
    context = spark.sparkContext
    if getattr(context, "_surveyloom_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="surveyloom-code-"), "surveyloom.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    whole = os.path.join(folder, name)
                    out.write(whole, os.path.relpath(whole, os.path.dirname(package)))
    context.addPyFile(archive)
    context._surveyloom_shipped = True
