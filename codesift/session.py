"""Session defaults and the shared work folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Bytes of rows in an Arrow batch on its way to a Python worker. Rows alone bound nothing: 10,000
# whole texts can be any size, and the JVM, the worker and its pool hold a batch at once.
ARROW_BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_LOCAL_WORK_DIR: dict[str, str] = {}
_SHIPPED: set[str] = set()


def build_session(app_name: str = "codesift", master: str | None = None,
                  shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the jobs are written for.

    On a cluster leave ``master`` and ``shuffle_partitions`` to spark-submit.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Whole source files travel in Arrow batches; keep those small.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        .config(_BATCH_SETTING, str(ARROW_BATCH_BYTES))
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, from ``spark.checkpoint.dir``.

    Only a local session may do without the setting: it gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = sc.applicationId
    if app not in _LOCAL_WORK_DIR:
        _LOCAL_WORK_DIR[app] = tempfile.mkdtemp(prefix="codesift-")
    return _LOCAL_WORK_DIR[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def written(df, name: str):
    """``df`` written once to the shared folder and read back.

    Cuts lineage in a way that outlives executors.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def without_summary(model):
    """A fitted model without the summary of its fit.

    The summary holds the session, and a session that has observed a table cannot be sent to
    tasks, so neither could a model that has one.
    """
    return model.copy() if getattr(model, "hasSummary", False) else model


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    As good as ``--py-files`` for a session that was started without it. A session without a
    bound for the bytes of an Arrow batch gets one.
    """
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(ARROW_BATCH_BYTES))
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="codesift-zip-"), "codesift"), "zip",
        os.path.dirname(package), os.path.basename(package))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
