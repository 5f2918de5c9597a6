"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "storelens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; `conf` adds or overrides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # split a hot join key even when that costs one more shuffle
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by the cluster in spark.checkpoint.dir.

    A local session without the setting gets a temporary folder; a cluster without it is an
    error, since a machine-local folder would lose data with its executor.
    """
    context = spark.sparkContext
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured is None and context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="storelens-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return (configured or context.getCheckpointDir()).rstrip("/")


def _folder(spark: SparkSession, path: str):
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(context._jsc.hadoopConfiguration()), folder


def folder_exists(spark: SparkSession, path: str) -> bool:
    store, folder = _folder(spark, path)
    return store.exists(folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared store, if it is there, through Spark's own file systems."""
    store, folder = _folder(spark, path)
    store.delete(folder, True)


def _scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/storelens/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path of this application below the shared folder."""
    return f"{_scratch(spark)}/{label}-{uuid.uuid4().hex}"


def clean_scratch(spark: SparkSession) -> None:
    """Deletes what this application has left below the shared folder. Call it when no frame that
    reads it is needed any more, at the end of a job."""
    remove_folder(spark, _scratch(spark))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder of the shared store, sorted; none if it is not there."""
    store, folder = _folder(spark, path)
    if not store.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in store.listStatus(folder))


def read_text(spark: SparkSession, path: str) -> str:
    """A small file of the shared store."""
    store, file = _folder(spark, path)
    stream = store.open(file)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Adds a small file whole, unless there is one: of several writers one succeeds."""
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs
    store, file = _folder(spark, path)
    draft = hadoop.Path(f"{file.getParent()}/.{uuid.uuid4().hex}")
    stream = store.create(draft, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    files = hadoop.FileContext.getFileContext(store.getUri(), context._jsc.hadoopConfiguration())
    keep_existing = context._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        files.rename(draft, file, keep_existing)
    except Py4JJavaError as error:
        store.delete(draft, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True
