"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.speculation": "true",
    "spark.checkpoint.compress": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Large splits, as a task's distinct words grow far slower than its text: fewer tasks send
# fewer rows. Spark still makes smaller splits of an input that would leave cores idle.
SPLIT_SETTING, SPLIT_BYTES = "spark.sql.files.maxPartitionBytes", "512m"


def build_session(app_name: str = "lexiband") -> SparkSession:
    """Session of a job of its own. A split size given to spark-submit is kept."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return with_settings(builder.getOrCreate())


def with_settings(spark: SparkSession) -> SparkSession:
    """Give a session the settings of a job that can still be given: those of SQL."""
    spark.conf.set("spark.sql.adaptive.enabled", SETTINGS["spark.sql.adaptive.enabled"])
    if not spark.sparkContext.getConf().contains(SPLIT_SETTING):
        spark.conf.set(SPLIT_SETTING, SPLIT_BYTES)
    return spark


def use_shared_folder(spark: SparkSession) -> str:
    """Set the checkpoint directory if need be and return it.

    The cluster names it in spark.checkpoint.dir. A temporary folder stands in only in
    local mode, where every task runs on the machine that made it.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None and folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="lexiband-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    if named is not None and not _inside(folder, named):
        context.setCheckpointDir(named)
    return context.getCheckpointDir()


def _inside(folder: str | None, parent: str) -> bool:
    """Spark makes a folder of its own inside the one it is given."""
    return folder is not None and urlparse(folder).path.startswith(urlparse(parent).path.rstrip("/") + "/")


def kept_files(checkpointed: DataFrame) -> str | None:
    """The folder of a DataFrame that `checkpoint` returned."""
    file = checkpointed._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    return file.get() if file.isDefined() else None


def remove(spark: SparkSession, path: str | None) -> None:
    """Delete a folder that the session has written."""
    if path is not None:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def new_shared_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing was written to yet."""
    return f"{use_shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
