"""Where jobs put the tables that outlive one plan."""

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

_local_base: dict[str, str] = {}  # application id -> folder, for local sessions only


def _is_local(master: str) -> bool:
    """Driver and tasks in one process: `local` and `local[..]`, but not `local-cluster[..]`."""
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new directory for `name` in the shared folder that `spark.checkpoint.dir` names.

    A local session without that setting gets a temporary folder, removed when Python ends; a cluster session must have
    it, since executors on other machines could not read a driver-local folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not _is_local(spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.conf.get("spark.app.id")
        if app not in _local_base:
            _local_base[app] = tempfile.mkdtemp(prefix="groundline-")
            atexit.register(shutil.rmtree, _local_base[app], ignore_errors=True)
        base = _local_base[app]
    return f"{base.rstrip('/')}/groundline/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder in whatever store its path names; False if there is none."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
