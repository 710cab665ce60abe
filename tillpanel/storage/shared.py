"""Where intermediate tables may be written."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor reaches: the session's checkpoint directory.

    Where it is unset, a local master (a single process, as in tests) uses a folder in its warehouse;
    on a cluster that is an error.
    """
    configured = spark.conf.get(CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/tillpanel/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``new_folder`` named, through whatever file system it is on."""
    if not path.startswith(f"{shared_folder(spark)}/tillpanel/"):
        raise ValueError(f"{path} is not in the shared folder")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
