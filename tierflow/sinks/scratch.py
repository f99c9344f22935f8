"""Where intermediate results go when a lineage must be cut."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The session's shared checkpoint folder.

    A folder of our own is made only where none is set and the session is
    local; on a cluster a machine-local folder would lose data with its host.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        root = tempfile.mkdtemp(prefix="tierflow-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the scratch root, never used before."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete what was written under a scratch path."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target.getFileSystem(conf).delete(target, True)
