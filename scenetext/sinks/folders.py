"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below the cluster's ``spark.checkpoint.dir``, in a folder of this
    application that is deleted when the driver ends.

    Only a local session, where all tasks see the same disk, may go without
    that setting; it then gets a temporary folder for its lifetime. On a cluster
    the path has its scheme, also where the setting has none: the folder is shared
    by definition, so Spark and the tasks' Python may both go there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    local = spark.sparkContext.master.startswith("local")
    if not root:
        if not local:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = tempfile.mkdtemp(prefix="scenetext-")
        spark.conf.set("spark.checkpoint.dir", root)
    own = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/scenetext-{spark.sparkContext.applicationId}")
    store = own.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.mkdirs(own):
        store.deleteOnExit(own)
    whole = store.makeQualified(own).toString()
    if local and whole.startswith("file:"):
        whole = f"{root.rstrip('/')}/{own.getName()}"
    return f"{whole}/{purpose}-{uuid.uuid4().hex}"
