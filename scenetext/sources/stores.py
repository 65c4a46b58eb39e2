"""File systems as the tasks' Python sees them."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import SparkSession


def open_store(path: str) -> tuple[fs.FileSystem, str]:
    """File system of a path and the path inside it, for the URIs Spark uses."""
    if path.startswith("file:"):
        path = path.removeprefix("file://").removeprefix("file:")
    if "://" not in path:
        return fs.LocalFileSystem(), path.rstrip("/")
    store, inner = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return store, inner.rstrip("/")


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme that Spark reads it by, so that the tasks' Python goes to the same
    place. A path without one follows the session's default file system; if that is a local disk, as on
    no cluster it should be, such a path is refused off local masters."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(hadoop).toString()
    local = spark.sparkContext.master.startswith("local")
    if whole.startswith("file:") and not path.startswith("file:") and not local:
        raise ValueError(f"{path} would be on the own disk of every executor: give it with its scheme")
    return whole
