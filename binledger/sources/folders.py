"""Folders of the stores that Spark writes to, through its own file systems."""

import atexit
import shutil
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


def _store(spark, folder):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, folder: str) -> bool:
    store, path = _store(spark, folder)
    return store.exists(path)


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    """The folders right below one, without hidden ones; none if it is not there."""
    store, path = _store(spark, folder)
    if not store.exists(path):
        return []
    found = [s.getPath() for s in store.listStatus(path) if s.isDirectory()]
    return sorted(f"{folder}/{p.getName()}" for p in found if not p.getName().startswith(("_", ".")))


def rename(spark: SparkSession, old: str, new: str) -> None:
    store, path = _store(spark, old)
    store.rename(path, spark._jvm.org.apache.hadoop.fs.Path(new))


def remove(spark: SparkSession, folders) -> None:
    for folder in folders:
        store, path = _store(spark, folder)
        store.delete(path, True)


@cache
def _local_folder():
    folder = tempfile.mkdtemp(prefix="shared-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, for its owner to expire. Only a local
    session may do without that setting: it gets a folder that ends with the process."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_folder()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
