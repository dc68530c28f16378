"""Tables written once and read again, so that a lost executor costs no more than
the step that was running."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``. Only a local session may do
    without that setting; a folder of this machine is used then."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back. The folder stays, as
    results still read it; the owner of ``spark.checkpoint.dir`` lets it expire. The
    shuffles that made it are no longer needed and leave the executors' disks."""
    folder = shared_folder(df.sparkSession, name)
    with _shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@contextmanager
def _shuffles_dropped(spark: SparkSession):
    """Lets Spark delete the shuffle files of each query that ends in here."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def free_name(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores before it if a frame has such a column."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def share(spark: SparkSession, value):
    """Broadcasts an object of this package; call the result for it in a task. A worker
    unpacks it once and keeps it for its later tasks."""
    sent = spark.sparkContext.broadcast({"pickled": cloudpickle.dumps(value)})

    def get():
        held = sent.value
        if "object" not in held:
            held["object"] = cloudpickle.loads(held["pickled"])
        return held["object"]

    return get


def small_batches(spark: SparkSession, size: str = "8m") -> SparkSession:
    """Lets Arrow batches to and from Python workers be no larger than this: a batch is
    held several times, and texts are large rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", size)
    return spark
