"""Partitions for a costly step on small rows. Spark sizes partitions by bytes,
but here a row of some 60 bytes stands for a whole file."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FILES_PER_TASK = 2_000

# Bytes that opening a file costs as much as, and hex digits of md5(path) that deal files
# into lanes, each with a running total of its own.
FILE_BYTES = 4096
_DIGITS = 3


def spread(df: DataFrame, n: int) -> DataFrame:
    """At most ``n`` files over enough tasks; the number is fixed, so adaptive
    execution does not merge them."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = max(min(n, cores), -(-n // FILES_PER_TASK), 1)
    return df.repartition(tasks, "path")


def size_ranges(df: DataFrame, tasks: int, file_bytes: int = FILE_BYTES) -> DataFrame:
    """``df`` with the column ``task``, 0 to ``tasks`` - 1: files in the order of md5 prefix,
    path, size and type are cut into ranges of equal bytes, where each file counts with
    ``file_bytes`` more than its size. A range exceeds its share by less than one file. A
    missing size counts as none; a column ``task`` of ``df`` is replaced.

    Running totals go by lane, and start from the totals of the lanes before, at most 4,096
    numbers that come to the driver, so no task sees all files.
    """
    weight = F.greatest(F.coalesce("size", F.lit(0)), F.lit(0)) + F.lit(file_bytes)
    lane = F.substring(F.md5(F.coalesce("path", F.lit(""))), 1, _DIGITS)
    rows = df.drop("task").withColumns({"_lane": lane, "_bytes": weight.cast("bigint")})
    totals = sorted(rows.groupBy("_lane").agg(F.sum("_bytes")).collect())
    starts, total = [], 0
    for name, n_bytes in totals:
        starts.append((name, total))
        total += n_bytes
    if not starts:
        return df.drop("task").withColumn("task", F.lit(0))
    before = df.sparkSession.createDataFrame(starts, "_lane string, _start long")
    order = Window.partitionBy("_lane").orderBy("path", "size", "type")
    running = F.sum("_bytes").over(order.rowsBetween(Window.unboundedPreceding, -1))
    place = (F.col("_start") + F.coalesce(running, F.lit(0))).cast("decimal(38,0)")
    placed = rows.join(F.broadcast(before), "_lane").withColumn("_place", place)
    task = F.expr(f"cast(_place * {int(tasks)} div cast({max(total, 1)} as decimal(38,0)) as int)").alias("task")
    return placed.select(*[F.col(f"`{c}`") for c in df.columns if c != "task"], task)


def spread_by_size(df: DataFrame, tasks: int, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Files dealt over ``tasks`` partitions of about equal bytes (``size_ranges``), for
    steps that read whole files. Only one file larger than a share makes a larger task."""
    ranges = size_ranges(df, tasks, file_bytes)
    return ranges.repartitionById(tasks, "task").select([F.col(f"`{c}`") for c in df.columns])
