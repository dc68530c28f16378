import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from binledger.plans.spread import size_ranges, spread_by_size


def loads(df):
    by_task = df.groupBy(F.spark_partition_id().alias("task")).agg(F.sum(F.coalesce("size", F.lit(0))).alias("n"))
    return {r["task"]: r["n"] for r in by_task.collect()}


def test_huge_files_do_not_meet(spark, files):
    """A few files hold most bytes: no task has more than twice the mean."""
    rng = random.Random(2)
    data = [(f"/0/{i}.exe", rng.randrange(10_000), "exe") for i in range(3000)] + [(f"/0/huge{i}.exe", 9_000_000, "exe") for i in range(11)]
    df = files(data).repartition(5)
    got = spread_by_size(df, 12)
    assert rows(got) == sorted(data, key=repr) and got.rdd.getNumPartitions() == 12
    mean = sum(r[1] for r in data) / 12
    assert max(loads(got).values()) <= 2 * mean
    assert max(loads(df.repartition(12, "path")).values()) > 2 * mean


@pytest.mark.parametrize("tasks", [1, 3, 64])
def test_ranges_are_those_of_one_running_total(files, tasks):
    import hashlib

    rng = random.Random(7)
    data = [(f"/{i % 9}/{rng.randrange(400)}", rng.choice([None, 0, 5, 10_000, 2**40, -3]), rng.choice(["a", "b"])) for i in range(900)]
    data += [(None, 7, None), ("", None, "x")] + data[:30]
    key = lambda r: (hashlib.md5((r[0] or "").encode()).hexdigest()[:3], r[0] is not None, r[0] or "", r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "")
    cost = lambda r: max(r[1] or 0, 0) + 4096
    total, place, want = sum(map(cost, data)), 0, []
    for r in sorted(data, key=key):
        want.append((*r, place * tasks // total))
        place += cost(r)
    assert rows(size_ranges(files(data), tasks)) == sorted(want, key=repr)


def test_no_files_and_clashing_columns(spark, files):
    assert size_ranges(files([]), 4).columns == ["path", "size", "type", "task"] and size_ranges(files([]), 4).count() == 0
    df = files([("/a", 1, "x")]).withColumn("task", F.lit("mine"))
    assert rows(size_ranges(df, 4)) == [("/a", 1, "x", 0)]
    assert rows(spread_by_size(df.withColumn("size", F.lit(5)), 4)) is not None
