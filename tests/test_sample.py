import hashlib
import random
from collections import Counter

import pytest
from conftest import rows

from binledger.operators.sample import balanced_sample


def expected(data, n, seed=42):
    key = lambda r: (hashlib.md5(f"{seed}:{r[0]}".encode()).hexdigest(), *r)
    return sorted(
        (r for c in (0, 1) for r in sorted((r for r in data if r[3] == c), key=key)[: n // 2]), key=repr
    )


@pytest.fixture(scope="module")
def catalogue():
    rng = random.Random(3)
    data = [(f"/{c}/{rng.randrange(10**9)}.exe", rng.randrange(50), "exe", c) for c in (0, 1) for _ in range(700)]
    # A third of all rows are copies of one file, and one path has many sizes.
    return data + [data[5]] * 800 + [("/1/sizes.exe", s, "exe", 1) for s in range(300)]


@pytest.mark.parametrize("n", [1, 2, 7, 100, 901, 1500])
def test_matches_a_full_sort(files, catalogue, n):
    df = files(catalogue, with_class=True).repartition(7)
    assert rows(balanced_sample(df, n)) == expected(catalogue, n)


def test_other_seed(files, catalogue):
    df = files(catalogue, with_class=True)
    assert rows(balanced_sample(df, 40, seed=7)) == expected(catalogue, 40, seed=7)


def test_copies_across_the_cut(files):
    """The cut falls inside a run of equal rows: only part of the copies is taken."""
    data = [("/0/a.exe", 1, "exe", 0)] * 100 + [("/1/b.exe", 2, "exe", 1)] * 7
    assert Counter(rows(balanced_sample(files(data, with_class=True), 14))) == {data[0]: 7, data[-1]: 7}


def test_partitions_do_not_matter(spark, files, catalogue):
    df = files(catalogue, with_class=True)
    before = rows(balanced_sample(df, 100))
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert rows(balanced_sample(df.repartition(11), 100)) == before
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_counts(files):
    df = files([(f"/{c}/{i}.exe", i, "exe", c) for c in (0, 1) for i in range(10)], with_class=True)
    assert balanced_sample(df, 0).count() == 0
    assert Counter(r["class"] for r in balanced_sample(df, 7).collect()) == {0: 3, 1: 3}
    with pytest.raises(ValueError):
        balanced_sample(df, -1)


def test_small_class(files):
    data = [(f"/0/{i}.exe", i, "exe", 0) for i in range(9)] + [("/1/m.exe", 1, "exe", 1)]
    df = files(data, with_class=True)
    with pytest.raises(ValueError, match="1: 1"):
        balanced_sample(df, 10)
    assert Counter(r["class"] for r in balanced_sample(df, 10, strict=False).collect()) == {0: 5, 1: 1}


def test_absent_class(files):
    df = files([("/0/a.exe", 1, "exe", 0)], with_class=True)
    with pytest.raises(ValueError, match="1: 0"):
        balanced_sample(df, 2)
    assert balanced_sample(df, 2, strict=False).count() == 1


def test_nothing_is_ranked(files, catalogue):
    """Filters over the files and a count of the copies of two rows: no order, no window."""
    for n in (2, 900, 1500):
        plan = balanced_sample(files(catalogue, with_class=True), n, strict=False)._jdf.queryExecution().toString()
        assert not any(name in plan for name in ("Window", "Sort ", "Join", "rangepartitioning"))


def test_rows_are_not_shuffled(files):
    """Without copies at the cut the sample is a filter."""
    data = [(f"/{c}/{i}.exe", i, "exe", c) for c in (0, 1) for i in range(500)]
    plan = balanced_sample(files(data, with_class=True), 900)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan


def test_a_path_with_very_many_sizes(spark):
    """One path is most of its class; the cut among its sizes is found by counting."""
    df = spark.range(200_000).selectExpr(
        "if(id % 10 = 0, concat('/0/', id, '.exe'), '/0/hot.exe') as path", "if(id = 1, null, id * 1000003 - 7) as size",
        "'exe' as type", "0 as class",
    ).repartition(8)
    hot = df.filter("path = '/0/hot.exe'")
    before = df.filter("md5(concat('5:', path)) < md5('5:/0/hot.exe')").count()
    got = balanced_sample(df, 2 * (before + 100_000), seed=5, strict=False, classes=(0, 1))
    sizes = [r["size"] for r in got.filter("path = '/0/hot.exe'").orderBy("size").collect()]
    assert sizes == [r["size"] for r in hot.orderBy("size").limit(100_000).collect()]
    assert got.count() == before + 100_000 and got.rdd.getNumPartitions() >= 8


def test_order_of_other_columns(files, spark):
    """Missing values first, numbers by value, text by its characters."""
    values = [(None, "b"), (-5, "b"), (-5, "a"), (0, None), (0, "a"), (0, "a b"), (0, "a"), (7, "z"), (2**62, ""), (-(2**62), "")]
    data = [("/0/a", size, kind, 0) for size, kind in values] + [("/1/a", 1, "x", 1)] * 10
    ordered = sorted(data[:10], key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or ""))
    for k in range(1, 11):
        got = rows(balanced_sample(files(data, with_class=True), 2 * k).filter("class = 0"))
        assert got == sorted(ordered[:k], key=repr)


def test_missing_paths_and_clashing_columns(spark):
    data = [(None, 1, "x", 0, "p"), ("", 1, "x", 0, "p"), (None, 1, "x", 0, "q"), ("/b", 2, "x", 1, None), ("/b", 2, "x", 1, "r")]
    df = spark.createDataFrame(data, "path string, size long, type string, class int, files string")
    assert rows(balanced_sample(df, 4, seed=1)) == sorted([data[0], data[2], data[3], data[4]], key=repr)
