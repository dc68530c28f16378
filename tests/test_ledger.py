import pytest
from conftest import rows

from binledger.operators.checks import check_results
from binledger.operators.ledger import append_ledger, current_ledger, drop_known_paths, drop_processed
from binledger.schemas import BROADCAST_MAX_ROWS, CATALOG_COLUMNS, LEDGER_SCHEMA, RESULT_SCHEMA
from binledger.sources.tables import JdbcTable, ParquetTable

BATCH = [("a", 1, "exe"), ("a", 1, "exe"), ("b", None, "dll"), ("c", 2, "dll"), ("e", 5, "exe"), ("e", 5, "exe"), (None, 1, "x")]
DONE = [("b", None, "dll"), ("c", 3, "dll"), ("a", 1, "exe"), ("a", 1, "exe"), ("z", 1, "exe"), (None, 1, "x")]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("max_rows", [None, len(BATCH), BROADCAST_MAX_ROWS + 1])
def test_drop_processed_is_except_distinct(files, max_rows):
    batch, done = files(BATCH), files(DONE)
    got = rows(drop_processed(batch, done, max_rows))
    assert got == rows(batch.subtract(done)) == [("c", 2, "dll"), ("e", 5, "exe")]


@pytest.mark.parametrize("max_rows", [None, len(BATCH)])
def test_drop_known_paths(files, max_rows):
    batch, done = files(BATCH), files(DONE)
    skip = rows(drop_known_paths(batch, done, "skip", max_rows))
    assert skip == [("e", 5, "exe"), ("e", 5, "exe"), (None, 1, "x")]
    replace = rows(drop_known_paths(batch, done, "replace", max_rows))
    assert replace == [("c", 2, "dll"), ("e", 5, "exe"), ("e", 5, "exe")]
    with pytest.raises(ValueError):
        drop_known_paths(batch, done, "other")


def test_larger_batch_than_said_is_not_broadcast(files):
    plan = plan_of(drop_processed(files(BATCH), files(DONE), len(BATCH) - 1))
    assert "Broadcast" not in plan


def test_bounded_batch_does_not_shuffle_the_ledger(spark, files, tmp_path):
    """The ledger is filtered against broadcast paths right above its scan."""
    files(DONE).write.parquet(str(tmp_path / "l"))
    done = spark.read.parquet(str(tmp_path / "l"))
    plan = plan_of(drop_processed(files(BATCH), done, 7))
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line)
    join = max(i for i, line in enumerate(lines[:scan]) if "BroadcastHashJoin" in line)
    assert not any("Exchange hashpartitioning" in line for line in lines[join:scan])
    assert "Broadcast" not in plan_of(drop_processed(files(BATCH), done))


def test_a_hot_path_is_split(spark, files):
    """A path that fills one partition of the batch, with many sizes, is joined by
    several tasks."""
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        batch = spark.range(60_000).selectExpr(
            "if(id % 10 > 0, 'hot', concat('p', id)) as path", "xxhash64(id) as size", "'exe' as type"
        )
        done = spark.range(30_000).selectExpr("concat('p', id) as path", "id as size", "'exe' as type")
        kept = drop_known_paths(batch.repartition(8), done)
        counted = kept.selectExpr("count(*)", "max(size)")
        assert counted.collect()[0][0] == 60_000 - 3_000
        assert "skew=true" in plan_of(counted)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_copies_are_one_row_in_the_join(spark):
    batch = spark.range(200_000).selectExpr("if(id % 3 > 0, 'hot', concat('p', id)) as path", "1L as size", "'x' as type")
    done = spark.createDataFrame([("p0", 1, "x")], "path string, size long, type string")
    kept = drop_known_paths(batch, done)
    assert kept.count() == 199_999 and kept.filter("path = 'hot'").count() == 133_333
    lines = plan_of(kept).splitlines()
    join = next(i for i, line in enumerate(lines) if "Join" in line)
    assert any("partial_count" in line for line in lines[join:]) and any("explode" in line for line in lines[:join])


def test_current_ledger(spark):
    log = spark.createDataFrame(
        [("a", 1, "exe", 1), ("a", 9, "exe", 2), ("a", 5, "exe", 3), ("b", None, "dll", 1), ("c", 1, "x", 1), ("c", 2, "x", 1)],
        LEDGER_SCHEMA,
    )
    assert rows(current_ledger(log)) == [("a", 5, "exe"), ("b", None, "dll"), ("c", 2, "x")]


def test_ledger_table(spark, files, tmp_path):
    table = ParquetTable(str(tmp_path / "ledger"))
    assert table.read(spark, LEDGER_SCHEMA).count() == 0
    append_ledger(files([("a", 1, "exe"), ("b", 2, "dll")]), table, 1)
    append_ledger(files([("a", 3, "exe")]), table, 2)
    log = table.read(spark, LEDGER_SCHEMA)
    assert log.count() == 3 and log.columns == CATALOG_COLUMNS + ["batch"]
    assert rows(current_ledger(log)) == [("a", 3, "exe"), ("b", 2, "dll")]


class Recorder:
    """Stands in for a writer or reader: no database is started in tests."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return call


def test_jdbc_table_options():
    table = JdbcTable("jdbc:x://db/files", "results", {"user": "u", "batchsize": 5000}, split_by_size=(0, 10**6, 16))
    writer = Recorder()
    table.append(type("Frame", (), {"write": writer})())
    assert [c[0] for c in writer.calls] == ["format", "options", "mode", "save"]
    assert writer.calls[0][1] == ("jdbc",) and writer.calls[2][1] == ("append",)
    assert writer.calls[1][2] == {"url": "jdbc:x://db/files", "dbtable": "results", "user": "u", "batchsize": 5000}
    assert table.read_options()["partitionColumn"] == "size" and table.read_options()["numPartitions"] == 16


def results(spark, data):
    return spark.createDataFrame(data, RESULT_SCHEMA)


def test_check_results(spark):
    batch = results(
        spark,
        [
            ("/0/ok.exe", 1, "exe", "32", 1, 0),
            ("/0/bad.exe", 1, "exe", None, -1, -1),
            ("/0/" + "x" * 252, 1, "exe", "64", 0, 0),
            ("/0/" + "y" * 253, 1, "exe", "64", 0, 0),
            ("/0/null.exe", None, None, "64", 0, 0),
            ("/0/type.html", 1, "html", "16", 0, 0),
            ("/0/twice.exe", 1, "exe", "64", 0, 0),
            ("/0/twice.exe", 2, "exe", "64", 0, 0),
            (None, 1, "exe", "64", 0, 0),
            (None, 2, "exe", "64", 0, 0),
            ("/0/old.exe", 1, "exe", "64", 0, 0),
        ],
    )
    stored = results(spark, [("/0/old.exe", 7, "exe", "64", 0, 0), ("/0/other.exe", 7, "exe", "16", 0, 0)])
    want = {
        ("/0/" + "y" * 253, "path_too_long", 1),
        ("/0/null.exe", "size_missing", 1),
        ("/0/null.exe", "type_missing", 1),
        ("/0/type.html", "type_too_long", 1),
        ("/0/type.html", "architecture_unknown", 1),
        ("/0/twice.exe", "path_repeated", 2),
        (None, "path_missing", 2),
        ("/0/old.exe", "path_stored_already", 1),
    }
    for max_rows in (None, 11):
        assert set(rows(check_results(batch, stored, max_rows))) == want
    assert set(rows(check_results(batch))) == {w for w in want if w[1] != "path_stored_already"}
    assert check_results(stored.limit(0), stored).count() == 0
