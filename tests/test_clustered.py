import os
import random
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_batch import store  # noqa: F401

from binledger.operators.ledger import append_ledger, current_ledger, drop_known_paths, drop_processed
from binledger.plans.batch import choose_files, store_batch
from binledger.schemas import LEDGER_SCHEMA, RESULT_SCHEMA
from binledger.sources.clustered import ClusteredLedger, bucket_of, drop_known_by_sketch
from binledger.sources.tables import BatchTable


def log_rows(seed, n, versions=4, paths=None):
    draw = random.Random(seed)
    paths = paths or [f"/{i % 2}/f{i}.exe" for i in range(n // versions + 1)]
    out = [(draw.choice(paths), draw.choice([None, 1, 2, 3]), draw.choice(["exe", "dll"]), draw.randrange(versions)) for _ in range(n)]
    return out + [(None, 1, "x", 0), (None, 2, "x", 1), ("", 0, "", 1)]


def appended(spark, ledger, log):
    for batch in sorted({r[3] for r in log}):
        df = spark.createDataFrame([r[:3] for r in log if r[3] == batch], "path string, size long, type string")
        append_ledger(df, ledger, batch)


@pytest.fixture
def ledger(tmp_path):
    return ClusteredLedger(f"{tmp_path}/ledger", buckets=8)


def test_reads_what_was_appended(spark, ledger):
    assert ledger.read(spark).count() == 0
    log = log_rows(1, 200)
    appended(spark, ledger, log)
    assert rows(ledger.read(spark)) == sorted(log, key=repr)


def test_same_append_again_leaves_the_same_rows(spark, ledger):
    log = log_rows(2, 100)
    appended(spark, ledger, log)
    # What a job that ended half-way leaves: some buckets of a batch, some without their file.
    parts = sorted(Path(ledger.folder).glob("appends/batch=2/bucket=*/*.parquet"))
    for part in parts[::2]:
        part.unlink()
    appended(spark, ledger, [r for r in log if r[3] == 2])
    appended(spark, ledger, [r for r in log if r[3] == 1])
    assert rows(ledger.read(spark)) == sorted(log, key=repr)


def test_a_batch_leaves_other_buckets_unread(spark, tmp_path):
    """100 files of a ledger of 4,000 in 512 buckets: the scan opens the files of their
    buckets, and no more."""
    ledger = ClusteredLedger(f"{tmp_path}/ledger", buckets=512)
    log = spark.range(4000).selectExpr("concat('/0/', id, '.exe') as path", "id as size", "'exe' as type", "1L as batch")
    ledger.append(log)
    batch = spark.range(100).selectExpr("concat('/0/', id * 50, '.exe') as path", "id * 50 as size", "'exe' as type")
    known = ledger.read_for(batch)
    buckets = {r[0] for r in batch.select(bucket_of("path", 512)).collect()}
    opened = {r[0] for r in known.select(F.input_file_name()).distinct().collect()}
    assert {f.rsplit("/", 2)[-2] for f in opened} == {f"bucket={b}" for b in buckets}
    assert len(opened) <= 100 < ledger.files(spark) / 4
    plan = known._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters", 1)[1]
    assert rows(drop_processed(batch, known)) == rows(drop_processed(batch, log))
    assert rows(drop_known_paths(batch, known)) == rows(drop_known_paths(batch, log))


def test_compaction_keeps_the_current_rows_and_shrinks(spark, ledger):
    log = log_rows(3, 400)
    appended(spark, ledger, log)
    before, files, n = rows(current_ledger(ledger.read(spark))), ledger.files(spark), ledger.read(spark).count()
    assert ledger.compact(spark)
    assert rows(current_ledger(ledger.read(spark))) == before
    assert ledger.files(spark) < files and ledger.read(spark).count() == len(before) < n
    assert not ledger.compact(spark)
    # Later appends, newer and older than what the snapshot holds, and another compaction.
    later = [(p, 9, "exe", 7) for p, *_ in log[:50]] + [("/new", 1, "exe", 7), (None, 5, "y", 7)] + [(p, 8, "dll", -1) for p, *_ in log[50:90]]
    appended(spark, ledger, later)
    everything = spark.createDataFrame(log + later, LEDGER_SCHEMA)
    assert rows(current_ledger(ledger.read(spark))) == rows(current_ledger(everything))
    assert ledger.compact(spark) and rows(current_ledger(ledger.read(spark))) == rows(current_ledger(everything))
    appended(spark, ledger, [("/last", 1, "exe", 8)])
    assert ledger.compact(spark)
    assert sorted(os.listdir(f"{ledger.folder}/snapshots")) == ["2", "3"]


def test_small_appends_wait(spark, ledger):
    appended(spark, ledger, [(f"/{i}", i, "exe", 1) for i in range(100)])
    assert ledger.compact(spark, least_share=0.1)
    appended(spark, ledger, [(f"/x{i}", i, "exe", 2) for i in range(9)])
    assert not ledger.compact(spark, least_share=0.1)
    appended(spark, ledger, [("/y", 1, "exe", 3)])
    assert ledger.compact(spark, least_share=0.1)


def test_a_compaction_cut_short_changes_nothing(spark, ledger, monkeypatch):
    """It ends before the appends are removed, or before its snapshot is complete."""
    log = log_rows(4, 200)
    appended(spark, ledger, log)
    want = rows(current_ledger(ledger.read(spark)))
    with monkeypatch.context() as m:
        m.setattr("binledger.sources.clustered.remove", lambda *_: None)
        assert ledger.compact(spark)
    assert rows(current_ledger(ledger.read(spark))) == want
    os.remove(f"{ledger.folder}/snapshots/1/_SUCCESS")
    assert rows(current_ledger(ledger.read(spark))) == want
    assert ledger.compact(spark)
    assert rows(current_ledger(ledger.read(spark))) == want


@pytest.mark.parametrize("compacted", [False, True])
def test_sketch_loses_nothing(spark, tmp_path, compacted):
    ledger = ClusteredLedger(f"{tmp_path}/ledger", buckets=4, blocks=2)
    log = log_rows(5, 3000)
    appended(spark, ledger, log)
    if compacted:
        ledger.compact(spark)
        appended(spark, ledger, [("/late", 1, "exe", 9)])
    done = spark.createDataFrame([*log, ("/late", 1, "exe", 9)] if compacted else log, LEDGER_SCHEMA)
    files = [(f"/{i % 2}/f{i}.exe", i % 4 or None, "exe", i) for i in range(0, 4000, 3)]
    df = spark.createDataFrame(files + files[:50] + [(None, 1, "x", 0), ("/late", 1, "exe", 1), ("", 0, "", 0)], "path string, size long, type string, other int")
    known = {r[0] for r in done.select("path").collect()} - {None}
    marked = {(r["path"], r["maybe_known"]) for r in ledger.maybe_known(df).collect()}
    assert all((p, True) in marked for p in known & {f[0] for f in files})
    false_hits = sum(hit for p, hit in marked if p not in known)
    assert false_hits <= 0.03 * len(marked) and (None, False) in marked
    assert rows(drop_known_by_sketch(df, ledger)) == rows(drop_known_paths(df, done))
    replaced = [(p, s, t, 1) for p, s, t, _ in log[:40]]
    again = spark.createDataFrame(replaced, df.schema)
    assert rows(drop_known_by_sketch(again, ledger, "replace")) == rows(drop_known_paths(again, ledger.read(spark), "replace"))


def test_new_files_leave_most_of_the_ledger_unread(spark, tmp_path):
    ledger = ClusteredLedger(f"{tmp_path}/ledger", buckets=64)
    ledger.append(spark.range(20_000).selectExpr("concat('/0/', id) as path", "id as size", "'x' as type", "1L as batch"))
    new = spark.range(500).selectExpr("concat('/1/', id) as path", "id as size", "'x' as type")
    hits = ledger.maybe_known(new).filter("maybe_known")
    share = ledger.read_for(hits).count() / 20_000
    assert share < 0.15
    assert drop_known_by_sketch(new, ledger).count() == 500


def test_an_empty_ledger_and_no_files(spark, ledger, files):
    batch = files([("/a", 1, "exe"), (None, None, None)])
    assert rows(drop_known_by_sketch(batch, ledger)) == rows(batch)
    appended(spark, ledger, [("/a", 1, "exe", 1)])
    assert drop_known_by_sketch(batch.limit(0), ledger).count() == 0
    assert ledger.read_for(batch.limit(0)).count() == 0


@pytest.mark.parametrize("on_change", ["process", "skip"])
def test_choose_files_from_a_clustered_ledger(spark, ledger, on_change):
    catalog = spark.range(300).selectExpr("concat('/', id % 2, '/', id, '.exe') as path", "id as size", "'exe' as type", "cast(id % 2 as int) as class")
    log = [(f"/{i % 2}/{i}.exe", i + i % 3, "exe", 1) for i in range(0, 300, 2)] + [(f"/{i % 2}/{i}.exe", i, "exe", 2) for i in range(0, 300, 5)]
    appended(spark, ledger, log)
    done = spark.createDataFrame(log, LEDGER_SCHEMA)
    want = rows(choose_files(catalog, done, 100, on_change=on_change))
    assert rows(choose_files(catalog, ledger, 100, on_change=on_change)) == want and want


def test_whole_job_with_both(spark, store, ledger, tmp_path):  # noqa: F811
    results = BatchTable(f"{tmp_path}/by-batch")
    got = rows(store.run(spark, 10, batch=1, results=results, ledger=ledger))
    assert len(got) == 10
    assert rows(store.run(spark, 10, batch=1, results=results, ledger=ledger)) == got
    assert rows(results.read(spark, RESULT_SCHEMA)) == got
    store.run(spark, 1000, batch=2, results=results, ledger=ledger)
    assert rows(results.read(spark, RESULT_SCHEMA)) == store.expected(store.files)
    assert rows(current_ledger(ledger.read(spark))) == sorted((r[:3] for r in store.expected(store.files)), key=repr)


def test_half_done_append_is_repeated(spark, tmp_path, ledger):
    results = BatchTable(f"{tmp_path}/by-batch")
    first = spark.createDataFrame([(f"/0/{i}.exe", i, "exe", "64", 1, 1) for i in range(20)], RESULT_SCHEMA)
    second = spark.createDataFrame([(f"/1/{i}.exe", i, "exe", "32", 1, 1) for i in range(20)], RESULT_SCHEMA)
    store_batch(spark, first, 1, ledger=ledger, results=results)
    store_batch(spark, second, 2, ledger=ledger, results=results)
    # The job ended when some of batch 2 was written, and nothing of it recorded.
    results.append_batch(second.limit(7), 2)
    store_batch(spark, second, 2, ledger=ledger, results=results)
    store_batch(spark, second, 2, ledger=ledger, results=results)
    assert rows(results.read(spark, RESULT_SCHEMA)) == rows(first.union(second))
    assert ledger.read(spark).count() == 40
    with pytest.raises(ValueError, match="path_stored_already: 20 rows"):
        store_batch(spark, second, 3, ledger=ledger, results=results)
