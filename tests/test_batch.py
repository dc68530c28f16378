import os
import random

import pytest
from conftest import rows
from executables import NAMED, build, random_file

from binledger.operators.ledger import current_ledger
from binledger.plans import batch as B
from binledger.schemas import LEDGER_SCHEMA, RESULT_SCHEMA
from binledger.sources.tables import ParquetTable


@pytest.fixture
def store(tmp_path):
    rng = random.Random(8)
    files = {**NAMED, **{f"/{i % 2}/r{i}.exe": random_file(rng) for i in range(40)}}
    for path, value in files.items():
        target = tmp_path / "bucket" / path.replace("%20", " ").lstrip("/")
        os.makedirs(target.parent, exist_ok=True)
        target.write_bytes(value[0])
    (tmp_path / "bucket/1/skip.html5").write_bytes(b"ab")
    return Store(tmp_path, files)


class Store:
    def __init__(self, folder, files):
        self.folder, self.files = folder, files
        self.roots = [f"{folder}/bucket/{c}" for c in (0, 1)]
        self.results = ParquetTable(f"{folder}/results")
        self.ledger = ParquetTable(f"{folder}/ledger")

    def run(self, spark, n=10, **options):
        return B.run_batch(
            spark, self.roots, n, **{"results": self.results, "ledger": self.ledger, "strict": False, "seed": 42, **options}
        )

    def stored(self, spark):
        return rows(self.results.read(spark, RESULT_SCHEMA))

    def recorded(self, spark):
        return rows(current_ledger(self.ledger.read(spark, LEDGER_SCHEMA)))

    def expected(self, paths):
        return sorted(
            ((p, len(self.files[p][0]), p.rsplit(".", 1)[-1], *self.files[p][1:]) for p in paths), key=repr
        )


def test_whole_job(spark, store):
    got = rows(store.run(spark, 10, batch=1))
    assert len(got) == 10 and sum(r[0].startswith("/1/") for r in got) == 5
    assert got == store.expected([r[0] for r in got]) == store.stored(spark)
    assert store.recorded(spark) == sorted((r[:3] for r in got), key=repr)


def test_second_run_adds_nothing(spark, store):
    store.run(spark, 10, batch=1)
    before = store.stored(spark)
    assert store.run(spark, 10, batch=2).count() == 0
    assert store.stored(spark) == before


def test_larger_sample_adds_the_rest(spark, store):
    store.run(spark, 10, batch=1)
    assert store.run(spark, 30, batch=2).count() == 20
    store.run(spark, 1000, batch=3)
    assert store.stored(spark) == store.expected(store.files)
    assert len(store.recorded(spark)) == len(store.files)


def test_unbounded_plan_gives_the_same(spark, store, monkeypatch):
    monkeypatch.setattr("binledger.operators.ledger.BROADCAST_MAX_ROWS", 0)
    store.run(spark, 10, batch=1)
    store.run(spark, 1000, batch=2)
    assert store.stored(spark) == store.expected(store.files)


def test_another_request_is_another_batch(spark, store):
    """The same batch number with another catalogue, base or header rule does its own
    files, and gives none of the first one's rows."""
    base, schema = f"{store.folder}/bucket", "path string, size long, type string, class int"
    found = [(f"/{p.parent.name}/{p.name}", p.stat().st_size, p.suffix[1:]) for p in sorted((store.folder / "bucket").glob("[01]/*.exe"))]
    first, second = ([(*f, int(f[0][1])) for f in half if " " not in f[0]] for half in (found[::2], found[1::2]))
    for files in (first, second):
        catalog = spark.createDataFrame(files, schema)
        got = store.run(spark, 1000, batch=1, catalog=catalog, base=base)
        assert {r.path for r in got.collect()} == {f[0] for f in files}
    again = spark.createDataFrame(first, schema)
    assert store.run(spark, 1000, batch=1, catalog=again, base=base, strict_headers=False).count() == 0


def test_all_violations_are_kept(spark, tmp_path):
    bad = [(f"/0/{i}.exe", None if i % 2 else 1, "exe", "16", 0, 0) for i in range(40)]
    batch = spark.createDataFrame(bad, RESULT_SCHEMA)
    results = ParquetTable(str(tmp_path / "results"))
    with pytest.raises(B.BatchRejected, match="architecture_unknown: 40 rows; size_missing: 20 rows; see ") as error:
        B.store_batch(spark, batch, 1, ledger=None, results=results)
    kept = spark.read.parquet(str(error.value).rsplit("see ", 1)[1])
    assert kept.count() == 60 and results.read(spark, RESULT_SCHEMA).count() == 0


def test_default_seed_moves_on(spark, store):
    paths = [{r.path for r in store.run(spark, 10, batch=b, seed=None).collect()} for b in (1, 2, 3)]
    assert not paths[0] & paths[1] and len(set().union(*paths)) > 10


def test_strict_sample_fails_before_anything_is_stored(spark, store):
    with pytest.raises(ValueError, match="larger than class"):
        store.run(spark, 1000, batch=1, strict=True)
    assert store.stored(spark) == []


def test_changed_file(spark, store):
    store.run(spark, 1000, batch=1)
    (store.folder / "bucket/0/a.exe").write_bytes(build(64, [9, 9, 9]))
    assert store.run(spark, 1000, batch=2, on_change="skip").count() == 0
    with pytest.raises(B.BatchRejected, match="path_stored_already: 1 rows"):
        store.run(spark, 1000, batch=3)
    assert store.stored(spark) == store.expected(store.files)


def test_file_changed_back_is_new_again(spark, store):
    """Only the newest version in the ledger counts as done."""
    log = spark.createDataFrame([("/0/a.exe", 5, "exe", 1), ("/0/a.exe", 6, "exe", 2)], LEDGER_SCHEMA)
    catalog = spark.createDataFrame([("/0/a.exe", 5, "exe", 0)], "path string, size long, type string, class int")
    assert B.choose_files(catalog, log, 2, strict=False).count() == 1
    assert B.choose_files(catalog, log.select("path", "size", "type"), 2, strict=False).count() == 0


class Failing(ParquetTable):
    def append(self, df):
        raise RuntimeError("store is gone")


def test_failure_between_the_sinks_is_resumed(spark, store, monkeypatch):
    with pytest.raises(RuntimeError):
        store.run(spark, 10, batch=1, ledger=Failing(store.ledger.path))
    assert len(store.stored(spark)) == 10 and store.recorded(spark) == []
    monkeypatch.setattr(B, "extract_from_store", None)
    store.run(spark, 10, batch=1)
    assert len(store.stored(spark)) == 10 and len(store.recorded(spark)) == 10


def test_failure_before_the_sinks_is_resumed(spark, store, monkeypatch):
    with pytest.raises(RuntimeError):
        store.run(spark, 10, batch=1, results=Failing(store.results.path))
    monkeypatch.setattr(B, "extract_from_store", None)
    got = rows(store.run(spark, 10, batch=1))
    assert store.stored(spark) == got and len(got) == 10


def test_repair_ledger(spark, store):
    store.run(spark, 10, batch=1, ledger=None)
    assert store.recorded(spark) == []
    B.repair_ledger(spark, 2, ledger=store.ledger, results=store.results)
    B.repair_ledger(spark, 3, ledger=store.ledger, results=store.results)
    assert len(store.recorded(spark)) == 10 == store.ledger.read(spark, LEDGER_SCHEMA).count()


def test_results_serve_as_ledger(spark, store):
    store.run(spark, 10, batch=1, ledger=None)
    assert store.run(spark, 30, batch=2, ledger=None).count() == 20


def test_every_file_is_read_once(spark, store):
    """The files are opened for one job only, though two tables are written."""
    seen = store.folder / "opened"
    seen.mkdir()

    def counting():
        from pyarrow import fs

        (seen / f"{os.getpid()}-{os.urandom(6).hex()}").touch()
        return fs.LocalFileSystem()

    reads = store.run(spark, 20, batch=1, filesystem=counting, base=f"{store.folder}/bucket")
    opened = len(os.listdir(seen))
    reads.count()
    assert opened and len(os.listdir(seen)) == opened


def test_staging_folder(spark, store):
    assert B._staging_folder(spark, "/x/") == "/x/batches"
    assert B._staging_folder(spark, None).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_deleted_file_is_put_aside_and_tried_again(spark, store):
    """A file deleted after the listing, and one that cannot be opened as a file."""
    listed = B.file_catalog(spark, store.roots, "*.???", f"{store.folder}/bucket")
    catalog = spark.createDataFrame(listed.collect(), listed.schema)
    victims = ["/0/r2.exe", "/1/r3.exe"]
    kept = {v: (store.folder / "bucket" / v[1:]).read_bytes() for v in victims}
    for v in victims:
        (store.folder / "bucket" / v[1:]).unlink()
    (store.folder / "bucket" / victims[1][1:]).mkdir()
    options = {"catalog": catalog, "base": f"{store.folder}/bucket", "unreadable": 0.2}
    got = rows(store.run(spark, 1000, batch=1, **options))
    assert got == store.stored(spark) == store.expected(set(store.files) - set(victims))
    aside = B.unreadable_files(spark, 1)
    assert sorted(r["path"] for r in aside.filter("path like '/%/r_.exe'").collect() if r["path"] in victims) == victims
    assert all(r["error"] for r in aside.collect())
    (store.folder / "bucket" / victims[1][1:]).rmdir()
    for v, data in kept.items():
        (store.folder / "bucket" / v[1:]).write_bytes(data)
    assert {r["path"] for r in store.run(spark, 1000, batch=2, **options).collect()} == set(victims)
    assert store.stored(spark) == store.expected(store.files)
    assert B.unreadable_files(spark, 2).count() == 0 == B.unreadable_files(spark, 77).count()


def test_too_many_unreadable_files(spark, store):
    catalog = spark.createDataFrame(
        [(f"/0/gone{i}.exe", 5, "exe", 0) for i in range(20)] + [("/1/r1.exe", len(store.files["/1/r1.exe"][0]), "exe", 1)],
        "path string, size long, type string, class int",
    )
    options = {"catalog": catalog, "base": f"{store.folder}/bucket"}
    for _ in range(2):
        with pytest.raises(B.TooManyUnreadable, match="20 of 21 files"):
            store.run(spark, 1000, batch=5, **options)
    assert store.stored(spark) == [] and store.recorded(spark) == []
    assert B.unreadable_files(spark, 5).count() == 20
    assert store.run(spark, 1000, batch=5, unreadable=1.0, **options).count() == 1


def test_header_limit_of_the_job(spark, store):
    """Headers behind 8 KiB are damaged by default, and followed with None or a larger limit."""
    late = build(64, [3, 2], 4, header_offset=100_000)
    (store.folder / "bucket/0/late.exe").write_bytes(late)
    architectures = []
    for batch, limit in enumerate([8192, None, 200_000]):
        results = ParquetTable(f"{store.folder}/results{batch}")
        options = {"results": results, "ledger": None, "header_limit": limit, "strict_headers": False}
        got = store.run(spark, 1000, batch=batch, **options)
        architectures.append(got.filter("path = '/0/late.exe'").first()["architecture"])
    assert architectures == [None, "64", "64"]


def test_rules_counted_in_the_write(spark):
    """The numbers of the write are those of the check of the written rows."""
    from pyspark.sql import Observation

    from binledger.operators.checks import check_results, watch_rules

    bad = [("/0/a", 1, "exe", "16", 0, 0), (None, None, "html5", "32", 0, 0), ("x" * 300, 2, None, None, 0, 0), ("/0/a", 1, "exe", "64", 0, 0)]
    df = spark.createDataFrame(bad, RESULT_SCHEMA)
    counted = Observation()
    watch_rules(df, counted).collect()
    whole = {r["rule"]: r["n"] for r in check_results(df).groupBy("rule").agg({"n_rows": "sum"}).toDF("rule", "n").collect()}
    assert {rule: n for rule, n in counted.get.items() if n} == {r: n for r, n in whole.items() if r != "path_repeated"}
    rest = check_results(df, row_rules=False)
    assert rows(rest) == [("/0/a", "path_repeated", 2)]
