import pytest
from conftest import rows
from executables import build
from test_batch import store  # noqa: F401

from binledger.operators.ledger import current_ledger
from binledger.plans.stream import run_stream
from binledger.schemas import LEDGER_SCHEMA, RESULT_SCHEMA
from binledger.sources.clustered import ClusteredLedger
from binledger.sources.tables import BatchTable, ParquetTable


def tables(store, kind):  # noqa: F811
    if kind == "clustered":
        return {"results": BatchTable(f"{store.folder}/r"), "ledger": ClusteredLedger(f"{store.folder}/l", buckets=4)}
    return {"results": store.results, "ledger": store.ledger}


@pytest.mark.parametrize("kind", ["plain", "clustered"])
def test_stream(spark, store, kind):  # noqa: F811
    options = tables(store, kind) | {"checkpoint": f"{store.folder}/checkpoint", "unreadable": 0.1}
    filled = [p for p, v in store.files.items() if v[0]]
    assert run_stream(spark, store.roots, max_files=20, **options) == len(filled)
    first = rows(options["results"].read(spark, RESULT_SCHEMA))
    assert first == store.expected(filled)
    assert run_stream(spark, store.roots, **options) == 0
    # A changed file is left out, a new one is done.
    (store.folder / "bucket/0/a.exe").write_bytes(build(64, [9, 9, 9]))
    (store.folder / "bucket/1/new.exe").write_bytes(build(32, [2], 3))
    assert run_stream(spark, store.roots, **options) == 1
    stored = rows(options["results"].read(spark, RESULT_SCHEMA))
    assert [r for r in stored if r not in first] == [("/1/new.exe", len(build(32, [2], 3)), "exe", "32", 2, 3)]
    recorded = rows(current_ledger(options["ledger"].read(spark, LEDGER_SCHEMA)))
    assert recorded == sorted((r[:3] for r in stored), key=repr)


def test_files_of_the_ledger_are_left_out(spark, store):  # noqa: F811
    store.run(spark, 10, batch=1)
    filled = [p for p, v in store.files.items() if v[0]]
    done = len([r for r in store.recorded(spark) if r[1]])
    got = run_stream(spark, store.roots, results=store.results, ledger=store.ledger, checkpoint=f"{store.folder}/c", first_batch=100)
    assert got == len(filled) - done


class Failing(ParquetTable):
    def append(self, df):
        raise RuntimeError("store is gone")


def test_a_failed_batch_is_done_again(spark, store):  # noqa: F811
    """Results are stored, the ledger is not: the next run records without storing twice."""
    options = {"results": store.results, "checkpoint": f"{store.folder}/checkpoint"}
    with pytest.raises(Exception, match="store is gone"):
        run_stream(spark, store.roots, ledger=Failing(store.ledger.path), **options)
    stored = store.stored(spark)
    assert stored and store.recorded(spark) == []
    run_stream(spark, store.roots, ledger=store.ledger, **options)
    assert store.stored(spark) == stored and store.recorded(spark) == sorted((r[:3] for r in stored), key=repr)
