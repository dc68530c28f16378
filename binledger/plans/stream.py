"""The job as a stream that ends when all files there are have been done."""

from pyspark.sql import SparkSession

from binledger.operators.headers import HEADER_LIMIT
from binledger.operators.ledger import current_ledger, drop_processed
from binledger.plans.batch import extract_batch, readable_rows, store_batch, write_counted
from binledger.schemas import CATALOG_COLUMNS, CATALOG_SCHEMA, LEDGER_SCHEMA
from binledger.sources.clustered import ClusteredLedger
from binledger.sources.files import file_stream
from binledger.sources.folders import shared_folder
from binledger.sources.tables import ParquetTable


def run_stream(
    spark: SparkSession,
    roots,
    *,
    results,
    ledger,
    checkpoint: str,
    base: str | None = None,
    first_batch: int = 0,
    strict_headers: bool = True,
    glob: str = "*.???",
    filesystem=None,
    header_limit: int | None = HEADER_LIMIT,
    max_files: int | None = None,
    unreadable: float = 0.01,
) -> int:
    """Process every file below ``roots`` that neither an earlier run nor the ledger has, and
    return their number. Ends when there are no more; the next call with the same
    ``checkpoint`` folder goes on with what came since.

    ``max_files`` of each root make a batch; its number is ``first_batch`` and the count of
    batches of the checkpoint. A batch that failed is done again under its number: rows
    already there are left out, or written over (``BatchTable``, ``ClusteredLedger``).

    The stream knows files by their paths: one that changes after it was seen is left out, as
    ``on_change='skip'`` of ``run_batch`` does. Files that could not be read, and those of
    zero bytes, are not recorded, so ``run_batch`` finds them. Further arguments are those of
    ``run_batch``.
    """
    if base is None:
        base = list(roots)[0].rstrip("/").rsplit("/", 1)[0]
    done = []

    def process(files, epoch):
        session, batch = files.sparkSession, first_batch + epoch
        listed = ParquetTable(shared_folder(spark, f"stream-{batch}-files"))
        if not write_counted(files.select(CATALOG_COLUMNS), listed.path):
            return
        files = listed.read(session, CATALOG_SCHEMA)
        known = ledger.read_for(files) if isinstance(ledger, ClusteredLedger) else ledger.read(session, LEDGER_SCHEMA)
        # What this batch recorded before it failed is not known yet to its second try.
        known = current_ledger(known.filter(known["batch"] != batch))
        chosen = ParquetTable(shared_folder(spark, f"stream-{batch}-chosen"))
        n = write_counted(drop_processed(files, known), chosen.path)
        folder = shared_folder(spark, f"stream-{batch}")
        extract_batch(chosen.read(session, CATALOG_SCHEMA), n, folder, base, filesystem, strict_headers, header_limit)
        rows, clean = readable_rows(session, folder, unreadable)
        store_batch(session, rows, batch, ledger=ledger, results=results, row_rules=not clean)
        done.append(n)

    stream = file_stream(spark, roots, glob, base, max_files)
    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()
    return sum(done)
