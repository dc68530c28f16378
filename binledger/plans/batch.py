"""The whole job: choose files not done yet, extract, store, record."""

import hashlib
import re
import time
import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from binledger.operators.catalog import distinct_files
from binledger.operators.checks import check_results, watch_rules
from binledger.operators.extract import extract_from_store
from binledger.operators.headers import HEADER_LIMIT
from binledger.operators.ledger import append_ledger, current_ledger, drop_known_paths, drop_processed, rows_for_batch
from binledger.operators.sample import balanced_sample
from binledger.plans.spread import spread
from binledger.schemas import CATALOG_COLUMNS, CATALOG_SCHEMA, LEDGER_SCHEMA, LISTING_SCHEMA, RESULT_COLUMNS, RESULT_SCHEMA
from binledger.sources.clustered import ClusteredLedger
from binledger.sources.files import file_catalog
from binledger.sources.folders import exists, rename, shared_folder, subfolders
from binledger.sources.tables import ParquetTable


class BatchRejected(ValueError):
    """The batch breaks constraints of the results table."""


class TooManyUnreadable(OSError):
    """More files of the batch could not be read than is allowed."""


def choose_files(
    catalog: DataFrame,
    ledger: DataFrame | ClusteredLedger,
    n: int = 100,
    seed: int = 42,
    strict: bool = True,
    on_change: str = "process",
) -> DataFrame:
    """path, size, type of the files of a balanced sample that the ledger does
    not hold. ``ledger`` may be the log of all batches or path, size, type only, or a
    ``ClusteredLedger``, of which only the buckets of the sample are read.

    ``on_change`` says what happens to a recorded file whose size changed:
    ``'process'`` chooses it again, ``'skip'`` leaves it out.
    """
    if on_change not in ("process", "skip"):
        raise ValueError(f"on_change must be 'process' or 'skip': {on_change}")
    picked = balanced_sample(catalog, n, seed, strict).select(CATALOG_COLUMNS)
    if isinstance(ledger, ClusteredLedger):
        # Drawn once: for its buckets, and to be compared.
        drawn = ParquetTable(shared_folder(catalog.sparkSession, "picked"))
        drawn.append(picked)
        picked = drawn.read(catalog.sparkSession, CATALOG_SCHEMA)
        ledger = ledger.read_for(picked)
    if on_change == "skip":
        return drop_known_paths(distinct_files(picked), ledger, "skip", max_rows=n, sampled=True)
    # The difference is one of sets: it drops copies as well.
    known = rows_for_batch(ledger, picked, n, sampled=True)
    if "batch" in ledger.columns:
        known = current_ledger(known)
    return drop_processed(picked, known)


def run_batch(
    spark: SparkSession,
    roots=(),
    n: int = 100,
    *,
    results,
    ledger=None,
    base: str | None = None,
    batch: int | None = None,
    seed: int | None = None,
    strict: bool = True,
    strict_headers: bool = True,
    on_change: str = "process",
    glob: str = "*.???",
    filesystem=None,
    staging: str | None = None,
    catalog: DataFrame | None = None,
    header_limit: int | None = HEADER_LIMIT,
    unreadable: float = 0.01,
) -> DataFrame:
    """Process up to ``n`` files below ``roots`` and return their result rows.

    ``catalog`` gives the files instead, as path, size, type, class, e.g. from
    ``describe_files`` over an inventory table; ``base`` is needed then.

    ``results`` and ``ledger`` are tables (``ParquetTable``, ``JdbcTable``); without a
    ledger, files in the results table count as done. With ``BatchTable`` and
    ``ClusteredLedger`` appends may be repeated, and only a part of the ledger is read.
    ``base`` is the folder or bucket the paths start in, by default the parent
    of the first root.

    The listing and the extracted rows are written once to a staging folder, below
    ``spark.checkpoint.dir`` unless ``staging`` names another; the rows are
    checked there, and both tables filled from them. The same call with the same ``batch``
    after a failure goes on from the staged rows and appends only what is
    missing in each table.

    ``seed`` defaults to the batch number, so later batches draw other files.

    A file that cannot be read, for instance since it was deleted after it was listed,
    is put aside with the reason (``unreadable_files``), stored and recorded nowhere, and
    so chosen again by a later batch. More than the share ``unreadable`` of the files, and
    more than one, raise TooManyUnreadable with nothing appended.

    Raises BatchRejected, with nothing appended, if a row breaks a constraint of
    the results table; the violations are a table beside the staged rows. A changed file chosen again does: its path is stored
    already. ``on_change='skip'`` avoids that.
    """
    batch = time.time_ns() // 1_000_000 if batch is None else batch
    seed = batch if seed is None else seed
    if base is None:
        base = list(roots)[0].rstrip("/").rsplit("/", 1)[0]
    wanted = (
        list(roots), base, glob, n, seed, strict, strict_headers, on_change, results.location, ledger and ledger.location,
        _name_of(filesystem), None if catalog is None else _fingerprint(catalog), header_limit,
    )
    staged = f"{_staging_folder(spark, staging)}/{batch}-{_digest(wanted)}"
    resume = _is_complete(spark, staged)
    if not resume:
        if catalog is None:
            # Listed once; the sample takes passes over it.
            listing = ParquetTable(staged + "-files")
            file_catalog(spark, roots, glob, base, filesystem=filesystem).write.mode("overwrite").parquet(listing.path)
            catalog = listing.read(spark, LISTING_SCHEMA)
        picked = ParquetTable(staged + "-chosen")
        done = _recorded(spark, ledger, results)
        chosen = choose_files(catalog, done, n, seed, strict, on_change)
        n_files = write_counted(chosen, picked.path)
        extract_batch(picked.read(spark, CATALOG_SCHEMA), n_files, staged, base, filesystem, strict_headers, header_limit)
    rows, clean = readable_rows(spark, staged, unreadable)
    violations = staged + "-violations"
    store_batch(
        spark, rows, batch, ledger=ledger, results=results, max_rows=n, resume=resume, violations=violations, row_rules=not clean
    )
    return rows


def write_counted(df: DataFrame, folder: str) -> int:
    """Writes rows and counts them in the same job."""
    counted = Observation()
    df.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(folder)
    return counted.get["rows"]


def extract_batch(files, n_files, folder, base, filesystem=None, strict_headers=True, header_limit=HEADER_LIMIT) -> None:
    """Reads ``n_files`` files once and writes result rows, and those of unreadable files,
    below ``folder``, with what is counted of them in the same job beside it."""
    spark, counted = files.sparkSession, Observation()
    parsed = extract_from_store(spread(files, n_files), base, filesystem, strict_headers, header_limit=header_limit, errors=True)
    parsed = parsed.withColumn("readable", F.col("error").isNull())
    watched = watch_rules(parsed, counted, F.col("readable"), unreadable=~F.col("readable"), files=F.lit(True))
    watched.write.mode("overwrite").partitionBy("readable").parquet(folder)
    found = spark.createDataFrame(list(counted.get.items()), "name string, n long")
    found.coalesce(1).write.mode("overwrite").parquet(folder + "-counts")


def readable_rows(spark: SparkSession, folder: str, unreadable: float) -> tuple[DataFrame, bool]:
    """Result rows of the files that could be read, and whether the job that wrote them
    counted no broken rule of one row. Too many unreadable files raise, and are read
    again by the next call."""
    found = {}
    if exists(spark, folder + "-counts/_SUCCESS"):
        found = {r["name"]: r["n"] for r in spark.read.schema("name string, n long").parquet(folder + "-counts").collect()}
    if not found:  # the job ended between the two writes
        n_files, lost = _staged(spark, folder).agg(F.count("*"), F.count_if(~F.col("readable"))).first()
        found = {"files": n_files, "unreadable": lost, "not counted": 1}
    lost, n_files = found.pop("unreadable"), found.pop("files")
    if lost > max(unreadable * n_files, 1):
        rename(spark, folder + "/_SUCCESS", folder + "/_REJECTED")
        raise TooManyUnreadable(f"{lost} of {n_files} files could not be read; see {folder}")
    return _staged(spark, folder).filter("readable").select(RESULT_COLUMNS), not any(found.values())


def _staged(spark, folder):
    schema = T.StructType([*RESULT_SCHEMA.fields]).add("error", "string").add("readable", "boolean")
    return spark.read.schema(schema).parquet(folder)


def unreadable_files(spark: SparkSession, batch: int, staging: str | None = None) -> DataFrame:
    """path, size, type, error of the files of a batch that could not be read."""
    folder = _staging_folder(spark, staging)
    names = [f for f in subfolders(spark, folder) if re.fullmatch(f"{batch}-[0-9a-f]{{16}}", f.rsplit("/", 1)[-1])]
    found = [_staged(spark, f) for f in names if exists(spark, f"{f}/_SUCCESS") or exists(spark, f"{f}/_REJECTED")]
    if not found:
        return spark.createDataFrame([], T.StructType([*CATALOG_SCHEMA.fields]).add("error", "string"))
    return reduce(DataFrame.unionByName, found).filter("not readable").select(*CATALOG_COLUMNS, "error")


def store_batch(
    spark: SparkSession,
    rows: DataFrame,
    batch: int,
    *,
    ledger,
    results,
    max_rows: int | None = None,
    resume: bool = True,
    violations: str | None = None,
    row_rules: bool = True,
) -> None:
    """Check result rows, held in a table of their own, and append them to the
    results and the ledger. ``resume`` leaves out what is there already;
    ``max_rows`` as in ``rows_for_batch``. All violations are written to the folder
    ``violations``, by default a new one; the error names it and counts them."""
    # A table of batches is written over, so nothing is left out, or compared with itself.
    by_batch = hasattr(results, "append_batch")
    stored = results.read(spark, RESULT_SCHEMA, but=batch) if by_batch else results.read(spark, RESULT_SCHEMA)
    fresh = drop_processed(rows, stored, max_rows, RESULT_COLUMNS) if resume and not by_batch else rows
    found = ParquetTable(violations or f"{_staging_folder(spark, None)}/{batch}-{uuid.uuid4().hex}-violations")
    check_results(fresh, stored, max_rows, row_rules).write.mode("overwrite").parquet(found.path)
    broken = spark.read.schema("path string, rule string, n_rows long").parquet(found.path)
    counts = broken.groupBy("rule").agg(F.sum("n_rows").alias("n")).orderBy("rule").collect()  # one row per rule
    if counts:
        raise BatchRejected("; ".join(f"{c['rule']}: {c['n']} rows" for c in counts) + f"; see {found.path}")
    results.append_batch(fresh, batch) if by_batch else results.append(fresh)
    if ledger is not None:
        files = rows.select(CATALOG_COLUMNS)
        if resume and not isinstance(ledger, ClusteredLedger):
            files = drop_processed(files, current_ledger(rows_for_batch(_log(spark, ledger), files, max_rows)))
        append_ledger(files, ledger, batch)


def _log(spark, ledger):
    return ledger.read(spark, LEDGER_SCHEMA)


def _recorded(spark, ledger, results):
    """The ledger's log, or the ledger if it is clustered; without one the results table
    serves as one."""
    if isinstance(ledger, ClusteredLedger):
        return ledger
    return results.read(spark, RESULT_SCHEMA).select(CATALOG_COLUMNS) if ledger is None else _log(spark, ledger)


def repair_ledger(spark: SparkSession, batch: int, *, ledger, results) -> None:
    """Record every stored result the ledger misses, e.g. after a run of another
    tool, or a failure between the two appends with the staged rows lost."""
    done = results.read(spark, RESULT_SCHEMA).select(CATALOG_COLUMNS)
    append_ledger(drop_processed(done, current_ledger(_log(spark, ledger))), ledger, batch)


def _staging_folder(spark, staging):
    folder = staging or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a shared folder, or pass staging")
    return folder.rstrip("/") + "/batches"


def _fingerprint(catalog):
    """Tells catalogues apart, in whatever order their rows come."""
    columns = [c for c in LISTING_SCHEMA.names if c in catalog.columns]
    total = F.sum(F.xxhash64(*columns).cast("decimal(38,0)"))
    return [str(x) for x in catalog.agg(F.count("*"), total).first()]


def _name_of(filesystem):
    return filesystem and f"{filesystem.__module__}.{filesystem.__qualname__}"


def _digest(value):
    return hashlib.md5(repr(value).encode()).hexdigest()[:16]


def _is_complete(spark, folder):
    return exists(spark, folder + "/_SUCCESS")
