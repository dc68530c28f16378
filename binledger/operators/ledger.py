"""Files done before: difference with the ledger and its upkeep."""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binledger.operators.copies import count_copies, repeat_rows
from binledger.schemas import BROADCAST_MAX_ROWS, CATALOG_COLUMNS

_LANES = 64


def _is_small(batch, max_rows, sampled=False):
    """Whether the batch may be broadcast: the caller's bound is no larger than
    ``BROADCAST_MAX_ROWS``, and holds, which a small job counts unless the batch is a
    sample of that size by its making."""
    if max_rows is None or max_rows > BROADCAST_MAX_ROWS:
        return False
    return sampled or batch.limit(max_rows + 1).count() <= max_rows


def rows_for_batch(table: DataFrame, batch: DataFrame, max_rows: int | None, sampled: bool = False) -> DataFrame:
    """The rows of a big table that share a path with the batch.

    Up to ``max_rows`` rows, if that is small and the batch keeps to it
    (``_is_small``), the batch's paths are broadcast, so the table is read but not
    shuffled; else the table is returned as it is and the caller's shuffle does the
    matching.
    """
    if not _is_small(batch, max_rows, sampled):
        return table
    paths = batch.select(F.col("path").alias("_batch_path")).distinct()
    return table.join(F.broadcast(paths), table["path"].eqNullSafe(F.col("_batch_path")), "left_semi")


def drop_processed(
    df: DataFrame, ledger: DataFrame, max_rows: int | None = None, columns=tuple(CATALOG_COLUMNS)
) -> DataFrame:
    """EXCEPT DISTINCT on path, size, type; NULL equals NULL. A file whose size
    changed since it was recorded stays.

    Both sides go through one aggregation that combines equal rows before the
    shuffle, so a file recorded or listed very often costs one row per task.
    """
    columns = list(columns)
    known = rows_for_batch(ledger, df, max_rows).select(columns).withColumn("_known", F.lit(True))
    both = df.select(columns).withColumn("_known", F.lit(False)).unionByName(known)
    return both.groupBy(columns).agg(F.max("_known").alias("_known")).filter(~F.col("_known")).select(columns)


def drop_known_paths(
    df: DataFrame, ledger: DataFrame, on_change: str = "skip", max_rows: int | None = None, sampled: bool = False
) -> DataFrame:
    """Rows of ``df`` not recorded yet, duplicates kept: a test by key, file by file.

    ``on_change='skip'`` goes by path alone, so a recorded file whose size
    changed is dropped too. ``'replace'`` goes by path, size and type, so that
    file passes and can be processed again.

    Copies of a row are counted together before the join and written out after
    it, and ledger keys are made distinct. If one path still fills a partition
    of ``df``, with many sizes, adaptive execution splits it; it does so only if
    both join inputs come straight from an exchange, which the lane in the
    distinct brings about: keys spread by key and lane must be exchanged again.
    """
    if on_change not in ("skip", "replace"):
        raise ValueError(f"on_change must be 'skip' or 'replace': {on_change}")
    keys = ["path"] if on_change == "skip" else CATALOG_COLUMNS
    lane = F.pmod(F.xxhash64(*keys), F.lit(_LANES)).alias("_lane")
    known = rows_for_batch(ledger, df, max_rows, sampled).select(*[F.col(c).alias(f"_known_{c}") for c in keys], lane)
    known = known.distinct().drop("_lane")
    if on_change == "skip":
        same = F.col("path") == F.col("_known_path")
    else:
        same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_known_{c}")) for c in keys])
    if on_change == "skip" and _is_small(df, max_rows, sampled):
        # Distinct paths of the batch: no more than its rows.
        return df.join(F.broadcast(known), same, "left_anti")
    return repeat_rows(count_copies(df).join(known, same, "left_anti"))


def newest_rows(ledger: DataFrame) -> DataFrame:
    """path, size, type, batch of the newest batch of each path; in the same batch the
    largest size, then type."""
    newest = F.max(F.struct("batch", "size", "type")).alias("_newest")
    return ledger.groupBy("path").agg(newest).select("path", "_newest.size", "_newest.type", "_newest.batch")


def current_ledger(ledger: DataFrame) -> DataFrame:
    """path, size, type of ``newest_rows``."""
    return newest_rows(ledger).select(CATALOG_COLUMNS)


def append_ledger(df: DataFrame, ledger, batch: int) -> None:
    """Record path, size, type under a batch number, in a table with ``append``."""
    ledger.append(df.select(*CATALOG_COLUMNS, F.lit(batch).cast("bigint").alias("batch")))
