"""Equal rows counted together for a shuffle, and written out again after it."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_AT_ONCE = 65_536


def count_copies(df: DataFrame, name: str = "_copies") -> DataFrame:
    """Distinct rows and how often each occurs. Copies are counted before the
    shuffle, so a row that occurs very often is one row per task."""
    return df.groupBy(*df.columns).agg(F.count("*").alias(name))


def repeat_rows(df: DataFrame, times: str = "_copies") -> DataFrame:
    """Each row ``times`` times, without that column; in pieces, so that no array
    grows with the number."""
    keep = [f"`{c}`" for c in df.columns if c != times]
    pieces = df.selectExpr("*", f"explode(sequence(0, ({times} - 1) div {_AT_ONCE})) as _piece")
    return pieces.selectExpr(
        *keep, f"explode(sequence(1, least({_AT_ONCE}, {times} - _piece * {_AT_ONCE}))) as _copy"
    ).select(keep)
