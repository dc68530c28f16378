"""Constraints of the results table, checked before a batch is appended."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from binledger.operators.ledger import rows_for_batch

# Limits of the results table's columns.
MAX_PATH = 255
MAX_TYPE = 3
ARCHITECTURES = ["32", "64"]

RULES = [
    "path_missing",
    "path_too_long",
    "size_missing",
    "type_missing",
    "type_too_long",
    "architecture_unknown",
    "path_repeated",
    "path_stored_already",
]


def _row_rules():
    """The rules that one row breaks by itself."""
    breaks = {
        "path_missing": F.col("path").isNull(),
        "path_too_long": F.char_length("path") > MAX_PATH,
        "size_missing": F.col("size").isNull(),
        "type_missing": F.col("type").isNull(),
        "type_too_long": F.char_length("type") > MAX_TYPE,
        "architecture_unknown": ~F.col("architecture").isin(ARCHITECTURES),
    }
    return {rule: F.coalesce(broken, F.lit(False)) for rule, broken in breaks.items()}


def watch_rules(df: DataFrame, observation: Observation, only=None, **counts) -> DataFrame:
    """``df``, whose next job also counts the rows that break each rule of one row, those
    that ``only`` holds for, and further ``counts``; the observation has the numbers then."""
    rules = {rule: broken if only is None else broken & only for rule, broken in _row_rules().items()}
    return df.observe(observation, *[F.count_if(c).alias(name) for name, c in (rules | counts).items()])


def check_results(
    df: DataFrame, target: DataFrame | None = None, max_rows: int | None = None, row_rules: bool = True
) -> DataFrame:
    """Violations as path, rule, n_rows (rows of the path that break the rule);
    empty if the batch may be appended to ``target``. ``max_rows`` as in
    ``rows_for_batch``. One aggregation by path finds all of them. Without ``row_rules``
    only what needs other rows is looked at, and of ``df`` only the paths: for a batch
    whose rows were counted as they were written (``watch_rules``)."""
    breaks = _row_rules() if row_rules else {}
    flags = {rule: broken.cast("bigint").alias(rule) for rule, broken in breaks.items()}
    rows = df.select("path", *flags.values(), F.lit(1).cast("bigint").alias("_rows"), F.lit(False).alias("_stored"))
    if target is not None:
        stored = rows_for_batch(target, df, max_rows).select(
            "path",
            *[F.lit(0).cast("bigint").alias(rule) for rule in flags],
            F.lit(0).cast("bigint").alias("_rows"),
            F.lit(True).alias("_stored"),
        )
        rows = rows.unionByName(stored)
    per_path = rows.groupBy("path").agg(
        *[F.sum(rule).alias(rule) for rule in flags],
        F.sum("_rows").alias("_rows"),
        F.max("_stored").alias("_stored"),
    )
    named = F.col("path").isNotNull()
    n_rows = F.col("_rows")
    counts = {rule: F.col(rule) for rule in flags} | {
        "path_repeated": F.when(named & (n_rows > 1), n_rows).otherwise(0),
        "path_stored_already": F.when(named & F.col("_stored"), n_rows).otherwise(0),
    }
    found = F.array(*[F.struct(F.lit(rule).alias("rule"), counts[rule].alias("n_rows")) for rule in RULES if rule in counts])
    return (
        per_path.filter(n_rows > 0)
        .select("path", F.inline(F.filter(found, lambda v: v["n_rows"] > 0)))
    )
