"""Filters, projections and reports over catalogue rows."""

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binledger.functions.globs import compile_glob
from binledger.schemas import CATALOG_COLUMNS


def glob_files(df: DataFrame, glob: str) -> DataFrame:
    """Rows whose whole path matches the glob, e.g. ``/?/*.???`` or ``/{0,1}/[a-f]*.exe``
    (see ``compile_glob``). What all matches start with goes to the scan as a filter of its
    own, so a catalogue sorted by path is read in part."""
    pattern = compile_glob(glob)
    path = F.col("path")
    if pattern.literal:
        return df.filter(path.isin(list(pattern.prefixes)))
    matches = path.rlike(f"\\A{pattern.regex}\\z")
    if "" not in pattern.prefixes:
        matches = reduce(or_, [path.startswith(p) for p in pattern.prefixes]) & matches
    return df.filter(matches)


def path_parts(df: DataFrame) -> DataFrame:
    """Add dir, name and extension. The extension is ``''`` for a name without dot
    or with leading dots only (``.profile``)."""
    base = F.element_at(F.split("path", "/"), -1)
    head = F.expr("left(path, length(path) - length(element_at(split(path, '/'), -1)))")
    with_dot = "(?s)^([.]*[^.].*)[.]([^.]*)$"
    return (
        df.withColumn("dir", F.when(head.rlike("^/*$"), head).otherwise(F.rtrim(head, F.lit("/"))))
        .withColumn("name", F.when(base.rlike(with_dot), F.regexp_extract(base, with_dot, 1)).otherwise(base))
        .withColumn("extension", F.regexp_extract(base, with_dot, 2))
    )


def distinct_files(df: DataFrame) -> DataFrame:
    """Distinct path, size, type."""
    return df.select(CATALOG_COLUMNS).distinct()


def union_files(a: DataFrame, b: DataFrame) -> DataFrame:
    """All rows of both, duplicates kept."""
    return a.unionByName(b)


def class_counts(df: DataFrame) -> DataFrame:
    """Files and bytes per class and type."""
    return df.groupBy("class", "type").agg(
        F.count("*").alias("files"), F.sum("size").cast("bigint").alias("bytes")
    )


def smallest_files(df: DataFrame, k: int = 20) -> DataFrame:
    """The first ``k`` files by size, then path: a report for the eye."""
    return df.orderBy("size", "path", "type").limit(k)
