"""Exact, repeatable samples with the same number of files of each class."""

from dataclasses import dataclass
from functools import reduce
from operator import or_
from os.path import commonprefix

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from binledger.operators.copies import count_copies, repeat_rows

# Characters of the order key by which one pass tells rows apart: at most 17^3 groups.
_STEP = 3
# Rows of a class among which the last one may be found by comparing their keys.
_FEW = 4096


@dataclass
class _Cut:
    """Where a class ends. The last row taken has a key that starts with ``prefix``; ``below``
    rows come before those. Once settled it is a whole key, of whose rows ``copies`` are
    taken, all of them if None; without a prefix then, the class is taken whole."""

    prefix: str = ""
    below: int = 0
    files: int = -1
    length: int = _STEP
    settled: bool = False
    copies: int | None = None


def balanced_sample(
    df: DataFrame, n: int = 100, seed: int = 42, strict: bool = True, classes: tuple = (0, 1)
) -> DataFrame:
    """``n // 2`` rows per class without replacement, the first ones by md5(seed:path), then
    by their columns; equal rows count as often as they occur. An odd ``n`` gives ``n - 1``
    rows.

    With ``strict`` a class with too few rows raises ValueError; otherwise all its rows are
    taken.

    Nothing is ranked. Small jobs count rows by ever longer prefixes of the order key until
    few rows are left around the last one taken; their keys tell where the class ends. They
    run right away; what comes back is a filter, so rows are neither shuffled nor sorted,
    whatever one path or class has. The few rows of the last key are copies of one row, of
    which as many as needed are taken.
    """
    if n < 0:
        raise ValueError(f"n must not be negative: {n}")
    k = n // len(classes)
    if k == 0:
        return df.filter(F.lit(False))

    keyed = df.filter(F.col("class").isin(*classes)).withColumn("_key", _order_key(df, seed))
    cuts = {c: _Cut() for c in classes}
    totals = _narrow(keyed, cuts, k)
    short = {c: totals.get(c, 0) for c in classes if totals.get(c, 0) < k}
    if strict and short:
        raise ValueError(f"sample of {k} files larger than class (class: files): {short}")
    while not all(cut.settled for cut in cuts.values()):
        _narrow(keyed, cuts, k)

    keep = [F.col(f"`{c}`") for c in df.columns]
    key, taken, parted = F.col("_key"), [], {}
    for c, cut in cuts.items():
        inside = F.lit(True) if not cut.prefix else key < cut.prefix if cut.copies else key <= cut.prefix
        taken.append((F.col("class") == c) & inside)
        if cut.copies:
            parted[c] = cut
    sample = keyed.filter(reduce(or_, taken)).select(keep)
    if parted:
        some = keyed.filter(reduce(or_, [(F.col("class") == c) & (key == cut.prefix) for c, cut in parted.items()]))
        copies = F.coalesce(*[F.when(F.col("class") == c, F.lit(cut.copies)) for c, cut in parted.items()])
        sample = sample.union(repeat_rows(count_copies(some.drop("_key")).withColumn("_copies", copies)).select(keep))
    return sample


def _order_key(df, seed):
    """Text that orders rows by md5, then by their columns with missing values first, and is
    equal for equal rows only. The path, which the md5 stands for, is not spelled out."""
    parts = [F.expr(f"md5(concat('{int(seed)}:', coalesce(path, '')))"), F.when(F.col("path").isNull(), "0").otherwise("1")]
    for field in df.schema.fields:
        if field.name in ("path", "class"):
            continue
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            # As unsigned hexadecimal digits, the smallest number first.
            spelled = F.lpad(F.hex(value.cast("bigint").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
        else:
            spelled = F.concat(F.hex(value.cast("binary" if isinstance(field.dataType, T.BinaryType) else "string")), F.lit("."))
        parts.append(F.coalesce(F.concat(F.lit("1"), spelled), F.lit("0")))
    return F.concat(*parts)


def _narrow(keyed, cuts, k):
    """Finds for each open class the group of keys of one longer prefix that holds row
    ``k``. Gives the rows of each class that were looked at."""
    open_cuts = {c: cut for c, cut in cuts.items() if not cut.settled}
    near = [(F.col("class") == c) & F.col("_key").startswith(cut.prefix) for c, cut in open_cuts.items()]
    prefix = F.coalesce(*[F.when(F.col("class") == c, F.substring("_key", 1, cut.length)) for c, cut in open_cuts.items()])
    groups = keyed.filter(reduce(or_, near)).groupBy("class", prefix.alias("prefix")).agg(F.count("*").alias("files"))
    found = groups.collect()  # 17^3 of a class at most
    totals = {c: sum(r["files"] for r in found if r["class"] == c) for c in open_cuts}
    for c, cut in open_cuts.items():
        own = sorted((r["prefix"], r["files"]) for r in found if r["class"] == c)
        if cut.below + totals[c] <= k:
            cut.settled = True
            continue
        before = cut.files
        for cut.prefix, cut.files in own:
            if cut.below + cut.files >= k:
                break
            cut.below += cut.files
        here = keyed.filter((F.col("class") == c) & F.col("_key").startswith(cut.prefix))
        if cut.files == before:
            # All keys go on alike: to the place where they part.
            ends = here.agg(F.min("_key"), F.max("_key")).first()
            cut.prefix = commonprefix(list(ends))
            few = ends[0] == ends[1]
        else:
            few = cut.files <= _FEW
        if few:
            _settle(here, cut, k)
        cut.length = len(cut.prefix) + _STEP
    return totals


def _settle(here, cut, k):
    """The key of row ``k`` among a few different ones."""
    for key, files in sorted(map(tuple, here.groupBy("_key").agg(F.count("*")).collect())):
        if cut.below + files >= k:
            cut.prefix, cut.settled = key, True
            cut.copies = None if cut.below + files == k else k - cut.below
            return
        cut.below += files
    raise RuntimeError("the rows changed while the sample was drawn")
