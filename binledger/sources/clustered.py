"""A ledger clustered by path: dealt into buckets, so that a batch reads only its own.

    <folder>/appends/batch=<n>/bucket=<b>/     what each batch recorded
    <folder>/snapshots/<version>/bucket=<b>/   newest row of each path, sorted by path
    <folder>/sketches/batch=<n>/               Bloom filters of the paths of a batch
    <folder>/sketches-of/<version>/            those of a snapshot

A batch is written over partitions of its own, so the same append again leaves the same
rows. ``compact`` merges the newest snapshot with the appends into the next one.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from binledger.operators.ledger import drop_known_paths, newest_rows
from binledger.schemas import LEDGER_SCHEMA
from binledger.sources.folders import exists, remove, shared_folder, subfolders

# A block of a Bloom filter is one value of Spark's bitmap functions.
_BLOCK_BITS = 32_768
_PROBES = 6
_STORED = T.StructType([*LEDGER_SCHEMA.fields, T.StructField("bucket", T.IntegerType())])


def bucket_of(path, buckets: int) -> Column:
    """Bucket of a path; a missing path has one like any other."""
    return F.pmod(F.xxhash64(path), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class ClusteredLedger:
    """A ledger in a folder of Parquet files that all executors share.

    ``buckets`` is fixed when the ledger is made: reading for n files opens at most n of
    them. ``blocks`` sizes the sketch: Bloom filter blocks of 4 KiB in each bucket, enough
    for some 3,000 paths a block at about one false hit in a hundred. One job writes at a time.
    """

    folder: str
    buckets: int = 1024
    blocks: int = 1

    @property
    def location(self) -> str:
        return self.folder

    # -- writing

    def append(self, df: DataFrame) -> None:
        """Record path, size, type, batch. All rows of a batch come in one call; the same
        call again, also after a half-done one, leaves the same rows."""
        rows = df.select(LEDGER_SCHEMA.names).withColumn("bucket", bucket_of("path", self.buckets))
        # One task writes a bucket, and opens one file in it for each batch.
        dealt = rows.repartition("bucket").sortWithinPartitions("batch", "bucket", "path")
        _over_partitions(dealt, f"{self.folder}/appends", "batch", "bucket")
        _over_partitions(self._sketch(rows, "batch"), f"{self.folder}/sketches", "batch")

    def compact(self, spark: SparkSession, least_share: float = 0.0) -> bool:
        """Merge snapshot and appends into a new snapshot: the newest row of each path,
        as ``current_ledger`` has them, with its batch. Tells whether it did: appends of
        fewer rows than ``least_share`` of the snapshot are left for later, so that the
        snapshot is not rewritten for little. The snapshot before stays for jobs that
        still read it; the next compaction removes it.
        """
        batches = subfolders(spark, f"{self.folder}/appends")
        if not batches:
            return False
        versions = self._versions(spark)
        if versions and least_share:
            added = self._appends(spark).count()
            if added < least_share * self._snapshot(spark, versions[-1]).count():
                return False
        version = versions[-1] + 1 if versions else 1
        rows = newest_rows(self.read(spark, LEDGER_SCHEMA)).withColumn("bucket", bucket_of("path", self.buckets))
        dealt = rows.repartition("bucket").sortWithinPartitions("bucket", "path")
        # The sketch first: a version counts once its rows are complete.
        self._sketch(rows).write.mode("overwrite").parquet(f"{self.folder}/sketches-of/{version}")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(self._version(version))
        sketches = subfolders(spark, f"{self.folder}/sketches")
        done = {name.rsplit("/", 1)[-1] for name in batches}
        remove(spark, batches + [s for s in sketches if s.rsplit("/", 1)[-1] in done])
        for old in versions[:-1]:
            remove(spark, [self._version(old), f"{self.folder}/sketches-of/{old}"])
        return True

    # -- reading

    def read(self, spark: SparkSession, schema: T.StructType = LEDGER_SCHEMA, buckets=None) -> DataFrame:
        """The log: rows of the newest snapshot and of all appends since, also twice if a
        compaction was cut short. ``buckets`` reads only the folders of these."""
        parts = [self._snapshot(spark, v) for v in self._versions(spark)[-1:]]
        if exists(spark, f"{self.folder}/appends"):
            parts.append(self._appends(spark))
        if buckets is not None:
            parts = [p.filter(F.col("bucket").isin(sorted(buckets))) for p in parts]
        if not parts:
            return spark.createDataFrame([], schema)
        return reduce(DataFrame.unionByName, parts).select(schema.names)

    def read_for(self, df: DataFrame, schema: T.StructType = LEDGER_SCHEMA) -> DataFrame:
        """The log of the buckets that the paths of ``df`` fall in. At most one number per
        bucket comes to the driver."""
        numbers = df.select(bucket_of("path", self.buckets).alias("bucket")).distinct().collect()
        return self.read(df.sparkSession, schema, [row["bucket"] for row in numbers])

    def maybe_known(self, df: DataFrame) -> DataFrame:
        """``df`` with the column ``maybe_known``: false means that no row of the ledger has
        the path. Reads the Bloom filters only, those of the buckets of ``df``."""
        spark = df.sparkSession
        hashed = df.withColumn("_bucket", bucket_of("path", self.buckets)).withColumn("_block", self._block())
        numbers = [row["_bucket"] for row in hashed.select("_bucket").distinct().collect()]
        blocks = self._blocks(spark, numbers)
        same = (hashed["_bucket"] == blocks["bucket"]) & (hashed["_block"] == blocks["block"])
        probed = [_bit_is_set("bits", place) for place in self._places()]
        hit = F.coalesce(reduce(Column.__and__, probed), F.lit(False))
        return hashed.join(blocks, same, "left").select(*[F.col(f"`{c}`") for c in df.columns], hit.alias("maybe_known"))

    def files(self, spark: SparkSession) -> int:
        """Files of rows that a whole read opens."""
        return len(self.read(spark).inputFiles())

    # -- parts

    def _version(self, version):
        return f"{self.folder}/snapshots/{version}"

    def _versions(self, spark):
        found = [f for f in subfolders(spark, f"{self.folder}/snapshots") if exists(spark, f"{f}/_SUCCESS")]
        return sorted(int(f.rsplit("/", 1)[-1]) for f in found)

    def _snapshot(self, spark, version):
        return spark.read.schema(_STORED).parquet(self._version(version))

    def _appends(self, spark):
        return spark.read.schema(_STORED).parquet(f"{self.folder}/appends")

    def _block(self):
        return F.pmod(F.xxhash64("path", F.lit("block")), F.lit(self.blocks)).cast("int")

    def _places(self):
        """Bits of a path in its block."""
        return [F.pmod(F.xxhash64("path", F.lit(i)), F.lit(_BLOCK_BITS)) for i in range(_PROBES)]

    def _sketch(self, rows, *by):
        place = F.explode(F.array(*self._places())).alias("place")
        places = rows.filter("path is not null").select(*by, "bucket", self._block().alias("block"), place)
        return places.groupBy(*by, "bucket", "block").agg(F.bitmap_construct_agg("place").alias("bits"))

    def _blocks(self, spark, buckets):
        """One Bloom filter for each block: those of the snapshot and of all appends or'ed."""
        schema = "bucket int, block int, bits binary"
        found = [f"{self.folder}/sketches-of/{v}" for v in self._versions(spark)[-1:]]
        if exists(spark, f"{self.folder}/sketches"):
            found.append(f"{self.folder}/sketches")
        if not found:
            return spark.createDataFrame([], schema)
        parts = [spark.read.schema(schema).parquet(f).select("bucket", "block", "bits") for f in found]
        rows = reduce(DataFrame.union, parts).filter(F.col("bucket").isin(sorted(buckets)))
        return rows.groupBy("bucket", "block").agg(F.bitmap_or_agg("bits").alias("bits"))


def _bit_is_set(bits, place):
    """Whether a bit of a binary column is set, in the order of the bitmap functions."""
    byte = F.conv(F.hex(F.substring(bits, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


def _over_partitions(df, folder, *columns):
    """Writes over the partitions that ``df`` has rows of, and no others."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*columns).parquet(folder)


def drop_known_by_sketch(df: DataFrame, ledger: ClusteredLedger, on_change: str = "skip") -> DataFrame:
    """``drop_known_paths`` where most files are new: rows whose path no Bloom filter holds
    pass at once; the others, one in a hundred of the new ones among them, are compared with
    the ledger, of which only their buckets are read. False hits change nothing."""
    folder = shared_folder(df.sparkSession, "probed")
    ledger.maybe_known(df).write.partitionBy("maybe_known").parquet(folder)
    schema = T.StructType([*df.schema.fields, T.StructField("maybe_known", T.BooleanType())])
    probed = df.sparkSession.read.schema(schema).parquet(folder)
    maybe = probed.filter("maybe_known").drop("maybe_known")
    new = probed.filter("not maybe_known").drop("maybe_known")
    return new.unionByName(drop_known_paths(maybe, ledger.read_for(maybe), on_change))
