"""Results table and ledger stores: a Parquet folder or a JDBC table."""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException


@dataclass(frozen=True)
class ParquetTable:
    """A folder of Parquet files, appended to as a job commits."""

    path: str

    @property
    def location(self) -> str:
        return self.path

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """The table with the given schema; empty before the first append."""
        try:
            return spark.read.schema(schema).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    def append(self, df: DataFrame) -> None:
        df.write.mode("append").parquet(self.path)


@dataclass(frozen=True)
class BatchTable:
    """A folder of Parquet files with a partition for each batch, which a batch is written
    over: the same append again, also after a half-done one, leaves the same rows."""

    path: str

    @property
    def location(self) -> str:
        return self.path

    def read(self, spark: SparkSession, schema: T.StructType, but: int | None = None) -> DataFrame:
        """The table with the given schema, without the rows of batch ``but``; empty before
        the first append."""
        partitioned = T.StructType([f for f in schema if f.name != "batch"]).add("batch", "long")
        rows = ParquetTable(self.path).read(spark, partitioned)
        return (rows if but is None else rows.filter(rows["batch"] != but)).select(schema.names)

    def append_batch(self, df: DataFrame, batch: int) -> None:
        rows = df.withColumn("batch", F.lit(batch).cast("bigint"))
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch").parquet(self.path)


@dataclass(frozen=True)
class JdbcTable:
    """A table of a SQL database.

    ``options`` go to the reader and writer (user, password, driver, batchsize,
    numPartitions ...). Without ``partitionColumn`` Spark reads through one
    connection; ``split_by_size`` = (lower, upper, parts) splits the read on the
    indexed ``size`` column, in strides that lose no row.
    """

    url: str
    table: str
    options: dict = field(default_factory=dict)
    split_by_size: tuple | None = None

    @property
    def location(self) -> str:
        return f"{self.url} {self.table}"

    def read_options(self) -> dict:
        split = {}
        if self.split_by_size:
            lower, upper, parts = self.split_by_size
            split = {"partitionColumn": "size", "lowerBound": lower, "upperBound": upper, "numPartitions": parts}
        return {**self.options, **split, "url": self.url, "dbtable": self.table}

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        table = spark.read.format("jdbc").options(**self.read_options()).load()
        return table.select([table[f.name].cast(f.dataType) for f in schema.fields])

    def append(self, df: DataFrame) -> None:
        options = {**self.options, "url": self.url, "dbtable": self.table}
        df.write.format("jdbc").options(**options).mode("append").save()
