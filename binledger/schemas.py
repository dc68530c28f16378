"""Column sets shared by the catalogue, the ledger and the results table."""

from pyspark.sql import types as T

CATALOG_COLUMNS = ["path", "size", "type"]
RESULT_COLUMNS = CATALOG_COLUMNS + ["architecture", "imports", "exports"]

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("type", T.StringType()),
    ]
)

LISTING_SCHEMA = T.StructType(CATALOG_SCHEMA.fields + [T.StructField("class", T.IntegerType())])

# "batch" orders the versions of one path; it grows from one run to the next.
LEDGER_SCHEMA = T.StructType(CATALOG_SCHEMA.fields + [T.StructField("batch", T.LongType())])

RESULT_SCHEMA = T.StructType(
    CATALOG_SCHEMA.fields
    + [
        T.StructField("architecture", T.StringType()),
        T.StructField("imports", T.LongType()),
        T.StructField("exports", T.LongType()),
    ]
)

SECTION_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("idx", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("va", T.LongType()),
        T.StructField("raw_size", T.LongType()),
        T.StructField("raw_ptr", T.LongType()),
        T.StructField("raw_offset_sum", T.LongType()),
    ]
)

# Largest batch whose paths may be broadcast. An object key has at most 1024
# bytes, so this many keys stay near 100 MB in the worst case.
BROADCAST_MAX_ROWS = 100_000

IMPORT_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("dll_idx", T.IntegerType()),
        T.StructField("n_symbols", T.IntegerType()),
    ]
)
