"""Architecture, import and export counts of executables.

The header fields are column expressions (``header_columns``); only the symbol
lists are followed in Python, on Arrow batches, in the same stage. Content of
files without countable headers is blanked before it goes to Python.
"""

from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from binledger.functions import symbols
from binledger.operators.headers import (
    COFF_SIZE,
    DIRECTORY_SIZE,
    DOS_HEADER_SIZE,
    FIXED_PART_64,
    HEADER_LIMIT,
    LFANEW_AT,
    header_columns,
)
from binledger.schemas import CATALOG_COLUMNS, IMPORT_SCHEMA, RESULT_SCHEMA, SECTION_SCHEMA
from binledger.sources.files import READ_ERRORS, file_opener, read_files, reason, store_settings

# Bytes of one request for symbol lists, and requests kept for each file.
_BLOCK = 256 * 1024
_BLOCKS_KEPT = 8

_HEADER_FIELDS = ["architecture", "n_sections", "section_offset", "export_rva", "import_rva"]

_RESULT_ARROW = pa.schema(
    [
        ("path", pa.string()),
        ("size", pa.int64()),
        ("type", pa.string()),
        ("architecture", pa.string()),
        ("imports", pa.int64()),
        ("exports", pa.int64()),
    ]
)
_SECTION_ARROW = pa.schema(
    [
        ("path", pa.string()),
        ("idx", pa.int32()),
        ("name", pa.string()),
        ("va", pa.int64()),
        ("raw_size", pa.int64()),
        ("raw_ptr", pa.int64()),
        ("raw_offset_sum", pa.int64()),
    ]
)
_IMPORT_ARROW = pa.schema([("path", pa.string()), ("dll_idx", pa.int32()), ("n_symbols", pa.int32())])


def _slices(data):
    """``take`` and size over bytes in memory."""
    return (lambda pos, n: data[pos : pos + n]), len(data)


def _reads(file):
    """``take`` and size over an open file. Its section table and lists lie close together,
    and each read may be a request to a store, so whole blocks are read and some kept."""
    size = file.size()

    @lru_cache(_BLOCKS_KEPT)
    def block(i):
        return file.read_at(min(_BLOCK, size - i * _BLOCK), i * _BLOCK)

    def take(pos, n):
        end = min(pos + n, size)
        if pos >= end:
            return b""
        first, last = pos // _BLOCK, (end - 1) // _BLOCK
        if last - first >= _BLOCKS_KEPT:
            return file.read_at(end - pos, pos)
        data = block(first) if first == last else b"".join(map(block, range(first, last + 1)))
        return data[pos - first * _BLOCK : end - first * _BLOCK]

    return take, size


def _contents(batch):
    """Per row: (take, size) over its content without copying, None if blank."""
    column = batch.column("content")
    for i in range(batch.num_rows):
        value = column[i].as_buffer()
        yield None if value is None else _slices(memoryview(value))


def _headers(batch):
    return batch.select(_HEADER_FIELDS).to_pylist()


def _width(header):
    return 8 if header["architecture"] == "64" else 4


def _counts(source, header):
    """(architecture, imports, exports); (None, -1, -1) without usable headers."""
    if source is None:
        return None, -1, -1
    take, size = source
    spans = symbols.section_spans(symbols.read_sections(take, header["section_offset"], header["n_sections"]))
    imports = exports = 0
    if header["import_rva"]:
        imports = sum(symbols.dll_symbol_counts(take, size, spans, header["import_rva"], _width(header)))
    if header["export_rva"]:
        exports = symbols.export_count(take, size, spans, header["export_rva"])
    return header["architecture"], imports, exports


def _result_batch(batch, counted):
    architecture, imports, exports = zip(*counted) if counted else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [batch.column(c) for c in CATALOG_COLUMNS]
        + [pa.array(architecture, pa.string()), pa.array(imports, pa.int64()), pa.array(exports, pa.int64())],
        schema=_RESULT_ARROW,
    )


def _count_contents(batches):
    for batch in batches:
        counted = [_counts(source, header) for source, header in zip(_contents(batch), _headers(batch))]
        yield _result_batch(batch, counted)


def _rows_in_pieces(rows, schema, most=10_000):
    """Record batches of at most ``most`` rows from an iterator of tuples."""
    while piece := list(islice(rows, most)):
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*piece), schema)], schema=schema)


def _section_rows(batches):
    def rows(batch):
        for path, source, header in zip(batch.column("path").to_pylist(), _contents(batch), _headers(batch)):
            if source is None:
                continue
            before = 0
            table = symbols.read_sections(source[0], header["section_offset"], header["n_sections"])
            for idx, row in enumerate(table):
                name = bytes(row["name"]).strip(b"\0").decode("latin-1")
                raw_size = int(row["raw_size"])
                yield path, idx, name, int(row["va"]), raw_size, int(row["raw_ptr"]), before
                before += raw_size

    for batch in batches:
        yield from _rows_in_pieces(rows(batch), _SECTION_ARROW)


def _import_rows(batches):
    def rows(batch):
        for path, source, header in zip(batch.column("path").to_pylist(), _contents(batch), _headers(batch)):
            if source is None or not header["import_rva"]:
                continue
            take, size = source
            spans = symbols.section_spans(symbols.read_sections(take, header["section_offset"], header["n_sections"]))
            counts = symbols.dll_symbol_counts(take, size, spans, header["import_rva"], _width(header))
            for dll_idx, n_symbols in enumerate(counts):
                yield path, dll_idx, n_symbols

    for batch in batches:
        yield from _rows_in_pieces(rows(batch), _IMPORT_ARROW)


def _countable():
    """Sound headers with both directories. Without them the count is undefined
    and the file gets the sentinel row."""
    return ~F.col("corrupted") & (F.col("n_directories") >= 2)


def _with_headers(df, keep, strict_headers, header_limit, usable=None):
    content = F.when(_countable() if usable is None else usable, F.col("content")).alias("content")
    rows = df.select(*keep, "content")
    return header_columns(rows, strict_headers=strict_headers, header_limit=header_limit).select(
        *keep, content, *_HEADER_FIELDS
    )


def extract_metadata(
    df: DataFrame, strict_headers: bool = True, header_limit: int | None = HEADER_LIMIT
) -> DataFrame:
    """path, size, type, architecture, imports, exports from rows with the whole
    ``content`` of each file.

    A file whose headers are corrupted (see ``header_columns``) or lack the
    export and import directories gets ``(NULL, -1, -1)``; no content makes the
    batch fail. Counts follow every non-zero directory address, whatever the
    directory's size field says. ``header_limit`` as in ``header_columns``.
    """
    rows = _with_headers(df, CATALOG_COLUMNS, strict_headers, header_limit)
    return rows.mapInArrow(_count_contents, RESULT_SCHEMA)


def _headers_end(head):
    """Bytes from the start that hold the headers of a file which begins with ``head``."""
    at = int.from_bytes(head[LFANEW_AT : LFANEW_AT + 4], "little")
    return at + COFF_SIZE + FIXED_PART_64 + 2 * DIRECTORY_SIZE if head[:2] == b"MZ" and len(head) >= DOS_HEADER_SIZE else 0


def extract_from_store(
    df: DataFrame,
    base: str,
    filesystem=None,
    strict_headers: bool = True,
    threads: int = 8,
    header_limit: int | None = HEADER_LIMIT,
    errors: bool = False,
) -> DataFrame:
    """Same as ``extract_metadata`` for rows of path, size, type whose files lie
    under ``base``: each task fetches the first ``header_limit`` bytes of its own
    rows, then only the section table and symbol lists in blocks of 256 KiB, never
    whole files. With ``header_limit=None`` headers are followed wherever they lie,
    and fetched up to there.

    A file that cannot be read fails the task. With ``errors`` it gives a row with the
    reason in the column ``error``, without architecture and counts; ``error`` is missing
    in other rows.

    ``filesystem`` is a function giving a ``pyarrow.fs.FileSystem``; without it
    the scheme of ``base`` decides. ``threads`` files are read at a time.
    """
    open_file = file_opener(base, filesystem, store_settings(df.sparkSession, base))

    def count_files(batches):
        def one(item):
            path, usable, error, header = item
            if error:
                return (None, None, None), error
            if not usable:
                return _counts(None, header), None
            if not header["import_rva"] and not header["export_rva"]:
                return (header["architecture"], 0, 0), None
            try:
                with open_file(path) as file:
                    return _counts(_reads(file), header), None
            except READ_ERRORS as e:
                if not errors:
                    raise
                return (None, None, None), reason(e)

        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                failed = batch.column("error").to_pylist()
                items = zip(batch.column("path").to_pylist(), batch.column("usable").to_pylist(), failed, _headers(batch))
                found = list(pool.map(one, items))
                rows = _result_batch(batch, [f[0] for f in found])
                if errors:
                    rows = rows.append_column("error", pa.array([f[1] for f in found], pa.string()))
                yield rows

    first = HEADER_LIMIT if header_limit is None else header_limit
    more = _headers_end if header_limit is None else None
    heads = read_files(df.select(CATALOG_COLUMNS), base, first - 1, filesystem, threads, errors, more)
    if not errors:
        heads = heads.withColumn("error", F.lit(None).cast("string"))
    rows = header_columns(heads, strict_headers=strict_headers, header_limit=header_limit).select(
        *CATALOG_COLUMNS, F.coalesce(_countable(), F.lit(False)).alias("usable"), "error", *_HEADER_FIELDS
    )
    schema = StructType([*RESULT_SCHEMA.fields, StructField("error", StringType())]) if errors else RESULT_SCHEMA
    return rows.mapInArrow(count_files, schema)


def file_sections(
    df: DataFrame, strict_headers: bool = True, header_limit: int | None = HEADER_LIMIT
) -> DataFrame:
    """One row per section of each sound file, whatever directories it has: path,
    idx, name without NULs, address, raw size and position, and the raw sizes of all
    sections before."""
    sound = ~F.col("corrupted")
    return _with_headers(df, ["path"], strict_headers, header_limit, sound).mapInArrow(_section_rows, SECTION_SCHEMA)


def sections_by_name(sections: DataFrame) -> DataFrame:
    """Index of each section name per file; of equal names the last one."""
    return sections.groupBy("path", "name").agg(F.max("idx").alias("idx"))


def file_imports(
    df: DataFrame, strict_headers: bool = True, header_limit: int | None = HEADER_LIMIT
) -> DataFrame:
    """One row per imported DLL of each sound file: path, position in the import
    table, number of symbols."""
    return _with_headers(df, ["path"], strict_headers, header_limit).mapInArrow(_import_rows, IMPORT_SCHEMA)


def imports_by_file(imports: DataFrame) -> DataFrame:
    """DLLs and imported symbols per file."""
    return imports.groupBy("path").agg(
        F.count("*").alias("n_dlls"), F.sum("n_symbols").cast("bigint").alias("imports")
    )
