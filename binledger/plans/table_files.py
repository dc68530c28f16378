"""File catalogues and executables derived from relational tables, as column
expressions. They let the operators run on tables that hold no binaries: the
bytes of a file follow from its row, so the expected counts do too."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binledger.functions.binary import hex_le, zeros

# Addresses and layout used in the derived executables.
TEXT_ADDRESS = 0x1000
PAYLOAD_ADDRESS = 0x100000
IMPORT_ADDRESS = PAYLOAD_ADDRESS + 40


def add_executable(
    df: DataFrame,
    *,
    wide: str,
    exports: str,
    dlls: str,
    header_offset: str = "64",
    size_of_headers: str = "512",
    unknown_magic: str = "false",
    n_sections: str = "1",
) -> DataFrame:
    """Add ``content``: the bytes of a small executable. All arguments are SQL
    expressions over ``df``.

    ``wide`` tells 64- from 32-bit; ``exports`` is NumberOfFunctions, ``dlls`` an
    array of symbol counts, one per imported DLL. The headers start at
    ``header_offset`` (64 or more). Of ``n_sections`` sections the last,
    ``.idata``, holds the tables; the others are ``.text`` and ``.rsrc`` in
    turns, section i with raw size 16 * (i + 1).
    """

    def section(name, va, raw_size):
        size = hex_le(raw_size)
        return f"concat(rpad(hex({name}), 16, '0'), {size}, {hex_le(va)}, {size}, {hex_le('_start')}, {zeros(16)})"

    # Every list takes as many entries as the longest one, and a zero.
    columns = {
        "_wide": wide,
        "_exports": f"cast({exports} as int)",
        "_dlls": dlls,
        "_header": f"cast({header_offset} as int)",
        "_sections": f"cast({n_sections} as int)",
        "_width": "if(_wide, 8, 4)",
        "_fixed": "if(_wide, 112, 96)",
        "_count": "size(_dlls)",
        "_list": "_width * (coalesce(array_max(_dlls), 0) + 1)",
        "_start": "_header + 152 + _fixed + 40 * _sections",
        "_rows_size": "20 * (_count + 1)",
        "_payload_size": "40 + _rows_size + _count * _list",
        "_symbol": "if(_wide, '0100000000000080', '01000080')",
        "_dos": f"concat('4D5A', {zeros(58)}, {hex_le('_header')}, {zeros('_header - 64')})",
        "_coff": f"concat('50450000', if(_wide, '6486', '4C01'), {hex_le('_sections', 2)}, {zeros(12)}, "
        "if(_wide, 'F000', 'E000'), '0200')",
        "_magic": f"if({unknown_magic}, '0701', if(_wide, '0B02', '0B01'))",
        "_optional": f"concat(_magic, {zeros(58)}, {hex_le(size_of_headers)}, {zeros('_fixed - 68')}, '10000000')",
        "_export_entry": f"if(_exports > 0, concat({hex_le(PAYLOAD_ADDRESS)}, {hex_le(40)}), {zeros(8)})",
        "_import_entry": f"if(_count > 0, concat({hex_le(IMPORT_ADDRESS)}, {hex_le('_rows_size')}), {zeros(8)})",
        "_fillers": f"""array_join(transform(slice(sequence(0, _sections), 1, _sections - 1), i ->
            {section("if(i % 2 = 0, '.text', '.rsrc')", f"{TEXT_ADDRESS} * (i + 1)", "16 * (i + 1)")}), '')""",
        "_last": section("'.idata'", PAYLOAD_ADDRESS, "_payload_size"),
        "_import_rows": f"""array_join(transform(_dlls, (c, i) ->
            concat({hex_le(f"{IMPORT_ADDRESS} + _rows_size + i * _list")}, {zeros(16)})), '')""",
        "_lists": f"array_join(transform(_dlls, c -> concat(repeat(_symbol, c), {zeros('_list - c * _width')})), '')",
    }
    parts = [
        "_dos", "_coff", "_optional", "_export_entry", "_import_entry", zeros(112), "_fillers", "_last",
        zeros(20), hex_le("_exports"), zeros(16), "_import_rows", zeros(20), "_lists",
    ]
    staged = df.selectExpr("*", *[f"{value} as {name}" for name, value in columns.items()])
    return staged.selectExpr(*df.columns, f"unhex(concat({', '.join(parts)})) as content")


def _documents_as_files(documents, labels):
    kind = "case doc_id % 3 when 0 then 'dll' when 1 then 'exe' else 'html5' end as type"
    joined = documents.select("doc_id", "n_chars", "lang").join(labels, "doc_id", "left")
    return joined.selectExpr("*", "coalesce(toxic, 0) as class", kind).selectExpr(
        "concat('/', class, '/', doc_id, '.', type) as path", "n_chars as size", "type", "class", "lang", "quality"
    )


def document_catalog(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One file per document: toxic ones are class 1, all others, also without
    label, class 0. path /class/doc_id.type, size in characters."""
    return _documents_as_files(documents, labels).select("path", "size", "type", "class")


def text_catalog(documents: DataFrame) -> DataFrame:
    """One file per document, named after its text, so exact copies are
    duplicates; the size is NULL for German ones."""
    return documents.select(
        F.concat(F.lit("/0/"), F.md5("text"), F.lit(".txt")).alias("path"),
        F.when(F.col("lang") != "de", F.col("n_chars")).alias("size"),
        F.lit("txt").alias("type"),
    )


def document_log(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Ledger log: batch 1 recorded all documents of good quality, non-English
    ones with another size than now; batch 2 the toxic ones among them again,
    with the present size."""
    first = "named_struct('size', if(lang = 'en', size, size + 1), 'batch', 1L)"
    second = "named_struct('size', size, 'batch', 2L)"
    rows = _documents_as_files(documents, labels).filter("quality = 1")
    versions = rows.selectExpr("path", "type", f"inline(if(class = 1, array({first}, {second}), array({first})))")
    return versions.select("path", "size", "type", "batch")


def catalog_contents(catalog: DataFrame) -> DataFrame:
    """Add ``content``: 64-bit for odd sizes, size % 11 exports, three DLLs with
    size % 5, size % 7 and doc_id % 37 symbols."""
    doc_id = "cast(regexp_extract(path, '/([0-9]+)[.]', 1) as bigint)"
    dlls = f"array(cast(size % 5 as int), cast(size % 7 as int), cast({doc_id} % 37 as int))"
    return add_executable(catalog, wide="size % 2 = 1", exports="size % 11", dlls=dlls)


def document_files(documents: DataFrame) -> DataFrame:
    """path, size, type, content: an executable per document with its whole text
    at the end; French ones are the bare text, without headers."""
    files = add_executable(
        documents.select("doc_id", "lang", "n_chars", "text"),
        wide="lang = 'en'",
        exports="n_chars % 13",
        dlls="transform(sequence(0, cast(n_chars % 4 as int)), i -> cast((doc_id + i) % 50 as int))",
        header_offset="128",
        size_of_headers="1024",
    )
    text = "encode(text, 'UTF-8')"
    return _as_files(files, "doc_id", f"if(lang = 'fr', {text}, concat(content, {text}))")


def part_files(part: DataFrame) -> DataFrame:
    """path, size, type, content, one executable per part, with sound and damaged
    ones: p_size 49 is plain text, 50 has an unknown magic, and one in seven
    claims 4 KiB of headers."""
    dlls = "transform(sequence(0, p_size % 4), i -> cast((p_partkey + i) % 40 as int))"
    files = add_executable(
        part.select("p_partkey", "p_size", "p_name"),
        wide="p_partkey % 2 = 1",
        exports="p_size - 1",
        dlls=f"if(p_size % 10 = 0, cast(array() as array<int>), {dlls})",
        header_offset="64 + 8 * (p_partkey % 300)",
        size_of_headers="if(p_size % 7 = 0, 4096, 512)",
        unknown_magic="p_size = 50",
        n_sections="1 + p_size % 5",
    )
    return _as_files(files, "p_partkey", "if(p_size = 49, encode(p_name, 'UTF-8'), content)")


def _as_files(df, key, content):
    files = df.selectExpr(f"concat('/0/', {key}, '.exe') as path", f"{content} as content")
    return files.selectExpr("path", "cast(octet_length(content) as bigint) as size", "'exe' as type", "content")
