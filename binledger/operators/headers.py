"""Executable headers as columns, in built-in functions only."""

from pyspark.sql import DataFrame

from binledger.functions.binary import u16, u32

# Read budget for headers.
HEADER_STEP = 1024
HEADER_LIMIT = 8 * 1024

# Published layout of PE headers (offsets in bytes).
DOS_HEADER_SIZE = 64
LFANEW_AT = 60
COFF_SIZE = 24
N_SECTIONS_AT = 6
OPTIONAL_SIZE_AT = 20
SIZE_OF_HEADERS_AT = 60
MAGIC_32 = 0x10B
MAGIC_64 = 0x20B
FIXED_PART_32 = 96
FIXED_PART_64 = 112
DIRECTORY_SIZE = 8

HEADER_COLUMNS = [
    "is_pe",
    "headers_read",
    "size_of_headers",
    "corrupted",
    "architecture",
    "n_sections",
    "section_offset",
    "n_directories",
    "export_rva",
    "export_size",
    "import_rva",
    "import_size",
    "has_exports",
    "has_imports",
]


def header_columns(
    df: DataFrame, content: str = "content", strict_headers: bool = True, header_limit: int | None = HEADER_LIMIT
) -> DataFrame:
    """Add ``HEADER_COLUMNS`` to a DataFrame with file bytes.

    Only the first ``header_limit`` bytes of ``content`` are looked at, so a column
    holding just that prefix gives the same answer as the whole file. 8 KiB is the
    rule of the job this package does; headers that end later count as corrupted.
    With None they are followed wherever they lie in ``content``.

    ``headers_read`` counts the bytes asked for, in steps of 1 KiB, until the
    headers parse. They parse once the fixed part of the optional header (96
    bytes, 112 for 64-bit) is complete; how a parser treats shorter headers is
    its own choice, this one rejects them. If they never parse, it is the
    number asked for before giving up: one empty read past the end of a short
    file, ``header_limit`` at most.

    ``corrupted`` is true if the headers do not parse, if ``size_of_headers``
    exceeds ``headers_read`` (dropped by ``strict_headers=False``), or if the
    optional-header magic is neither 32- nor 64-bit. ``n_directories`` tells how
    many of the first two data directories (exports, imports) are there;
    ``has_exports`` and ``has_imports`` are false for a zero address or zero
    size in them.
    """
    limit = 2**31 - 1 if header_limit is None else header_limit
    data = f"`{content}`" if header_limit is None else f"substring(`{content}`, 1, {limit})"
    window_size = COFF_SIZE + FIXED_PART_64 + 2 * DIRECTORY_SIZE
    strict = "or size_of_headers > headers_read" if strict_headers else ""
    directories = f"{COFF_SIZE} + _fixed"

    def directory(index, part):
        at = f"{directories} + {DIRECTORY_SIZE * index + part}"
        return f"if(n_directories > {index}, {u32('_window', at)}, null)"

    # A header offset past the prefix, up to 4 GiB, gives an empty window; no
    # field is read unless the shortest complete header is there.
    columns = {
        "_prefix": data,
        "_n": "coalesce(octet_length(_prefix), 0)",
        "_nt": f"if(_n >= {DOS_HEADER_SIZE} and hex(substring(_prefix, 1, 2)) = '4D5A', {u32('_prefix', LFANEW_AT)}, null)",
        "_window": f"substring(_prefix, cast(least(_nt, {limit - 1}) as int) + 1, {window_size})",
        "_signed": f"octet_length(_window) >= {COFF_SIZE + FIXED_PART_32} and hex(substring(_window, 1, 4)) = '50450000'",
        "_magic": f"if(_signed, {u16('_window', COFF_SIZE)}, null)",
        "_fixed": f"if(_magic = {MAGIC_64}, {FIXED_PART_64}, {FIXED_PART_32})",
        "_end": f"if(_signed, _nt + {COFF_SIZE} + _fixed, null)",
        "is_pe": "coalesce(_end <= _n, false)",
        "headers_read": f"""cast(if(is_pe, {HEADER_STEP} * ceil(_end / {HEADER_STEP}),
            least({limit}, {HEADER_STEP} * (ceil(_n / {HEADER_STEP}) + 1))) as int)""",
        "size_of_headers": f"if(is_pe, {u32('_window', COFF_SIZE + SIZE_OF_HEADERS_AT)}, null)",
        "_architecture": f"case _magic when {MAGIC_32} then '32' when {MAGIC_64} then '64' end",
        "corrupted": f"not is_pe or _architecture is null {strict}",
        "architecture": "if(corrupted, null, _architecture)",
        "n_sections": f"if(is_pe, cast({u16('_window', N_SECTIONS_AT)} as int), null)",
        "section_offset": f"if(is_pe, _nt + {COFF_SIZE} + {u16('_window', OPTIONAL_SIZE_AT)}, null)",
        "n_directories": f"""if(is_pe, cast(least({u32('_window', f'{directories} - 4')},
            (octet_length(_window) - ({directories})) div {DIRECTORY_SIZE}, 2) as int), null)""",
        "export_rva": directory(0, 0),
        "export_size": directory(0, 4),
        "import_rva": directory(1, 0),
        "import_size": directory(1, 4),
        "has_exports": "coalesce(export_rva != 0 and export_size != 0, false)",
        "has_imports": "coalesce(import_rva != 0 and import_size != 0, false)",
    }
    keep = [c for c in df.columns if c not in HEADER_COLUMNS]
    # Later columns refer to earlier ones of the same SELECT.
    staged = df.select(keep).selectExpr("*", *[f"{value} as {name}" for name, value in columns.items()])
    return staged.select(*keep, *HEADER_COLUMNS)
