import os
import random
import struct

import pytest
from executables import CORRUPTED, NAMED, brute_force, build, random_file
from pyspark.sql import functions as F

from binledger.operators.extract import (
    extract_from_store,
    extract_metadata,
    file_imports,
    file_sections,
    imports_by_file,
    sections_by_name,
)
from binledger.functions.symbols import ZeroEndedLists
from binledger.operators.headers import header_columns
from binledger.plans import table_files
from binledger.schemas import RESULT_SCHEMA


def contents(spark, files):
    return spark.createDataFrame(
        [(p, len(c), p.rsplit(".", 1)[-1], bytearray(c)) for p, c in files.items()],
        "path string, size long, type string, content binary",
    )


def extracted(df):
    return {r.path: (r.architecture, r.imports, r.exports) for r in df.collect()}


@pytest.fixture(scope="module")
def random_files():
    rng = random.Random(11)
    return {f"/0/r{i}.exe": random_file(rng) for i in range(300)}


def test_named_files(spark):
    df = extract_metadata(contents(spark, {p: v[0] for p, v in NAMED.items()}))
    assert df.schema == RESULT_SCHEMA
    assert extracted(df) == {p: v[1:] for p, v in NAMED.items()}


def test_random_files(spark, random_files):
    df = contents(spark, {p: v[0] for p, v in random_files.items()})
    assert extracted(extract_metadata(df)) == {p: v[1:] for p, v in random_files.items()}
    sums = {r.path: r.imports for r in imports_by_file(file_imports(df)).collect()}
    assert sums == {p: v[2] for p, v in random_files.items() if v[2] or p in sums}


def test_lenient_headers_count_files_with_long_headers(spark):
    df = contents(spark, {"/1/big.exe": NAMED["/1/big.exe"][0], "/1/junk.dll": b"x" * 528})
    assert extracted(extract_metadata(df, strict_headers=False)) == {"/1/big.exe": ("64", 2, 0), "/1/junk.dll": CORRUPTED}


def test_headers_agree_with_extraction(spark, random_files):
    files = {p: v[0] for p, v in {**NAMED, **random_files}.items()}
    df = contents(spark, files)
    heads = {r.path: r for r in header_columns(df).drop("content").collect()}
    for path, (architecture, imports, exports) in extracted(extract_metadata(df)).items():
        assert heads[path].corrupted == (architecture is None), path
        assert heads[path].architecture == architecture
        assert imports <= 0 or heads[path].import_rva
        assert exports <= 0 or heads[path].has_exports


@pytest.mark.parametrize(
    "data, is_pe, read",
    [
        (b"", False, 1024),
        (b"x" * 528, False, 2048),
        (b"x" * 1024, False, 2048),
        (b"MZ" + b"\xff" * 9000, False, 8192),
        (build(32), True, 1024),
        (build(32, header_offset=1024 - 24 - 96), True, 1024),
        (build(32, header_offset=1024 - 24 - 95), True, 2048),
        (build(64, header_offset=1024 - 24 - 111), True, 2048),
        (build(32, header_offset=8192 - 24 - 96), True, 8192),
        (build(32, header_offset=8192 - 24 - 95), False, 8192),
        (build(64, header_offset=0xF0)[: 0xF0 + 24 + 111], False, 2048),
    ],
)
def test_header_bytes_read(spark, data, is_pe, read):
    row = header_columns(contents(spark, {"/0/f.exe": data})).first()
    assert (row.is_pe, row.headers_read) == (is_pe, read)


def test_prefix_is_enough_for_headers(spark, random_files):
    df = contents(spark, {p: v[0] for p, v in random_files.items()})
    cut = df.withColumn("content", F.substring("content", 1, 8192))
    whole = header_columns(df).drop("content")
    assert whole.exceptAll(header_columns(cut).drop("content")).isEmpty()


def test_null_content_is_corrupted(spark):
    df = spark.createDataFrame([("/0/a.exe", 1, "exe", None)], "path string, size long, type string, content binary")
    assert extracted(extract_metadata(df)) == {"/0/a.exe": CORRUPTED}


def test_too_few_directories_is_the_sentinel(spark):
    df = contents(spark, {"/0/d1.exe": build(32, [3], 4, n_directories=1), "/0/d2.exe": build(32, [3], 4, n_directories=2)})
    assert extracted(extract_metadata(df)) == {"/0/d1.exe": CORRUPTED, "/0/d2.exe": ("32", 3, 4)}


def test_export_count_beyond_int_is_kept(spark):
    df = contents(spark, {"/0/e.dll": build(32, [1], 0x80000000), "/0/f.dll": build(32, [1], 0x7FFFFFFF)})
    assert extracted(extract_metadata(df)) == {"/0/e.dll": ("32", 1, 0x80000000), "/0/f.dll": ("32", 1, 0x7FFFFFFF)}


def test_headers_behind_the_limit(spark):
    df = contents(spark, {"/0/a.exe": build(64, [3], 2, header_offset=20_000)})
    assert extracted(extract_metadata(df)) == {"/0/a.exe": CORRUPTED}
    assert extracted(extract_metadata(df, header_limit=None)) == {"/0/a.exe": ("64", 3, 2)}
    assert extracted(extract_metadata(df, header_limit=32_768)) == {"/0/a.exe": ("64", 3, 2)}


def test_scan_keeps_stretches_not_zeros():
    """Lists all over a region of zeros, then of ones: what is kept follows the lists."""
    for data in (bytes(1 << 20), b"\1" * (1 << 20)):
        lists = ZeroEndedLists(lambda pos, n, data=data: data[pos : pos + n], len(data), 4)
        for start in range(0, 4000, 4):
            assert lists.length(start, len(data)) == (0 if data[0] == 0 else (len(data) - start) // 4)
        assert sum(map(len, lists.starts.values())) <= 1000


def test_damaged_files_match_brute_force(spark):
    """Random bytes flipped and files cut anywhere: always a row, and the right one."""
    rng = random.Random(5)
    files = {}
    for i in range(1200):
        data = bytearray(random_file(rng)[0])
        reach = len(data) if i % 2 else min(len(data), 600)
        for _ in range(rng.randrange(0, 12)):
            data[rng.randrange(reach)] = rng.choice([0, 1, 0x10, 0x30, rng.randrange(256)])
        files[f"/1/{i}.exe"] = bytes(data[: rng.randrange(len(data) + 1)] if i % 3 == 0 else data)
    df = contents(spark, files)
    got = extracted(extract_metadata(df))
    assert got == {path: brute_force(data) for path, data in files.items()}
    assert 200 < sum(a is not None for a, _, _ in got.values()) < 1100
    sums = {r.path: r.imports for r in imports_by_file(file_imports(df)).collect()}
    assert all(sums.get(p, 0) == i for p, (a, i, _) in got.items() if a)


def test_rows_pointing_all_over_one_long_list_stay_linear(spark):
    """5000 import rows into one list of 40,000 symbols without a zero."""
    rows, symbols = 5000, 40_000
    data = bytearray(build(32, [1], pad=20 * rows + 4 * symbols))
    table_at = data.rindex(struct.pack("<5I", 0x3000 + 80, 0, 0, 0, 0))
    lists_va = 0x3000 + 40 + 20 * (rows + 1)
    for i in range(rows):
        struct.pack_into("<5I", data, table_at + 20 * i, lists_va + 4 * i, 0, 0, 0, 0)
    struct.pack_into("<5I", data, table_at + 20 * rows, 0, 0, 0, 0, 0)
    first = table_at + 20 * (rows + 1)
    n = (len(data) - first) // 4
    data[first:] = b"\1\0\0\0" * n + data[first + 4 * n :]
    expected = sum(n - i for i in range(rows))
    assert extracted(extract_metadata(contents(spark, {"/1/a.exe": bytes(data)}))) == {"/1/a.exe": ("32", expected, 0)}


def test_sections(spark):
    data = build(32, [2], names=[b".text", b".rsrc", b".text", b".idata"], sizes=[10, 20, 40, 500])
    sections = file_sections(contents(spark, {"/0/s.exe": data, "/0/j.exe": b"junk"}))
    got = [(r.idx, r.name, r.raw_size, r.raw_offset_sum) for r in sections.orderBy("idx").collect()]
    assert got == [(0, ".text", 10, 0), (1, ".rsrc", 20, 10), (2, ".text", 40, 30), (3, ".idata", 500, 70)]
    assert {(r.name, r.idx) for r in sections_by_name(sections).collect()} == {(".text", 2), (".rsrc", 1), (".idata", 3)}


def test_sections_without_directories(spark):
    files = {f"/0/{n}.exe": build(32, [2], n_directories=n) for n in (0, 1, 2)}
    df = contents(spark, files)
    assert {r.path: r.n for r in file_sections(df).groupBy("path").agg(F.count("*").alias("n")).collect()} == dict.fromkeys(files, 2)


def test_section_count_beyond_the_file_is_cut(spark):
    data = bytearray(build(32, [2]))
    struct.pack_into("<H", data, 64 + 6, 65535)
    df = contents(spark, {"/0/s.exe": bytes(data)})
    assert file_sections(df).count() == (len(data) - (64 + 24 + 96 + 128)) // 40
    assert extracted(extract_metadata(df))["/0/s.exe"][0] == "32"


def test_store_reads_give_the_same_rows(spark, tmp_path, random_files):
    files = {**NAMED, **random_files}
    for path, value in files.items():
        target = tmp_path / path.replace("%20", " ").lstrip("/")
        os.makedirs(target.parent, exist_ok=True)
        target.write_bytes(value[0])
    df = contents(spark, {p: v[0] for p, v in files.items()}).drop("content").repartition(3)
    assert extracted(extract_from_store(df, str(tmp_path))) == {p: v[1:] for p, v in files.items()}
    assert extracted(extract_from_store(df, f"file:{tmp_path}")) == {p: v[1:] for p, v in files.items()}


def test_missing_file_fails_the_task(spark, files, tmp_path):
    with pytest.raises(Exception, match="gone.exe"):
        extract_from_store(files([("/0/gone.exe", 1, "exe")]), str(tmp_path)).collect()


def test_python_side_gets_no_blank_content(spark):
    """Header work and blanking stay in column expressions below the Arrow step."""
    df = extract_metadata(contents(spark, {"/0/a.exe": build()}))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Exchange" not in plan


def test_derived_executables_match_the_generator(spark):
    """The column expressions and the struct-packed generator agree on counts."""
    part = spark.createDataFrame(
        [(k, 1 + k % 50, f"part {k}") for k in range(200)], "p_partkey long, p_size int, p_name string"
    )
    got = extracted(extract_metadata(table_files.part_files(part)))
    for k in range(200):
        size = 1 + k % 50
        n = 0 if size % 10 == 0 else size % 4 + 1
        sound = size not in (49, 50) and not (size % 7 == 0 and 64 + 8 * (k % 300) + 24 + 112 <= 3072)
        want = ("64" if k % 2 else "32", sum((k + i) % 40 for i in range(n)), size - 1) if sound else CORRUPTED
        assert got[f"/0/{k}.exe"] == want, k


def test_blocks_of_a_file_are_fetched_once():
    """Lists of 60 DLLs all over a file cost a request for each block, not for each list."""
    from binledger.functions import symbols
    from binledger.operators.extract import _BLOCK, _reads

    class File:
        def __init__(self, data):
            self.data, self.reads = data, []

        def size(self):
            return len(self.data)

        def read_at(self, n, at):
            self.reads.append((at, n))
            return self.data[at : at + n]

    rng = random.Random(4)
    file = File(rng.randbytes(3 * _BLOCK + 1000))
    take, size = _reads(file)
    for _ in range(500):
        at, n = rng.randrange(size + 2000), rng.randrange(5000)
        assert take(at, n) == file.data[at : at + n]
    assert len(file.reads) <= 4
    assert take(0, size * 2) == file.data and take(10, 20 * _BLOCK) == file.data[10:]
    many = File(build(64, [i % 50 for i in range(60)], 5))
    take, size = _reads(many)
    sections = symbols.read_sections(take, 64 + 24 + 112 + 128, 2)
    assert sum(symbols.dll_symbol_counts(take, size, symbols.section_spans(sections), 0x3028, 8)) == sum(i % 50 for i in range(60))
    assert len(many.reads) == 1


def test_unreadable_files_have_a_reason(spark, files, tmp_path):
    (tmp_path / "0").mkdir()
    (tmp_path / "0/a.exe").write_bytes(build(64, [3], 2))
    (tmp_path / "0/folder.exe").mkdir()
    df = files([("/0/a.exe", 1, "exe"), ("/0/gone.exe", 1, "exe"), ("/0/folder.exe", 1, "exe")])
    got = {r["path"]: r for r in extract_from_store(df, str(tmp_path), errors=True).collect()}
    assert got["/0/a.exe"]["error"] is None and got["/0/a.exe"]["imports"] == 3
    for path in ("/0/gone.exe", "/0/folder.exe"):
        assert got[path]["error"] and got[path]["architecture"] is None and got[path]["imports"] is None


def test_store_reads_follow_late_headers(spark, files, tmp_path):
    (tmp_path / "0").mkdir()
    for at in (64, 8100, 20_000, 300_000):
        (tmp_path / f"0/{at}.exe").write_bytes(build(64, [3], 2, header_offset=at))
    df = files([(f"/0/{at}.exe", 1, "exe") for at in (64, 8100, 20_000, 300_000)])
    late = extracted(extract_from_store(df, str(tmp_path)))
    assert late["/0/20000.exe"] == late["/0/300000.exe"] == CORRUPTED and late["/0/64.exe"] == ("64", 3, 2)
    assert set(extracted(extract_from_store(df, str(tmp_path), header_limit=None)).values()) == {("64", 3, 2)}
