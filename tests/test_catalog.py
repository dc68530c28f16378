import fnmatch
import os
import re

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from binledger.functions.globs import glob_to_regex, raw_path

from binledger.operators.catalog import (
    class_counts,
    distinct_files,
    glob_files,
    path_parts,
    smallest_files,
    union_files,
)
from binledger.sources.files import describe_files, file_catalog, read_files, store_uri


@pytest.fixture
def folder(tmp_path):
    for path, data in {
        "0/a.exe": b"1",
        "0/b.dll": b"22",
        "0/skip.html5": b"22",
        "0/deep/er.exe": b"4",
        "0/deep.dir/x.exe": b"4",
        "1/c d.exe": b"333",
        "1/x..ab": b"22",
        "1/plus+ü.a b": b"55555",
        "1/noext": b"1",
        "1/100%.exe": b"666666",
        "1/no thing#.dll": b"",
        "1/nothing.html": b"",
    }.items():
        os.makedirs((tmp_path / path).parent, exist_ok=True)
        (tmp_path / path).write_bytes(data)
    return tmp_path


CATALOG = [
    ("/0/a.exe", 1, "exe", 0),
    ("/0/b.dll", 2, "dll", 0),
    ("/1/100%25.exe", 6, "exe", 1),
    ("/1/c%20d.exe", 3, "exe", 1),
    ("/1/no%20thing%23.dll", 0, "dll", 1),
    ("/1/plus+ü.a%20b", 5, "a b", 1),
    ("/1/x..ab", 2, "ab", 1),
]


def test_file_catalog(spark, folder):
    df = file_catalog(spark, [f"file:{folder}/0", f"{folder}/1/"])
    assert df.columns == ["path", "size", "type", "class"]
    assert rows(df) == CATALOG


def test_file_catalog_with_classes_given(spark, folder):
    df = file_catalog(spark, {f"{folder}/0": 7}, glob="*")
    assert {(r.path, r["class"]) for r in df.collect()} >= {("/0/skip.html5", 7), ("/0/a.exe", 7)}


def test_folders_below_a_base(spark, tmp_path):
    """Classes spread over folders of their own, more than 32 of them."""
    roots = {}
    for c in (0, 1):
        for shard in range(20):
            folder = tmp_path / f"data/{c}/s{shard}"
            folder.mkdir(parents=True)
            (folder / "a b.exe").write_bytes(b"x" * shard)
            roots[str(folder)] = c
    df = file_catalog(spark, roots, base=str(tmp_path / "data"))
    assert rows(df) == sorted(((f"/{c}/s{i}/a%20b.exe", i, "exe", c) for c in (0, 1) for i in range(20)), key=repr)
    assert {len(bytes(r.content)) for r in read_files(df, str(tmp_path / "data")).collect()} == set(range(20))
    with pytest.raises(ValueError):
        file_catalog(spark, roots, base=str(tmp_path / "other"))


def test_listing_does_not_read_contents(spark, folder):
    df = file_catalog(spark, [f"{folder}/0"], empty_files=False).filter("size > 1")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema: ")[1] and "GreaterThan(length,1)" in plan


def test_catalog_with_content(spark, folder):
    df = file_catalog(spark, [f"{folder}/1"], with_content=True)
    got = {r.path: bytes(r.content) for r in df.collect()}
    assert got["/1/c%20d.exe"] == b"333" and got["/1/no%20thing%23.dll"] == b""


@pytest.mark.parametrize("range_bytes, want", [(0, b"666666"), (1, b"66"), (4, b"66666"), (99, b"666666")])
def test_read_files(spark, folder, range_bytes, want):
    catalog = file_catalog(spark, [f"{folder}/0", f"{folder}/1"])
    got = {r.path: bytes(r.content) for r in read_files(catalog, str(folder), range_bytes).collect()}
    assert set(got) == {r[0] for r in CATALOG}
    assert got["/1/100%25.exe"] == want and got["/1/plus+ü.a%20b"] == b"55555"[: range_bytes + 1 if range_bytes else 9]


def test_read_files_with_a_filesystem_function(spark, folder):
    def local():
        from pyarrow import fs

        return fs.SubTreeFileSystem(str(folder), fs.LocalFileSystem())

    df = read_files(file_catalog(spark, [f"{folder}/0"]), "", filesystem=local)
    assert {bytes(r.content) for r in df.collect()} == {b"1", b"22"}


def test_store_uri():
    assert store_uri("s3a://bucket/x") == "s3://bucket/x"
    assert store_uri("file:/tmp/x") == "file:///tmp/x"
    assert store_uri("file:///tmp/x") == "file:///tmp/x"
    assert store_uri("/tmp/x") == "/tmp/x"


def test_describe_files(spark):
    listing = spark.createDataFrame(
        [("s3a://b/0/a.b.exe", 1), ("s3a://b/1/x%20y", 2**31), ("s3a://b/in/z+%2B.d%20l", 3), ("s3a://b/1/a [1].exe?x", 4), ("no uri", 5)], "uri string, n long"
    )
    assert rows(describe_files(listing, "uri", "n").filter("size > 3 and size < 9")) == [
        ("/1/a [1].exe", 4, "exe", 1),
        (None, 5, None, None),
    ]
    assert rows(describe_files(listing, "uri", "n").filter("size < 4 or size > 9")) == [
        ("/0/a.b.exe", 1, "exe", 0),
        ("/1/x%20y", 2147483648, "x y", 1),
        ("/in/z+%2B.d%20l", 3, "d l", None),
    ]


def test_glob(spark, files):
    names = ["/0/a.exe", "/1/x..ab", "/0/a.html5", "/0/aexe", "/0/d/a.exe", "/2x/a.exe", "/1/a.a%20b", "/1/a.%20", "/0/.exe"]
    df = files([(n, 1, "") for n in names])
    matched = {r.path for r in glob_files(df, "/?/*.???").collect()}
    assert matched == {"/0/a.exe", "/1/x..ab", "/1/a.a%20b", "/0/.exe"}
    assert {r.path for r in glob_files(df, "/1/a.a b").collect()} == {"/1/a.a%20b"}
    assert {r.path for r in glob_files(df, "/{0,1}/a.[e-h]??").collect()} == {"/0/a.exe"}


NAME = st.text(st.sampled_from("ab.x0 %#é+2"), max_size=7)


@settings(max_examples=300, deadline=None)
@given(name=NAME, glob=st.text(st.sampled_from("ab.x0 %*?2"), max_size=5))
def test_globs_are_those_of_plain_names(name, glob):
    assert bool(re.fullmatch(glob_to_regex(glob), raw_path(name))) == fnmatch.fnmatchcase(name, glob)


def test_glob_on_long_names(files):
    df = files([("/0/" + "a" * 100_000 + ".exe", 1, ""), ("/0/" + "%20" * 30_000, 1, ""), ("/0/a.exe\n", 1, "")])
    assert glob_files(df, "/0/*.exe").count() == 1


def test_path_parts(spark, files):
    want = {
        "store/setup.dll": ("store", "setup", "dll"),
        "/0/a.b.exe": ("/0", "a.b", "exe"),
        "/a.exe": ("/", "a", "exe"),
        "plain": ("", "plain", ""),
        "/0/.profile": ("/0", ".profile", ""),
        "/0/..ab": ("/0", "..ab", ""),
        "/1/x..ab": ("/1", "x.", "ab"),
        "a//b.c": ("a", "b", "c"),
        "/0/d.": ("/0", "d", ""),
    }
    got = path_parts(files([(n, 1, "") for n in want])).collect()
    assert {r.path: (r.dir, r.name, r.extension) for r in got} == want


def test_distinct_union_counts(spark, files):
    df = files([("a", 1, "exe"), ("a", 1, "exe"), ("c", 2, "dll"), ("b", None, "dll"), ("b", None, "dll")])
    assert distinct_files(df).count() == 3
    assert union_files(df, df.select("type", "size", "path")).count() == 10
    counted = class_counts(files([("a", 1, "exe", 0), ("b", 2, "exe", 0), ("b", 5, "exe", 1)], with_class=True))
    assert rows(counted) == [(0, "exe", 2, 3), (1, "exe", 1, 5)]


def test_smallest(spark, files):
    df = files([("b", 5, "exe"), ("a", 5, "exe"), ("c", 1, "exe"), ("d", 2147483648, "exe")])
    assert [r.path for r in smallest_files(df, 3).collect()] == ["c", "a", "b"]
    assert "TakeOrderedAndProject" in smallest_files(df, 3)._jdf.queryExecution().executedPlan().toString()
