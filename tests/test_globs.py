import fnmatch
import re

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st

from binledger.functions.globs import compile_glob, raw_path
from binledger.operators.catalog import glob_files

PLAIN = "ab.x0 %é2-"


def literal(c):
    return st.just((c, "[" + c + "]" if c in "*?[" else c))


# A pattern as a pair: as this library spells it, and as lists of what fnmatch knows.
ATOM = st.one_of(
    st.sampled_from(PLAIN).map(lambda c: (c, [c])),
    st.sampled_from("*?").map(lambda c: (c, [c])),
    st.sampled_from("*?[]{}\\,").map(lambda c: ("\\" + c, ["[" + c + "]"])),
    st.sampled_from(["[ab]", "[^ab]", "[!b-x]", "[a-x0]", "[ -.]", "[%é]", "[^ %]", "[-a]", "[a-]", "[]a]"]).map(
        lambda c: (c, [c.replace("[^", "[!")])
    ),
)
GLOB = st.recursive(
    st.lists(ATOM, max_size=4),
    lambda inner: st.lists(st.one_of(ATOM, st.lists(inner, min_size=1, max_size=3)), max_size=3),
    max_leaves=8,
)


def spelled(pattern):
    """The glob: tuples are atoms, lists of patterns are braces."""
    return "".join(p[0] if isinstance(p, tuple) else "{" + ",".join(map(spelled, p)) + "}" for p in pattern)


def expanded(pattern):
    """All patterns without braces, for fnmatch."""
    found = [""]
    for p in pattern:
        tails = p[1] if isinstance(p, tuple) else [e for q in p for e in expanded(q)]
        found = [f + t for f in found for t in tails]
    return found


@settings(max_examples=600, deadline=None)
@given(name=st.text(st.sampled_from(PLAIN + "*?[]{}\\,"), max_size=6), pattern=GLOB)
def test_names_against_fnmatch_with_braces_expanded(name, pattern):
    glob = compile_glob(spelled(pattern))
    want = any(fnmatch.fnmatchcase(name, p) for p in expanded(pattern))
    assert bool(re.fullmatch(glob.regex, raw_path(name))) == want
    if want:
        assert any(raw_path(name).startswith(p) for p in glob.prefixes)
    if glob.literal:
        assert want == (raw_path(name) in glob.prefixes)


@settings(max_examples=200, deadline=None)
@given(path=st.lists(st.text(st.sampled_from("ab."), max_size=3), min_size=1, max_size=3), levels=st.lists(GLOB, min_size=1, max_size=3))
def test_levels_are_matched_one_by_one(path, levels):
    """No wildcard crosses a folder."""
    glob = compile_glob("/".join(map(spelled, levels)))
    want = len(path) == len(levels) and all(any(fnmatch.fnmatchcase(n, p) for p in expanded(level)) for n, level in zip(path, levels))
    assert bool(re.fullmatch(glob.regex, "/".join(path))) == want


PATHS = ["/0/a.exe", "/1/a.dll", "/1/b c.exe", "/1/sub/a.exe", "/2/a.exe", "/0/[x].exe", "/0/ü.exe", "/10/a.exe", "/0/a,b.exe"]


@pytest.mark.parametrize(
    "glob, want",
    [
        ("/{0,1}/*.exe", ["/0/a.exe", "/1/b c.exe", "/0/[x].exe", "/0/ü.exe", "/0/a,b.exe"]),
        ("/[01]/?.{exe,dll}", ["/0/a.exe", "/1/a.dll", "/0/ü.exe"]),
        ("/1/{sub/,}a.*", ["/1/a.dll", "/1/sub/a.exe"]),
        ("/{1{,0},2}/a.exe", ["/10/a.exe", "/2/a.exe"]),
        ("/*/*/*.exe", ["/1/sub/a.exe"]),
        ("/0/\\[x\\].exe", ["/0/[x].exe"]),
        ("/0/[!a-z]*", ["/0/[x].exe", "/0/ü.exe"]),
        ("/1/b[ -~]c.exe", ["/1/b c.exe"]),
        ("/0/a\\,b.exe", ["/0/a,b.exe"]),
        ("/0/{a\\,b,a}.exe", ["/0/a.exe", "/0/a,b.exe"]),
        ("/0/a,b.exe", ["/0/a,b.exe"]),
        ("", []),
    ],
)
def test_paths(files, glob, want):
    df = files([(raw_path(p), 1, "") for p in PATHS])
    assert [r[0] for r in rows(glob_files(df, glob))] == sorted(map(raw_path, want))


@pytest.mark.parametrize("glob", ["/{a", "/a}", "/[a", "/[]", "a\\", "[b-a]", "{a,{b}", "[a\\"])
def test_broken_globs(glob):
    with pytest.raises(ValueError, match="glob"):
        compile_glob(glob)


def test_many_alternatives_have_shorter_prefixes():
    glob = compile_glob("/x" + "{a,b,c,d}" * 10)
    assert 1 < len(glob.prefixes) <= 64 and not glob.literal
    assert re.fullmatch(glob.regex, "/xabcdabcdab") and not re.fullmatch(glob.regex, "/xabcdabcda")


def test_prefixes_reach_the_scan(spark, files, tmp_path):
    files([(p, 1, "") for p in PATHS]).write.parquet(str(tmp_path / "c"))
    catalog = spark.read.parquet(str(tmp_path / "c"))
    plan = glob_files(catalog, "/{0,1}/*.exe")._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(path,/0/)" in plan and "StringStartsWith(path,/1/)" in plan
    assert "In(path, [/0/a.exe,/1/a.exe])" in glob_files(catalog, "/[01]/a.exe".replace("[01]", "{0,1}"))._jdf.queryExecution().executedPlan().toString()
