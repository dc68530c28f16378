import os

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_catalog import CATALOG, folder  # noqa: F401

from binledger.sources.files import describe_files, file_catalog, names_between, store_connector, store_settings


@pytest.mark.parametrize("splits", [[], ["b"], ["a.exe", "m", "plus", "x"], ["0", "0", "zzz"]])
def test_ranges_give_the_same_rows(spark, folder, splits):  # noqa: F811
    roots = [f"file:{folder}/0", f"{folder}/1/"]
    assert rows(file_catalog(spark, roots, splits=splits)) == CATALOG
    whole = file_catalog(spark, roots, empty_files=False)
    assert rows(file_catalog(spark, roots, empty_files=False, splits=splits)) == rows(whole)
    assert rows(file_catalog(spark, roots, "[a-c]*.{exe,dll}", splits=splits)) == [r for r in CATALOG if r[0][3] in "abc"]
    options = {"roots": [f"{folder}/0", f"{folder}/1"], "base": str(folder.parent)}
    assert rows(file_catalog(spark, splits=splits, **options)) == rows(file_catalog(spark, **options))


def test_many_names_over_many_tasks(spark, tmp_path):
    """100,000 files of two folders by 32 ranges: equal to the listing of whole folders."""
    for size in range(7):
        (tmp_path / f"{size}.bytes").write_bytes(b"x" * size)
    for c in (0, 1):
        (tmp_path / str(c)).mkdir()
        for i in range(50_000):
            os.link(tmp_path / f"{i % 7}.bytes", tmp_path / str(c) / f"{i * 7919 % 50_000:05x}.exe")
    roots = [f"{tmp_path}/0", f"{tmp_path}/1"]
    splits = [f"{i:x}" for i in range(16)] + [f"0{i:x}" for i in range(16)]
    listed = file_catalog(spark, roots, splits=splits)
    by_task = listed.groupBy(F.spark_partition_id()).count().collect()
    assert len(by_task) >= 20 and max(r["count"] for r in by_task) < 10_000
    plain = file_catalog(spark, roots)
    assert listed.count() == 100_000 and listed.exceptAll(plain).count() == 0 == plain.exceptAll(listed).count()


def test_a_lister_of_ones_own(spark, tmp_path):
    """A store that lists by ranges is asked for each range alone."""
    (tmp_path / "0").mkdir()

    def names(store, folder, low, high):
        yield f"{low or 'first'}-{high or 'last'}.exe", 3

    got = file_catalog(spark, {f"{tmp_path}/0": 5}, splits=["g", "t"], names=names)
    assert rows(got) == [("/0/first-g.exe", 3, "exe", 5), ("/0/g-t.exe", 3, "exe", 5), ("/0/t-last.exe", 3, "exe", 5)]
    with pytest.raises(ValueError, match="splits"):
        file_catalog(spark, [f"{tmp_path}/0"], splits=[], with_content=True)


def test_pyarrow_stores_list_ranges(folder):  # noqa: F811
    from pyarrow import fs

    class Other:
        def get_file_info(self, selector):
            return fs.LocalFileSystem().get_file_info(selector)

    for low, high in (("", None), ("b", "skip.html5"), ("zz", None)):
        args = f"{folder}/0", low, high
        assert sorted(names_between(Other(), *args)) == sorted(names_between(fs.LocalFileSystem(), *args))


def test_session_settings_reach_tasks(spark):
    hadoop = spark._jsc.hadoopConfiguration()
    settings = {
        "fs.s3a.access.key": "key", "fs.s3a.secret.key": "secret", "fs.s3a.endpoint": "http://localhost:9000",
        "fs.s3a.endpoint.region": "eu-west-1", "fs.s3a.path.style.access": "true", "fs.s3a.bucket.open.aws.credentials.provider":
        "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider", "fs.s3a.bucket.open.endpoint": "store.example",
    }
    old = {name: hadoop.get(name) for name in settings}
    try:
        for name, value in settings.items():
            hadoop.set(name, value)
        own = store_settings(spark, "s3a://bucket/0")
        assert own == {
            "access_key": "key", "secret_key": "secret", "region": "eu-west-1", "endpoint_override": "localhost:9000",
            "scheme": "http", "force_virtual_addressing": False,
        } | ({"session_token": hadoop.get("fs.s3a.session.token")} if hadoop.get("fs.s3a.session.token") else {})
        anonymous = store_settings(spark, "s3://open/0")
        assert anonymous["anonymous"] and "access_key" not in anonymous
        assert (anonymous["endpoint_override"], anonymous["scheme"]) == ("store.example", "https")
        assert store_settings(spark, "/local") == store_settings(spark, "hdfs://n/x") == {}

        def opened(_):
            store, where = store_connector(None, own)("s3a://bucket/0/")
            yield type(store).__name__, where, store.region

        assert spark.sparkContext.parallelize([0], 1).mapPartitions(opened).collect() == [("S3FileSystem", "bucket/0", "eu-west-1")]
    finally:
        for name, value in old.items():
            hadoop.unset(name) if value is None else hadoop.set(name, value)


def test_one_form_of_a_path(spark, folder):  # noqa: F811
    """An inventory that encodes all but ASCII names the same paths as the listing."""
    spelled = [
        ("s3://b/1/plus+%C3%BC.a%20b", "/1/plus+ü.a%20b"),
        ("s3://b/1/plus+ü.a%20b", "/1/plus+ü.a%20b"),
        ("s3://b/1/%2Bx%2b%41.e", "/1/%2Bx%2b%41.e"),
        ("s3://b/1/%E6%97%A5+100%25.exe", "/1/日+100%25.exe"),
        ("s3://b/1/bad%C3.exe", "/1/bad%C3.exe"),
        ("s3://b/1/%zz%C3%BC.exe", "/1/%zzü.exe"),
    ]
    df = spark.createDataFrame([(u, 1) for u, _ in spelled], "uri string, n long")
    got = [r["path"] for r in describe_files(df, "uri", "n", 1).collect()]
    assert got == [path for _, path in spelled]
    assert os.path.exists(folder / "1/plus+ü.a b")
