"""Files in object stores and directories: listing and reading."""

import os
import re
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from itertools import islice, product
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from binledger.functions.globs import glob_to_regex, raw_path
from binledger.schemas import CATALOG_COLUMNS

_URI = "^[A-Za-z][A-Za-z0-9+.-]*:(?://[^/?#]*)?(/[^?#]*)"
# Most file bytes a Python worker holds at a time, beyond a single larger file.
_PIECE_BYTES = 64 * 1024 * 1024
_BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"
# What opening and reading a file may end with.
READ_ERRORS = (OSError, pa.ArrowException)


def describe_files(df: DataFrame, uri, size, class_value=None) -> DataFrame:
    """Catalogue rows from any table of file URIs and sizes, such as a store's
    inventory report: path is the raw (percent-encoded) URI path without scheme
    and host, type the text after the last dot of the name, or the whole name.
    A value that is no URI gives a row without path and type. ``class_value``
    defaults to the first folder of the path, if it is a number."""
    uri = F.col(uri) if isinstance(uri, str) else uri
    size = F.col(size) if isinstance(size, str) else size
    # By a pattern, as parsing fails on a blank or bracket in a name.
    path = _one_form(F.when(uri.rlike(_URI), F.regexp_extract(uri, _URI, 1)))
    name = F.element_at(F.split("path", "/"), -1)
    folder = F.regexp_extract("path", "^/([0-9]+)/", 1).try_cast("int")
    class_column = folder if class_value is None else F.lit(class_value).cast("int")
    return (
        df.select(path.alias("path"), size.cast("bigint").alias("size"))
        .withColumn("type", F.element_at(F.split(_decoded(name), "[.]"), -1))
        .withColumn("class", class_column)
    )


def _decoded(path: Column) -> Column:
    """Percent-decoding that leaves ``+`` alone, and a value that does not decode."""
    plain = F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(path, F.lit("%")), F.coalesce(plain, path)).otherwise(path)


def _one_form(path: Column) -> Column:
    """A raw path as listings have it: encoded characters beyond ASCII are written out, so
    that one file has one path. What does not decode stays as it is."""
    ascii_kept = F.replace(F.regexp_replace(path, "%(?![89A-Fa-f][0-9A-Fa-f])", "%25"), F.lit("+"), F.lit("%2B"))
    plain = F.try_url_decode(ascii_kept)
    decodes = path.rlike("%[89A-Fa-f][0-9A-Fa-f]") & ~F.contains(plain, F.lit("\ufffd"))
    return F.when(decodes, plain).otherwise(path)


def names_between(store, folder: str, low: str, high: str | None):
    """Name and size of the files right below a folder whose names are ``low`` or greater
    and less than ``high``, in any order. A store that lists by ranges of names can do
    better than this, which goes through the whole folder; a local one without keeping it."""
    from pyarrow import fs

    if isinstance(store, fs.LocalFileSystem):
        with os.scandir(folder) as entries:
            for entry in entries:
                if low <= entry.name and (high is None or entry.name < high) and entry.is_file():
                    yield entry.name, entry.stat().st_size
    else:
        for info in store.get_file_info(fs.FileSelector(folder)):
            if info.is_file and low <= info.base_name and (high is None or info.base_name < high):
                yield info.base_name, info.size


def file_catalog(
    spark: SparkSession,
    roots,
    glob: str = "*.???",
    base: str | None = None,
    with_content: bool = False,
    empty_files: bool = True,
    filesystem=None,
    splits=None,
    names=names_between,
) -> DataFrame:
    """path, size, type, class of the files right below each root folder.

    ``roots`` is a list of folder URIs whose last segments are the classes
    (``s3a://bucket/0``), or a dict from folder URI to class. Paths start below
    ``base``, by default the parent of each root; for a bucket that makes them
    the paths in it. File bytes are read only with ``with_content=True``. Store
    settings (``fs.s3a.*`` endpoint, credentials) are those of the session.

    Spark's file scan passes over files of zero bytes; they come from a second
    listing, dealt over as many tasks as roots, through ``filesystem`` (see ``store_connector``);
    ``empty_files=False`` leaves them out.

    Each folder is listed by one process, and the list kept on the driver; more
    than 32 folders are listed by a Spark job. ``splits``, a list of names, lists in tasks
    instead, one for each root and range between two splits, zero-byte files included, and
    nothing is kept: for folders of very many files. ``names`` is the function that lists a
    range (see ``names_between``), such as one that asks the store for it. Where there is
    an inventory table, give that to ``describe_files``.
    """
    if not isinstance(roots, dict):
        roots = {root: int(root.rstrip("/").rsplit("/", 1)[-1]) for root in roots}
    roots = {root.rstrip("/"): value for root, value in roots.items()}
    settings = store_settings(spark, next(iter(roots), ""))
    connect = store_connector(filesystem, settings)
    if splits is not None:
        if with_content:
            raise ValueError("splits give no contents; see read_files")
        return _list_ranges(_ranges(spark, roots, base, splits), glob, connect, names, lambda size: size or empty_files)
    scans = defaultdict(list)
    for root, value in roots.items():
        scans[value, _folders_kept(root, base)].append(root)
    parts = [_scan(spark, group, glob, *key, with_content) for key, group in scans.items()]
    if empty_files:
        parts.append(_empty_files(spark, roots, glob, base, with_content, connect))
    return reduce(DataFrame.unionByName, parts)


def _folders_kept(root, base):
    """How many of the last folders of a root belong to the paths below base."""
    if base is None:
        return 1
    base = base.rstrip("/")
    if not root.startswith(base + "/"):
        raise ValueError(f"root {root} is not below {base}")
    return root[len(base) :].count("/")


def _scan(spark, roots, glob, class_value, folders, with_content):
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(roots)
    return _described(files, class_value, folders, with_content)


def file_stream(spark: SparkSession, roots, glob: str = "*.???", base: str | None = None, max_files: int | None = None) -> DataFrame:
    """``file_catalog`` as a stream of the files that come: each once, by its path, at most
    ``max_files`` at a time from each root. Files of zero bytes are passed over."""
    if not isinstance(roots, dict):
        roots = {root: int(root.rstrip("/").rsplit("/", 1)[-1]) for root in roots}
    parts = []
    for root, value in roots.items():
        stream = spark.readStream.format("binaryFile").schema(_BINARY_FILE).option("pathGlobFilter", glob)
        if max_files:
            stream = stream.option("maxFilesPerTrigger", max_files)
        root = root.rstrip("/")
        parts.append(_described(stream.load(root), value, _folders_kept(root, base), False))
    return reduce(DataFrame.unionByName, parts)


def _described(files, class_value, folders, with_content):
    raw = F.parse_url("_metadata.file_path", F.lit("PATH"))
    path = F.regexp_extract(raw, f"((?:/[^/]+){{{folders + 1}}})$", 1)
    columns = [
        path.alias("path"),
        F.col("length").alias("size"),
        # The scan's own path column is decoded.
        F.element_at(F.split(F.element_at(F.split("path", "/"), -1), "[.]"), -1).alias("type"),
        F.lit(class_value).alias("class"),
    ]
    return files.select(*columns, *(["content"] if with_content else []))


def _list_ranges(ranges, glob, connect, names, keep):
    """Function for tasks whose rows are ranges of names; gives catalogue rows of the names
    that match the glob, in batches of 10,000."""
    pattern = glob_to_regex(glob)
    schema = pa.schema([("path", "string"), ("size", "int64"), ("type", "string"), ("class", "int32")])

    def listed(batches):
        for batch in batches:
            for row in batch.to_pylist():
                store, folder = connect(row["root"])
                inside = "/" + "/".join(row["root"].split("/")[-row["folders"] :]) + "/"
                found = ((n, s) for n, s in names(store, folder, row["low"], row["high"]) if keep(s) and re.fullmatch(pattern, raw_path(n)))
                while some := list(islice(found, 10_000)):
                    columns = {
                        "path": [raw_path(inside + n) for n, _ in some],
                        "size": [s for _, s in some],
                        "type": [n.split(".")[-1] for n, _ in some],
                        "class": [row["class"]] * len(some),
                    }
                    yield pa.RecordBatch.from_pydict(columns, schema=schema)

    return ranges.mapInArrow(listed, "path string, size long, type string, class int")


def _ranges(spark, roots, base, splits):
    """One row for each root folder and range of names between splits, dealt one by one."""
    edges = ["", *sorted(set(splits) - {""}), None]
    rows = [
        (i, root, value, _folders_kept(root, base), low, high)
        for i, ((root, value), (low, high)) in enumerate(product(roots.items(), zip(edges, edges[1:])))
    ]
    schema = "task int, root string, class int, folders int, low string, high string"
    return spark.createDataFrame(rows, schema).repartitionById(len(rows), "task")


def _empty_files(spark, roots, glob, base, with_content, connect):
    files = _list_ranges(_ranges(spark, roots, base, []), glob, connect, names_between, lambda size: not size)
    return files.withColumn("content", F.lit(b"")) if with_content else files


def store_uri(base: str) -> str:
    """The Hadoop scheme names as ``pyarrow.fs`` spells them."""
    for prefix in ("s3a://", "s3n://"):
        if base.startswith(prefix):
            return "s3://" + base[len(prefix) :]
    return base if "://" in base or not base.startswith("file:") else "file://" + base[len("file:") :]


def store_settings(spark: SparkSession, base: str) -> dict:
    """What the session's ``fs.s3a.*`` settings, those of the bucket first, say for
    ``pyarrow.fs.S3FileSystem``; nothing for other stores."""
    if not store_uri(base).startswith("s3://"):
        return {}
    hadoop = spark._jsc.hadoopConfiguration()
    bucket = store_uri(base)[len("s3://") :].split("/", 1)[0]

    def get(name):
        return hadoop.get(f"fs.s3a.bucket.{bucket}.{name}") or hadoop.get(f"fs.s3a.{name}")

    settings = {
        "access_key": get("access.key"),
        "secret_key": get("secret.key"),
        "session_token": get("session.token"),
        "region": get("endpoint.region"),
        "role_arn": get("assumed.role.arn"),
    }
    if "Anonymous" in (get("aws.credentials.provider") or ""):
        settings = {"anonymous": True, "region": settings["region"]}
    endpoint = get("endpoint")
    if endpoint:
        scheme, _, host = endpoint.rpartition("://")
        settings["endpoint_override"] = host
        settings["scheme"] = scheme or ("http" if get("connection.ssl.enabled") == "false" else "https")
        settings["force_virtual_addressing"] = get("path.style.access") != "true"
    return {k: v for k, v in settings.items() if v is not None}


def store_connector(filesystem=None, settings: dict | None = None):
    """Function for use inside tasks: folder URI -> (``pyarrow.fs`` store, folder
    in it). ``filesystem`` is a function giving the store, for what neither a URI nor the
    session's settings hold; without it the scheme decides, with ``store_settings``."""

    def connect(base):
        from pyarrow import fs

        uri = store_uri(base)
        if filesystem or settings:
            store, folder = filesystem() if filesystem else fs.S3FileSystem(**settings), uri.split("://", 1)[-1]
        else:
            store, folder = fs.FileSystem.from_uri(uri)
        return store, folder.rstrip("/")

    return connect


def file_opener(base: str, filesystem=None, settings: dict | None = None):
    """Function for use inside tasks: path of a catalogue row -> open file below
    ``base``. The connection is made once per Python worker."""
    connect = store_connector(filesystem, settings)
    connection = []

    def open_file(path):
        if not connection:
            connection.append(connect(base))
        store, folder = connection[0]
        return store.open_input_file(folder + "/" + unquote(path).lstrip("/"))

    return open_file


def read_files(
    df: DataFrame, base: str, range_bytes: int = 0, filesystem=None, threads: int = 8, errors: bool = False, more=None
) -> DataFrame:
    """Add ``content`` to catalogue rows: the bytes of each file below ``base``,
    fetched by the task that holds the row. ``range_bytes`` asks for bytes 0 to
    ``range_bytes``, both included, as in an HTTP range; 0 means the whole file. ``more``
    is a function that tells from these bytes how many are needed from the start; if that
    is more than there are, the rest is fetched too.

    A file that cannot be read fails the task. With ``errors`` it gives a row without
    content, and the reason in the column ``error``, which is missing in other rows.
    """
    open_file = file_opener(base, filesystem, store_settings(df.sparkSession, base))

    def fetch(path):
        with open_file(path) as file:
            data = file.read_at(range_bytes + 1, 0) if range_bytes else file.read()
            needed = more(data) if more else 0
            return data + file.read_at(needed - len(data), len(data)) if len(data) < min(needed, file.size()) else data

    def one(path):
        try:
            return fetch(path), None
        except READ_ERRORS as e:
            if not errors:
                raise
            return None, reason(e)

    def read(batches):
        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                sizes = [range_bytes + 1] * batch.num_rows if range_bytes else batch.column("size").to_pylist()
                for piece in _pieces(batch, sizes):
                    found = list(pool.map(one, piece.column("path").to_pylist()))
                    new = {"content": pa.array([f[0] for f in found], pa.binary())}
                    if errors:
                        new["error"] = pa.array([f[1] for f in found], pa.string())
                    yield pa.RecordBatch.from_arrays([*piece.columns, *new.values()], names=[*piece.schema.names, *new])

    rows = df.select(*CATALOG_COLUMNS, *[c for c in df.columns if c not in CATALOG_COLUMNS])
    schema = rows.select("*", F.lit(None).cast("binary").alias("content")).schema
    return rows.mapInArrow(read, schema.add("error", "string") if errors else schema)


def reason(error) -> str:
    """An error in a few words for a table."""
    return f"{type(error).__name__}: {error}"[:500]


def _pieces(batch, sizes):
    """Slices of a record batch whose files add up to ``_PIECE_BYTES`` at most, or
    are one file."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + (size or 0) > _PIECE_BYTES:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += size or 0
    if batch.num_rows:
        yield batch.slice(start)
