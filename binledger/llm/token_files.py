"""Token ids in Arrow files of equal-length sequences.

A file is one Arrow IPC file with the columns ``ids`` (fixed-size list of unsigned
integers) and ``mask`` (fixed-size list of booleans, true where an id is real). The
sequences of a file, one after the other, are the ids of its documents; only the last
is padded. Mapped into memory, a batch is a matrix without a copy, and any id is found
by its place. ``read_sequences`` and the index give documents back.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs, ipc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from binledger.llm.pieces import PieceTable, groups, ranges
from binledger.llm.staging import share, shared_folder, staged

INDEX = "part int, file string, doc_id long, file_start long, n_tokens long"


class LibraryCodec:
    """The tokenizers library, made in each worker from the vocabulary's JSON."""

    def __init__(self, json: str):
        self.json, self.table = json, None
        self.whole, self.added = None, ()

    def __getstate__(self):
        return {"json": self.json, "table": None, "whole": None, "added": ()}

    def encode(self, texts) -> list[np.ndarray]:
        """Ids of each text as the library gives them without adding special tokens. Texts
        that hold one of the vocabulary's added tokens are encoded whole, as that is an id
        of its own in the midst of a piece; all others piece by piece."""
        if self.table is None:
            from tokenizers import Tokenizer

            library = Tokenizer.from_str(self.json)
            self.whole = Tokenizer.from_str(self.json)
            self.added = [t.content for t in library.get_added_tokens_decoder().values()]
            library.encode_special_tokens = True

            # A token of a byte-level vocabulary has a character for each byte.
            vocabulary = library.get_vocab()
            n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
            n_bytes[list(vocabulary.values())] = [len(t) for t in vocabulary]

            def encoded(pieces):
                """Pieces that can stand in one text are encoded as one: fewer calls."""
                alone = [i for i, p in enumerate(pieces) if p[:1] != " " or p[1:2].isspace() or p[-1].isspace()]
                apart = set(alone)
                joined = [i for i in range(len(pieces)) if i not in apart]
                texts = ["".join([pieces[i] for i in joined[a : a + 1000]]) for a in range(0, len(joined), 1000)]
                rows = library.encode_batch_fast(texts + [pieces[i] for i in alone], add_special_tokens=False)
                ids = np.array([i for r in rows for i in r.ids], np.uint32)
                order = joined + alone
                ends = np.cumsum([len(pieces[i].encode()) for i in order])
                last = np.searchsorted(np.cumsum(n_bytes[ids]), ends) + 1
                counts, starts = np.diff(last, prepend=0), np.concatenate([[0], last[:-1]])
                of = np.empty(len(order), np.int64)
                of[order] = np.arange(len(order))
                return ids[ranges(starts[of], counts[of])], counts[of]

            # Only for vocabularies that split at spaces as byte-level ones do.
            # Workers live on, and another job's codec may come beside this one: no larger table.
            self.table = PieceTable(encoded)
        whole = [i for i, t in enumerate(texts) if t and any(a in t for a in self.added)]
        if not whole:
            return self.table.ids(texts)
        apart = set(whole)
        found = self.table.ids([None if i in apart else t for i, t in enumerate(texts)])
        for i, row in zip(whole, self.whole.encode_batch_fast([texts[i] for i in whole], add_special_tokens=False)):
            found[i] = np.array(row.ids, np.uint32)
        return found


class _SequenceFile:
    """Writes ids of documents as full batches of sequences; memory holds one batch."""

    def __init__(self, stream, kind, length, rows):
        self.length, self.rows, self.kind = length, rows, kind
        fields = [("ids", pa.list_(pa.from_numpy_dtype(kind), length)), ("mask", pa.list_(pa.bool_(), length))]
        self.schema = pa.schema(fields)
        self.writer = ipc.new_file(stream, self.schema)
        self.waiting, self.held, self.start = [], 0, 0

    def add(self, ids):
        self.waiting.append(ids.astype(self.kind))
        self.held += len(ids)
        self.start += len(ids)
        if self.held >= self.length * self.rows:
            self._write(self.held // (self.length * self.rows) * self.length * self.rows)

    def _write(self, n):
        ids = np.concatenate(self.waiting) if self.waiting else np.zeros(0, self.kind)
        now, rest = ids[:n], ids[n:]
        pad = -len(now) % self.length
        mask = np.arange(len(now) + pad) < len(now)
        flat = np.concatenate([now, np.zeros(pad, self.kind)])
        for at in range(0, len(flat), self.length * self.rows):
            columns = [
                pa.FixedSizeListArray.from_arrays(pa.array(x[at : at + self.length * self.rows]), self.length)
                for x in (flat, mask)
            ]
            self.writer.write_batch(pa.record_batch(columns, schema=self.schema))
        self.waiting, self.held = [rest], len(rest)

    def close(self):
        if self.held:
            self._write(self.held)
        self.writer.close()


def write_sequences(
    df: DataFrame,
    folder: str,
    codec,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    length: int = 2048,
    rows: int = 256,
    kind: str = "uint16",
) -> DataFrame:
    """Encode whole texts, append ``end_id`` to each, and write the ids to files in
    ascending order of ``key``. Returns the index, one row per document: part, file,
    doc_id, file_start (ids before it in its file), n_tokens. Parts ascend by key.

    ``codec`` has encode(list of texts) -> list of id arrays; ``kind`` must hold every
    id (an id that does not fit fails the job). Missing and empty texts are ``end_id``
    alone; a missing key comes first; rows of one key stand next to each other, in an
    order of their own, and may spread over files; no rows give no file and an empty
    index. Other columns are not read. A task that runs twice writes a file of another
    name, and the index names the files of the tasks that counted.
    """
    codec_here = share(df.sparkSession, codec)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context, out, file = TaskContext.get(), None, ""
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            texts, keys = batch.column("text").to_pylist(), batch.column("key")
            starts, counts = [], []
            for a, b in groups(texts):
                for ids in codec_here().encode(texts[a:b]):
                    if out is None:
                        store.create_dir(root, recursive=True)
                        name = f"tokens-{context.partitionId():06d}-{context.taskAttemptId()}.arrow"
                        file = f"{folder}/{name}"
                        stream = store.open_output_stream(f"{root}/{name}")
                        out = _SequenceFile(stream, np.dtype(kind), length, rows)
                    if len(ids) and int(ids.max()) > np.iinfo(kind).max:
                        raise ValueError(f"id {int(ids.max())} does not fit {kind}")
                    starts.append(out.start)
                    counts.append(len(ids) + 1)
                    out.add(np.append(ids, end_id))
            n = len(starts)
            yield pa.record_batch(
                [pa.array([context.partitionId()] * n, pa.int32()), pa.array([file] * n, pa.string()), keys.cast(pa.int64())]
                + [pa.array(x, pa.int64()) for x in (starts, counts)],
                names=["part", "file", "doc_id", "file_start", "n_tokens"],
            )
        if out is not None:
            out.close()
            stream.close()

    documents = df.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text"))
    # The last column deals out rows of one key that is very frequent.
    spread = documents.withColumn("place", F.xxhash64(F.monotonically_increasing_id()))
    ordered = spread.repartitionByRange("key", "place").sortWithinPartitions("key", "place")
    return staged(ordered.select("key", "text").mapInArrow(write, INDEX), "token-index")


def global_starts(index: DataFrame) -> DataFrame:
    """The index with column start: ids of all documents in earlier files and before
    it in its own. The running sum is over one row per file."""
    files = index.groupBy("part", "file").agg(F.sum("n_tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return index.join(files.select("file", before.alias("_before")), "file").withColumn(
        "start", F.col("_before") + F.col("file_start")
    ).drop("_before")


class SequenceReader:
    """Random access to the ids of one file; the file is mapped where it is local."""

    def __init__(self, uri: str):
        store, path = fs.FileSystem.from_uri(uri)
        local = isinstance(store, fs.LocalFileSystem)
        self.file = ipc.open_file(pa.memory_map(path) if local else store.open_input_file(path))
        self.length = self.file.schema.field("ids").type.list_size
        self.rows = self.file.get_batch(0).num_rows if self.file.num_record_batches else 1

    def batch(self, i: int):
        """Matrices of ids and mask of batch ``i``; the ids are a view of the file."""
        batch = self.file.get_batch(i)
        ids = batch.column("ids").flatten().to_numpy(zero_copy_only=True)
        mask = batch.column("mask").flatten().to_numpy(zero_copy_only=False)
        return ids.reshape(-1, self.length), mask.reshape(-1, self.length)

    def ids(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ids of places start to start + n, in pieces as the batches have them."""
        size = self.rows * self.length
        while n:
            i, at = divmod(start, size)
            ids = self.file.get_batch(i).column("ids").flatten().to_numpy(zero_copy_only=True)
            piece = ids[at : at + n]
            yield piece
            start, n = start + len(piece), n - len(piece)


def read_back(index: DataFrame) -> DataFrame:
    """``index`` with ids_crc32: unsigned crc32 of each document's ids as the files have
    them, as little-endian unsigned 32-bit numbers. Rows of one file stand together, so
    a task opens few files."""

    @F.arrow_udf("long")
    def crc(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        name, reader = None, None
        for files, starts, counts in batches:
            out = []
            for file, start, n in zip(files.to_pylist(), starts.to_pylist(), counts.to_pylist()):
                if file != name:
                    name, reader = file, SequenceReader(file)
                value = 0
                for piece in reader.ids(start, n):
                    value = zlib.crc32(piece.astype("<u4").tobytes(), value)
                out.append(value)
            yield pa.array(out, pa.int64())

    return index.withColumn("ids_crc32", crc("file", "file_start", "n_tokens"))


def document_tokens(df: DataFrame, codec, **options) -> DataFrame:
    """Write the files of ``write_sequences`` to the shared folder and read them back:
    doc_id, start, n_tokens, ids_crc32, part, file, file_start."""
    folder = shared_folder(df.sparkSession, "token-files")
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    index = write_sequences(df, folder, codec, **options)
    return global_starts(read_back(index))
