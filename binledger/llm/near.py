"""SimHash near-duplicates: fingerprints of word shingles, linked through BK-trees."""

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binledger.llm.components import components
from binledger.llm.staging import staged

SHARD_NODES = 4096
CLASSES = 32  # of characters, in a text's counts
_SAMPLED = 64
_BROADCAST_ROWS = 100_000
_AT_ONCE = 1 << 16


def simhash(data: bytes, n: int, seed: int) -> int:
    """Fingerprint of a text's shingles of ``n`` words, lower-cased from A to Z: bit set
    if set in more than half of their XXH64. Fewer words make one shingle, none zero."""
    import xxhash

    words = data.lower().split()  # at 0x20 and 0x09 to 0x0D
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = min(n, len(words))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - n + 1].tolist(), ends[n - 1 :].tolist())
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, len(words) - n + 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _AT_ONCE):
        part = hashes[at : at + _AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(df: DataFrame, text: str = "text", n: int = 4, seed: int = 42, name: str = "fingerprint") -> DataFrame:
    """``df`` with the SimHash of each whole text as BIGINT (the 64 bits, signed). A
    missing text counts as an empty one: zero."""

    @F.arrow_udf("long")
    def hashed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = [simhash(v.as_buffer().to_pybytes() if v.is_valid else b"", n, seed) for v in batch]
            yield pa.array(np.array(found, np.uint64).view(np.int64), pa.int64())

    return df.withColumn(name, hashed(F.col(f"`{text}`")))


class BKTree:
    """A forest of BK-trees over 64-bit numbers, one tree for each value of ``group``.

    A node's children are keyed by their Hamming distance to it, one child per distance.
    Trees grow level by level: of the numbers at one node that have the same distance to
    it, the first becomes the child and the others go on below it.
    """

    def __init__(self, numbers: np.ndarray, group: np.ndarray):
        self.numbers = numbers
        size = len(numbers)
        parent, edge = np.full(size, -1), np.zeros(size, np.int64)
        left, at = np.arange(size), group.astype(np.int64)
        first_of = {}
        while len(left):
            order = np.lexsort((left, at))
            heads = order[np.flatnonzero(np.r_[True, at[order][1:] != at[order][:-1]])]
            nodes = left[heads]
            if not first_of:
                first_of = {"groups": at[heads], "roots": nodes}
            node_of = np.repeat(nodes, np.diff(np.r_[np.searchsorted(at[order], at[heads]), len(left)]))
            rest = left[order] != node_of
            left, node = left[order][rest], node_of[rest]
            parent[left] = node
            edge[left] = distance(numbers[left], numbers[node])
            at = node * 65 + edge[left]
        # Those that ended as nodes keep the parent and edge they had last.
        self.groups, self.roots = first_of.get("groups", np.zeros(0, int)), first_of.get("roots", np.zeros(0, int))
        inner = np.flatnonzero(parent >= 0)
        inner = inner[np.lexsort((edge[inner], parent[inner]))]
        self.keys, self.children = parent[inner] * 65 + edge[inner], inner

    def search(self, queries: np.ndarray, group: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (place in queries, node) within the radius, from the tree of the query's
        group. At a node of distance d only edges d - radius to d + radius are followed."""
        place = np.searchsorted(self.groups, group)
        known = place < len(self.groups)
        known[known] = self.groups[place[known]] == group[known]
        stack = [(np.flatnonzero(known), self.roots[place[known]])]
        while stack:
            who, node = stack.pop()
            if len(who) > _AT_ONCE:
                stack += [(who[i : i + _AT_ONCE], node[i : i + _AT_ONCE]) for i in range(0, len(who), _AT_ONCE)]
                continue
            far = distance(queries[who], self.numbers[node])
            hit = far <= radius
            if hit.any():
                yield who[hit], node[hit]
            low = np.searchsorted(self.keys, node * 65 + np.maximum(far - radius, 0))
            high = np.searchsorted(self.keys, node * 65 + np.minimum(far + radius, 64), side="right")
            many = high - low
            if many.any():
                ends = np.cumsum(many)
                stack.append((np.repeat(who, many), self.children[np.repeat(low - ends + many, many) + np.arange(ends[-1])]))


def distance(a, b):
    return np.bitwise_count(a ^ b).astype(np.int64)


def least_edits(a, b):
    """Rows of counts of characters: an edit distance of their texts is no smaller than
    what one has more of, or the other."""
    more = a.astype(np.int16) - b
    return np.maximum(np.maximum(more, 0).sum(axis=1, dtype=np.int64), np.maximum(-more, 0).sum(axis=1, dtype=np.int64))


def join_labels(labels, a, b):
    """Lowers the labels of linked places until those of each link are equal."""
    while True:
        x, y = labels[a], labels[b]
        differ = x != y
        if not differ.any():
            return
        a, b, low, high = a[differ], b[differ], np.minimum(x, y)[differ], np.maximum(x, y)[differ]
        np.minimum.at(labels, high, low)
        while True:
            shorter = labels[labels]
            if (shorter == labels).all():
                break
            labels[:] = shorter


def blocks(number, radius: int, extra: int):
    """Keys of a 64-bit BIGINT column, as array of structs (table, value): it is cut in
    radius + extra parts; two numbers that differ in ``radius`` bits or fewer agree in
    at least ``extra`` parts, so in one of the tables, one for each choice of so many."""
    parts = radius + extra
    edges = [64 * i // parts for i in range(parts + 1)]
    tables = []
    for i, chosen in enumerate(combinations(range(parts), extra)):
        mask = sum(((1 << edges[p + 1]) - (1 << edges[p])) for p in chosen)
        signed = mask - (1 << 64) if mask >> 63 else mask
        tables.append(F.xxhash64(F.lit(i), number.bitwiseAND(F.lit(signed))))
    return F.array(*tables)


def shard_links(
    numbers: DataFrame,
    radius: int,
    extra: int = 2,
    every: bool = False,
    keyed: Callable[[DataFrame], DataFrame] | None = None,
    slack: float | None = None,
) -> DataFrame:
    """Links (a, b) between ids whose numbers differ in ``radius`` bits or fewer.

    ``numbers``: distinct id and BIGINT fp, best a written table, as it is read twice.
    Without ``every`` there are enough links to join all that are so connected, at most one
    per id and tree met, and not all pairs of a dense group. With it, ``numbers`` also has
    a label, and all pairs of different labels are given.

    Numbers that agree in a table's parts form a shard (``blocks``), which has a BK-tree.
    Keys of over about ``SHARD_NODES`` numbers, found in a sample of one number in
    ``_SAMPLED``, are dealt out by hash into lots of that size; each pair of lots is a
    shard of its own. What the sample misses is not lost, its shard is only larger.

    ``keyed`` names other shards in place of these tables: from rows of ``numbers`` it makes
    rows of id, fp and key, a hash, and label; then only numbers that share a key are linked.
    It is asked for the sample first, then for all rows once. With ``slack`` there is a
    column size, too, and those whose sizes differ by more than this share of the larger are
    not linked.
    """
    labels = [*(["label"] if every else []), *([] if slack is None else ["size"])]

    def link(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames):
            ids, labels = frame["id"].to_numpy(), np.arange(len(frame))
            for who, node in near_pairs(frame, radius, every, slack):
                if every:
                    yield pd.DataFrame({"a": ids[who], "b": ids[node]})
                else:
                    join_labels(labels, who, node)
            if not every:
                linked = np.flatnonzero(labels != np.arange(len(ids)))
                yield pd.DataFrame({"a": ids[linked], "b": ids[labels[linked]]})

    return _dealt(numbers, radius, extra, keyed, labels).mapInPandas(link, "a long, b long").distinct()


def shard_meets(
    numbers: DataFrame, radius: int, slack: float, extra: int = 2, keyed: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """shard, id, fp, label and size of the rows that ``shard_links`` with ``every`` and
    ``slack`` has a pair for in that shard, of which the counts of characters, a column
    counts, differ by no more than the sizes may: no more rows than are dealt out, whatever
    the pairs."""
    names = ["shard", "id", "fp", "label", "size"]

    def meet(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(frames):
            paired = np.zeros(len(frame), bool)
            counts = np.frombuffer(b"".join(frame["counts"]), np.uint8).reshape(-1, CLASSES)
            for who, node in near_pairs(frame, radius, True, slack, counts):
                paired[who] = paired[node] = True
            yield frame.loc[paired, names]

    rows = _dealt(numbers, radius, extra, keyed, ["label", "size", "counts"])
    return rows.mapInPandas(meet, "shard long, id long, fp long, label long, size int")


def near_pairs(
    frame: pd.DataFrame, radius: int, every: bool, slack: float | None, counts: np.ndarray | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs of whole shards that ``shard_links`` describes; without
    ``every`` each is there twice, and each row with itself."""
    ids, fp = frame["id"].to_numpy(), frame["fp"].to_numpy().view(np.uint64)
    group = np.unique(frame["shard"].to_numpy(), return_inverse=True)[1]
    tree = BKTree(fp, group)
    labels = frame["label"].to_numpy() if every else None
    sizes = None if slack is None else frame["size"].to_numpy()
    for at in range(0, len(fp), SHARD_NODES):
        queries = slice(at, at + SHARD_NODES)
        for who, node in tree.search(fp[queries], group[queries], radius):
            who = who + at
            if every:
                new = (labels[who] != labels[node]) & (ids[who] > ids[node])
                who, node = who[new], node[new]
            if slack is not None:
                most = slack * np.maximum(sizes[who], sizes[node]) + 1e-9
                fits = np.abs(sizes[who] - sizes[node]) <= most
                if counts is not None:
                    fits[fits] = least_edits(counts[who[fits]], counts[node[fits]]) <= most[fits]
                who, node = who[fits], node[fits]
            yield who, node


def _dealt(numbers, radius, extra, keyed, labels):
    """Rows of shard, id, fp and the labels, those of a shard in one partition, in order."""
    if keyed is None:
        tables = F.explode(blocks(F.col("fp"), radius, extra)).alias("key")
        keyed = lambda rows: rows.select("id", "fp", *labels, tables)
    sampled = numbers.filter(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(_SAMPLED)) == 0)
    found = keyed(sampled).groupBy("key").agg((F.count("*") * _SAMPLED).alias("n")).filter(F.col("n") > SHARD_NODES)
    hot = staged(found.select("key", F.ceil(F.col("n") / SHARD_NODES).cast("int").alias("lots")), "hot-keys")
    n_hot = hot.count()
    rows, shard = keyed(numbers), F.col("key")
    if n_hot:
        hot = F.broadcast(hot) if n_hot <= _BROADCAST_ROWS else hot
        lot = F.pmod(F.xxhash64("id", "key"), F.col("lots")).cast("int")
        others = F.coalesce(F.sequence(F.lit(0), F.col("lots") - 1), F.array(F.lit(0)))
        rows = rows.join(hot, "key", "left").withColumn("lot", lot).withColumn("other", F.explode(others))
        pair = F.xxhash64("key", F.least("lot", "other"), F.greatest("lot", "other"))
        shard = F.when(F.col("lots").isNull(), shard).otherwise(pair)
    return rows.select(shard.alias("shard"), "id", "fp", *labels).repartition("shard").sortWithinPartitions("shard", "id")  # so all shards name the same id


def whole_groups(frames, least=50_000):
    """Frames sorted by shard, put together so that no shard is cut; shards of a
    single row are left out."""
    held, size = [], 0
    for frame in frames:
        held.append(frame)
        size += len(frame)
        if size >= least:
            frame = pd.concat(held, ignore_index=True)
            cut = int(frame["shard"].searchsorted(frame["shard"].iloc[-1]))
            yield frame[:cut][frame["shard"][:cut].duplicated(keep=False)]
            held, size = [frame[cut:]], 0
    if held:
        frame = pd.concat(held, ignore_index=True)
        yield frame[frame["shard"].duplicated(keep=False)]


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", n: int = 4, radius: int = 4, seed: int = 42
) -> DataFrame:
    """key, fingerprint (16 hex digits) and component_id (the smallest key reachable over
    fingerprints that differ in ``radius`` bits or fewer) for every row of ``df``.

    Copies share a fingerprint and are one number in the search. Texts without a word,
    missing ones included, have fingerprint zero and are linked like any other. Rows of
    one key each get a row; a missing key stays missing and is no component's smallest
    key unless it has none other. Short texts are hashed like any other, so different ones
    may be linked by chance. Other columns are not read. No rows give no rows.
    """
    hashed = fingerprints(df.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias(text)), text, n, seed, "fp")
    rows = staged(hashed.select(key, "fp"), "fingerprints")
    numbers = staged(rows.groupBy("fp").agg(F.min(key).alias("first")), "fingerprint-numbers")
    linked = components(shard_links(numbers.select(F.col("fp").alias("id"), "fp"), radius))
    reached = numbers.join(linked, numbers["fp"] == linked["id"], "left").select(
        numbers["fp"], "first", F.coalesce("component", "fp").alias("component")
    )
    smallest = reached.groupBy("component").agg(F.min("first").alias("component_id"))
    named = reached.join(smallest, "component").select(F.col("fp").alias("_fp"), "component_id")
    return rows.join(named, rows["fp"] == named["_fp"]).select(
        key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
