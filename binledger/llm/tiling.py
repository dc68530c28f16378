"""Benchmark decontamination by greedy string tiling of documents against test items."""

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binledger.llm.pieces import groups
from binledger.llm.staging import share

MIN_MATCH = 5
COVERAGE = 0.5
BLOCK_BYTES = 16 << 20
_WORD = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x5851F42D4C957F2D)


def words_of(text) -> list[str]:
    """Runs of letters and digits, lower case."""
    return _WORD.findall(text.lower()) if text else []


def window_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hash of every window of ``n`` numbers, for all windows at once."""
    if len(ids) < n:
        return np.zeros(0, np.uint64)
    out, size = np.zeros(len(ids) - n + 1, np.uint64), len(ids) - n + 1
    for k in range(n):
        out = out * _BASE + (ids[k : k + size] + 1).astype(np.uint64)
    return out


def greedy_tiles(item, document, seeds, n: int) -> list[tuple[int, int, int]]:
    """Tiles (place in item, place in document, length) of greedy string tiling with
    matches of ``n`` words or more.

    The longest match of words that are in no tile yet becomes a tile, again and again; of
    equally long ones the first in the item, then in the document. ``seeds``: pairs of
    places with equal hashes of ``n`` words, at least those with which such pairs begin on
    their diagonal. A match that a tile has cut is taken up again with what is left of it,
    so every round sees the longest free match.
    """
    item, document, matches = np.asarray(item, np.int64), np.asarray(document, np.int64), []
    for i, j in set(seeds):
        if i and j and item[i - 1] == document[j - 1]:
            continue
        k = _common(item, document, i, j)
        if k >= n:
            matches.append((-k, i, j))
    heapq.heapify(matches)
    used_item, used_document, tiles = np.zeros(len(item), bool), np.zeros(len(document), bool), []
    while matches:
        length, i, j = heapq.heappop(matches)
        free = ~(used_item[i : i - length] | used_document[j : j - length])
        if free.all():
            used_item[i : i - length] = used_document[j : j - length] = True
            tiles.append((i, j, -length))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[0], free, [0]])))
        for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - begin >= n:
                heapq.heappush(matches, (begin - end, i + begin, j + begin))
    return tiles


def _common(item, document, i, j, at_once=64):
    """How many words are equal from two places on, compared in ever longer stretches."""
    k = 0
    while True:
        size = min(at_once, len(item) - i - k, len(document) - j - k)
        same = item[i + k : i + k + size] == document[j + k : j + k + size]
        if not same.all():
            return k + int(same.argmin())
        k += size
        if size < at_once:
            return k
        at_once *= 2


class ItemBlock:
    """A bounded number of test items, their words as numbers, and their seeds."""

    def __init__(self, items, n: int):
        self.n, self.words, self.items = n, {}, []
        hashes, before, places = [], [], []
        for item_id, text in items:
            ids = [self.words.setdefault(w, len(self.words)) for w in words_of(text)]
            found = window_hashes(np.array(ids, np.int64), n).tolist()
            hashes += found
            before += [None, *found[:-1]] if found else []
            places += [(len(self.items), i) for i in range(len(found))]
            self.items.append((item_id, ids))
        # Places of a hash stand together, and among them those with the same one before.
        order = sorted(range(len(hashes)), key=lambda k: (hashes[k], before[k] is not None, before[k] or 0))
        self.places, self.of, self.after = [places[k] for k in order], {}, {}
        for at, k in enumerate(order):
            for table, key in ((self.of, hashes[k]), (self.after, (hashes[k], before[k]))):
                table[key] = (table.get(key, (at,))[0], at + 1)
        self.hashes = np.unique(np.array(hashes, np.uint64))

    def found(self, texts):
        """(place in texts, item_id, words of the item, tiles) of every pair of a text and
        an item that share a seed."""
        number = self.words.get
        ids, ends = [], []
        for text in texts:
            ids += [number(w, -1) for w in words_of(text)]
            ids.append(-2)  # no match goes from one text to the next
            ends.append(len(ids))
        ids, ends = np.array(ids, np.int64), np.array(ends, np.int64)
        seen = window_hashes(ids, self.n)
        hit = np.flatnonzero(np.isin(seen, self.hashes)) if len(self.hashes) else np.zeros(0, np.int64)
        pairs = defaultdict(list)
        of = np.searchsorted(ends, hit, side="right")
        own = seen[hit].tolist()
        previous = [None if place == 0 else h for place, h in zip(hit.tolist(), seen[np.maximum(hit - 1, 0)].tolist())]
        for place, t, value, last in zip(hit.tolist(), of.tolist(), own, previous):
            start = int(ends[t - 1]) if t else 0
            low, high = self.of[value]
            # Where the windows before are equal, too, the match has begun there.
            a, b = (high, high) if last is None else self.after.get((value, last), (high, high))
            for k in (*range(low, a), *range(b, high)):
                item, i = self.places[k]
                pairs[t, item].append((i, place - start))
        for (t, item), seeds in pairs.items():
            item_id, item_ids = self.items[item]
            document = ids[ends[t - 1] if t else 0 : ends[t] - 1].tolist()
            yield t, item_id, item_ids, greedy_tiles(item_ids, document, seeds, self.n)


def contaminated(
    df: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    min_match: int = MIN_MATCH,
    coverage: float = COVERAGE,
) -> DataFrame:
    """key, item_id, n_words, covered, coverage, longest, n_tiles of every pair of a
    document and a test item of whose words at least ``coverage`` lie in tiles.

    Words are runs of letters and digits in lower case. Tiles are matches of ``min_match``
    words or more that overlap on neither side, wherever they stand, so a passage in
    another order is caught; words are compared after the hashes. Items of fewer words
    than that and missing or empty texts match nothing. Copies of a document or of an
    item each give their pairs; a missing key stays missing; other columns are not read;
    no documents or no items give no rows.

    Items are a query set: they are dealt by hash into blocks of about ``BLOCK_BYTES`` of
    text, and each block is broadcast for a pass over the documents, which are not
    shuffled. Only pairs above the threshold leave a task.
    """
    spark = df.sparkSession
    size = items.agg(F.sum(F.octet_length(F.col(f"`{item_text}`")))).first()[0] or 0
    n_blocks = -(-size // BLOCK_BYTES) or 1
    rows = items.select(F.col(f"`{item_key}`").cast("long").alias("id"), F.col(f"`{item_text}`").alias("text")).filter("text is not null")
    documents = df.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias(text)).filter(F.col(text).isNotNull())
    kind = documents.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, item_id long, n_words long, covered long, coverage double, longest long, n_tiles long"

    def passed(block):
        block_here = share(spark, block)

        def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts, out = batch.column(1).to_pylist(), []
                for a, b in groups(texts, 500_000):
                    for t, item_id, item, tiles in block_here().found(texts[a:b]):
                        covered = sum(k for _, _, k in tiles)
                        if covered and covered >= coverage * len(item):
                            longest = max(k for _, _, k in tiles)
                            out.append((a + t, item_id, len(item), covered, covered / len(item), longest, len(tiles)))
                columns = list(zip(*out)) if out else [()] * 7
                types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
                values = [pa.array(c, kind) for c, kind in zip(columns[1:], types)]
                keys = batch.column(0).take(pa.array(columns[0], pa.int64()))
                yield pa.RecordBatch.from_arrays([keys, *values], names=[key, "item_id", "n_words", "covered", "coverage", "longest", "n_tiles"])

        return documents.mapInArrow(tile, schema)

    result = None
    for i in range(n_blocks):
        block = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n_blocks)) == i).collect()  # BLOCK_BYTES of text
        found = passed(ItemBlock([tuple(r) for r in block], min_match))
        result = found if result is None else result.union(found)
    return result
