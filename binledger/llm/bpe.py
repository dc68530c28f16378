"""Byte-level BPE encoding and decoding by a file of ranks.

Different pretokens of a batch become rows of padded matrices, one matrix for each
bucket of lengths. In each round every row merges its leftmost pair of the lowest
rank, found in a hash table of pairs; rows without a pair to merge leave the matrix.
"""

import base64
import heapq
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binledger.llm.pieces import PieceTable, ranges, slices
from binledger.llm.staging import share

_NONE = np.int32(2**31 - 1)
_LONG = 256  # bytes; a longer pretoken has a heap of its own instead of a matrix row
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _plain(piece):
    """Pretokens of a piece of European letters and one sign at most behind them,
    without the cost of the pattern; None for any other piece."""
    word = piece[1:] if piece[:1] == " " else piece
    if word and max(word) < "\u0590":
        if word.isalpha():
            return [piece]
        if word[-1] in ".,;:!?|" and word[:-1].isalpha():
            return [piece[:-1], word[-1]]
    return None


class RankCodec:
    """Tables for one file of ranks; small, built once on the driver and broadcast.
    A worker keeps the object, and with it the pieces it has encoded."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("the ranks must hold every single byte")
        self.ranks, self.pattern = ranks, pattern
        self.plain = r" ?\p{L}+|" in pattern and r" ?[^\s\p{L}\p{N}]+|" in pattern
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self._hash_pairs(np.fromiter(pairs, np.uint64, len(pairs)), np.fromiter(pairs.values(), np.int32, len(pairs)))
        by_id = sorted((rank, token) for token, rank in ranks.items())
        if [r for r, _ in by_id] != list(range(len(by_id))):
            raise ValueError("ranks must be 0, 1, 2, ...")
        self.token_lengths = np.array([len(t) for _, t in by_id], np.int64)
        self.token_starts = np.cumsum(self.token_lengths) - self.token_lengths
        self.token_bytes = np.frombuffer(b"".join(t for _, t in by_id), np.uint8)
        self.table = None

    @classmethod
    def from_file(cls, path: str, pattern: str) -> "RankCodec":
        with open(path, "rb") as file:
            rows = (line.split() for line in file if line.strip())
            return cls({base64.b64decode(token): int(rank) for token, rank in rows}, pattern)

    def __getstate__(self):
        return self.__dict__ | {"table": None}

    def _hash_pairs(self, keys, merged):
        """Open addressing; a slot holds its pair and the id of the merged token."""
        bits = max(4, int(np.ceil(np.log2(4 * len(keys) + 1))))
        self.shift, self.mask = np.uint64(64 - bits), np.int64(2**bits - 1)
        self.slot_key = np.full(2**bits, 2**64 - 1, np.uint64)
        self.slot_id = np.full(2**bits, _NONE, np.int32)
        at, left = (keys * _MIX >> self.shift).astype(np.int64), np.arange(len(keys))
        while len(left):
            free = left[self.slot_id[at[left]] == _NONE]
            first = free[np.unique(at[free], return_index=True)[1]]
            self.slot_key[at[first]], self.slot_id[at[first]] = keys[first], merged[first]
            left = np.setdiff1d(left, first, assume_unique=True)
            at[left] = at[left] + 1 & self.mask

    def pair_ranks(self, left, right):
        """Rank of the token that each pair of ids merges to, or a number above all."""
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        at = (keys * _MIX >> self.shift).astype(np.int64)
        out = np.full(keys.shape, _NONE, np.int32)
        open_ = np.flatnonzero(self.slot_id[at] != _NONE)
        while len(open_):
            same = self.slot_key[at[open_]] == keys[open_]
            out[open_[same]] = self.slot_id[at[open_[same]]]
            open_ = open_[~same]
            at[open_] = at[open_] + 1 & self.mask
            open_ = open_[self.slot_id[at[open_]] != _NONE]
        return out

    def _merge_rows(self, rows):
        """Ids of pretokens of similar length, as one padded matrix, and how many
        of each row count."""
        lengths = np.array([len(r) for r in rows])
        width = int(lengths.max())
        ids = np.zeros((len(rows), width), np.int32)
        ids[np.arange(width) < lengths[:, None]] = self.byte_ids[np.frombuffer(b"".join(rows), np.uint8)]
        ranks = np.full((len(rows), width), _NONE, np.int32)
        r, c = np.nonzero(np.arange(1, width + 1) < lengths[:, None])
        ranks[r, c] = self.pair_ranks(ids[r, c], ids[r, c + 1])
        done, done_lengths, row_of = np.zeros_like(ids), lengths.copy(), np.arange(len(rows))
        while len(row_of):
            place = ranks.argmin(axis=1)
            lowest = ranks[np.arange(len(row_of)), place]
            busy = lowest != _NONE
            if not busy.all():
                over = row_of[~busy]
                done[over, : ids.shape[1]], done_lengths[over] = ids[~busy], lengths[~busy]
                ids, ranks, lengths, row_of, place, lowest = (x[busy] for x in (ids, ranks, lengths, row_of, place, lowest))
                if not len(row_of):
                    break
                ids, ranks = ids[:, : lengths.max()], ranks[:, : lengths.max()]
            n = np.arange(len(row_of))
            ids[n, place] = lowest
            later = np.arange(ids.shape[1] - 1) > place[:, None]
            ids[:, :-1][later] = ids[:, 1:][later]
            ranks[:, :-1][later] = ranks[:, 1:][later]
            lengths -= 1
            ranks[n, lengths - 1] = _NONE
            for at in (place - 1, place):
                ok = np.flatnonzero((at >= 0) & (at + 1 < lengths))
                ranks[ok, at[ok]] = self.pair_ranks(ids[ok, at[ok]], ids[ok, at[ok] + 1])
        return done, done_lengths

    def _merge_long(self, row):
        """One long pretoken: the same merges in the same order, from a heap."""
        ids = self.byte_ids[np.frombuffer(row, np.uint8)]
        ranks = self.pair_ranks(ids[:-1], ids[1:]).tolist() + [int(_NONE)]
        ids, after, before = ids.tolist(), list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = [(rank, i) for i, rank in enumerate(ranks) if rank != _NONE]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            if ids[i] < 0 or ranks[i] != rank:
                continue
            j = after[i]
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[i] < len(ids):
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0:
                    right = after[k]
                    pair = self.pair_ranks(np.array([ids[k]]), np.array([ids[right]])) if right < len(ids) else [_NONE]
                    ranks[k] = int(pair[0])
                    if ranks[k] != _NONE:
                        heapq.heappush(heap, (ranks[k], k))
        return np.array([i for i in ids if i >= 0], np.int32)

    def encode_pretokens(self, pretokens: list[bytes]):
        """Ids of all pretokens one after the other, and how many each has."""
        rank = self.ranks.get
        whole = np.array([rank(p, -1) for p in pretokens], np.int32)
        sizes = np.fromiter(map(len, pretokens), np.int64, len(pretokens))
        counts, parts = np.ones(len(pretokens), np.int64), [(np.flatnonzero(whole >= 0), whole[whole >= 0])]
        for i in np.flatnonzero((whole < 0) & (sizes > _LONG)):
            ids = self._merge_long(pretokens[i])
            counts[i] = len(ids)
            parts.append((np.array([i]), ids))
        rest = np.flatnonzero((whole < 0) & (sizes <= _LONG))
        buckets = sizes[rest] + 1 & ~1
        for width in np.unique(buckets):
            members = rest[buckets == width]
            step = max(1, 100_000 // int(width))
            for part in np.split(members, range(step, len(members), step)):
                ids, counts[part] = self._merge_rows([pretokens[i] for i in part])
                parts.append((part, ids[np.arange(ids.shape[1]) < counts[part, None]]))
        starts, flat = np.cumsum(counts) - counts, np.empty(int(counts.sum()), np.int32)
        for members, ids in parts:
            flat[ranges(starts[members], counts[members])] = ids
        return flat, counts

    def _encode_pieces(self, texts):
        import regex

        found = regex.compile(self.pattern).findall
        split = [_plain(t) or found(t) for t in texts] if self.plain else [found(t) for t in texts]
        every = list(chain.from_iterable(split))
        slots = dict(zip(dict.fromkeys(every), count()))
        flat, counts = self.encode_pretokens([p.encode() for p in slots])
        order = np.fromiter(map(slots.__getitem__, every), np.int64, len(every))
        ids = flat[ranges((np.cumsum(counts) - counts)[order], counts[order])]
        ends = np.concatenate([[0], np.cumsum(counts[order])])
        return ids, np.diff(ends[np.cumsum([0, *map(len, split)])])

    def encode(self, texts) -> list[np.ndarray]:
        """Ids of each text; an empty or missing text has none."""
        if self.table is None:
            self.table = PieceTable(self._encode_pieces)
        return self.table.ids(texts)

    def decode(self, ids) -> bytes:
        """The bytes behind ids."""
        ids = np.asarray(ids)
        if len(ids) and int(ids.max()) >= len(self.token_lengths):
            raise ValueError(f"no token has the id {int(ids.max())}")
        return self.token_bytes[ranges(self.token_starts[ids], self.token_lengths[ids])].tobytes()


def encode_texts(df: DataFrame, codec: RankCodec, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the token ids of its texts as column ``ids``: BINARY,
    little-endian unsigned 32-bit numbers, empty for an empty or missing text.

    All other columns pass by unchanged; a column of the name ``ids`` is replaced.
    Each row stands for itself, so copies, ties and missing keys make no
    difference; an empty table stays empty. Texts are encoded whole.
    """
    codec_here = share(df.sparkSession, codec)

    @F.arrow_udf("binary")
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for texts in slices(batch):
                out = [row.astype("<u4").tobytes() for row in codec_here().encode(texts.to_pylist())]
                yield pa.array(out, pa.binary())

    return df.withColumn(ids, encoded(F.col(f"`{text}`")))


def decode_ids(df: DataFrame, codec: RankCodec, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the bytes behind the ids of ``encode_texts`` as BINARY column
    ``decoded``, empty for missing or no ids. An unknown id fails the job."""
    codec_here = share(df.sparkSession, codec)

    @F.arrow_udf("binary")
    def bytes_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for part in slices(batch):
                rows = (np.frombuffer(v.as_buffer() if v.is_valid else b"", "<u4") for v in part)
                yield pa.array([codec_here().decode(row) for row in rows], pa.binary())

    return df.withColumn(decoded, bytes_of(F.col(f"`{ids}`")))


def token_count(ids: str = "ids"):
    """Number of ids in a column of ``encode_texts``."""
    return (F.octet_length(F.col(f"`{ids}`")) / 4).cast("long")
