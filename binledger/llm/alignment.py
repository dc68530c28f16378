"""Two tokenizers' tokens of the same bytes, cut into the smallest groups that agree.

Every token points to the token that overlaps it and reaches farthest to the right;
doubling these pointers until they rest leads each token to the last one of its group.
"""

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from binledger.llm.pieces import CUT, groups, ranges, split
from binledger.llm.staging import share

_ALIGNED = "groups string, links binary, n_a long, n_b long, n_groups long, n_links long"


def byte_characters() -> dict:
    """Byte of each character of byte-level vocabularies: printable Latin-1 characters stand
    for themselves, the other bytes in ascending order for the characters from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class ByteLevelCodec:
    """A byte-level vocabulary of the tokenizers library, from its JSON; strings of special
    tokens are plain text."""

    def __init__(self, json: str):
        self.json = json

    def open(self):
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(self.json)
        library.encode_special_tokens = True
        of = byte_characters()
        names = library.get_vocab()
        self.token_bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.token_bytes[i] = bytes(of[c] for c in name) if all(c in of for c in name) else name.encode()
        self.n_bytes = np.array([len(x) for x in self.token_bytes], np.int64)
        self.library = library
        return self

    def encode(self, pieces) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a space and each piece, one after the other, and how many each has. Pieces
        that neither begin nor end with white space are encoded as one text, as fewer calls."""
        alone = np.array([t[0].isspace() or t[-1].isspace() for t in pieces], bool)
        order = np.argsort(alone, kind="stable")
        spaced, n = [" " + pieces[i] for i in order.tolist()], len(pieces) - int(alone.sum())
        texts = ["".join(spaced[k : min(k + 1000, n)]) for k in range(0, n, 1000)] + spaced[n:]
        rows = self.library.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(r.ids for r in rows), np.int64)
        ends = np.cumsum([len(t.encode()) for t in spaced])
        last = np.searchsorted(np.cumsum(self.n_bytes[ids]), ends) + 1
        counts = np.diff(last, prepend=0)
        of = np.argsort(order)
        return ids[ranges((last - counts)[of], counts[of])], counts[of]


class PieceModelCodec:
    """A sentencepiece model with byte fallback, from its file's bytes; it adds the space."""

    def __init__(self, model: bytes):
        self.model = model

    def open(self):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=self.model)
        ids = range(self.library.get_piece_size())
        names = self.library.id_to_piece(list(ids))
        self.token_bytes = [
            bytes([int(name[3:5], 16)]) if self.library.is_byte(i) else name.replace("▁", " ").encode() for i, name in zip(ids, names)
        ]
        self.n_bytes = np.array([len(x) for x in self.token_bytes], np.int64)
        return self

    def encode(self, pieces) -> tuple[np.ndarray, np.ndarray]:
        rows = self.library.encode(pieces, num_threads=1)
        return np.fromiter(chain.from_iterable(rows), np.int64), np.fromiter(map(len, rows), np.int64, len(rows))


def terminals(a_ends, b_ends) -> tuple[np.ndarray, np.ndarray]:
    """For tokens of A and of B that tile the same bytes, given by the places where they
    end: the token of B that ends the group of each token of A, and of each of B."""
    n_a = len(a_ends)
    ends = np.concatenate([a_ends, b_ends])
    # The token of the other side that holds a token's last byte reaches farthest.
    over_a = n_a + np.searchsorted(b_ends, a_ends)
    over_b = np.searchsorted(a_ends, b_ends)
    to = np.concatenate([over_a, np.where(a_ends[over_b] > b_ends, over_b, n_a + np.arange(len(b_ends)))])
    assert (ends[to] >= ends).all()
    while True:
        beyond = to[to]
        if (beyond == to).all():
            return to[:n_a] - n_a, to[n_a:] - n_a
        to = beyond


class Aligner:
    """Aligns whole pieces (see ``pieces``), each different one once: neither vocabulary
    has a token that crosses a space between two other characters, so all tokens of both
    end there. Forgets all pieces when it holds ``most``, which changes no result."""

    def __init__(self, a, b, most: int = 300_000):
        self.a, self.b, self.most = a, b, most
        self.slots = None

    def __getstate__(self):
        return {"a": self.a, "b": self.b, "most": self.most, "slots": None}

    def open(self):
        self.a, self.b = self.a.open(), self.b.open()
        self.spelled = [str(i) for i in range(max(len(self.a.token_bytes), len(self.b.token_bytes)))]
        self.pairs = possible_pairs(self.a.token_bytes, self.b.token_bytes)
        self._forget()
        return self

    def _forget(self):
        self.slots, self.names = {}, []
        # Tokens of A, of B, groups, links and whether the bytes agree; links one after another.
        self.facts, self.starts = np.zeros((1024, 5), np.int64), np.zeros(1024, np.int64)
        self.links, self.used = np.zeros(4096, np.int32), 0

    def _learn(self, texts):
        """Aligns new pieces, all at once as if they were one text."""
        (a, n_a), (b, n_b) = self.a.encode(texts), self.b.encode(texts)
        targets = [b" " + t.encode() for t in texts]
        good = _gives_back(self.a, a, n_a, targets) & _gives_back(self.b, b, n_b, targets)
        if not good.all():
            a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
            n_a, n_b = n_a * good, n_b * good
        a_ends, b_ends = np.cumsum(self.a.n_bytes[a]), np.cumsum(self.b.n_bytes[b])
        of_a, of_b = terminals(a_ends, b_ends)
        last = np.unique(of_b)  # in the order of the text
        piece = np.repeat(np.arange(len(texts)), n_b)[last]
        n_groups = np.bincount(piece, minlength=len(texts))
        # The two last tokens of a group end together, and no others.
        links = pair_places(self.pairs, a[np.searchsorted(a_ends, b_ends[last])], b[last])
        self._name(a, b, of_a, of_b, last, n_groups)
        n, k = len(self.slots), len(texts)
        while n + k > len(self.starts):
            self.facts, self.starts = (np.concatenate([x, np.zeros_like(x)]) for x in (self.facts, self.starts))
        while self.used + len(links) > len(self.links):
            self.links = np.concatenate([self.links, np.zeros_like(self.links)])
        self.facts[n : n + k] = np.stack([n_a, n_b, n_groups, n_groups, good.astype(np.int64)], axis=1)
        self.starts[n : n + k] = self.used + np.cumsum(n_groups) - n_groups
        self.links[self.used : self.used + len(links)] = links
        self.used += len(links)
        self.slots.update(zip(texts, range(n, n + k)))

    def _name(self, a, b, of_a, of_b, last, n_groups):
        """The groups of each piece as text."""
        at_a = np.searchsorted(of_a, last, "right").tolist()
        at_b = np.searchsorted(of_b, last, "right").tolist()
        spelled = self.spelled.__getitem__
        a, b = list(map(spelled, a.tolist())), list(map(spelled, b.tolist()))
        names = [
            ",".join(a[i:j]) + "|" + ",".join(b[k:m]) for i, j, k, m in zip([0, *at_a], at_a, [0, *at_b], at_b)
        ]
        ends = np.cumsum(n_groups).tolist()
        self.names += [";".join(names[i:j]) for i, j in zip([0, *ends], ends)]

    def _pieces(self, text):
        """The pieces of a space and the text, without the space they begin with."""
        if text[0].isspace() or text[-1].isspace():
            return CUT.split(text)
        first, *others = split(text)
        return [first[0], *others]

    def align(self, texts) -> pa.RecordBatch:
        """groups, links, n_a, n_b, n_groups, n_links of each text."""
        if self.slots is None:
            self.open()
        if len(self.slots) > self.most:
            self._forget()
        keys, counts = [], []
        for text in texts:
            row = self._pieces(text) if text else []
            keys += row
            counts.append(len(row))
        new = list(set(keys).difference(self.slots))
        if new:
            self._learn(new)
        slots = np.fromiter(map(self.slots.__getitem__, keys), np.int64, len(keys))
        ends = np.cumsum([0, *counts])
        total = np.concatenate([np.zeros((1, 5), np.int64), np.cumsum(self.facts[slots], axis=0)])[ends]
        facts = np.diff(total, axis=0)
        whole = facts[:, 4] == np.array(counts, np.int64)  # every piece gives its bytes back
        lengths = self.facts[slots, 3]
        link_ends = np.concatenate([[0], np.cumsum(lengths)])[ends].tolist()
        links = self.links[ranges(self.starts[slots], lengths)].astype("<i4").tobytes()
        name = self.names.__getitem__
        places = slots.tolist()
        ok, ends = whole.tolist(), ends.tolist()
        named = [";".join(map(name, places[i:j])) if g else "" for i, j, g in zip(ends, ends[1:], ok)]
        held = [links[4 * i : 4 * j] if g else b"" for i, j, g in zip(link_ends, link_ends[1:], ok)]
        columns = [pa.array(named, pa.string()), pa.array(held, pa.binary())]
        columns += [pa.array(np.where(whole, facts[:, i], 0), pa.int64()) for i in range(4)]
        return pa.RecordBatch.from_arrays(columns, names=["groups", "links", "n_a", "n_b", "n_groups", "n_links"])


def _gives_back(codec, ids, counts, targets):
    """Whether the tokens of each piece are its bytes again."""
    ends = np.concatenate([[0], np.cumsum(counts)])
    sizes = np.diff(np.concatenate([[0], np.cumsum(codec.n_bytes[ids])])[ends])
    parts = list(map(codec.token_bytes.__getitem__, ids.tolist()))
    if (sizes == np.array([len(t) for t in targets], np.int64)).all() and b"".join(parts) == b"".join(targets):
        return np.ones(len(targets), bool)
    ends = ends.tolist()
    return np.array([b"".join(parts[i:j]) == t for i, j, t in zip(ends, ends[1:], targets)], bool)


def possible_pairs(a_bytes, b_bytes) -> np.ndarray:
    """All pairs of ids (a << 32 | b, ascending) whose tokens can end together over the
    same bytes: one's bytes end with the other's. No more than the bytes of both
    vocabularies, times the B tokens of equal bytes, whatever texts there are."""
    of_a, of_b, found = {}, {}, set()
    for names, table in ((a_bytes, of_a), (b_bytes, of_b)):
        for i, name in enumerate(names):
            if name:
                table.setdefault(name, []).append(i)
    for name, ids in of_a.items():
        for cut in range(len(name)):
            found.update((a << 32) | b for b in of_b.get(name[cut:], ()) for a in ids)
    for name, ids in of_b.items():
        for cut in range(1, len(name)):
            found.update((a << 32) | b for a in of_a.get(name[cut:], ()) for b in ids)
    return np.array(sorted(found), np.int64)


def pair_places(pairs, a, b):
    """Places of the pairs (a, b) in the table of possible pairs."""
    return np.searchsorted(pairs, (a << 32) | b).astype(np.int32)


def align_tokens(df: DataFrame, codec_a, codec_b, text: str = "text") -> DataFrame:
    """``df`` without the text, with

    - groups: the smallest groups of tokens of A and B that cover the same bytes, as
      ``a1,a2|b1;a3|b2,b3`` (ids in decimal), '' without tokens;
    - links: little-endian int32 for each pair of tokens that end together, its place in
      ``possible_pairs``;
    - n_a, n_b, n_groups, n_links: tokens, groups and links.

    Texts that are missing or empty, or whose tokens of A or B do not give a space and the
    text again, have no tokens. Columns of these names in ``df`` are replaced; rows are
    never joined, so keys may repeat or be missing; no rows give no rows.
    """
    aligner = share(df.sparkSession, Aligner(codec_a, codec_b))
    new = [part.split()[0] for part in _ALIGNED.split(", ")]
    keep = [c for c in df.columns if c != text and c not in new]
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias(text))

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(keep)).to_pylist()
            for i, j in groups(texts):
                found = aligner().align(texts[i:j])
                columns = [batch.column(c).slice(i, j - i) for c in range(len(keep))] + found.columns
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, *new])

    schema = rows.drop(text).schema
    for part in _ALIGNED.split(", "):
        schema = schema.add(*part.split())
    return rows.mapInArrow(align, schema)


def _links(column):
    """All links of a column of lists of them, and where each row's end, after a zero."""
    offsets = np.frombuffer(column.buffers()[1], "<i4")[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    links = np.frombuffer(data, "<i4") if data and data.size else np.zeros(0, "<i4")
    return links[offsets[0] // 4 : offsets[-1] // 4], (offsets - offsets[0]) // 4


def link_counts(aligned: DataFrame) -> DataFrame:
    """pair (place in ``possible_pairs``) and n, how many links of all texts hold it. No
    more rows than possible pairs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            links, _ = _links(batch.column(0))
            found = np.bincount(links, minlength=1)
            if len(found) > len(total):
                total = np.concatenate([total, np.zeros(len(found), np.int64)])
            total[: len(found)] += found
        pair = np.flatnonzero(total)
        for at in range(0, len(pair), 50_000):
            some = pair[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["pair", "n"])

    return aligned.select("links").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def best_links(aligned: DataFrame, counts: DataFrame, pairs: np.ndarray) -> DataFrame:
    """``aligned`` with count_sum, the counts of a text's links added up, and n_best, the
    links whose count is the highest of their B id, ties included; links are dropped.

    The counts go to every task: their number is bounded by the two vocabularies
    (``possible_pairs``), not by the texts."""
    n = np.zeros(len(pairs), np.int64)
    held = counts.toArrow()  # at most len(pairs) rows
    n[held.column("pair").to_numpy()] = held.column("n").to_numpy()
    b = pairs & 0xFFFFFFFF
    best = np.zeros(int(b.max()) + 1, np.int64)
    np.maximum.at(best, b, n)
    table = share(aligned.sparkSession, (n, n == best[b]))
    rows = aligned.drop("n_best", "count_sum")
    at = rows.columns.index("links")
    names = [c for c in rows.columns if c != "links"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, is_best = table()
            links, ends = _links(batch.column(at))
            sums = [np.diff(np.concatenate([[0], np.cumsum(x[links], dtype=np.int64)])[ends]) for x in (is_best, counts)]
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            columns += [pa.array(x, pa.int64()) for x in sums]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_best", "count_sum"])

    schema = rows.drop("links").schema.add("n_best", "long").add("count_sum", "long")
    return rows.mapInArrow(score, schema)
