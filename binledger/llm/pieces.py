"""Texts as rows of known pieces. A piece is what stands between two spaces that
have a character other than white space on both sides, with the space before it. No
match of the tokenizers' splitting pattern crosses such a space, so pieces are
encoded apart from each other, each different one once."""

import re

import numpy as np
import pyarrow.compute as pc

_OTHER_SPACE = [chr(c) for c in range(0x3001) if chr(c).isspace() and c != 0x20]
CUT = re.compile(r"(?<=\S) (?=\S)")


def split(text: str) -> list:
    """Keys of the pieces of a text: the first as a tuple, a later one as the
    string behind its space."""
    run = "  " in text or any(c in text and (" " + c in text or c + " " in text) for c in _OTHER_SPACE)
    parts = CUT.split(text) if run else text.split(" ")
    parts[0] = (parts[0],)
    return parts


class PieceTable:
    """Token ids of pieces, encoded when first met. It forgets all of them once it
    holds ``most`` pieces, which bounds memory and changes no result."""

    def __init__(self, encode, most=250_000):
        self.encode, self.most = encode, most
        self._forget()

    def _forget(self):
        self.slots, self.count, self.used = {}, 0, 0
        self.start, self.length = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.flat = np.zeros(4096, np.uint32)

    def _learn(self, keys):
        texts = [k[0] if type(k) is tuple else " " + k for k in keys]
        ids, lengths = self.encode(texts)
        while self.count + len(keys) > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        at = slice(self.count, self.count + len(keys))
        self.length[at] = lengths
        self.start[at] = self.used + np.cumsum(lengths) - lengths
        self.flat[self.used : self.used + len(ids)] = ids
        self.slots.update(zip(keys, range(at.start, at.stop)))
        self.count, self.used = at.stop, self.used + len(ids)

    def ids(self, texts) -> list[np.ndarray]:
        """Token ids of each text."""
        if self.count > self.most:
            self._forget()
        keys, counts = [], []
        for text in texts:
            row = split(text) if text else []
            keys += row
            counts.append(len(row))
        new = list(set(keys).difference(self.slots))
        if new:
            self._learn(new)
        slots = np.fromiter(map(self.slots.__getitem__, keys), np.int64, len(keys))
        lengths = self.length[slots]
        ids = self.flat[ranges(self.start[slots], lengths)]
        token_ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum([0, *counts])]
        return [ids[a:b] for a, b in zip(token_ends[:-1], token_ends[1:])]


def ranges(starts, lengths):
    """The numbers start, start + 1, ... of each range, one range after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def groups(texts, characters=1_000_000):
    """Slices of a list of texts of about so many characters; a longer text is a
    slice of its own."""
    begin = size = 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if size and size + n > characters:
            yield begin, i
            begin, size = i, 0
        size += n
    if begin < len(texts):
        yield begin, len(texts)


def slices(column, size=1 << 20):
    """Slices of an Arrow array of strings or binaries of about so many bytes; a longer
    value is a slice of its own. An empty array has one, itself."""
    if not len(column):
        yield column
        return
    lengths = np.nan_to_num(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(float))
    begin = held = 0
    for i, n in enumerate(lengths.tolist()):
        if held and held + n > size:
            yield column.slice(begin, i - begin)
            begin, held = i, 0
        held += n
    yield column.slice(begin)
