"""Counting symbols in one executable: the small per-file part that follows
pointers and so cannot be a column expression.

``take(pos, n)`` gives up to ``n`` bytes at a file position, ``size`` is the file
size. Nothing here trusts an address: every read is cut to its section and to
the file, and a list without terminator ends there.
"""

from bisect import bisect_right

import numpy as np

# Published layout of PE section rows, import rows and exports.
SECTION_ROW = np.dtype(
    [
        ("name", "V8"),
        ("virtual_size", "<u4"),
        ("va", "<u4"),
        ("raw_size", "<u4"),
        ("raw_ptr", "<u4"),
        ("rest", "V16"),
    ]
)
IMPORT_ROW = np.dtype(("<u4", 5))
LOOKUP_AT = 0
ADDRESS_AT = 4
EXPORT_TABLE_SIZE = 40
N_FUNCTIONS_AT = 20


def read_sections(take, offset, count):
    """Section table as a structured array, cut to the rows present."""
    raw = take(offset, SECTION_ROW.itemsize * count)
    return np.frombuffer(raw, SECTION_ROW, len(raw) // SECTION_ROW.itemsize)


def section_spans(sections):
    """(first address, address after, file position, position after) per section."""
    va = sections["va"].astype(np.int64)
    raw = sections["raw_size"].astype(np.int64)
    ptr = sections["raw_ptr"].astype(np.int64)
    span = np.maximum(raw, sections["virtual_size"].astype(np.int64))
    return va, va + span, ptr, ptr + raw


def locate(spans, rva, size):
    """File range holding the bytes from ``rva`` to the end of its section. An
    address outside all sections is a file position: headers are mapped flat."""
    va, va_end, ptr, ptr_end = spans
    hits = np.flatnonzero((va <= rva) & (rva < va_end))
    if len(hits) == 0:
        return rva, size
    first = hits[0]
    return int(ptr[first] + rva - va[first]), min(int(ptr_end[first]), size)


def blocks(take, start, end, row):
    """Rows of dtype ``row`` from ``start`` on, in blocks that double in size."""
    width = row.itemsize
    rows = 32
    while end - start >= width:
        raw = take(start, min(rows * width, (end - start) // width * width))
        block = np.frombuffer(raw, row, len(raw) // width)
        if len(block) == 0:
            return
        yield block
        start += len(block) * width
        rows = min(2 * rows, 8192)


class ZeroEndedLists:
    """Lengths of zero-ended lists, scanned where they lie. A damaged file whose rows
    all point into one long list would make that quadratic; so what was scanned is
    kept as stretches without a zero, and a scan that comes to one goes on behind it.
    There are no more stretches than lists."""

    def __init__(self, take, size, width):
        self.take = take
        self.size = size
        self.row = np.dtype(f"<u{width}")
        # By alignment: starts in order, and start -> (end, whether a zero is there).
        self.starts = {}
        self.stretches = {}

    def length(self, start, end):
        width = self.row.itemsize
        most = (end - start) // width
        if most <= 0:
            return 0
        return min((self._next_zero(start, start + most * width) - start) // width, most)

    def _next_zero(self, start, end):
        """Position of the first zero from ``start`` on, or ``end``."""
        width = self.row.itemsize
        starts = self.starts.setdefault(start % width, [])
        stretches = self.stretches.setdefault(start % width, {})
        at = start
        while at < end:
            i = bisect_right(starts, at)
            if i and at <= stretches[starts[i - 1]][0]:
                stop, zero = stretches[starts[i - 1]]
                if zero:
                    return self._keep(starts, stretches, start, stop, True)
                if stop > at:
                    at = stop
                    continue
            until = min(end, starts[i]) if i < len(starts) else end
            for block in blocks(self.take, at, until, self.row):
                zeros = np.flatnonzero(block == 0)
                if len(zeros):
                    return self._keep(starts, stretches, start, at + width * int(zeros[0]), True)
                at += block.nbytes
            if at < until:  # the file ends here
                break
        return self._keep(starts, stretches, start, at, False) if at >= end else end

    def _keep(self, starts, stretches, start, stop, zero):
        """Remember a stretch in place of those it covers; gives its end."""
        i = bisect_right(starts, start)
        if i and stretches[starts[i - 1]][0] >= start:
            i, start = i - 1, starts[i - 1]
            if stretches[start][0] >= stop:
                return stop
        j = i
        while j < len(starts) and starts[j] <= stop:
            end, ended = stretches.pop(starts[j])
            if end >= stop and (end, ended) != (stop, False):
                stretches[start] = (end, ended)
                starts[i : j + 1] = [start]
                return stop
            j += 1
        stretches[start] = (stop, zero)
        starts[i:j] = [start]
        return stop


def dll_symbol_counts(take, size, spans, rva, width):
    """Number of symbols of each import row, up to the all-zero row."""
    lists = ZeroEndedLists(take, size, width)

    def list_length(address):
        return lists.length(*locate(spans, address, size)) if address else 0

    for block in blocks(take, *locate(spans, rva, size), IMPORT_ROW):
        for row in block:
            if not row.any():
                return
            yield list_length(int(row[LOOKUP_AT])) or list_length(int(row[ADDRESS_AT]))


def export_count(take, size, spans, rva):
    """Number of exported functions, 0 unless the whole export table is there."""
    start, end = locate(spans, rva, size)
    table = take(start, EXPORT_TABLE_SIZE) if end - start >= EXPORT_TABLE_SIZE else b""
    if len(table) < EXPORT_TABLE_SIZE:
        return 0
    return int.from_bytes(table[N_FUNCTIONS_AT : N_FUNCTIONS_AT + 4], "little")
