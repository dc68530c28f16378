"""Generator of small executables with known counts, packed with ``struct``."""

import random
import struct

CORRUPTED = (None, -1, -1)


def build(
    bits=32,
    dlls=(),
    exports=None,
    size_of_headers=512,
    header_offset=64,
    magic=None,
    n_directories=16,
    names=(b".text", b".idata"),
    sizes=None,
    lookup_zero=False,
    import_rva=None,
    pad=0,
):
    """Bytes of a file with the given symbol counts per DLL; ``exports=None``
    means no export directory. ``sizes`` overrides the sections' raw sizes."""
    wide = bits == 64
    fixed = 112 if wide else 96
    width = 8 if wide else 4
    start = header_offset + 24 + fixed + 8 * n_directories + 40 * len(names)
    va = 0x3000

    lists, where = b"", []
    table_at = va + 40
    lists_at = table_at + 20 * (len(dlls) + 1)
    for count in dlls:
        where.append(lists_at + len(lists))
        lists += struct.pack("<Q" if wide else "<I", 1 << (8 * width - 1) | 7) * count + b"\0" * width
    table = b"".join(struct.pack("<5I", 0 if lookup_zero else at, 0, 0, 0, at if lookup_zero else 0) for at in where)
    payload = struct.pack("<5I", 0, 0, 0, 0, 0) + struct.pack("<I", exports or 0) + b"\0" * 16
    payload += table + b"\0" * 20 + lists + b"\0" * pad

    if import_rva is None:
        import_rva = table_at if dlls else 0
    directories = [(va, 40) if exports is not None else (0, 0), (import_rva, 20 * (len(dlls) + 1) if import_rva else 0)]
    directories = (directories + [(0, 0)] * 16)[:n_directories]

    out = b"MZ" + b"\0" * 58 + struct.pack("<I", header_offset)
    out = out.ljust(header_offset, b"\0") + b"PE\0\0"
    out += struct.pack("<HHIIIHH", 0x8664 if wide else 0x14C, len(names), 0, 0, 0, fixed + 8 * n_directories, 2)
    optional = struct.pack("<H", magic if magic is not None else (0x20B if wide else 0x10B)).ljust(60, b"\0")
    optional += struct.pack("<I", size_of_headers)
    out += optional.ljust(fixed - 4, b"\0") + struct.pack("<I", n_directories)
    out += b"".join(struct.pack("<II", *d) for d in directories)
    for i, name in enumerate(names):
        last = i == len(names) - 1
        raw = len(payload) if last else 32 * (i + 1)
        if sizes:
            raw = sizes[i]
        out += name.ljust(8, b"\0") + struct.pack("<4I", raw, va if last else 0x100 * (i + 1), raw, start) + b"\0" * 16
    return out + payload


def random_file(rng: random.Random):
    """(bytes, architecture, imports, exports) of a random sound file."""
    bits = rng.choice([32, 64])
    dlls = [rng.randrange(0, 400) for _ in range(rng.randrange(0, 12))]
    exports = rng.choice([None, rng.randrange(0, 5000)])
    header_offset = rng.choice([64, 72, 128, 900, 1016, 3000, 7000])
    data = build(
        bits, dlls, exports, header_offset=header_offset, lookup_zero=rng.random() < 0.3, pad=rng.randrange(0, 2000),
        names=[b".s%d" % i for i in range(rng.randrange(1, 6))],
    )
    return data, str(bits), sum(dlls), exports or 0


def brute_force(data: bytes):
    """(architecture, imports, exports) entry by entry, by the plainest reading of
    the layout; for comparison on small files."""
    u16 = lambda at: int.from_bytes(data[at : at + 2], "little")
    u32 = lambda at: int.from_bytes(data[at : at + 4], "little")
    head = data[:8192]
    nt = u32(60)
    if len(head) < 64 or head[:2] != b"MZ" or head[nt : nt + 4] != b"PE\0\0" or nt + 24 + 96 > len(head):
        return CORRUPTED
    wide = u16(nt + 24) == 0x20B
    fixed_end = nt + 24 + (112 if wide else 96)
    if fixed_end > len(head) or u16(nt + 24) not in (0x10B, 0x20B):
        return CORRUPTED
    if u32(nt + 24 + 60) > -(-fixed_end // 1024) * 1024 or u32(fixed_end - 4) < 2 or fixed_end + 16 > len(head):
        return CORRUPTED
    sections = []
    for i in range(u16(nt + 6)):
        at = nt + 24 + u16(nt + 20) + 40 * i
        if at + 40 <= len(data):
            sections.append([u32(at + k) for k in (8, 12, 16, 20)])

    def place(rva):
        for virtual, va, raw, ptr in sections:
            if va <= rva < va + max(virtual, raw):
                return ptr + rva - va, min(ptr + raw, len(data))
        return rva, len(data)

    def symbols(rva):
        (at, end), n = place(rva) if rva else (0, 0), 0
        width = 8 if wide else 4
        while at + width <= end and any(data[at : at + width]):
            at, n = at + width, n + 1
        return n

    imports = exports = 0
    if u32(fixed_end + 8):
        at, end = place(u32(fixed_end + 8))
        while at + 20 <= end and any(data[at : at + 20]):
            imports += symbols(u32(at)) or symbols(u32(at + 16))
            at += 20
    if u32(fixed_end):
        at, end = place(u32(fixed_end))
        exports = u32(at + 20) if at + 40 <= end else 0
    return "64" if wide else "32", imports, exports


# name -> (bytes, expected architecture, imports, exports)
NAMED = {
    "/0/a.exe": (build(64, [100, 55]).ljust(170_496, b"\0"), "64", 155, 0),
    "/0/b.dll": (build(32, [3], 7), "32", 3, 7),
    "/0/noimp.dll": (build(32, [], 2), "32", 0, 2),
    "/1/c%20d.exe": (build(64, [1, 2, 3], 5), "64", 6, 5),
    "/1/big.exe": (build(64, [2], size_of_headers=4096), *CORRUPTED),
    "/1/junk.dll": (b"x" * 528, *CORRUPTED),
    "/1/junk.exe": (b"MZ" + b"x" * 541, *CORRUPTED),
    "/1/empty.exe": (b"", *CORRUPTED),
    "/1/cut.exe": (build(32, [50])[:-100], "32", 26, 0),
    "/1/badmagic.exe": (build(32, [4], magic=0x107), *CORRUPTED),
    "/1/far.dll": (build(32, [4], 9, import_rva=0x7FFFFFF0), "32", 0, 9),
    "/1/thunk.dll": (build(64, [5, 6], lookup_zero=True), "64", 11, 0),
    "/1/x..ab": (b"ab", *CORRUPTED),
}
