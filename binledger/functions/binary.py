"""SQL text for little-endian numbers in BINARY columns and hex digits."""


def read_uint(data: str, offset, width: int) -> str:
    """Unsigned little-endian integer of ``width`` bytes at a 0-based offset, as
    BIGINT. Bytes past the end count as absent digits: callers see to it that the
    field is there."""
    digits = ", ".join(f"hex(substring({data}, {offset} + {i}, 1))" for i in range(width, 0, -1))
    return f"cast(conv(concat({digits}), 16, 10) as bigint)"


def u16(data: str, offset) -> str:
    return read_uint(data, offset, 2)


def u32(data: str, offset) -> str:
    return read_uint(data, offset, 4)


def hex_le(value, width: int = 4) -> str:
    """Hex digits of an unsigned integer below 2**(8 * width), lowest byte first."""
    value = f"cast({value} as bigint)"
    swapped = " | ".join(
        f"shiftleft(shiftright({value}, {8 * i}) & 255, {8 * (width - 1 - i)})" for i in range(width)
    )
    return f"lpad(hex({swapped}), {2 * width}, '0')"


def zeros(n) -> str:
    """Hex digits of ``n`` zero bytes."""
    return f"'{'00' * n}'" if isinstance(n, int) else f"repeat('00', {n})"
