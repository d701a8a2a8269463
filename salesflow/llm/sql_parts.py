"""Parts of SQL texts that several operators share."""

from __future__ import annotations

# The checksum's table for half a byte.
_HALF_BYTES = [
    0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
    3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108,
]


def crc32_sql(digits: str) -> str:
    """The unsigned crc32 of bytes whose hexadecimal digits an expression gives, half a byte at a time."""
    halves = (
        f"list_transform(range(0, length({digits})),"
        f" lambda i: instr('0123456789ABCDEF', {digits}[xor(i, 1) + 1])::bigint - 1)"
    )
    step = f"xor(c >> 4, list_extract({_HALF_BYTES}::bigint[], (xor(c, x) & 15) + 1))"
    return f"xor(4294967295::bigint, list_reduce(list_prepend(4294967295::bigint, {halves}), lambda c, x: {step}))"
