"""CRC-32 of texts in SQL, for engines without such a function."""

from __future__ import annotations

# Remainders of all bytes, from the reflected polynomial.
TABLE = """
crc_table AS (
    SELECT list(c ORDER BY i) AS entries FROM (
        SELECT i, list_reduce(range(8), lambda c, _: xor(c >> 1, CASE WHEN (c & 1) = 1 THEN 3988292384 ELSE 0 END), i) AS c
        FROM range(256) AS t(i)
    )
)"""


def crc32(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes; ``crc_table`` must be in scope."""
    digits = f"hex(encode({text}))"
    octets = f"list_transform(range(0, len({digits}), 2), lambda i: ('0x' || {digits}[i + 1:i + 2])::BIGINT)"
    step = "lambda c, b: xor(entries[(xor(c, b) & 255) + 1], c >> 8)"
    return f"xor(list_reduce({octets}, {step}, 4294967295), 4294967295)"
