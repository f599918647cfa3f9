"""CRC-32 as a DuckDB expression, for the statements that check queries over hashed ids."""

from __future__ import annotations

POLYNOMIAL = 3988292384  # fixed value of the standard
ONES = 4294967295


def crc32_sql(text: str) -> str:
    """The unsigned CRC-32 of the UTF-8 of ``text``, an SQL string of code points below 2048.

    Every byte is mixed in, then eight steps (marked -1) shift one bit out each.
    """
    code = "unicode(ch)::BIGINT"
    utf8 = f"flatten(list_transform(string_split({text}, ''), lambda ch: CASE WHEN {code} < 128 THEN [{code}] ELSE [192 | ({code} >> 6), 128 | ({code} & 63)] END))"
    steps = f"flatten(list_transform({utf8}, lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1]))"
    one = f"CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, {POLYNOMIAL} * (c & 1)) END"
    return f"xor(list_reduce(list_prepend({ONES}, {steps}), lambda c, x: {one}), {ONES})"
