"""Small string helpers with the white-space rules the results rely on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters that count as white space when a text is stripped.
WHITE_SPACE = "".join(
    chr(code)
    for code in (
        *range(0x09, 0x0E),
        *range(0x1C, 0x21),
        0x85,
        0xA0,
        0x1680,
        *range(0x2000, 0x200B),
        0x2028,
        0x2029,
        0x202F,
        0x205F,
        0x3000,
    )
)

# Line ends inside a line of a text file: all but \n, \r and \r\n, which the
# reader has already split on.
INNER_LINE_ENDS = r"[\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"


def strip(col: Column) -> Column:
    """Without leading and trailing white space of any kind, not only blanks."""
    return F.btrim(col, F.lit(WHITE_SPACE))


def is_blank(col: Column) -> Column:
    return strip(col) == ""


def join_nonempty(*cols: Column) -> Column:
    """Non-empty parts joined by one space, then stripped."""
    return strip(F.concat_ws(" ", *[F.nullif(c, F.lit("")) for c in cols]))


def stable_id(*parts: Column) -> Column:
    """An id in UUID shape that depends only on ``parts``.

    Unlike a random id it comes out the same when a lost task is recomputed.
    """
    digest = F.sha2(F.to_json(F.array(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts])), 256)
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.substring(digest, 13, 4),
        F.substring(digest, 17, 4),
        F.substring(digest, 21, 12),
    )
