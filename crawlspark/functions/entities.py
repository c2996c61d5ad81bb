"""HTML character references in attribute values, decoded inside the JVM."""

from __future__ import annotations

import html.entities
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The HTML5 replacements for numeric references to the C1 control block (empty means itself).
_C1 = ["€", "", "‚", "ƒ", "„", "…", "†", "‡", "ˆ", "‰", "Š", "‹", "Œ", "", "Ž", "",
       "", "‘", "’", "“", "”", "•", "–", "—", "˜", "™", "š", "›", "œ", "", "ž", "Ÿ"]

# A reference, a stretch without one, or a lone ampersand.
_PIECES = r"(?s)&(?:#[0-9]++;?|#[xX][0-9a-fA-F]++;?|[^\t\n\f <&#;]{1,32}+;?)|[^&]++|&"


@lru_cache(maxsize=1)
def _tables() -> tuple[str, str]:
    """The named references of the standard, as a foldable map text and as a pattern of the ``;``-less names."""
    pairs = "\x01".join(f"{name}\x02{value}" for name, value in html.entities.html5.items())
    bare = sorted((n for n in html.entities.html5 if not n.endswith(";")), key=len, reverse=True)
    return pairs, "^(" + "|".join(bare) + ")"


def _character(code: Column) -> Column:
    """Text of one code point."""
    plain = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    c1 = F.element_at(F.array(*[F.lit(c or chr(0x80 + i)) for i, c in enumerate(_C1)]), (code - 0x7F).cast("int"))
    return (F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF) | code.isNull(), F.lit("�"))
            .when(code == 0x0D, F.lit("\r"))
            .when(code.between(0x80, 0x9F), c1)
            .when(code.between(1, 8) | code.between(0x0E, 0x1F) | (code == 0x7F) | (code == 0x0B)
                  | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(0xFFFE) == 0xFFFE), F.lit(""))
            .otherwise(plain))


def unescape(text: Column) -> Column:
    """Replace character references as browsers do, ``;`` missing included. Text without ``&`` is passed through."""
    pairs, bare = _tables()
    names = F.str_to_map(F.lit(pairs), F.lit("\x01"), F.lit("\x02"))

    def one(piece: Column) -> Column:
        digits = F.regexp_extract(piece, r"^&#([0-9]+);?$", 1)
        hexes = F.regexp_extract(piece, r"^&#[xX]([0-9a-fA-F]+);?$", 1)
        name = F.substring(piece, 2, 64)
        prefix = F.regexp_extract(name, bare, 1)
        rest = F.substring(name, F.length(prefix) + 1, F.lit(64))
        number = F.when(digits != "", F.when(F.length(F.ltrim(digits, F.lit("0"))) < 10, digits.cast("long"))
                        .otherwise(F.lit(0x110000).cast("long")))
        number = number.otherwise(F.when(F.length(F.ltrim(hexes, F.lit("0"))) < 9,
                                         F.conv(hexes, 16, 10).cast("long")).otherwise(F.lit(0x110000).cast("long")))
        return (F.when(~piece.startswith("&") | (piece == "&"), piece)
                .when((digits != "") | (hexes != ""), _character(number))
                .otherwise(F.coalesce(
                    F.try_element_at(names, name),
                    F.when(prefix != "", F.concat(F.try_element_at(names, prefix), rest)),
                    piece)))

    pieces = F.transform(F.regexp_extract_all(text, F.lit(_PIECES), F.lit(0)), one)
    return F.when(text.contains("&"), F.array_join(pieces, "")).otherwise(text)
