"""Folding text to lower-case ASCII, and keys made from names."""

from __future__ import annotations

import unicodedata
from functools import lru_cache
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from umbu.fixed_values import WHITE_SPACE


@lru_cache(maxsize=1)
def _foldings() -> tuple[str, str, dict[str, str]]:
    """Characters whose compatibility form holds ASCII, by how much of it.

    Returns the ones that fold to a single character, their images in the same
    order, and a dict of those that fold to several. All others vanish.
    """
    single, image, several = [], [], {}
    for code in chain(range(0x80, 0xD800), range(0xE000, 0x110000)):
        char = chr(code)
        ascii_part = "".join(filter(str.isascii, unicodedata.normalize("NFKD", char)))
        if len(ascii_part) == 1:
            single.append(char)
            image.append(ascii_part)
        elif ascii_part:
            several[char] = ascii_part
    return "".join(single), "".join(image), several


def _char_class(chars) -> str:
    """Regex class of the characters, with runs written as ranges."""
    runs: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if runs and code == runs[-1][1] + 1:
            runs[-1][1] = code
        else:
            runs.append([code, code])
    return "[" + "".join(chr(a) if a == b else f"{chr(a)}-{chr(b)}" for a, b in runs) + "]"


def strip_white_space(text: Column) -> Column:
    """Strip every kind of ASCII white space; ``F.trim`` strips blanks only."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def to_ascii(text: Column) -> Column:
    """Compatibility-decompose and keep the ASCII part only.

    Text that is ASCII already is passed through after a length check. In the
    rest, characters such as ½ or a ligature are written out first, but only
    those that occur, then one ``translate`` maps the accented ones. Looking for
    them among the non-ASCII characters alone is what keeps long texts fast.
    """
    single, image, several = _foldings()
    pairs = "\x1e".join(f"{char}\x1f{ascii_part}" for char, ascii_part in several.items())
    table = F.str_to_map(F.lit(pairs), F.lit("\x1e"), F.lit("\x1f"))
    special = F.regexp_replace(text, r"[\x00-\x7F]+", "")
    found = F.array_distinct(
        F.regexp_extract_all(special, F.lit(_char_class(several)), F.lit(0))
    )
    written_out = F.aggregate(
        found, text, lambda acc, char: F.replace(acc, char, F.try_element_at(table, char))
    )
    plain = F.regexp_replace(F.translate(written_out, single, image), r"[^\x00-\x7F]+", "")
    return F.when(F.octet_length(text) == F.char_length(text), text).otherwise(plain)


def fold(text: Column) -> Column:
    """Accent-free lower-case ASCII without outer white space; null stays null."""
    return strip_white_space(F.lower(to_ascii(text)))


def city_key(name: Column) -> Column:
    """Join key of a city as named in a price sheet (``são_paulo``)."""
    return F.replace(fold(name), F.lit("_"), F.lit(" "))
