"""Accent and compatibility folding (Unicode NFKD without combining marks).

Spark has no normalisation function, so the tables for ``translate`` come from
``unicodedata`` by rule when the module loads.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

HANGUL_FIRST, HANGUL_LAST = 0xAC00, 0xD7A3
SURROGATES = range(0xD800, 0xE000)


def folded_char(char: str) -> str:
    """The compatibility decomposition of one character, its marks left out."""
    parts = unicodedata.normalize("NFKD", char)
    return "".join(filter(lambda part: unicodedata.combining(part) == 0, parts))


def fold_accents(text: str) -> str:
    """Python's counterpart of the tables below, for short constants."""
    return text if text.isascii() else "".join(map(folded_char, text))


@lru_cache(maxsize=1)
def folding_tables() -> tuple[dict[str, str], str, dict[str, str]]:
    """(one-to-one map, deleted characters, one-to-many map) beyond ASCII."""
    single, deleted, several = {}, [], {}
    for code in range(0x80, sys.maxunicode + 1):
        if code in SURROGATES or HANGUL_FIRST <= code <= HANGUL_LAST:
            continue
        char = chr(code)
        folded = folded_char(char)
        if folded == char:
            continue
        if not folded:
            deleted.append(char)
        elif len(folded) == 1:
            single[char] = folded
        else:
            several[char] = folded
    return single, "".join(deleted), several


def _coarse_class(codes, gap: int = 96) -> str:
    """A short regex class that covers the codes, neighbours merged."""
    parts: list[list[int]] = []
    for code in sorted(codes):
        if parts and code - parts[-1][1] <= gap:
            parts[-1][1] = code
        else:
            parts.append([code, code])
    return "[" + "".join(f"\\x{{{lo:x}}}-\\x{{{hi:x}}}" for lo, hi in parts) + "]"


def rare_class() -> str:
    """Regex class of characters that may become several, but the ellipsis."""
    several = folding_tables()[2]
    syllables = set(range(HANGUL_FIRST, HANGUL_LAST + 1, 90)) | {HANGUL_LAST}
    return _coarse_class({ord(c) for c in several} - {0x2026} | syllables)


def _fold_several(char: Column) -> Column:
    """Folding of one character that becomes several."""
    _, _, several = folding_tables()
    keys = F.lit("".join(several))
    values = F.split(F.lit("\n".join(several.values())), "\n")
    syllable = F.ascii(char) - HANGUL_FIRST
    lead = F.substring(F.lit("".join(chr(0x1100 + i) for i in range(19))),
                       F.floor(syllable / 588).cast("int") + 1, F.lit(1))
    vowel = F.substring(F.lit("".join(chr(0x1161 + i) for i in range(21))),
                        F.floor((syllable % 588) / 28).cast("int") + 1, F.lit(1))
    tail = F.substring(F.lit("".join(chr(0x11A8 + i) for i in range(27))),
                       (syllable % 28).cast("int"), F.lit(1))
    is_syllable = char.between(chr(HANGUL_FIRST), chr(HANGUL_LAST))
    return (
        F.when(char <= "\x7f", char)
        .when(is_syllable & (syllable % 28 > 0), F.concat(lead, vowel, tail))
        .when(is_syllable, F.concat(lead, vowel))
        .otherwise(F.coalesce(F.try_element_at(values, F.nullif(F.instr(keys, char), F.lit(0))), char))
    )


def strip_accents(text: Column) -> Column:
    """Every character folded, whatever the script; stays in the JVM.

    ASCII rows are returned as they are.  Others pass one ``translate``; only
    rows that may hold a character that becomes several are taken apart, after
    the frequent one of these, the ellipsis, is written out.
    """
    single, deleted, _ = folding_tables()
    source = "".join(single) + deleted
    target = "".join(single.values())
    dotted = F.replace(text, F.lit("\u2026"), F.lit("..."))
    characters = F.regexp_extract_all(dotted, F.lit("(?s)."), F.lit(0))
    pieces = F.array_join(F.transform(characters, _fold_several), "")
    taken_apart = F.when(dotted.rlike(rare_class()), pieces).otherwise(dotted)
    is_ascii = F.octet_length(text) == F.length(text)
    return F.when(is_ascii, text).otherwise(F.translate(taken_apart, source, target))
