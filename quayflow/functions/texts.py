"""Text clean-up and identifier rules for the reference tables."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four ASCII separators.
_SPACE = r"[\s\x1c-\x1f]+"
_EDGE_SPACE = rf"(?U)\A{_SPACE}|{_SPACE}\z"


def strip_space(text: Column) -> Column:
    """Drop white space of any kind at both ends; ``F.trim`` drops blanks only."""
    return F.regexp_replace(text, _EDGE_SPACE, "")


def text_or_empty(text: Column) -> Column:
    """Stripped text, with the empty string for NULL."""
    return F.coalesce(strip_space(text), F.lit(""))


@cache
def _accent_table() -> tuple[str, str]:
    """Lower-case letters that decompose to an ASCII letter plus marks, and that letter."""
    letters, plain = [], []
    for code in range(0xC0, 0x2000):
        char = chr(code)
        decomposed = unicodedata.normalize("NFD", char)
        if len(decomposed) > 1 and decomposed[0].isascii() and decomposed[0].islower():
            letters.append(char)
            plain.append(decomposed[0])
    return "".join(letters), "".join(plain)


def fold_accents(lower_text: Column) -> Column:
    """Replace accented lower-case letters by their base letter and drop loose marks."""
    letters, plain = _accent_table()
    marks = "".join(chr(code) for code in range(0x300, 0x370))
    # translate deletes the characters that have no counterpart
    return F.translate(lower_text, letters + marks, plain)


def normalise_name(name: Column) -> Column:
    """Lower-case, without accents, every other run of characters as one space."""
    folded = fold_accents(F.lower(name))
    return F.trim(F.regexp_replace(folded, "[^a-z0-9]+", " "))


def _extract(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def stop_number(stop_id: Column) -> Column:
    """``FR::monomodalStopPlace:45873:FR1`` to ``45873``."""
    return _extract(stop_id, r":(\d+):")


def stop_ref(number: Column) -> Column:
    """``45873`` to ``STIF:StopPoint:Q:45873:``."""
    return F.concat(F.lit("STIF:StopPoint:Q:"), number, F.lit(":"))


def line_code(line_id: Column) -> Column:
    """``FR1:Line:C01742:`` to ``C01742``."""
    return _extract(line_id, r":Line:([^:]+):")


def line_ref(code: Column) -> Column:
    """``C01742`` to ``STIF:Line::C01742:``."""
    return F.concat(F.lit("STIF:Line::"), code, F.lit(":"))
