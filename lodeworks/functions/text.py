"""Text cells of statistical sheets: labels, indentation, numbers, footnotes.

A hard blank (U+00A0) is a blank here, as are the other Unicode spaces; plain ``trim`` would keep them.
Trimming by a set of characters needs no pattern matching, which counts on rows this many.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks that stand for "no figure", and the starts of closing notes.
MISSING_MARKS = ["n.d.", "n.a.", "-", "", "s.i."]
NOTE_PATTERN = r"^(\(\d+\)|Fuente|Elaborad|n\.d\.|n\.a\.|Comisi)"

# Every character that counts as a blank.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_NUMBER = r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?$"
_SPECIAL = r"^[+-]?(nan|inf|infinity)$"


def strip_blanks(s: Column) -> Column:
    return F.btrim(s, F.lit(BLANKS))


def clean_label(s: Column) -> Column:
    """Label without its translation (after " / "), footnote marks and repeated blanks."""
    text = F.substring_index(s, " / ", 1)
    unmarked = F.when(text.contains("("), F.regexp_replace(text, r"\(\p{Nd}+\)", "")).otherwise(text)
    return strip_blanks(F.regexp_replace(unmarked, f"[{BLANKS}]+", " "))


def indent(s: Column) -> Column:
    """Number of leading blanks."""
    return F.length(s) - F.length(F.ltrim(s, F.lit(BLANKS)))


def is_note(s: Column) -> Column:
    """True for a footnote or source line, which ends a sheet's body."""
    return F.coalesce(strip_blanks(s).rlike(NOTE_PATTERN), F.lit(False))


def is_blank(s: Column) -> Column:
    return s.isNull() | (strip_blanks(s) == "")


def parse_number(s: Column) -> Column:
    """Number of a text cell, comma or point decimal; missing marks and other text give null."""
    text = F.lower(strip_blanks(s))
    plain = F.replace(text, F.lit(","), F.lit("."))
    digits = F.when(plain.rlike(_NUMBER), F.replace(plain, F.lit("_"), F.lit("")))
    special = F.when(plain.rlike(_SPECIAL), plain)
    return F.when(~text.isin(MISSING_MARKS), F.coalesce(digits, special).try_cast("double"))


def parse_value(num: Column, txt: Column) -> Column:
    """Number of a typed cell: the numeric part if there is one, else the parsed text."""
    return F.coalesce(num, parse_number(txt))
