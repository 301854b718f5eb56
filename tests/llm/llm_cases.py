"""Rows and helpers that the tests of the operators share."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


#: Rows that every operator must bear: nulls, empty and blank texts, a long one, equal rows, rows of one id.
ODD = [
    (None, None),
    (None, "a text without an id"),
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "x"),
    (5, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
    (5, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
    (6, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"),
    (6, "another text under the same id"),
    (7, "long " * 30_000 + "end"),
    (8, "éß 漢字 \U0001f600 \x00 token = \"abcdefghijklmnop\""),
]
