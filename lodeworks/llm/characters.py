"""Characters whose class depends on the version of the Unicode tables."""

from __future__ import annotations

import unicodedata
from functools import cache

import numpy as np


@cache
def missing() -> np.ndarray:
    """True for each number of a character that this Python's Unicode tables do not have."""
    return np.array([unicodedata.category(chr(c)) == "Cn" for c in range(0x110000)])


def unsure(text: str) -> bool:
    """Whether a text has characters that libraries with other tables may class unlike each other."""
    return not text.isascii() and bool(missing()[np.frombuffer(text.encode("utf-32-le"), dtype="<u4")].any())
