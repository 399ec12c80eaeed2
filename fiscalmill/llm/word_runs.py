"""Words of one text in bounded portions, from its UTF-8 bytes."""

from __future__ import annotations

import re
from collections.abc import Iterator

PORTION = 1 << 20
"""Bytes of a text whose words are listed at once. A portion ends after a separator, so no word is cut."""

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
"""Translation of A-Z to lower case; other bytes, parts of longer characters included, stay."""


def word_runs(raw: bytes, word: re.Pattern, gap: re.Pattern, overlap: int) -> Iterator[list[bytes]]:
    """Lists of consecutive words; each but the first begins with the last `overlap` words before it.

    `word` matches a word and `gap` one byte between words.
    """
    at, before = 0, []
    while at < len(raw):
        found = gap.search(raw, at + PORTION)
        end = found.end() if found else len(raw)
        words = before + word.findall(raw, at, end)
        yield words
        before = words[-overlap:] if overlap else []
        at = end
