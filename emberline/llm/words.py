"""The words that shingles and benchmark matching see: lower case, ASCII punctuation as space."""

from __future__ import annotations

import string

#: ASCII control characters and punctuation part words; every other character belongs to a word.
_APART = bytes(32 if i <= 32 or i == 127 or chr(i) in string.punctuation else i for i in range(128)) + bytes(range(128, 256))


def words(text: str | None) -> list[bytes]:
    """Words as UTF-8."""
    return text.lower().encode("utf-8", "replace").translate(_APART).split() if text else []
