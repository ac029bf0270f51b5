"""Words as runs of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased."""

from __future__ import annotations

# Every byte that is no part of a word becomes a space; bytes of characters beyond ASCII stay.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256)
)


def words(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text, in order."""
    return text.translate(_FOLD).split()
